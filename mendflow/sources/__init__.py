"""Reading and writing tables, rules and playbooks."""
