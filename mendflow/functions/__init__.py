"""Column expressions: row identity, transforms, rule names and signatures."""
