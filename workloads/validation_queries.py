"""Checks, rules, universal templates, row identity and quarantine routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from mendflow.functions import identity
from mendflow.operators import checks as C
from mendflow.operators import validate as V
from mendflow.sources import playbooks, rules
from workloads import fixtures as X
from workloads.registry import joined, names, query

DIRTY = f"WITH dirty AS ({X.sql('DIRTY')})\n"
CUSTOMERS = f"WITH customers AS ({X.sql('CUSTOMERS')})\n"


def _invalid(df, *checks, refs=None):
    return C.split(df, list(checks), refs)[1]


# --- checks ---------------------------------------------------------------------------------------

@query(DIRTY + """SELECT order_id, status, 'customer_id_nn' AS failed FROM dirty WHERE customer_id IS NULL""")
def check_not_null(spark, sf):
    bad = _invalid(X.frame(spark, sf, "DIRTY"), X.check("customer_id_nn", "is_not_null", column="customer_id"))
    return bad.select("order_id", "status", names("_error").alias("failed"))


@query(CUSTOMERS + """SELECT customer_key, name, 'name_set' AS failed FROM customers
WHERE name IS NULL OR trim(name) = ''""")
def check_not_empty(spark, sf):
    bad = _invalid(
        X.frame(spark, sf, "CUSTOMERS"), X.check("name_set", "is_not_null_and_not_empty", column="name")
    )
    return bad.select("customer_key", "name", names("_error").alias("failed"))


@query(DIRTY + """SELECT order_id, code FROM dirty WHERE NOT regexp_matches(code, '^[0-9]{5}$')""")
def check_regex(spark, sf):
    bad = _invalid(
        X.frame(spark, sf, "DIRTY"), X.check("code", "matches_regex", column="code", pattern="^[0-9]{5}$")
    )
    return bad.select("order_id", "code")


@query(CUSTOMERS + r"""SELECT customer_key, email FROM customers
WHERE NOT regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$')""")
def check_format(spark, sf):
    bad = _invalid(X.frame(spark, sf, "CUSTOMERS"), X.check("email", "has_format", column="email", format="email"))
    return bad.select("customer_key", "email")


@query(DIRTY + """SELECT order_id, status FROM dirty WHERE status NOT IN ('F', 'O', 'P')""")
def check_in_list(spark, sf):
    bad = _invalid(
        X.frame(spark, sf, "DIRTY"),
        X.check("status", "is_in_list", column="status", allowed=["F", "O", "P"]),
    )
    return bad.select("order_id", "status")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (
  SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n > 1""")
def check_unique(spark, sf):
    bad = _invalid(
        X.table(spark, sf, "lineitem"),
        X.check("line_unique", "is_unique", columns=["l_orderkey", "l_linenumber"]),
    )
    return bad.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("""SELECT doc_id, lang, n_chars FROM (
  SELECT *, count(*) OVER (PARTITION BY text) AS n FROM documents) WHERE n > 1""")
def check_unique_text(spark, sf):
    bad = _invalid(
        X.table(spark, sf, "documents"),
        X.check("text_unique", "is_unique", columns=["text"], by_digest=True),
    )
    return bad.select("doc_id", "lang", "n_chars")


@query(DIRTY + """SELECT order_id, customer_id, updated_at::DATE::VARCHAR AS updated_on FROM (
  SELECT *, count(*) OVER (PARTITION BY customer_id, lower(priority), status) AS n FROM dirty
) WHERE n > 1 AND customer_id IS NOT NULL""")
def check_unique_ci(spark, sf):
    bad = _invalid(
        X.frame(spark, sf, "DIRTY"),
        X.check("one_each", "is_unique", columns=["customer_id", "priority", "status"], ci_columns=["priority"]),
    )
    return bad.select("order_id", "customer_id", F.date_format("updated_at", "yyyy-MM-dd").alias("updated_on"))


@query(DIRTY + """SELECT order_id FROM (
  SELECT *, count(*) OVER (PARTITION BY customer_id, status) AS n FROM dirty) WHERE n > 1""")
def check_unique_nulls_equal(spark, sf):
    bad = _invalid(
        X.frame(spark, sf, "DIRTY"),
        X.check("one_each", "is_unique", columns=["customer_id", "status"], nulls_distinct=False),
    )
    return bad.select("order_id")


@query("""SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0""")
def check_range(spark, sf):
    bad = _invalid(
        X.table(spark, sf, "customer"), X.check("balance", "is_in_range", column="c_acctbal", min=0)
    )
    return bad.select("c_custkey", "c_acctbal")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE NOT (l_returnflag <> 'R' OR l_quantity < 40)""")
def check_expression(spark, sf):
    bad = _invalid(
        X.table(spark, sf, "lineitem"),
        X.check("segment", "sql_expression", expression="l_returnflag <> 'R' OR l_quantity < 40"),
    )
    return bad.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(DIRTY + """SELECT d.order_id, d.priority, o.o_orderpriority AS expected FROM dirty d
JOIN orders o ON d.order_id = o.o_orderkey WHERE d.priority IS DISTINCT FROM o.o_orderpriority""")
def check_cross_table(spark, sf):
    orders = X.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("priority")
    )
    bad = _invalid(
        X.frame(spark, sf, "DIRTY"),
        X.check("priority_mismatch", "sql_query", compare_column="priority",
                other_table="main.silver.other", join_keys=["order_id"]),
        refs={"main.silver.other": orders},
    )
    return bad.join(orders.withColumnRenamed("priority", "expected"), "order_id").select(
        "order_id", "priority", "expected"
    )


@query(DIRTY + """SELECT order_id, customer_id FROM dirty d WHERE customer_id IS NOT NULL
AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = d.customer_id AND c.c_mktsegment <> 'BUILDING')""")
def check_foreign_key(spark, sf):
    known = X.table(spark, sf, "customer").filter("c_mktsegment <> 'BUILDING'")
    bad = _invalid(
        X.frame(spark, sf, "DIRTY"),
        X.check("customer_known", "foreign_key", column="customer_id", ref_table="c", ref_column="c_custkey"),
        refs={"c": known},
    )
    return bad.select("order_id", "customer_id")


# --- validation -----------------------------------------------------------------------------------

@query(X.prelude() + f"""SELECT order_id, {X.failed_names(X.ERRORS)} AS errors,
  {X.failed_names(X.WARNINGS)} AS warnings FROM flags""")
def validate_all_rows(spark, sf):
    rows = C.evaluate(X.frame(spark, sf, "DIRTY"), X.CHECKS)
    return rows.select("order_id", names("_error").alias("errors"), names("_warning").alias("warnings"))


@query(X.prelude() + f"""SELECT 'valid' AS side, order_id, '' AS errors, '' AS warnings FROM flags
WHERE NOT ({' OR '.join(X.ERRORS)})
UNION ALL SELECT 'invalid', order_id, {X.failed_names(X.ERRORS)}, {X.failed_names(X.WARNINGS)}
FROM flags WHERE {' OR '.join(X.ERRORS + X.WARNINGS)}""")
def validate_split(spark, sf):
    valid, quarantine = V.validate(X.frame(spark, sf, "DIRTY"), X.CHECKS, X.SOURCE, "order_id", as_of=X.at(1))
    good = valid.select(
        F.lit("valid").alias("side"), "order_id", F.lit("").alias("errors"), F.lit("").alias("warnings")
    )
    return good.unionAll(
        quarantine.select(F.lit("invalid"), "order_id", names("_error"), names("_warning"))
    )


@query(X.prelude() + """SELECT order_id, sha256(CAST(order_id AS VARCHAR)) AS row_id, 'order_id' AS row_id_keys,
  '2024-01-01' AS generated_on, 'main.silver.orders' AS data_source, 'main.silver.orders' AS rule_sources,
  false AS is_cross_table FROM flags
WHERE f_cust OR f_code OR f_status OR f_amount OR f_priority""")
def quarantine_decorated(spark, sf):
    rows = V.validate(X.frame(spark, sf, "DIRTY"), X.CHECKS, X.SOURCE, "order_id", as_of=X.at(1))[1]
    return rows.select(
        "order_id", F.col("_row_id").alias("row_id"), F.col("_row_id_keys").alias("row_id_keys"),
        F.date_format("_generated_at", "yyyy-MM-dd").alias("generated_on"),
        F.col("_data_source").alias("data_source"), F.col("_rule_sources").alias("rule_sources"),
        F.col("_is_cross_table").alias("is_cross_table"),
    )


@query(DIRTY + """SELECT order_id,
  sha256(CAST(order_id AS VARCHAR) || chr(31) || status) AS row_id, 'order_id,status' AS row_id_keys,
  'main.silver.orders,main.silver.customers' AS data_source, true AS is_cross_table
FROM dirty WHERE customer_id IS NULL""")
def quarantine_cross_table(spark, sf):
    rows = V.validate(
        X.frame(spark, sf, "DIRTY"), X.CHECKS[:1], ["main.silver.orders", " main.silver.customers "],
        ["order_id", "status"], as_of=X.at(1),
    )[1]
    return rows.select(
        "order_id", F.col("_row_id").alias("row_id"), F.col("_row_id_keys").alias("row_id_keys"),
        F.col("_data_source").alias("data_source"), F.col("_is_cross_table").alias("is_cross_table"),
    )


@query(DIRTY + """SELECT order_id, sha256(coalesce(CAST(customer_id AS VARCHAR), chr(0) || 'NULL' || chr(0))
  || chr(31) || CAST(order_id AS VARCHAR)) AS row_id, 'customer_id,order_id' AS row_id_keys FROM dirty""")
def row_id_hash(spark, sf):
    rows = identity.with_row_id(X.frame(spark, sf, "DIRTY"), ["customer_id", " order_id "])
    return rows.select("order_id", F.col("_row_id").alias("row_id"), F.col("_row_id_keys").alias("row_id_keys"))


@query("""SELECT l_orderkey, l_linenumber, sha256(concat_ws(chr(31), l_orderkey, l_partkey, l_suppkey,
  l_linenumber, CAST(l_quantity AS DECIMAL(18, 2)), CAST(l_extendedprice AS DECIMAL(18, 2)),
  CAST(l_discount AS DECIMAL(18, 2)), CAST(l_tax AS DECIMAL(18, 2)), l_returnflag, l_linestatus,
  strftime(l_shipdate, '%Y-%m-%d %H:%M:%S'))) AS row_id, '' AS row_id_keys FROM lineitem""")
def row_id_whole_row(spark, sf):
    """Every column counts; numbers and times get a text form that does not depend on the engine."""
    df = X.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        *[F.col(c).cast("decimal(18,2)").alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
        "l_returnflag", "l_linestatus", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("l_shipdate"),
    )
    return identity.with_row_id(df).select(
        "l_orderkey", "l_linenumber", F.col("_row_id").alias("row_id"), F.col("_row_id_keys").alias("row_id_keys")
    )


# --- rules ----------------------------------------------------------------------------------------

RULES = f"WITH rules AS ({X.sql('RULES')})"
PARSED_RULES = RULES + """, approved AS (SELECT * FROM rules WHERE status = 'approved'),
bad AS (SELECT rule_id, table_fqn, NULL AS name, 'error' AS criticality, NULL AS function,
    CASE WHEN "check" = '' THEN 'empty ''check'' payload' ELSE 'invalid check payload' END AS problem
  FROM approved WHERE "check" = '' OR NOT json_valid("check")),
good AS (SELECT rule_id, table_fqn, "check"::JSON AS j FROM approved WHERE "check" <> '' AND json_valid("check")),
items AS (
  SELECT rule_id, table_fqn, j FROM good WHERE json_type(j) <> 'ARRAY'
  UNION ALL SELECT rule_id, table_fqn, unnest(json_extract(j, '$[*]')) FROM good WHERE json_type(j) = 'ARRAY')
"""


@query(PARSED_RULES + """SELECT rule_id, table_fqn, json_extract_string(j, '$.name') AS name,
  coalesce(json_extract_string(j, '$.criticality'), 'error') AS criticality,
  json_extract_string(j, '$.check.function') AS function, NULL AS problem
FROM items WHERE coalesce(lower(trim(json_extract_string(j, '$.user_metadata.monitor_only'))), '') <> 'true'
UNION ALL SELECT * FROM bad""")
def rules_approved(spark, sf):
    table = X.frame(spark, sf, "RULES")
    loaded = rules.load_rules(table, table.select("table_fqn"))
    return rules.parse_rules(loaded).select(
        "rule_id", "table_fqn", "name", "criticality", "function", "problem"
    )


@query(RULES + """SELECT rule_id, table_fqn FROM rules WHERE lower(status) = 'approved'
AND table_fqn IN ('main.silver.brand1', 'main.silver.brand7')""")
def rules_for_tables(spark, sf):
    table = X.frame(spark, sf, "RULES")
    wanted = ["main.silver.brand1", " main.silver.brand7 ", "main.silver.brand1", ""]
    return rules.load_rules(table, wanted, ignore_case=True).select("rule_id", "table_fqn")


@query("""SELECT DISTINCT concat('main.silver.part', p_partkey) AS table_fqn FROM part WHERE p_type = 'PROMO'""")
def rules_missing(spark, sf):
    parts = X.table(spark, sf, "part")
    owned = F.concat(F.lit("main.silver.part"), "p_partkey").alias("table_fqn")
    status = F.when(F.col("p_type") == "PROMO", "draft").otherwise("approved").alias("status")
    return rules.tables_without_rules(parts.select(owned, status), parts.select(owned))


UNIVERSAL = f"""WITH universal AS ({X.sql('UNIVERSAL')}),
newest AS (SELECT * FROM universal WHERE lower(status) = 'approved'
  QUALIFY row_number() OVER (PARTITION BY lower(rule_fqn)
    ORDER BY version DESC NULLS LAST, updated_at DESC NULLS LAST, rule_id) = 1)
"""


@query(UNIVERSAL + "SELECT rule_id, rule_fqn, version, \"check\" AS check_json FROM newest")
def universal_latest(spark, sf):
    return rules.latest_universal_rules(X.frame(spark, sf, "UNIVERSAL"))


@query(UNIVERSAL + """SELECT rule_id, version FROM newest WHERE lower(rule_fqn) = 'red plate'""")
def universal_by_name(spark, sf):
    found = rules.latest_universal_rules(X.frame(spark, sf, "UNIVERSAL"), " Red Plate ")
    return found.select("rule_id", "version")


@query(UNIVERSAL + """, wanted AS (SELECT DISTINCT upper(p_name) AS rule_fqn, p_brand AS column_name,
  CAST(substring(p_brand, 7) AS INTEGER) AS position FROM part),
lists AS (SELECT rule_fqn, string_agg(column_name, ',' ORDER BY position) AS csv,
  '["' || string_agg(column_name, '","' ORDER BY position) || '"]' AS listed FROM wanted GROUP BY rule_fqn)
SELECT n.rule_fqn, w.column_name,
  replace(replace(replace(replace(replace("check", '"{{columns}}"', listed), '{{columns_csv}}', csv),
    '__COLUMNS__', csv), '{{column}}', w.column_name), '${column}', w.column_name) AS check_json
FROM newest n JOIN wanted w ON w.rule_fqn = n.rule_fqn JOIN lists l ON l.rule_fqn = n.rule_fqn""")
def universal_bind(spark, sf):
    templates = rules.latest_universal_rules(X.frame(spark, sf, "UNIVERSAL"))
    columns = X.table(spark, sf, "part").select(
        F.upper("p_name").alias("rule_fqn"),
        F.col("p_brand").alias("column_name"),
        F.substring("p_brand", 7, 10).cast("int").alias("position"),
    )
    return rules.bind_universal_json(templates, columns)


@query(DIRTY + """SELECT order_id, concat_ws('|', CASE WHEN customer_id IS NULL THEN 'customer_id_set' END,
  CASE WHEN amount IS NULL THEN 'amount_set' END) AS errors,
  'set' AS rule_name, 'customer_id,amount' AS rule_columns, false AS is_cross_table
FROM dirty WHERE customer_id IS NULL OR amount IS NULL""")
def universal_validate(spark, sf):
    template = {"name": "{{column}}_set", "criticality": "error",
                "check": {"function": "is_not_null", "arguments": {"column": "${column}"}}}
    rows = V.validate_universal(
        X.frame(spark, sf, "DIRTY"), [template], ["customer_id", "amount", "customer_id"],
        X.SOURCE, "set", "order_id", as_of=X.at(1),
    )[1]
    return rows.select(
        "order_id", names("_error").alias("errors"), F.col("_rule_name").alias("rule_name"),
        F.col("_rule_columns").alias("rule_columns"), F.col("_is_cross_table").alias("is_cross_table"),
    )


# --- names ----------------------------------------------------------------------------------------

SOURCES = """SELECT l_orderkey AS run, concat(CASE WHEN l_linenumber = 7 THEN 'other' ELSE 'main' END, '.',
  CASE WHEN l_returnflag = 'R' THEN 'Silver' ELSE 'bronze' END, '.',
  CASE WHEN l_quantity = 50 THEN '' ELSE concat('table_with_a_longish_name_for_part_', l_partkey) END) AS source
FROM lineitem"""


@query(f"""WITH sources AS ({SOURCES}),
parts AS (SELECT DISTINCT run, string_split(lower(source), '.') AS p FROM sources),
runs AS (SELECT run, bool_and(p[3] <> '') AS ok, count(DISTINCT p[1]) AS catalogs, min(p[1]) AS catalog,
    count(DISTINCT p[2]) AS schemas, min(p[2]) AS schema, count(*) AS n,
    list_sort(list(p[2] || '_' || p[3])) AS segments, list_sort(list(p[3])) AS tables
  FROM parts GROUP BY run),
named AS (SELECT *, CASE WHEN n > 1 AND schemas = 1 THEN schema || '_' ELSE '' END AS prefix,
    CASE WHEN n = 1 THEN segments[1] WHEN schemas = 1 THEN schema || '_cross_table__' || array_to_string(tables, '__')
    ELSE 'cross_table__' || array_to_string(segments, '__') END AS name FROM runs)
SELECT run, CASE WHEN ok AND catalogs = 1 THEN catalog || '.quarantine.' ||
    CASE WHEN length(name) > 200 THEN prefix || 'cross_table__' || substring(sha1(array_to_string(segments, '|')), 1, 8)
    ELSE name END END AS quarantine_fqn,
  CASE WHEN NOT ok THEN 'malformed_table_name' WHEN catalogs > 1 THEN 'sources_span_catalogs' END AS error
FROM named""")
def route_quarantine(spark, sf):
    X.table(spark, sf, "lineitem").createOrReplaceTempView("lineitem")
    return V.route_quarantine(spark.sql(SOURCES))


@query("""WITH runs AS (SELECT concat('main.', split_part(p_name, ' ', 1), '_', split_part(p_name, ' ', 2), '.', p_type) AS a,
  concat('main.', split_part(p_name, ' ', 1), '.', split_part(p_name, ' ', 2), '_', p_type) AS b FROM part),
routed AS (SELECT lower('main.quarantine.' || replace(substring(a, 6), '.', '_')) AS q, lower(a) AS s FROM runs
  UNION ALL SELECT lower('main.quarantine.' || replace(substring(b, 6), '.', '_')), lower(b) FROM runs)
SELECT q AS quarantine_fqn FROM routed GROUP BY q HAVING count(DISTINCT s) > 1""")
def name_collisions(spark, sf):
    parts = X.table(spark, sf, "part").select(F.split("p_name", " ").alias("w"), "p_type")
    a = F.concat(F.lit("main."), F.col("w")[0], F.lit("_"), F.col("w")[1], F.lit("."), "p_type")
    b = F.concat(F.lit("main."), F.col("w")[0], F.lit("."), F.col("w")[1], F.lit("_"), "p_type")
    sources = parts.select(F.explode(F.array(a, b)).alias("source")).distinct()
    runs = sources.withColumn("run", F.col("source"))
    routed = V.route_quarantine(runs).withColumnRenamed("run", "sources")
    return V.name_collisions(routed)


NAME_SQL = r"""SELECT {key}, array_to_string(list_filter(list_distinct_ordered, lambda x:
  lower(split_part(x, '.', 2)) <> 'information_schema' AND lower(x) <> 'www.example.com'), '|') AS table_names
FROM (SELECT {key}, list_filter(found, lambda x, i: list_position(found, x) = i) AS list_distinct_ordered FROM (
  SELECT {key}, list_transform(regexp_extract_all({text},
    '`?([A-Za-z0-9_]+)`?\.`?([A-Za-z0-9_]+)`?\.`?([A-Za-z0-9_]+)`?'), lambda x: replace(x, '`', '')) AS found
  FROM {table}))"""


@query(NAME_SQL.format(key="page_id", text="concat(url, ' ', html)", table="pages"))
def extract_table_names(spark, sf):
    pages = X.table(spark, sf, "pages").withColumn("body", F.concat_ws(" ", "url", "html"))
    found = identity.extract_table_names(pages, "body", exclude=["www.example.com"])
    return found.select("page_id", joined("table_names").alias("table_names"))


@query(NAME_SQL.format(key="doc_id", text="text", table="documents"))
def extract_table_names_documents(spark, sf):
    found = identity.extract_table_names(X.table(spark, sf, "documents"), "text", exclude=["www.example.com"])
    return found.select("doc_id", joined("table_names").alias("table_names"))


# --- playbook files -------------------------------------------------------------------------------

ENTRIES = """SELECT p_brand AS dataset, CASE WHEN p_size = 3 THEN '' ELSE p_name END AS rule_name,
  CASE WHEN p_size = 4 THEN NULL ELSE CAST(p_partkey % 400 AS INT) END AS priority,
  CASE WHEN p_type = 'PROMO' THEN NULL ELSE concat('size = ', p_size) END AS {W},
  CASE p_type WHEN 'SMALL' THEN 'geocode' WHEN 'LARGE' THEN 'dedupe_keep_latest' WHEN 'PROMO' THEN 'reject_rows'
    WHEN 'MEDIUM' THEN 'standardize_value' ELSE 'fill_default' END AS strategy, p_size FROM part"""


@query("WITH e AS (" + ENTRIES.replace("{W}", "where_text") + """), p AS (
  SELECT *, count(*) OVER (PARTITION BY dataset, priority) AS np,
    count(*) OVER (PARTITION BY dataset, rule_name, coalesce(where_text, '')) AS nr FROM e),
found AS (
  SELECT *, unnest(list_filter([
    CASE WHEN rule_name = '' THEN 'rule_name missing' END,
    CASE WHEN priority IS NULL THEN 'priority missing' END,
    CASE WHEN strategy = 'geocode' THEN 'unknown strategy' END,
    CASE WHEN strategy = 'dedupe_keep_latest' AND p_size > 40 THEN 'partition_by missing' END,
    CASE WHEN strategy = 'dedupe_keep_latest' AND p_size < 10 THEN 'order_by missing' END,
    CASE WHEN strategy = 'standardize_value' AND p_size > 45 THEN 'transform missing' END,
    CASE WHEN strategy = 'fill_default' THEN 'default_expr missing' END,
    CASE WHEN strategy = 'dedupe_keep_latest' AND p_size = 20 THEN 'bad order_direction' END,
    CASE WHEN strategy = 'dedupe_keep_latest' AND p_size > 30 THEN 'ci_columns outside partition_by' END,
    CASE WHEN strategy = 'standardize_value' AND p_size BETWEEN 12 AND 45 THEN 'unknown transform' END,
    CASE WHEN np > 1 AND priority IS NOT NULL THEN 'duplicate priority' END,
    CASE WHEN nr > 1 THEN 'duplicate rule_name and where' END,
    CASE WHEN p_size > 30 THEN 'unknown column' END
  ], lambda x: x IS NOT NULL)) AS problem FROM p)
SELECT dataset, rule_name, priority, where_text, strategy, problem FROM found""")
def playbook_lint(spark, sf):
    X.table(spark, sf, "part").createOrReplaceTempView("part")
    size = F.col("p_size")

    def param(name, value):
        return F.struct(F.lit(name).alias("key"), value.alias("value"))

    params = F.map_from_entries(
        F.filter(
            F.array(
                param("column", F.lit("p_name")),
                param("transform", F.when(size < 12, "trim").when(size <= 45, "shout")),
                param("partition_by", F.when(size > 40, "[]").otherwise('["p_name","p_size"]')),
                param("ci_columns", F.when(size > 30, '["p_color"]')),
                param("order_by", F.when(size >= 10, "p_size")),
                param("order_direction", F.when(size == 20, "newest")),
            ),
            lambda e: e["value"].isNotNull(),
        )
    )
    entries = spark.sql(ENTRIES.replace("{W}", "`where`")).withColumn("params", params)
    brands = X.table(spark, sf, "part").select(F.col("p_brand").alias("dataset")).distinct()
    columns = brands.withColumn("column_name", F.explode(F.array(F.lit("p_name"), F.lit("p_size"))))
    return playbooks.lint_entries(entries, columns).withColumnRenamed("where", "where_text")
