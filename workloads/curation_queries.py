"""Triage, playbook repair, transforms and proposal-based curation."""

from __future__ import annotations

from pyspark.sql import functions as F

from mendflow import schemas as S
from mendflow.functions import transforms
from mendflow.operators import curate, induce, lookup, playbook, probe, profile, reingest
from mendflow.operators import queue as Q
from mendflow.operators.checks import split
from mendflow.sources import tables
from workloads import fixtures as X
from workloads.registry import day, joined, names, query, sorted_map

VIOLATIONS = "string_split(violations, '|')"


# --- triage ---------------------------------------------------------------------------------------

@query(X.prelude() + """SELECT order_id, amount, row_id, '2024-01-0' || pass AS generated_on FROM latest""")
def latest_per_row(spark, sf):
    rows = lookup.latest_per_row(X.quarantine(spark, sf))
    return rows.select(
        "order_id", "amount", F.col("_row_id").alias("row_id"), day("_generated_at").alias("generated_on")
    )


@query("""SELECT user_id, event_type, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1""")
def latest_event(spark, sf):
    rows = lookup.latest_per_row(X.table(spark, sf, "events"), ["user_id", "event_type"], "ts", ["event_id"])
    return rows.select("user_id", "event_type", "event_id")


@query(X.prelude() + "SELECT order_id, violations FROM latest")
def rule_violations(spark, sf):
    return X.latest(spark, sf).select("order_id", joined("rule_violations").alias("violations"))


OLD_QUEUE = "SELECT DISTINCT row_id FROM quarantine WHERE pass = 3"
STAMP = "CASE pass WHEN 1 THEN '2024-01-01 00:00:00' WHEN 2 THEN '2024-01-02 00:00:00' ELSE '2024-01-03 00:00:00' END"


def _empty_queue(spark):
    return spark.createDataFrame([], S.QUEUE_DDL)


def _old_queue(spark, sf, status="reingested"):
    """A queue made by triaging only the third pass."""
    third = X.quarantine(spark, sf).filter(F.col("_generated_at") == X.at(3))
    queue = Q.triage(third, _empty_queue(spark), X.FQN, "run1", X.at(3))
    return queue.withColumn("status", F.lit(status))


@query(X.prelude(f"old AS ({OLD_QUEUE})") + f"""SELECT sha256('{X.FQN}' || chr(31) || row_id || chr(31) || {STAMP}) AS review_id,
  row_id, violations, 'pending' AS status, 0::INTEGER AS retry_count, 'main.silver.orders' AS data_source,
  '2024-01-0' || pass AS generated_on, 'run2' AS run_id
FROM latest WHERE row_id NOT IN (SELECT row_id FROM old)""")
def triage_new(spark, sf):
    new = Q.triage(X.quarantine(spark, sf), _old_queue(spark, sf), X.FQN, "run2", X.at(4))
    return new.select(
        "review_id", "row_id", joined("rule_violations").alias("violations"), "status", "retry_count",
        "data_source", day("quarantine_generated_at").alias("generated_on"), "run_id",
    )


@query(X.prelude("old AS (SELECT row_id, min(pass) AS seen FROM quarantine WHERE pass < 3 GROUP BY row_id)")
       + """SELECT l.order_id, l.pass FROM latest l LEFT JOIN old o USING (row_id) WHERE o.seen IS NULL OR l.pass > o.seen""")
def triage_requeue(spark, sf):
    rows = X.quarantine(spark, sf)
    early = rows.filter(F.col("_generated_at") < X.at(3))
    first = early.groupBy("_row_id").agg(F.min("_generated_at").alias("t"))
    queue = first.select(
        F.lit(X.FQN).alias("quarantine_fqn"), F.col("_row_id").alias("row_id"),
        F.lit(S.REINGESTED).alias("status"), F.col("t").alias("quarantine_generated_at"),
    )
    new = Q.triage(rows, queue, X.FQN, "run2", X.at(4), requeue="newer")
    ids = rows.select(F.col("_row_id").alias("row_id"), "order_id").distinct()
    return new.join(ids, "row_id").select(
        "order_id", F.dayofmonth("quarantine_generated_at").alias("pass")
    )


@query(f"""WITH queue AS ({X.sql('QUEUE')}) SELECT review_id, quarantine_fqn FROM queue
WHERE quarantine_fqn <> 'main.quarantine.silver_low'""")
def reset_queue(spark, sf):
    kept = Q.reset_queue(X.frame(spark, sf, "QUEUE"), "main.quarantine.silver_low")
    return kept.select("review_id", "quarantine_fqn")


# --- playbook -------------------------------------------------------------------------------------

ROUTED = """routed AS (SELECT *, CASE
    WHEN f_status AND status = 'Invalid' THEN 0 WHEN f_status AND status = 'Duplicate' THEN 1
    WHEN f_priority THEN 2 WHEN f_cust THEN 3 END AS entry_idx FROM latest),
ranked AS (SELECT *, row_number() OVER (PARTITION BY entry_idx, customer_id
    ORDER BY updated_at DESC NULLS LAST, row_id) AS rn FROM routed),
handled AS (SELECT *,
    CASE entry_idx WHEN 0 THEN 'status_is_not_in_the_list' WHEN 1 THEN 'status_is_not_in_the_list'
      WHEN 2 THEN 'priority_not_standard' ELSE 'customer_id_is_null' END AS playbook_rule,
    CASE entry_idx WHEN 0 THEN 'reject' WHEN 1 THEN CASE WHEN rn = 1 THEN 'keep' ELSE 'drop' END
      ELSE 'patch_fields' END AS action,
    CASE entry_idx WHEN 0 THEN 'reason=status is invalid'
      WHEN 1 THEN CASE WHEN rn = 1 THEN '' ELSE 'reason=duplicate_key_superseded_by_latest' END
      WHEN 2 THEN 'priority=' || trim(upper(priority)) ELSE 'customer_id=0' END AS payload
  FROM ranked WHERE entry_idx IS NOT NULL)"""


def _usable():
    return playbook.usable_entries(X.ENTRIES, X.FQN)


@query(X.prelude(ROUTED) + "SELECT order_id, entry_idx::INTEGER AS entry_idx FROM routed")
def playbook_route(spark, sf):
    return playbook.route_playbook(X.latest(spark, sf), _usable()).select("order_id", "entry_idx")


@query(X.prelude(ROUTED) + "SELECT order_id, playbook_rule, action, payload FROM handled")
def playbook_apply(spark, sf):
    done = playbook.apply_playbook(X.latest(spark, sf), _usable())
    return done.select(
        "order_id", "playbook_rule", F.col("remediation_action").alias("action"),
        sorted_map("action_payload").alias("payload"),
    )


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN rn = 1 THEN 'keep' ELSE 'drop' END AS action FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC NULLS LAST,
      concat_ws('|', l_partkey, l_suppkey, l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT))) AS rn FROM lineitem)""")
def dedupe_latest(spark, sf):
    lines = X.table(spark, sf, "lineitem").withColumn(
        "row_id",
        F.concat_ws("|", "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", F.col("l_quantity").cast("bigint")),
    )
    done = playbook.dedupe_keep_latest(
        lines, {"partition_by": ["l_orderkey", "l_linenumber"], "order_by": "l_shipdate"}
    )
    return done.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("remediation_action").alias("action")
    )


@query(f"""WITH dirty AS ({X.sql('DIRTY')}) SELECT order_id, CASE WHEN rn = 1 THEN 'keep' ELSE 'drop' END AS action,
  CASE WHEN rn = 1 THEN '' ELSE 'reason=duplicate_key_superseded_by_latest' END AS payload FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id, lower(priority)
    ORDER BY order_ts ASC NULLS LAST, CAST(order_id AS VARCHAR)) AS rn FROM dirty)""")
def dedupe_ci(spark, sf):
    rows = X.frame(spark, sf, "DIRTY").withColumn("row_id", F.col("order_id").cast("string"))
    done = playbook.dedupe_keep_latest(
        rows,
        {"partition_by": ["customer_id", "priority"], "ci_columns": ["priority"], "order_by": "order_ts",
         "order_direction": "asc"},
    )
    return done.select(
        "order_id", F.col("remediation_action").alias("action"), sorted_map("action_payload").alias("payload")
    )


@query(f"""WITH dirty AS ({X.sql('DIRTY')}) SELECT order_id, 'patch_fields' AS action,
  'priority=' || trim(upper(priority)) AS payload FROM dirty""")
def standardize(spark, sf):
    done = playbook.standardize_value(
        X.frame(spark, sf, "DIRTY"), {"column": "priority", "transform": "upper_trim"}
    )
    return done.select(
        "order_id", F.col("remediation_action").alias("action"), sorted_map("action_payload").alias("payload")
    )


@query(f"""WITH dirty AS ({X.sql('DIRTY')}) SELECT order_id,
  CASE WHEN customer_id IS NULL THEN 'customer_id=' || (order_id + 1) ELSE '' END AS payload,
  'customer_id=' || (order_id + 1) AS payload_overwrite FROM dirty""")
def fill_default(spark, sf):
    dirty = X.frame(spark, sf, "DIRTY")
    params = {"column": "customer_id", "default_expr": "order_id + 1"}
    kept = playbook.fill_default(dirty, params).withColumnRenamed("action_payload", "kept").drop("remediation_action")
    both = playbook.fill_default(kept, {**params, "overwrite": True})
    return both.select(
        "order_id", sorted_map("kept").alias("payload"), sorted_map("action_payload").alias("payload_overwrite")
    )


@query(X.prelude() + """SELECT order_id, 'reject' AS action, 'reason=rejected_by_playbook' AS payload FROM latest""")
def reject(spark, sf):
    done = playbook.reject_rows(X.latest(spark, sf), {})
    return done.select(
        "order_id", F.col("remediation_action").alias("action"), sorted_map("action_payload").alias("payload")
    )


QUEUE_STATUS = """CASE WHEN action = 'drop' THEN 'resolved_duplicate' WHEN action = 'reject' THEN 'rejected'
  WHEN action IS NULL THEN 'pending' ELSE 'curated' END"""


@query(X.prelude(ROUTED, f"old AS ({OLD_QUEUE})") + f"""SELECT l.row_id,
  CASE WHEN o.row_id IS NOT NULL THEN 'escalated' ELSE {QUEUE_STATUS} END AS status,
  CASE WHEN o.row_id IS NULL AND action IS NOT NULL THEN 'playbook' END AS source,
  CASE WHEN o.row_id IS NULL THEN playbook_rule END AS strategy,
  CASE WHEN o.row_id IS NULL THEN action END AS action,
  CASE WHEN o.row_id IS NULL THEN payload END AS payload,
  CASE WHEN o.row_id IS NULL AND action IS NOT NULL THEN 1.0::DOUBLE END AS confidence
FROM latest l LEFT JOIN handled h USING (row_id) LEFT JOIN old o ON o.row_id = l.row_id""")
def playbook_queue_update(spark, sf):
    rows = X.quarantine(spark, sf)
    old = _old_queue(spark, sf, "escalated")
    queue = old.unionByName(Q.triage(rows, old, X.FQN, "run2", X.at(4)))
    done = playbook.apply_playbook(Q.latest_quarantined(rows), _usable())
    updated = Q.apply_queue_updates(queue, playbook.playbook_updates(done, X.FQN, "run2", X.at(4)))
    return updated.select(
        "row_id", "status", F.col("remediation_source").alias("source"),
        F.col("playbook_strategy").alias("strategy"), F.col("remediation_action").alias("action"),
        sorted_map("proposed_fix").alias("payload"), "confidence",
    )


# --- transforms -----------------------------------------------------------------------------------

def _tx(df, column, **steps):
    """One output column per named transform chain."""
    return {name: transforms.chain(s if isinstance(s, list) else [s], column) for name, s in steps.items()}


@query(f"""WITH dirty AS ({X.sql('DIRTY')}) SELECT order_id, trim(priority) AS t_trim, lower(priority) AS t_lower,
  upper(priority) AS t_upper, trim(lower(priority)) AS t_lower_trim, trim(upper(priority)) AS t_upper_trim FROM dirty""")
def tx_string(spark, sf):
    df = X.frame(spark, sf, "DIRTY")
    made = _tx(
        df, "priority", **{f"t_{t}": {"transform": t} for t in ("trim", "lower", "upper", "lower_trim", "upper_trim")}
    )
    return df.select("order_id", *[e.alias(n) for n, e in made.items()])


@query("""SELECT doc_id, md5(regexp_replace(text, '[A-Za-z]+', '#', 'g')) AS replaced,
  regexp_extract(text, '([A-Za-z]+) ([a-z]+)', 2) AS second_word, regexp_extract(text, '[0-9]+', 0) AS digits
FROM documents""")
def tx_regex(spark, sf):
    df = X.table(spark, sf, "documents")
    made = _tx(
        df, "text",
        replaced={"transform": "regexp_replace", "pattern": "[A-Za-z]+", "replacement": "#"},
        second_word={"transform": "regexp_extract", "pattern": "([A-Za-z]+) ([a-z]+)", "group": 2},
        digits={"transform": "regexp_extract", "pattern": "[0-9]+"},
    )
    made["replaced"] = F.md5(made["replaced"])
    return df.select("doc_id", *[e.alias(n) for n, e in made.items()])


DATES = """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN concat('n/a ', o_orderpriority)
  ELSE {FMT} END AS text FROM orders"""


@query("WITH d AS (" + DATES.replace("{FMT}", "strftime(o_orderdate, '%d/%m/%Y %H:%M')") + """)
SELECT o_orderkey, strftime(try_strptime(text, '%d/%m/%Y %H:%M'), '%Y-%m-%d') AS as_date,
  strftime(try_strptime(text, '%d/%m/%Y %H:%M'), '%Y-%m-%d %H:%M:%S') AS as_timestamp FROM d""")
def tx_date(spark, sf):
    orders = X.table(spark, sf, "orders")
    text = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("n/a "), "o_orderpriority")).otherwise(
        F.date_format("o_orderdate", "dd/MM/yyyy HH:mm")
    )
    df = orders.select("o_orderkey", text.alias("text"))
    made = _tx(
        df, "text", as_date={"transform": "to_date", "from_format": "dd/MM/yyyy HH:mm"},
        as_timestamp={"transform": "to_timestamp", "from_format": "dd/MM/yyyy HH:mm"},
    )
    return df.select("o_orderkey", *[e.alias(n) for n, e in made.items()])


@query("""WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_extendedprice AS BIGINT)::VARCHAR AS v FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN length(v) > 5 THEN v ELSE lpad(v, 5, '0') END AS lp,
  lpad(v, 4, '*') AS lp_cut, CASE WHEN length(v) > 7 THEN v ELSE rpad(v, 7, 'x') END AS rp,
  substring(v, 2) AS sub, substring(v, 2, 2) AS sub_len, substring(v, -2) AS sub_end FROM t""")
def tx_pad(spark, sf):
    # round half even on both sides comes from the same double
    df = X.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.rint("l_extendedprice").cast("bigint").cast("string").alias("v")
    )
    made = _tx(
        df, "v", lp={"transform": "left_pad", "length": 5},
        lp_cut={"transform": "left_pad", "length": 4, "pad": "*", "truncate": True},
        rp={"transform": "right_pad", "length": "7", "pad": "x"}, sub={"transform": "substring", "pos": 2},
        sub_len={"transform": "substring", "pos": 2, "len": 2}, sub_end={"transform": "substring", "pos": -2},
    )
    return df.select("l_orderkey", "l_linenumber", "l_partkey", *[e.alias(n) for n, e in made.items()])


@query(f"""WITH dirty AS ({X.sql('DIRTY')}) SELECT order_id, coalesce(CAST(customer_id AS VARCHAR), 'none') AS filled,
  NULL::VARCHAR AS emptied, lpad(regexp_replace(code, '^[A-Za-z]+', '', 'g'), 5, '0') AS chained FROM dirty""")
def tx_null_and_chain(spark, sf):
    df = X.frame(spark, sf, "DIRTY")
    fixes = [
        {"column": "code", "transform": "regexp_replace", "pattern": "^[A-Za-z]+"},
        {"column": "nope", "transform": "trim"},
        {"column": "code", "transform": "left_pad", "length": 5},
        {"column": "customer_id", "transform": "set_default", "value": "none"},
    ]
    made = transforms.build_column_exprs(fixes, df.columns)
    emptied = transforms.chain([{"transform": "set_null"}], "status")
    return df.select(
        "order_id", made["customer_id"].alias("filled"), emptied.alias("emptied"), made["code"].alias("chained")
    )


# --- curation -------------------------------------------------------------------------------------

def _curatable(spark, sf):
    """Rows no playbook entry covers, with their signature."""
    rest = playbook.route_playbook(X.latest(spark, sf), _usable()).filter("entry_idx is null").drop("entry_idx")
    return curate.with_signature(rest)


REST = "rest AS (SELECT * FROM routed WHERE entry_idx IS NULL)"


@query(X.prelude() + "SELECT order_id, signature FROM latest")
def signatures(spark, sf):
    return curate.with_signature(X.latest(spark, sf)).select("order_id", "signature")


@query(X.prelude("""facts AS (SELECT *, concat_ws(',', CASE WHEN f_amount THEN 'amount' END, CASE WHEN f_code THEN 'code' END,
    CASE WHEN f_cust THEN 'customer_id' END, CASE WHEN f_priority THEN 'priority' END,
    CASE WHEN f_status THEN 'status' END) AS flagged,
  row_number() OVER (PARTITION BY signature ORDER BY row_id) AS rn FROM latest)""") + """
SELECT signature, count(*) AS n_rows, signature AS rules, min(flagged) AS flagged,
  string_agg(CASE WHEN rn <= 15 THEN CASE WHEN f_code THEN code WHEN f_status THEN status
    WHEN f_priority THEN priority END END, '/' ORDER BY rn) AS sample
FROM facts GROUP BY signature""")
def signature_profile(spark, sf):
    found = curate.signature_profiles(curate.with_signature(X.latest(spark, sf)))
    def value(sample, column):
        named = F.filter(sample, lambda p: p["column"] == column)
        return F.try_element_at(named, F.lit(1))["value"]

    shown = F.transform(
        "samples", lambda s: F.coalesce(*[value(s, c) for c in ("code", "status", "priority")])
    )
    sample = F.array_join(shown, "/")
    return found.select(
        "signature", "n_rows", joined(F.transform("rules", lambda r: r["name"])).alias("rules"),
        F.array_join("flagged", ",").alias("flagged"), F.when(sample != "", sample).alias("sample"),
    )


@query(f"""WITH silver AS ({X.sql('SILVER')}), v AS (
  SELECT DISTINCT 'code' AS "column", code AS value FROM silver
  UNION SELECT 'status', status FROM silver UNION SELECT 'customer_id', CAST(customer_id AS VARCHAR) FROM silver)
SELECT "column", value FROM v WHERE value IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY value) <= 5""")
def passing_examples(spark, sf):
    return curate.passing_examples(
        X.frame(spark, sf, "SILVER"), ["code", "status", "customer_id", "confidence", "absent"]
    )


@query("WITH r AS (" + X.sql("REPLIES") + """), j AS (SELECT signature, reply, CASE
  WHEN reply LIKE 'Here%' THEN regexp_extract(reply, '\\{"decision.*\\}', 0)::JSON
  WHEN reply LIKE 'As %' THEN {'decision': 'fix', 'fixes': [{'length': '7'}], 'confidence': 0.85,
    'reasoning': concat('None of ', regexp_extract(reply, 'None of ([^"]*)"', 1))}::JSON END AS j FROM r)
SELECT signature, coalesce(json_extract_string(j, '$.decision'), 'escalate') AS decision,
  coalesce('column=code;length=' || json_extract_string(j, '$.fixes[0].length')
    || CASE WHEN reply LIKE 'As %' THEN ';pad=<null>' ELSE '' END || ';transform=left_pad', '') AS fixes,
  coalesce(json_extract_string(j, '$.confidence')::DOUBLE, 0) AS confidence,
  coalesce(json_extract_string(j, '$.reasoning'), 'agent_unavailable: no decision in reply') AS reasoning FROM j""")
def parse_replies(spark, sf):
    found = curate.parse_replies(X.frame(spark, sf, "REPLIES"))
    fixes = F.array_join(F.transform("fixes", sorted_map), "/")
    return found.select("signature", "decision", fixes.alias("fixes"), "confidence", "reasoning")


@query("""SELECT 's' || c_custkey AS signature, CASE WHEN c_custkey % 5 = 0 THEN 'escalate' ELSE 'reject' END AS decision,
  CAST(CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE 0.75 END AS DOUBLE) AS confidence,
  CASE WHEN c_custkey % 5 = 0 THEN 'agent_unavailable: no decision in reply' ELSE 'unlike } or { of ' || c_custkey END AS reasoning
FROM customer""")
def parse_nested_replies(spark, sf):
    """Decisions among other objects, with up to eleven levels inside, braces in strings, and replies cut short."""
    key = F.col("c_custkey").cast("string")
    depth = (F.col("c_custkey") % 12).cast("int")
    extra = F.concat(F.repeat(F.lit('{"a": ['), depth), F.lit("1"), F.repeat(F.lit("]}"), depth))
    decision = F.concat(
        F.lit('{"decision": "reject", "extra": '), extra, F.lit(', "confidence": 0.75, "reasoning": "unlike } or { of '), key, F.lit('"')
    )
    end = F.when(F.col("c_custkey") % 5 == 0, "").otherwise("}")
    text = F.concat(F.lit('Taking {this} in, it\'s {"n": {"n": 1}} and so '), decision, end, F.lit(" as asked {"))
    replies = X.table(spark, sf, "customer").select(F.concat(F.lit("s"), key).alias("signature"), text.alias("reply"))
    return curate.parse_replies(replies).select("signature", "decision", "confidence", "reasoning")


@query(X.prelude() + r""", v AS (SELECT status AS signature, unnest([
    {'column': 'code', 'value': code}, {'column': 'priority', 'value': priority}, {'column': 'customer_id', 'value': customer_id::VARCHAR}]) AS x
  FROM dirty WHERE order_id % 30 < 10), s AS (SELECT signature, x.column AS "column", x.value AS value, array_to_string(list_transform(
    regexp_extract_all(x.value, '[0-9]+|[A-Z]+|[a-z]+|\s+|.'), lambda t: CASE WHEN regexp_matches(t, '^[0-9]') THEN 'D' || length(t)
      WHEN regexp_matches(t, '^[A-Z]') THEN 'U' || length(t) WHEN regexp_matches(t, '^[a-z]') THEN 'L' || length(t)
      WHEN regexp_matches(t, '^\s') THEN 'S' || length(t) ELSE '=' || t END), chr(9)) AS shape FROM v),
t AS (SELECT signature, "column", shape, count(*) AS n FROM s WHERE value IS NOT NULL GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY signature, "column" ORDER BY n DESC, shape) AS r FROM t)
SELECT signature, "column", count(*) AS n_rows, count(*) FILTER (WHERE value IS NULL) AS n_nulls,
  count(DISTINCT value) AS n_distinct, max(b.shape) AS shape, max(b.n) AS shape_rows,
  min(TRY_CAST(value AS DOUBLE)) AS least, max(TRY_CAST(value AS DOUBLE)) AS most
FROM s JOIN b USING (signature, "column") WHERE b.r = 1 GROUP BY signature, "column" HAVING count(*) < 1000""")
def signature_patterns(spark, sf):
    """Profiles of three appends, merged: rows, nulls, distinct values, commonest shape and range of each column."""
    rows = X.frame(spark, sf, "DIRTY").withColumnRenamed("status", "signature")
    parts = [
        profile.profile(rows.filter(F.col("order_id") % 30 % 3 == i).filter("order_id % 30 < 10"), ["code", "priority", "customer_id"])
        for i in range(3)
    ]
    found = profile.read_profile(profile.merge_profiles(parts), shapes=20).filter("n_rows < 1000")
    first = F.get("shapes", F.lit(0))
    return found.filter("signature is not null").select(
        "signature", "column", "n_rows", "n_nulls", "n_distinct", first["shape"].alias("shape"), first["n_rows"].alias("shape_rows"),
        F.get("quantiles", F.lit(0)).alias("least"), F.get("quantiles", F.lit(2)).alias("most"),
    )


#: Order lines' texts as they should be, and as they came: eight ways to be wrong.
_SHAPES = """shaped AS (SELECT o_orderkey % 8 AS kind, o_orderkey, lpad(CAST(o_orderkey % 10000 AS {S}), 5, '0') AS code,
  {DAY} AS day, concat(CAST(100 + o_custkey % 900 AS {S}), '-', CAST(1000 + o_orderkey % 9000 AS {S})) AS phone FROM orders)"""
_CAME = """came AS (SELECT o_orderkey, kind,
  CASE kind WHEN 0 THEN concat('A', CAST(o_orderkey % 10000 AS {S})) WHEN 1 THEN concat(code, '-X') ELSE code END AS code,
  CASE kind WHEN 2 THEN concat_ws('/', substring(day, 9, 2), substring(day, 6, 2), substring(day, 1, 4))
    WHEN 3 THEN concat(substring(day, 1, 4), substring(day, 6, 2), substring(day, 9, 2)) ELSE day END AS day,
  CASE kind WHEN 4 THEN replace(phone, '-', '.') WHEN 5 THEN replace(phone, '-', '') WHEN 6 THEN concat(' +1 ', phone) ELSE phone END AS phone
  FROM shaped)"""


@query("WITH " + _SHAPES.format(S="VARCHAR", DAY="strftime(o_orderdate, '%Y-%m-%d')") + """
SELECT o_orderkey, kind, code, day, phone FROM shaped WHERE kind < 7""")
def induced_repairs(spark, sf):
    """Prefixes, suffixes, date formats and separators are mended by chains found from the values alone."""
    orders = X.table(spark, sf, "orders")
    view = F.date_format("o_orderdate", "yyyy-MM-dd")
    parts = {"S": "STRING", "DAY": "day"}
    sql = "WITH " + ", ".join(t.format(**parts) for t in (_SHAPES, _CAME)) + " SELECT * FROM came"
    came = spark.sql(sql.replace("FROM orders", "FROM {orders}"), orders=orders.withColumn("day", view))
    folder = tables.scratch_folder(spark)  # every source then reads its own rows, and the good ones
    came.write.partitionBy("kind").parquet(folder)
    came = spark.read.schema(came.schema).parquet(folder)
    checks = [
        X.check("code_shape", "matches_regex", column="code", pattern="^[0-9]{5}$"),
        X.check("day_shape", "matches_regex", column="day", pattern="^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
        X.check("phone_shape", "matches_regex", column="phone", pattern="^[0-9]{3}-[0-9]{4}$"),
    ]
    out = None
    for kind in range(7):  # every source has its own way to be wrong
        good, bad = split(came.filter(F.col("kind").isin(kind, 7)), checks)
        rows = curate.with_signature(bad.withColumn("rule_violations", F.transform("_error", lambda e: e["name"])))
        rows = tables.cut_lineage(rows.withColumn("row_id", F.col("o_orderkey").cast("string")))  # six steps read them
        found = induce.induced_candidates(rows, good, checks)
        decided = curate.apply_proposals(rows, curate.search_transforms(rows, checks, found))
        mended = reingest.apply_patch(
            rows.select("row_id", "o_orderkey", "kind", "code", "day", "phone").join(decided.select("row_id", "proposed_fix"), "row_id"),
            columns=["o_orderkey", "kind", "code", "day", "phone"],
        ).select("o_orderkey", "kind", "code", "day", "phone")
        mended = tables.cut_lineage(mended)  # the driver then never plans and runs the joins of all sources at once
        out = mended if out is None else out.unionByName(mended)
    return out


# Proposals for the derived order table, keyed by signature.
PROPOSALS = [
    ("code_not_matching_regex", "fix",
     [{"column": "code", "transform": "regexp_replace", "pattern": "^[A-Za-z]+"},
      {"column": "code", "transform": "left_pad", "length": "5"},
      {"column": "status", "transform": "lower"}], 0.9, "strip prefix"),
    ("amount_not_positive", "fix", [{"column": "amount", "transform": "trim"}], 0.95, "trim it"),
    ("amount_not_positive|code_not_matching_regex", "fix",
     [{"column": "amount", "transform": "regexp_replace", "pattern": "-"}], 0.6, "drop sign"),
    ("amount_not_positive|customer_id_is_null", "reject", [], 0.7, "hopeless"),
    ("code_not_matching_regex|customer_id_is_null", "fix", [{"column": "code", "transform": "reverse"}], 0.9, "reverse"),
]


def _proposals(spark):
    return spark.createDataFrame(PROPOSALS, S.PROPOSAL_DDL)


SQL_DECISIONS = """decided AS (SELECT *, CASE
    WHEN signature IN ('code_not_matching_regex', 'amount_not_positive|code_not_matching_regex') THEN 'fix'
    WHEN signature = 'amount_not_positive|customer_id_is_null' THEN 'reject' ELSE 'escalate' END AS decision,
  CASE signature WHEN 'code_not_matching_regex' THEN 0.9
    WHEN 'amount_not_positive|code_not_matching_regex' THEN 0.6
    WHEN 'amount_not_positive|customer_id_is_null' THEN 0.7 ELSE 0.0 END::DOUBLE AS confidence,
  CASE signature WHEN 'code_not_matching_regex' THEN 'strip prefix'
    WHEN 'amount_not_positive|code_not_matching_regex' THEN 'drop sign'
    WHEN 'amount_not_positive|customer_id_is_null' THEN 'hopeless'
    WHEN 'amount_not_positive' THEN 'proposed transform was a no-op (before == after): trim it'
    WHEN 'code_not_matching_regex|customer_id_is_null' THEN 'bad_transform: reverse'
    ELSE 'agent_unavailable: no proposal' END AS reasoning,
  CASE signature WHEN 'code_not_matching_regex' THEN 'code=' || lpad(regexp_replace(code, '^[A-Za-z]+', ''), 5, '0')
    WHEN 'amount_not_positive|code_not_matching_regex' THEN 'amount=' || replace(amount_text, '-', '') END AS fix
  FROM (SELECT *, CAST(CAST(amount AS DECIMAL(18, 2)) AS VARCHAR) AS amount_text FROM latest) l)"""


def _decision_rows(spark, sf):
    """Latest rows with the amount as fixed-point text, so both engines print it alike."""
    rows = X.latest(spark, sf).withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    return curate.with_signature(rows)


@query(X.prelude(SQL_DECISIONS) + "SELECT row_id, signature, decision, confidence, reasoning, fix FROM decided")
def apply_proposals(spark, sf):
    done = curate.apply_proposals(_decision_rows(spark, sf), _proposals(spark))
    return done.select(
        "row_id", "signature", "decision", "confidence", "reasoning", sorted_map("proposed_fix").alias("fix")
    )


@query(X.prelude(SQL_DECISIONS) + """SELECT row_id, decision AS agent_decision,
  CASE WHEN decision = 'fix' THEN 'patch_fields' END AS action, confidence,
  CASE WHEN decision = 'fix' AND confidence >= 0.8 THEN 'curated' WHEN decision = 'reject' THEN 'rejected'
    ELSE 'escalated' END AS status FROM decided""")
def decision_status(spark, sf):
    rows = X.quarantine(spark, sf)
    queue = Q.triage(rows, _empty_queue(spark), X.FQN, "run2", X.at(4))
    done = curate.apply_proposals(_decision_rows(spark, sf), _proposals(spark))
    updated = Q.apply_queue_updates(queue, curate.decisions_to_updates(done, X.FQN, "run2", as_of=X.at(4)))
    return updated.select(
        "row_id", "agent_decision", F.col("remediation_action").alias("action"), "confidence", "status"
    )


@query(X.prelude(SQL_DECISIONS) + """SELECT signature, count(*) AS n_rows, min(decision) AS decision,
  min(confidence) AS confidence, min(reasoning) AS reasoning,
  coalesce(string_agg(CASE WHEN fix IS NOT NULL AND rn <= 5 THEN row_id || ':' || before || '>' || fix END, '/' ORDER BY row_id), '') AS examples
FROM (SELECT *, CASE WHEN signature = 'code_not_matching_regex' THEN code ELSE amount_text END AS before,
  row_number() OVER (PARTITION BY signature ORDER BY row_id) AS rn FROM decided) GROUP BY signature""")
def curation_summary(spark, sf):
    rows = _decision_rows(spark, sf)
    done = curate.apply_proposals(rows, _proposals(spark))
    shown = F.transform(
        "examples",
        lambda e: F.concat(
            e["row_id"], F.lit(":"), e["changes"][0]["before"], F.lit(">"), e["changes"][0]["column"],
            F.lit("="), e["changes"][0]["after"],
        ),
    )
    return curate.curation_summary(rows, done).select(
        "signature", "n_rows", "decision", "confidence", "reasoning",
        F.coalesce(F.array_join(shown, "/"), F.lit("")).alias("examples"),
    )


@query(X.prelude(SQL_DECISIONS) + """SELECT coalesce(min(CASE WHEN decision = 'fix' THEN confidence END), 1.0)::DOUBLE
  AS min_batch_confidence FROM decided""")
def gate_value(spark, sf):
    return curate.gate_confidence(curate.apply_proposals(_decision_rows(spark, sf), _proposals(spark)))


QUEUE = f"WITH queue AS ({X.sql('QUEUE')})\n"
WEAK = "remediation_source = 'agent' AND agent_decision = 'fix' AND confidence < 0.8"


@query(QUEUE + f"""SELECT 'rows' AS mode, review_id FROM queue WHERE status = 'curated' AND NOT coalesce({WEAK}, false)
UNION ALL SELECT 'table', review_id FROM queue WHERE status = 'curated'
  AND quarantine_fqn NOT IN (SELECT quarantine_fqn FROM queue WHERE {WEAK})""")
def confidence_gate(spark, sf):
    queue = X.frame(spark, sf, "QUEUE")
    parts = [
        curate.confidence_gate(queue, mode=m).select(F.lit(m).alias("mode"), "review_id") for m in ("rows", "table")
    ]
    return parts[0].unionAll(parts[1])


CHAINS = {
    0: "trim({v})", 1: "trim(lower({v}))", 2: "trim(upper({v}))", 3: "regexp_replace({v}, '^[^0-9]+', '')",
    4: "lpad(regexp_replace({v}, '^[^0-9]+', ''), 5, '0')",
}


def _score_sql() -> str:
    value_tests = {
        "customer_id_is_null": ("customer_id", "CAST(customer_id AS VARCHAR)", "{x} IS NULL"),
        "code_not_matching_regex": ("code", "code", "NOT regexp_matches({x}, '^[0-9]{{5}}$')"),
        "status_is_not_in_the_list": ("status", "status", "{x} NOT IN ('F', 'O', 'P')"),
        "priority_not_standard": (
            "priority", "priority",
            "{x} NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')"),
        "amount_not_positive": ("amount", "CAST(amount AS VARCHAR)", "TRY_CAST({x} AS DOUBLE) < 0"),
    }
    flags = {"customer_id_is_null": "f_cust", "code_not_matching_regex": "f_code",
             "status_is_not_in_the_list": "f_status", "priority_not_standard": "f_priority",
             "amount_not_positive": "f_amount"}
    parts = []
    for rule, (column, text, test) in value_tests.items():
        # The last two are derived from the fixed-length pattern and are tried for its rule only.
        for k, chain in CHAINS.items() if column == "code" else list(CHAINS.items())[:3]:
            fixed = chain.format(v=text)
            fails = test.format(x=f"({fixed})")
            parts.append(
                f"SELECT signature, '{rule}' AS rule, '{column}' AS \"column\", {k} AS candidate, "
                f"({fixed}) IS NOT NULL AND NOT coalesce({fails}, FALSE) AS ok FROM latest WHERE {flags[rule]}"
            )
    return (
        "scores AS (SELECT signature, rule, \"column\", candidate, count(*) AS n_rows, "
        "count(*) FILTER (WHERE ok) / count(*) AS share FROM (" + " UNION ALL ".join(parts)
        + ") GROUP BY ALL)"
    )


@query(X.prelude(_score_sql()) + """SELECT signature, rule, "column", candidate::INTEGER AS candidate, n_rows, round(share, 6) AS share FROM scores""")
def transform_scores(spark, sf):
    rows = curate.with_signature(X.latest(spark, sf))
    found = curate.transform_scores(rows, X.CHECKS)
    return found.select("signature", "rule", "column", "candidate", "n_rows", F.round("share", 6).alias("share"))


@query(X.prelude(_score_sql(), """best AS (SELECT * FROM scores
  QUALIFY row_number() OVER (PARTITION BY signature, rule ORDER BY share DESC, candidate) = 1),
agg AS (SELECT signature, min(share) AS share, count(*) AS solved,
  string_agg("column" || ':' || candidate, '/' ORDER BY rule) AS chosen FROM best GROUP BY signature),
sigs AS (SELECT DISTINCT signature, len(string_split(signature, '|')) AS n FROM latest)""") + """
SELECT s.signature, CASE WHEN share >= 0.9 AND solved = n THEN 'fix' ELSE 'escalate' END AS decision,
  CASE WHEN share >= 0.9 AND solved = n THEN chosen ELSE '' END AS chosen,
  CASE WHEN share >= 0.9 AND solved = n THEN round(0.6 + 0.35 * share, 2) ELSE 0.0 END::DOUBLE AS confidence
FROM sigs s LEFT JOIN agg USING (signature)""")
def search_transforms(spark, sf):
    rows = curate.with_signature(X.latest(spark, sf))
    found = curate.search_transforms(rows, X.CHECKS)
    # Name each fixed column by the first and last transform of its chain.
    def code(column):
        steps = F.filter("fixes", lambda f: f["column"] == column)
        first, last = F.element_at(steps, 1)["transform"], F.element_at(steps, -1)["transform"]
        number = (
            F.when(last == "left_pad", 4).when(first == "regexp_replace", 3).when(first == "upper_trim", 2)
            .when(first == "lower_trim", 1).otherwise(0)
        )
        return F.concat(column, F.lit(":"), number.cast("string"))

    columns = F.array_distinct(F.transform("fixes", lambda f: f["column"]))
    return found.select(
        "signature", "decision", F.array_join(F.transform(columns, code), "/").alias("chosen"), "confidence"
    )


PROBE = """mism AS (SELECT d.order_id, d.priority, o.o_orderpriority AS expected, d.status AS signature,
    sha256(CAST(d.order_id AS VARCHAR)) AS row_id
  FROM dirty d JOIN orders o ON d.order_id = o.o_orderkey WHERE d.priority <> o.o_orderpriority OR d.status <> o.o_orderstatus),
sampled AS (SELECT * FROM mism)"""


def _probe_input(spark, sf):
    orders = X.table(spark, sf, "orders")
    other = orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("priority"))
    dirty = X.frame(spark, sf, "DIRTY").join(
        orders.select(F.col("o_orderkey").alias("order_id"), "o_orderpriority", "o_orderstatus"), "order_id"
    )
    rows = dirty.filter("priority <> o_orderpriority OR status <> o_orderstatus").select(
        "order_id", "priority", F.col("status").alias("signature"),
        F.sha2(F.col("order_id").cast("string"), 256).alias("row_id"),
    )
    return rows, other


PROBE_SCORES = """SELECT signature, n.normalization, count(*) AS sampled,
  count(*) FILTER (WHERE CASE n.normalization WHEN 'trim' THEN trim(priority) = trim(expected)
    WHEN 'lower_trim' THEN trim(lower(priority)) = trim(lower(expected))
    ELSE trim(upper(priority)) = trim(upper(expected)) END) AS matched
FROM sampled, (VALUES ('trim'), ('lower_trim'), ('upper_trim')) n(normalization) GROUP BY ALL"""


@query(f"WITH dirty AS ({X.sql('DIRTY')}), {PROBE} {PROBE_SCORES}")
def probe_scores(spark, sf):
    rows, other = _probe_input(spark, sf)
    found = probe.probe_scores(rows, other, "priority", ["order_id"])
    return found.select("signature", "normalization", "sampled", "matched")


@query(f"""WITH dirty AS ({X.sql('DIRTY')}), {PROBE}, scores AS ({PROBE_SCORES}),
ranked AS (SELECT *, matched / sampled AS share, CASE normalization WHEN 'trim' THEN 0 WHEN 'lower_trim' THEN 1 ELSE 2 END AS k FROM scores),
first AS (SELECT * FROM ranked WHERE share >= 0.9 QUALIFY row_number() OVER (PARTITION BY signature ORDER BY k) = 1)
SELECT DISTINCT s.signature, CASE WHEN f.signature IS NULL THEN 'escalate' ELSE 'fix' END AS decision,
  f.normalization, CASE WHEN f.signature IS NULL THEN 0.85 ELSE round(0.6 + 0.35 * f.share, 2) END::DOUBLE AS confidence
FROM scores s LEFT JOIN first f ON f.signature = s.signature""")
def cross_table_probe(spark, sf):
    rows, other = _probe_input(spark, sf)
    found = probe.cross_table_probe(rows, other, "priority", ["order_id"])
    return found.select(
        "signature", "decision", F.try_element_at("fixes", F.lit(1))["transform"].alias("normalization"), "confidence"
    )
