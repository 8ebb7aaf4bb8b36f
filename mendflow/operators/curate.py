"""Proposal-based repair of rows that no playbook entry covers.

Rows are grouped into violation signatures (the set of rules that failed together). One
proposal per signature decides what happens to all its rows. Proposals are a table: anyone may
fill it, ``parse_replies`` reads it from text replies and ``search_transforms`` finds fixes by
trying transforms on the failing rows. A signature without a proposal escalates.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mendflow import schemas as S
from mendflow.functions.identity import signature
from mendflow.functions.transforms import chain_sql, column, is_bad_fix, quoted, run_steps
from mendflow.operators.checks import VALUE_CHECKS, Check, parse_checks, value_fails
from mendflow.operators.lookup import class_join, is_small
from mendflow.sources import tables

FIXES = "array<map<string,string>>"


def with_signature(df: DataFrame) -> DataFrame:
    return df.withColumn("signature", signature())


def _failed() -> Column:
    empty = F.array().cast(S.RESULT_DDL)
    return F.concat(F.coalesce(S.ERROR, empty), F.coalesce(S.WARNING, empty))


def known_columns(named: Column, available: Sequence[str]) -> Column:
    """Sorted data columns of lists of names."""
    known = F.array(*[F.lit(c) for c in available]).cast("array<string>")
    return F.array_sort(F.array_intersect(F.array_distinct(F.flatten(named)), known))


def flagged_columns(available: Sequence[str]) -> Column:
    """Sorted data columns named by the failed checks of a row."""
    return known_columns(F.transform(_failed(), lambda r: r["columns"]), available)


def signature_profiles(df: DataFrame, sample_size: int = S.SAMPLE_SIZE) -> DataFrame:
    """Per signature: rows, failed rules, flagged columns and a sample of failing values.

    Counting and rule gathering combine before the shuffle; the sample is the first
    ``sample_size`` rows by ``row_id`` and is cut in each task first. Rules and flagged columns
    come from every row.
    """
    columns = S.data_columns(df.drop("signature"))
    flagged = df.withColumn("flagged", flagged_columns(columns))
    counts = flagged.groupBy("signature").agg(F.count("*").alias("n_rows"))
    rules = (
        flagged.select("signature", F.explode(_failed()).alias("r"))
        .select("signature", "r.name", "r.function", "r.message", "r.columns")
        .distinct()
        .groupBy("signature")
        .agg(F.array_sort(F.collect_list(F.struct("name", "function", "message", "columns"))).alias("rules"))
        .withColumn("flagged", known_columns(F.transform("rules", lambda r: r["columns"]), columns))
    )
    samples = _samples(flagged, columns, sample_size)
    return counts.join(rules, "signature", "left").join(samples, "signature", "left")


def _values(columns: Sequence[str]) -> Column:
    """Data columns as a map from name to text."""
    pairs = ", ".join(f"{quoted(c)}, CAST({column(c)} AS string)" for c in columns)
    return F.expr(f"map({pairs})")


def _samples(flagged: DataFrame, columns: Sequence[str], sample_size: int) -> DataFrame:
    """Sample rows per signature; values become text only after the cut."""
    first = Window.partitionBy("signature").orderBy("row_id")
    cut = (
        flagged.withColumn("__rn", F.row_number().over(first))
        .filter(F.col("__rn") <= sample_size)
        .withColumn("__values", _values(columns))
    )
    picked = F.transform(
        "flagged",
        lambda c: F.struct(c.alias("column"), F.element_at("__values", c).alias("value")),
    )
    return cut.groupBy("signature").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("__rn", picked.alias("v")))), lambda s: s["v"]
        ).alias("samples"),
    )


def passing_examples(silver: DataFrame, columns: Sequence[str], n: int = S.PASSING_EXAMPLES) -> DataFrame:
    """The ``n`` smallest distinct non-null values of each column, as text.

    All columns share one scan. Ranks of equal values are equal, so each task keeps the rows of
    its own ``n`` smallest values before the shuffle; what is left is made distinct.
    """
    present = [c for c in columns if c in silver.columns]
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in present]
    )
    smallest = Window.partitionBy("column").orderBy("value")
    return (
        silver.select(F.inline(pairs))
        .filter("value is not null")
        .groupBy("column", "value", F.spark_partition_id())
        .agg(F.lit(1))
        .select("column", "value")
        .withColumn("__rn", F.dense_rank().over(smallest))
        .filter(F.col("__rn") <= n)
        .select("column", "value")
        .distinct()
    )


# --- proposals ------------------------------------------------------------------------------------

REPLY_DDL = f"decision string, fixes {FIXES}, confidence double, reasoning string"


_STRING = r"""(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"|'[^'\\]*+(?:\\.[^'\\]*+)*+')"""
_PIECES = f"(?s){_STRING}|[^\"']+|."


def _scan():
    """One pass over each text of an Arrow array; made here, so tasks get it without a copy of this module.

    To an object, quotes before its brace mean nothing. So open objects are on three stacks: those for which the scan is
    outside a string, inside double and inside single quotes. A quote swaps two of them, a brace is for the first alone.
    """
    special = re.compile(rb"""\\.|["'{}]""", re.DOTALL)

    def objects(text: bytes) -> list[bytes]:
        if b"decision" not in text and b"\\" not in text:
            return []
        plain, double, single = [], [], []
        begin = {b'"': 0, b"'": 0}  # of the string that a quote ends
        found = []
        for token in special.finditer(text):
            c = token.group()
            if c == b"{":
                plain.append([token.start(), False])
            elif c == b"}":
                if plain:
                    start, named = plain.pop()
                    if named:
                        found.append((start, token.end()))
            elif c in begin:
                inside = double if c == b'"' else single
                if inside:
                    string = text[begin[c] : token.start()]
                    # The innermost object has this string; with escapes it may be any name.
                    inside[-1][1] |= string == b"decision" or b"\\" in string
                begin[c] = token.end()
                if c == b'"':
                    plain, double = double, plain
                else:
                    plain, single = single, plain
        return [text[start:end] for start, end in sorted(found)]

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([objects(t) if t else [] for t in texts.to_pylist()], pa.list_(pa.binary()))

    return run


def decisions_in(text: str | Column) -> Column:
    """Objects in a text that may name a decision, nested to any depth, in the order in which they open."""
    found = F.arrow_udf(_scan(), "array<binary>")((F.col(text) if isinstance(text, str) else text).cast("binary"))
    return found.cast("array<string>")


def _literals_as_json(text: Column) -> Column:
    """``None``, ``True`` and ``False`` outside strings as JSON writes them."""
    pieces = F.regexp_extract_all(text, F.lit(_PIECES), F.lit(0))

    def plain(piece: Column) -> Column:
        for name, value in (("None", "null"), ("True", "true"), ("False", "false")):
            piece = F.regexp_replace(piece, rf"\b{name}\b", value)
        return piece

    def is_text(p: Column) -> Column:
        return F.substring(p, 1, 1).isin('"', "'")

    as_json = F.array_join(F.transform(pieces, lambda p: F.when(is_text(p), p).otherwise(plain(p))), "")
    return F.when(text.rlike("None|True|False"), as_json).otherwise(text)


def parse_replies(replies: DataFrame, reply_col: str = "reply") -> DataFrame:
    """Decisions from text replies ``(signature, reply)``; prose around the object is ignored.

    Every balanced object of the text, also those inside others, counts in the order in which they open, and the
    first that holds a decision wins; Python literals count as well as JSON. A reply without one escalates with confidence 0.
    """
    parsed = F.transform(
        decisions_in(reply_col), lambda x: F.from_json(_literals_as_json(x), REPLY_DDL, {"allowSingleQuotes": "true"})
    )
    first = F.get(F.filter(parsed, lambda r: r["decision"].isNotNull()), F.lit(0))
    good = F.col("r.decision").isNotNull()
    return replies.withColumn("r", first).select(
        "signature",
        F.coalesce("r.decision", F.lit("escalate")).alias("decision"),
        F.coalesce("r.fixes", F.array().cast(FIXES)).alias("fixes"),
        F.when(good, F.coalesce("r.confidence", F.lit(0.0))).otherwise(0.0).alias("confidence"),
        F.when(good, F.coalesce("r.reasoning", F.lit("")))
        .otherwise("agent_unavailable: no decision in reply")
        .alias("reasoning"),
    )


# Chains that are tried on every failing text column, in order of preference.
CASE_AND_BLANKS: tuple[tuple[Mapping, ...], ...] = tuple(
    ({"transform": t},) for t in ("trim", "lower_trim", "upper_trim")
)

# A pattern that is one character class repeated a fixed number of times.
_FIXED_LENGTH = re.compile(r"\^?(\[[^\]^]+\]|\\d)\{(\d+)\}\$?")


def candidates_for(check: Check) -> list[tuple[Mapping, ...]]:
    """Chains that may repair a value which fails this check, derived from the check itself.

    A fixed-length pattern suggests dropping what stands before the first character of its class,
    and padding to its length after that; every check suggests trimming and changing case.
    """
    chains = list(CASE_AND_BLANKS)
    shape = _FIXED_LENGTH.fullmatch(str(check.arguments.get("pattern") or ""))
    if check.function == "matches_regex" and shape:
        inside, length = shape.groups()
        inside = "[0-9]" if inside == "\\d" else inside
        # Something of the value must be left, or padding would make one up.
        prefix = f"^[^{inside[1:-1]}]+(?={inside})"
        strip = {"transform": "regexp_replace", "pattern": prefix, "replacement": ""}
        pad = "0" if re.match(inside, "0") else "A"
        chains += [(strip,), (strip, {"transform": "left_pad", "length": length, "pad": pad})]
    return chains


Candidates = Sequence[Sequence[Mapping]] | Mapping[str, Sequence[Sequence[Mapping]]]


def _tried(
    df: DataFrame, checks: Sequence[Mapping | Check], candidates: Candidates | None
) -> list[tuple[Check, Sequence[Sequence[Mapping]]]]:
    """Checks of one text-like column with the chains to try on it; a mapping adds to those of its rules."""
    found = []
    for check in parse_checks(checks):
        if check.function in VALUE_CHECKS and len(check.columns) == 1 and check.columns[0] in df.columns:
            if candidates is None or isinstance(candidates, Mapping):
                own = [*candidates_for(check), *(candidates or {}).get(check.name, ())]
            else:
                own = candidates
            found.append((check, own))
    return found


def transform_scores(
    df: DataFrame,
    checks: Sequence[Mapping | Check],
    candidates: Candidates | None = None,
) -> DataFrame:
    """Share of failing rows each candidate would repair, per signature and rule.

    One aggregation over all rows. Candidates are derived from the checks unless they are given;
    ``candidate`` counts those of the rule. A repaired value must also read as the column's own
    type; a null result does not count as repaired.
    """
    tried = _tried(df, checks, candidates)
    schema = "signature string, rule string, column string, n_rows bigint, candidate int, share double"
    if not any(chains for _, chains in tried):
        return df.sparkSession.createDataFrame([], schema)
    types = dict(df.dtypes)
    aggs, rows = [], []
    for i, (check, chains) in enumerate(tried):
        mine = f"array_contains(rule_violations, {quoted(check.name)})"
        aggs.append(F.expr(f"count_if({mine})").alias(f"__n{i}"))
        for k, steps in enumerate(chains):
            target = check.columns[0]
            fixed = f"try_cast({chain_sql(steps, target)} AS {types[target]})"
            passes = f"{fixed} IS NOT NULL AND NOT {value_fails(check, fixed)}"
            aggs.append(F.expr(f"count_if({mine} AND {passes})").alias(f"__p{i}_{k}"))
            rows.append(
                f"named_struct('rule', {quoted(check.name)}, 'column', {quoted(target)}, 'n_rows', __n{i}, "
                f"'candidate', {k}, 'share', try_divide(__p{i}_{k}, __n{i}))"
            )
    return (
        df.groupBy("signature")
        .agg(*aggs)
        .select("signature", F.expr(f"inline(array({', '.join(rows)}))"))
        .filter("n_rows > 0")
    )


def search_transforms(
    df: DataFrame,
    checks: Sequence[Mapping | Check],
    candidates: Candidates | None = None,
    threshold: float = S.PROBE_THRESHOLD,
) -> DataFrame:
    """Proposals found by trying candidate chains on the failing rows.

    A signature is fixed when every one of its rules has a candidate that repairs at least
    ``threshold`` of the rows; otherwise it escalates.
    """
    order = Window.partitionBy("signature", "rule").orderBy(F.col("share").desc(), "candidate")
    best = (
        transform_scores(df, checks, candidates)
        .withColumn("__rn", F.row_number().over(order))
        .filter("__rn = 1")
    )

    def step(fix: Mapping) -> Column:
        return F.create_map(*[F.lit(str(x)) for kv in fix.items() for x in kv])

    known = [
        x
        for check, chains in _tried(df, checks, candidates)
        for x in (F.lit(check.name), F.array(*[F.array(*[step(f) for f in c]) for c in chains]))
    ]
    if not known:
        return df.select("signature").distinct().select(
            "signature",
            F.lit("escalate").alias("decision"),
            F.array().cast(FIXES).alias("fixes"),
            F.lit(0.0).alias("confidence"),
            F.lit("no transform repaired enough rows").alias("reasoning"),
        )
    steps = F.element_at(F.create_map(*known), F.col("rule"))
    chosen = F.transform(
        F.element_at(steps, F.col("candidate") + 1),
        lambda s: F.map_concat(F.create_map(F.lit("column"), F.col("column")), s),
    )
    per_signature = best.withColumn("__steps", chosen).groupBy("signature").agg(
        F.min("share").alias("__share"),
        F.count("*").alias("__solved"),
        F.flatten(
            F.transform(
                F.array_sort(F.collect_list(F.struct("rule", "candidate"))),
                lambda r: F.array(r["rule"]),
            )
        ).alias("__rules"),
        F.collect_list(F.struct("rule", "__steps")).alias("__chosen"),
    )
    # A name may have a bar in it, so rules are not counted in the signature's text.
    solved = (F.col("__share") >= threshold) & (F.col("__solved") == F.col("__fewest")) & (F.col("__fewest") == F.col("__most"))
    ordered = F.flatten(
        F.transform(
            "__rules", lambda r: F.element_at(F.map_from_entries("__chosen"), r)
        )
    )
    n_rules = F.size(F.coalesce("rule_violations", F.array()))
    signatures = df.groupBy("signature").agg(F.min(n_rules).alias("__fewest"), F.max(n_rules).alias("__most"))
    return signatures.join(per_signature, "signature", "left").select(
        "signature",
        F.when(solved, "fix").otherwise("escalate").alias("decision"),
        F.when(solved, ordered).otherwise(F.array().cast(FIXES)).cast(FIXES).alias("fixes"),
        F.when(solved, F.round(0.6 + 0.35 * F.col("__share"), 2)).otherwise(0.0).alias("confidence"),
        F.when(solved, "transform search").otherwise("no transform repaired enough rows").alias("reasoning"),
    )


def checked_proposals(proposals: DataFrame) -> DataFrame:
    """Proposals with bad transforms or empty fixes turned into escalations."""
    bad = F.expr(f"exists(fixes, f -> {is_bad_fix('f')})")
    empty = F.coalesce(F.size("fixes") == 0, F.lit(True))
    is_fix = F.col("decision") == "fix"
    decision = (
        F.when(is_fix & ~empty & ~bad, "fix")
        .when(F.col("decision") == "reject", "reject")
        .otherwise("escalate")
    )
    return proposals.select(
        "signature",
        decision.alias("decision"),
        F.when(decision == "fix", F.col("fixes")).alias("fixes"),
        F.when(is_fix & ~empty & bad, 0.0)
        .otherwise(F.coalesce("confidence", F.lit(0.0)))
        .alias("confidence"),
        F.when(is_fix & ~empty & bad, F.concat(F.lit("bad_transform: "), F.coalesce("reasoning", F.lit(""))))
        .otherwise(F.coalesce("reasoning", F.lit("")))
        .alias("reasoning"),
    )


def _with_class(df: DataFrame, classes: DataFrame) -> DataFrame:
    """Join a table of one row a signature: sent to all tasks if it is measured small, else spread."""
    classes = tables.cut_lineage(classes)
    if is_small(classes):
        return df.join(F.broadcast(classes), "signature", "left")
    return class_join(df, classes, ["signature"])


def apply_proposals(
    df: DataFrame, proposals: DataFrame, flagged_only: bool = True
) -> DataFrame:
    """Row decisions ``(row_id, signature, decision, proposed_fix, confidence, reasoning)``.

    The fixes of a signature run over all of its rows without leaving Spark. A signature
    escalates when it has no proposal, a bad transform, no usable column or no row that changes.
    """
    columns = S.data_columns(df.drop("signature"))
    known = F.array(*[F.lit(c) for c in columns]).cast("array<string>")
    targets = flagged_columns(columns) if flagged_only and S.ERROR in df.columns else known
    named = F.array_distinct(F.transform("fixes", lambda f: F.element_at(f, "column")))
    rows = df.select(
        "row_id", "signature", targets.alias("__targets"), _values(columns).alias("__values")
    )
    joined = _with_class(rows, checked_proposals(proposals)).withColumn(
        "__cols", F.array_intersect(named, F.col("__targets"))
    )

    mine = "filter(fixes, f -> f['column'] = c)"
    fixed = (
        f"named_struct('column', c, 'value', {run_steps('__values[c]', mine)}, "
        f"'nulled', trim(element_at({mine}, -1)['transform']) = 'set_null')"
    )
    is_fix = F.col("decision") == "fix"
    outcome = joined.withColumn(
        "__out",
        F.expr(f"CASE WHEN decision = 'fix' AND size(__cols) > 0 THEN transform(__cols, c -> {fixed}) END"),
    ).withColumn(
        "__moved",
        F.expr("coalesce(exists(__out, o -> NOT (o.value <=> __values[o.column])), false)"),
    )
    # The fold over the transforms runs once; its results are read for the guard and for the rows.
    outcome = tables.cut_lineage(outcome.drop("__values", "__targets", "__cols", "fixes"))
    per_signature = outcome.groupBy("signature").agg(
        F.bool_or("__moved").alias("__any_moved"),
        F.bool_or(F.col("__out").isNotNull()).alias("__usable"),
    )
    judged = _with_class(outcome, per_signature)
    fails = is_fix & ~(F.col("__usable") & F.col("__any_moved"))
    why = F.when(~F.col("__usable"), "no valid flagged column in fixes: ").otherwise(
        "proposed transform was a no-op (before == after): "
    )
    # A transform that ends in null only counts when null was asked for.
    kept = F.expr("filter(__out, o -> o.value IS NOT NULL OR o.nulled)")
    fix = F.map_from_entries(F.transform(kept, lambda o: F.struct(o["column"], o["value"])))
    missing = F.col("decision").isNull()
    return judged.select(
        "row_id",
        "signature",
        F.when(missing | fails, "escalate").otherwise(F.col("decision")).alias("decision"),
        F.when(is_fix & ~fails & (F.size(kept) > 0), fix).alias("proposed_fix"),
        F.when(missing | fails, 0.0).otherwise(F.col("confidence")).alias("confidence"),
        F.when(missing, "agent_unavailable: no proposal")
        .when(fails, F.concat(why, "reasoning"))
        .otherwise(F.col("reasoning"))
        .alias("reasoning"),
    )


def decisions_to_updates(
    decisions: DataFrame,
    quarantine_fqn: str,
    run_id: str,
    threshold: float = S.CONFIDENCE_THRESHOLD,
    as_of: Column | None = None,
) -> DataFrame:
    """Queue updates for row decisions."""
    decision = F.col("decision")
    status = (
        F.when((decision == "fix") & (F.col("confidence") >= threshold), S.CURATED)
        .when(decision == "reject", S.REJECTED)
        .otherwise(S.ESCALATED)
    )
    return decisions.select(
        F.lit(quarantine_fqn).alias("quarantine_fqn"),
        "row_id",
        F.lit("agent").alias("remediation_source"),
        decision.alias("agent_decision"),
        F.when(decision == "fix", "patch_fields").alias("remediation_action"),
        "proposed_fix",
        "confidence",
        status.alias("status"),
        F.lit(run_id).alias("last_run_id"),
        (F.current_timestamp() if as_of is None else as_of).alias("updated_at"),
    )


def gate_confidence(decisions: DataFrame) -> DataFrame:
    """Lowest confidence among fixes; 1.0 when there is none."""
    lowest = F.min(F.when(F.col("decision") == "fix", F.col("confidence")))
    return decisions.agg(F.coalesce(lowest, F.lit(1.0)).alias("min_batch_confidence"))


def confidence_gate(
    queue: DataFrame, threshold: float = S.CONFIDENCE_THRESHOLD, mode: str = "rows"
) -> DataFrame:
    """Curated queue rows that may go on to re-validation.

    ``rows`` holds back only proposals under the threshold; ``table`` holds back every row of a
    table while one of its proposed fixes is under it.
    """
    by_agent = F.coalesce(F.col("remediation_source") == "agent", F.lit(False))
    weak = by_agent & (F.col("agent_decision") == "fix") & (F.col("confidence") < threshold)
    curated = queue.filter(F.col("status") == S.CURATED)
    if mode == "rows":
        return curated.filter(~F.coalesce(weak, F.lit(False)))
    if mode != "table":
        raise ValueError("mode must be 'rows' or 'table'")
    closed = queue.filter(weak).select("quarantine_fqn").distinct()
    return class_join(curated, closed, ["quarantine_fqn"], how="left_anti")


def curation_summary(
    df: DataFrame, decisions: DataFrame, examples: int = 5
) -> DataFrame:
    """Per signature: rows, decision, confidence and a few before / after values."""
    columns = S.data_columns(df.drop("signature"))
    totals = decisions.groupBy("signature").agg(
        F.count("*").alias("n_rows"),
        F.min("decision").alias("decision"),
        F.min("confidence").alias("confidence"),
        F.min("reasoning").alias("reasoning"),
    )
    first = Window.partitionBy("signature").orderBy("row_id")
    cut = (
        decisions.filter(F.col("proposed_fix").isNotNull())
        .withColumn("__rn", F.row_number().over(first))
        .filter(F.col("__rn") <= examples)
        .select("row_id", "signature", "proposed_fix")
    )
    values = df.select("row_id", _values(columns).alias("__values"))
    shown = cut.join(values, "row_id").select(
        "signature",
        F.struct(
            "row_id",
            F.transform(
                F.array_sort(F.map_keys("proposed_fix")),
                lambda c: F.struct(
                    c.alias("column"),
                    F.element_at("__values", c).alias("before"),
                    F.element_at("proposed_fix", c).alias("after"),
                ),
            ).alias("changes"),
        ).alias("example"),
    )
    per_signature = shown.groupBy("signature").agg(
        F.array_sort(F.collect_list("example")).alias("examples")
    )
    return totals.join(per_signature, "signature", "left")
