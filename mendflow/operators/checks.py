"""The check evaluator: rule dictionaries become native Spark predicates.

A check is ``{name, criticality, check: {function, arguments}}``. Row checks are plain
predicates. Dataset checks (uniqueness, cross-table comparison, foreign keys) first attach one
hidden boolean per check through a skew-safe lookup, several of them by one count of all their
keys, then join in as predicates too, so all checks of a table are decided together in one projection.

A null value does not fail a value check; only the not-null checks look at nulls.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mendflow import schemas as S
from mendflow.functions.transforms import column, literal, quoted
from mendflow.operators import keychecks, lookup
from mendflow.sources import tables

# Preset formats for the value-format check.
FORMATS = {
    "email": r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$",
    "url": r"^https?://[^\s]+$",
    "iso_date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
}


@dataclass(frozen=True)
class Check:
    """One parsed check."""

    name: str
    function: str
    arguments: Mapping = field(default_factory=dict)
    criticality: str = "error"

    @property
    def columns(self) -> list[str]:
        """The tested columns: a value check tests ``column``, or else each of ``columns``."""
        args = self.arguments
        if self.function in VALUE_CHECKS and args.get("column"):
            return [args["column"]]
        if args.get("columns"):
            return list(args["columns"])
        if args.get("column"):
            return [args["column"]]
        if args.get("compare_column"):
            return [args["compare_column"]]
        return []


def parse_check(raw: Mapping | Check) -> Check:
    """Read one check dictionary; name and level have defaults."""
    if isinstance(raw, Check):
        return raw
    body = raw.get("check") or {k: v for k, v in raw.items() if k in ("function", "arguments")}
    function = body.get("function")
    if not function:
        raise ValueError(f"check without a function: {raw}")
    args = dict(body.get("arguments") or {})
    for key in ("column", "columns"):
        if key in raw and key not in args:
            args[key] = raw[key]
    level = str(raw.get("criticality") or "error").lower()
    if level not in ("error", "warn"):
        raise ValueError(f"criticality must be 'error' or 'warn', got {level!r}")
    many = args.get("columns")
    if isinstance(many, str):
        args["columns"] = [c.strip() for c in many.split(",") if c.strip()]
    check = Check("", function, args, level)
    name = raw.get("name") or "_".join([*check.columns, function])
    return Check(name, function, args, level)


def parse_checks(raws: Sequence[Mapping | Check]) -> list[Check]:
    """Read a list of check dictionaries; nested lists are flattened."""
    flat: list = []
    for raw in raws:
        flat.extend(raw if isinstance(raw, list) else [raw])
    return [parse_check(r) for r in flat]


# --- row checks: SQL text of a value and arguments -> SQL text of "this value fails" ----------

def _range(v: str, args: Mapping) -> str:
    low, high = ("<=", ">=") if args.get("exclusive") else ("<", ">")
    tests = []
    if args.get("min") is not None:
        tests.append(f"{v} {low} {literal(args['min'])}")
    if args.get("max") is not None:
        tests.append(f"{v} {high} {literal(args['max'])}")
    return " OR ".join(tests) or "false"


def _in_list(v: str, args: Mapping) -> str:
    """A null in the list allows nothing more; without any value every non-null value fails."""
    allowed = [a for a in args["allowed"] or [] if a is not None]
    if not allowed:
        return f"{v} IS NOT NULL"
    if args.get("case_sensitive", True):
        return f"{v} NOT IN ({', '.join(literal(a) for a in allowed)})"
    return f"lower({v}) NOT IN ({', '.join(quoted(str(a).lower()) for a in allowed)})"


VALUE_CHECKS: dict[str, Callable[[str, Mapping], str]] = {
    "is_not_null": lambda v, a: f"{v} IS NULL",
    "is_not_null_and_not_empty": lambda v, a: f"{v} IS NULL OR trim(CAST({v} AS string)) = ''",
    "is_not_empty": lambda v, a: f"trim(CAST({v} AS string)) = ''",
    "matches_regex": lambda v, a: f"NOT CAST({v} AS string) RLIKE {quoted(a['pattern'])}",
    "has_format": lambda v, a: f"NOT CAST({v} AS string) RLIKE {quoted(FORMATS[a['format']])}",
    "is_in_list": _in_list,
    "is_in_range": _range,
}


def value_fails(check: Check, value: str) -> str:
    """The predicate of a value check over any SQL expression, never null."""
    return f"coalesce({VALUE_CHECKS[check.function](value, check.arguments)}, false)"


# --- dataset checks: frame -> frame with one hidden boolean ------------------------------------

Refs = Mapping[str, DataFrame]


def _mark(
    df: DataFrame, flagged: DataFrame, counts: DataFrame, on: Sequence[str], hidden: str
) -> DataFrame:
    """Mark the rows of the flagged keys.

    The flagged keys are written once and measured. Few of them, the usual case, are sent to the
    rows' tasks, and the rows are not shuffled; many are joined with the heavy keys spread.
    """
    keys = tables.cut_lineage(flagged.select(*on, F.lit(True).alias(hidden)))
    if lookup.is_small(keys):
        out = df.join(F.broadcast(keys), list(on), "left")
    else:
        out = lookup.counted_join(df, keys, counts, on)
    return out.withColumn(hidden, F.coalesce(F.col(hidden), F.lit(False)))


def _is_unique(df: DataFrame, check: Check, hidden: str, refs: Refs) -> DataFrame:
    """Flag every row of a repeated key.

    Keys are counted with map-side partial counts and only repeated keys are joined back; a
    window over the key would put all copies of a hot key into one task. ``by_digest`` compares
    SHA-256 digests, so that long texts are not shuffled as keys.
    """
    columns = check.columns
    folded = set(check.arguments.get("ci_columns") or [])
    keys = [f"{hidden}_k{i}" for i in range(len(columns))]
    distinct_nulls = check.arguments.get("nulls_distinct", True)
    exprs = {}
    for key, c in zip(keys, columns):
        value = F.lower(c) if c in folded else keychecks.plain(F.col(c), keychecks.kind(df, c))
        exprs[key] = F.sha2(value.cast("string"), 256) if check.arguments.get("by_digest") else value
    on = list(keys)
    if not distinct_nulls:
        # Nulls compare equal: keep a marker next to a non-null stand-in.
        on = []
        for key, c in zip(keys, columns):
            exprs[f"{key}_null"] = F.col(c).isNull()
            exprs[key] = F.coalesce(exprs[key].cast("string"), F.lit(""))
            on += [key, f"{key}_null"]
    keyed = df.withColumns(exprs)
    counts = (
        keyed.filter(~lookup.any_null(on))
        .groupBy(*on)
        .agg(F.count("*").alias("__n"))
        .filter("__n > 1")
    )
    return _mark(keyed, counts, counts, on, hidden).drop(*exprs)


def _foreign_key(df: DataFrame, check: Check, hidden: str, refs: Refs) -> DataFrame:
    """Flag rows whose non-null key is absent from the referenced table.

    Orphans are found among the distinct keys, so the anti join never sees a repeated key.
    """
    columns = check.columns
    args = check.arguments
    ref_columns = list(args.get("ref_columns") or [args["ref_column"]])
    keys = [f"{hidden}_k{i}" for i in range(len(columns))]
    keyed = df.withColumns({k: F.col(c) for k, c in zip(keys, columns)})
    counts = keyed.filter(~lookup.any_null(keys)).groupBy(*keys).agg(F.count("*").alias("__n"))
    known = (
        keychecks.ref(refs, args["ref_table"])
        .select(*[F.col(c).alias(k) for k, c in zip(keys, ref_columns)])
        .distinct()
    )
    orphans = counts.join(known, keys, "left_anti")
    return _mark(keyed, orphans, counts, keys, hidden).drop(*keys)


def _sql_query(df: DataFrame, check: Check, hidden: str, refs: Refs) -> DataFrame:
    """Flag rows whose compared column differs from the matching row of another table.

    Keys and values are compared as text; the other side keeps its smallest value per key.
    Rows without a partner do not fail.
    """
    args = check.arguments
    compared = args["compare_column"]
    keys = [f"{hidden}_k{i}" for i in range(len(args["join_keys"]))]
    named = [F.col(k).cast("string").alias(key) for key, k in zip(keys, args["join_keys"])]
    other = (
        keychecks.ref(refs, args["other_table"])
        .select(*named, F.col(compared).cast("string").alias("__value"))
        .filter(~lookup.any_null(keys))
        .groupBy(*keys)
        .agg(F.min("__value").alias("__value"), F.lit(True).alias("__partner"))
    )
    keyed = df.withColumns(
        {key: F.col(k).cast("string") for key, k in zip(keys, args["join_keys"])}
    )
    differs = F.col("__partner") & ~F.col(compared).cast("string").eqNullSafe(F.col("__value"))
    return (
        lookup.lookup_join(keyed, tables.cut_lineage(other), keys, measure=True)
        .withColumn(hidden, F.coalesce(differs, F.lit(False)))
        .drop(*keys, "__value", "__partner")
    )


DATASET_CHECKS: dict[str, Callable[[DataFrame, Check, str, Refs], DataFrame]] = {
    "is_unique": _is_unique,
    "foreign_key": _foreign_key,
    "sql_query": _sql_query,
}

FUNCTIONS = (*VALUE_CHECKS, "sql_expression", *DATASET_CHECKS)


# --- evaluation ---------------------------------------------------------------------------------

def value_of(name: str, available: Sequence[str]) -> str:
    """SQL text of a tested column: a column, a field of one (``s.f``), or an expression."""
    if name in available:
        return column(name)
    parts = name.split(".")
    if parts[0] in available and all(p.strip() for p in parts):
        return ".".join(column(p) for p in parts)
    return column(name) if name.replace("_", "").isalnum() else f"({name})"


def _fails(check: Check, hidden: str, available: Sequence[str]) -> str:
    if check.function in DATASET_CHECKS:
        return column(hidden)
    if check.function == "sql_expression":
        return f"coalesce(NOT ({check.arguments['expression']}), false)"
    if check.function not in VALUE_CHECKS:
        raise ValueError(f"unknown check function {check.function!r}; known: {FUNCTIONS}")
    if not check.columns:
        raise ValueError(f"check {check.name!r} names no column")
    return " OR ".join(value_fails(check, value_of(c, available)) for c in check.columns)


def _entry(check: Check) -> str:
    columns = check.columns
    message = f"{check.function} failed for {', '.join(columns) or check.name}"
    listed = f"array({', '.join(quoted(c) for c in columns)})" if columns else "CAST(array() AS array<string>)"
    return (
        f"named_struct('name', {quoted(check.name)}, 'message', {quoted(message)}, "
        f"'function', {quoted(check.function)}, 'columns', {listed})"
    )


class Evaluated:
    """A frame with its checks compiled in: split it, or keep all rows with their results."""

    def __init__(
        self,
        df: DataFrame,
        checks: Sequence[Mapping | Check],
        refs: Refs | None = None,
        markers: Sequence[str] = (),
    ):
        S.require_plain_columns(df.drop("row_id", *markers))
        self.columns = df.columns
        self._given = (df, refs, markers)
        self.checks = parse_checks(checks)
        names = [c.name for c in self.checks]
        if len(set(names)) < len(names):
            raise ValueError(f"check names must be unique: {sorted(names)}")
        self.frame = df
        self._failing: list[tuple[Check, str]] = []
        keyed = {f"__c{i}": c for i, c in enumerate(self.checks) if c.function in DATASET_CHECKS}
        if len(keyed) > 1 or any(c.arguments.get("history") for c in keyed.values()):
            self.frame = keychecks.mark_failing(df, keyed, refs or {})
        else:
            for hidden, check in keyed.items():
                self.frame = DATASET_CHECKS[check.function](df, check, hidden, refs or {})
        for i, check in enumerate(self.checks):
            hidden = f"__c{i}"
            self._failing.append((check, f"({_fails(check, hidden, self.columns)})"))

    def _any(self, *levels: str) -> str:
        return " OR ".join(f for c, f in self._failing if c.criticality in levels) or "false"

    def any_failing(self, *levels: str) -> Column:
        return F.expr(self._any(*levels))

    def results(self, level: str) -> Column:
        picked = [f"CASE WHEN {f} THEN {_entry(c)} END" for c, f in self._failing if c.criticality == level]
        if not picked:
            return F.lit(None).cast(S.RESULT_DDL)
        found = f"array_compact(array({', '.join(picked)}))"
        return F.expr(f"CAST(CASE WHEN {self._any(level)} THEN {found} END AS {S.RESULT_DDL})")

    def _with_results(self, frame: DataFrame) -> DataFrame:
        return frame.select(
            *self.columns,
            self.results("error").alias(S.ERROR),
            self.results("warn").alias(S.WARNING),
        )

    def all_rows(self) -> DataFrame:
        """Every input row with ``_error`` and ``_warning``; null when nothing failed."""
        return self._with_results(self.frame)

    def valid(self) -> DataFrame:
        """Rows without a failed error check; warnings stay in.

        Dataset checks that only warn are left out, so their joins are not run for these rows.
        """
        needless = [
            c for c in self.checks if c.criticality != "error" and c.function in DATASET_CHECKS
        ]
        if needless:
            df, refs, markers = self._given
            return Evaluated(df, [c for c in self.checks if c not in needless], refs, markers).valid()
        return self.frame.filter(~self.any_failing("error")).select(*self.columns)

    def invalid(self) -> DataFrame:
        """Rows with a failed check of either level, with their results."""
        return self._with_results(self.frame.filter(self.any_failing("error", "warn")))


def evaluate(df: DataFrame, checks: Sequence[Mapping | Check], refs: Refs | None = None) -> DataFrame:
    """Every row with its ``_error`` / ``_warning`` arrays."""
    return Evaluated(df, checks, refs).all_rows()


def split(
    df: DataFrame, checks: Sequence[Mapping | Check], refs: Refs | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows that pass all error checks, and rows that failed any check."""
    done = Evaluated(df, checks, refs)
    return done.valid(), done.invalid()
