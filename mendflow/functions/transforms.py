"""The vocabulary of column transforms a fix may use.

Each transform is one piece of SQL text. The same text serves fixes known when the plan is built
(``chain``) and an array of fixes that is itself a column (``run_steps``), so a table of
proposals never has to reach the driver, and a long chain is one expression to parse.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parameters each transform needs.
REQUIRED_PARAMS: dict[str, tuple[str, ...]] = {
    "trim": (),
    "lower": (),
    "upper": (),
    "lower_trim": (),
    "upper_trim": (),
    "regexp_replace": ("pattern",),
    "regexp_extract": ("pattern",),
    "to_date": ("from_format",),
    "to_timestamp": ("from_format",),
    "left_pad": ("length",),
    "right_pad": ("length",),
    "substring": ("pos",),
    "set_default": ("value",),
    "set_null": (),
}

# Parameters that must read as whole numbers.
INTEGER_PARAMS = {
    "regexp_extract": ("group",),
    "left_pad": ("length",),
    "right_pad": ("length",),
    "substring": ("pos", "len"),
}


def quoted(text: object) -> str:
    """A SQL string literal."""
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal(value: object) -> str:
    """A Python value as SQL text."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return f"CAST({quoted(repr(value))} AS double)"
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, datetime):
        return f"TIMESTAMP {quoted(value.isoformat(sep=' '))}"
    if isinstance(value, date):
        return f"DATE {quoted(value.isoformat())}"
    return quoted(value)


def column(name: str) -> str:
    """A column reference in SQL text."""
    return "`" + name.replace("`", "``") + "`"


Param = Callable[[str, str | None], str]


def _number(text: str) -> str:
    return f"try_cast({text} AS int)"


def _pad(side: str) -> Callable[[str, Param], str]:
    def padded(v: str, p: Param) -> str:
        length = _number(p("length", None))
        # Folding lower() of a literal would load the case tables of all of Unicode into the driver.
        keep = f"length({v}) > {length} AND translate({p('truncate', 'false')}, 'TRUE', 'true') <> 'true'"
        return f"CASE WHEN {keep} THEN {v} ELSE {side}({v}, {length}, {p('pad', '0')}) END"

    return padded


def _date(pattern: str) -> Callable[[str, Param], str]:
    return lambda v, p: f"date_format(try_to_timestamp({v}, {p('from_format', None)}), '{pattern}')"


_SQL: dict[str, Callable[[str, Param], str]] = {
    "trim": lambda v, p: f"trim({v})",
    "lower": lambda v, p: f"lower({v})",
    "upper": lambda v, p: f"upper({v})",
    "lower_trim": lambda v, p: f"trim(lower({v}))",
    "upper_trim": lambda v, p: f"trim(upper({v}))",
    "regexp_replace": lambda v, p: f"regexp_replace({v}, {p('pattern', None)}, {p('replacement', '')})",
    "regexp_extract": lambda v, p: f"regexp_extract({v}, {p('pattern', None)}, {_number(p('group', '0'))})",
    "to_date": _date("yyyy-MM-dd"),
    "to_timestamp": _date("yyyy-MM-dd HH:mm:ss"),
    "left_pad": _pad("lpad"),
    "right_pad": _pad("rpad"),
    "substring": lambda v, p: (
        f"CASE WHEN {p('len', None)} IS NULL THEN substring({v}, {_number(p('pos', None))}) "
        f"ELSE substring({v}, {_number(p('pos', None))}, {_number(p('len', None))}) END"
    ),
    "set_default": lambda v, p: f"coalesce({v}, {p('value', None)})",
    "set_null": lambda v, p: "CAST(NULL AS string)",
}


def check_fix(fix: Mapping[str, object]) -> None:
    """Raise for a transform that is unknown or lacks a parameter it needs."""
    name = str(fix.get("transform") or "").strip()
    if name not in REQUIRED_PARAMS:
        raise ValueError(f"unsupported transform: {name!r}")
    absent = [p for p in REQUIRED_PARAMS[name] if fix.get(p) is None]
    if absent:
        raise ValueError(f"transform {name!r} lacks {absent}")
    for p in INTEGER_PARAMS.get(name, ()):
        if fix.get(p) is not None:
            int(str(fix[p]))


def _known(fix: Mapping[str, object], value: str) -> str:
    check_fix(fix)

    def param(name: str, default: str | None) -> str:
        given = fix.get(name, default)
        return "CAST(NULL AS string)" if given is None else quoted(given)

    return _SQL[str(fix["transform"]).strip()](value, param)


def chain_sql(fixes: Sequence[Mapping[str, object]], value: str) -> str:
    """SQL text of several transforms over a column, in list order."""
    out = f"CAST({column(value)} AS string)"
    for fix in fixes:
        out = _known(fix, out)
    return out


def chain(fixes: Sequence[Mapping[str, object]], value: str) -> Column:
    """Several transforms over a column as text, in list order."""
    return F.expr(chain_sql(fixes, value))


def build_column_exprs(
    fixes: Sequence[Mapping[str, object]], available: Sequence[str]
) -> dict[str, Column]:
    """Per target column the chained transforms; unknown columns are ignored."""
    targets = [c for c in dict.fromkeys(f.get("column") for f in fixes) if c in available]
    return {c: chain([f for f in fixes if f.get("column") == c], c) for c in targets}


def run_steps(value: str, fixes: str) -> str:
    """SQL text that folds an ``array<map<string,string>>`` of fixes over a text value."""

    def param(name: str, default: str | None) -> str:
        given = f"f['{name}']"
        return given if default is None else f"coalesce({given}, {quoted(default)})"

    branches = " ".join(f"WHEN '{name}' THEN {build('v', param)}" for name, build in _SQL.items())
    return f"aggregate({fixes}, CAST({value} AS string), (v, f) -> CASE trim(f['transform']) {branches} END)"


def is_bad_fix(fix: str = "f") -> str:
    """SQL text: true for a fix map whose transform is unknown or lacks a parameter."""
    name = f"trim({fix}['transform'])"
    known = ", ".join(quoted(t) for t in REQUIRED_PARAMS)
    tests = [f"{name} NOT IN ({known})"]
    for transform, params in REQUIRED_PARAMS.items():
        tests += [f"({name} = '{transform}' AND {fix}['{p}'] IS NULL)" for p in params]
    for transform, params in INTEGER_PARAMS.items():
        tests += [
            f"({name} = '{transform}' AND {fix}['{p}'] IS NOT NULL AND {_number(f'{fix}[{quoted(p)}]')} IS NULL)"
            for p in params
        ]
    return f"coalesce({' OR '.join(tests)}, true)"
