"""Repairs found in the data: chains of transforms that turn failing values into the shape of passing ones.

A value's shape is its runs of digits, capitals, small letters and blanks with their lengths, and every other
character as it is. The commonest shapes of the failing values of each rule, and of the passing
values of its column, are counted in Spark; only these few shapes reach the driver. There, steps of the
transform vocabulary are tried on the failing shapes until they are passing ones. Whether a chain
repairs values, and how many, is decided by the checks over all rows, as for every other candidate.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from string import ascii_lowercase, ascii_uppercase, digits

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mendflow.operators.checks import VALUE_CHECKS, Check, parse_checks, value_fails, value_of

#: Commonest shapes that are looked at for each rule and column, steps of a chain, chains of a rule.
SHAPES, STEPS, CHAINS = 8, 3, 24

Token = tuple[str, int | str]
Shape = tuple[Token, ...]
Chain = tuple[Mapping[str, str], ...]

_CLASS = {"D": "[0-9]", "U": "[A-Z]", "L": "[a-z]", "S": "\\s"}
_BREAK = "\t"
_BLANKS = " \t\n\v\f\r"
#: The characters of the classes, and the class of each.
_CLASSES = digits + ascii_uppercase + ascii_lowercase + _BLANKS, "D" * 10 + "U" * 26 + "L" * 26 + "S" * len(_BLANKS)


def shape_of(value: Column) -> Column:
    """A value's shape as text, for example ``U1``, ``D4`` for ``A1005``."""
    runs = F.regexp_extract_all(value, F.lit(r"(?s)[0-9]+|[A-Z]+|[a-z]+|\s+|."), F.lit(0))

    def token(run: Column) -> Column:
        kinds = F.lit(None)
        for kind, pattern in _CLASS.items():
            kinds = F.coalesce(kinds, F.when(run.rlike(f"^{pattern}"), kind))
        return F.coalesce(F.concat(kinds, F.length(run).cast("string")), F.concat(F.lit("="), run))

    return F.array_join(F.transform(runs, token), _BREAK)


def read_shape(text: str) -> Shape:
    return tuple((t[0], t[1:] if t[0] == "=" else int(t[1:])) for t in text.split(_BREAK) if t)


def _commonest(values: DataFrame, by: str, n: int) -> dict[str, list[Shape]]:
    """The ``n`` commonest shapes of each group; at most that many rows a group are collected."""
    # Rows are grouped by the classes of their characters; only one value of each such group is read as a shape.
    classes = values.groupBy(by, F.translate("value", *_CLASSES).alias("classes")).agg(F.count("*").alias("rows"))
    counts = classes.withColumn("shape", shape_of(F.translate("classes", "DULS", "0Aa ")))
    order = Window.partitionBy(by).orderBy(F.desc("rows"), "shape")
    found: dict[str, list[Shape]] = {}
    for r in counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n).orderBy(by, "rank").collect():
        found.setdefault(r[by], []).append(read_shape(r["shape"]))
    return found


def _merged(tokens: Sequence[Token]) -> Shape:
    """Neighbouring runs of one class are one run."""
    out: list[Token] = []
    for kind, n in tokens:
        if out and kind != "=" and out[-1][0] == kind:
            out[-1] = (kind, out[-1][1] + n)
        else:
            out.append((kind, n))
    return tuple(out)


def _regex(tokens: Shape, exact: bool = False) -> str:
    return "".join(re.escape(n) if k == "=" else _CLASS[k] + (f"{{{n}}}" if exact else "+") for k, n in tokens)


def _replaced(pattern: str, replacement: str = "") -> Mapping[str, str]:
    return {"transform": "regexp_replace", "pattern": pattern, "replacement": replacement}


def _separators(shapes: Sequence[Shape]) -> list[str]:
    seen = dict.fromkeys(n if k == "=" else " " for s in shapes for k, n in s if k == "=" or (k, n) == ("S", 1))
    return list(seen)


def _dates(shape: Shape) -> Iterator[str]:
    """Date formats that a shape may be written in."""
    if shape == (("D", 8),):
        yield from ("yyyyMMdd", "ddMMyyyy", "MMddyyyy")
        return
    if len(shape) < 5 or any(k not in "=S" for k, _ in (shape[1], shape[-2])):
        return
    one, two = (f"'{n}'" if k == "=" and n.isalpha() else n if k == "=" else " " * n for k, n in (shape[1], shape[-2]))
    first, middle, last = shape[0], shape[2:-2], shape[-1]
    if first[0] != "D" or last[0] != "D":
        return
    if middle == (("U", 1), ("L", 2)) and last[1] == 4:
        yield f"{'d' * min(first[1], 2)}{one}MMM{two}yyyy"
    if len(middle) != 1 or middle[0][0] != "D":
        return
    short = {1: 1, 2: 2}
    if first[1] == 4 and middle[0][1] in short and last[1] in short:
        yield f"yyyy{one}{'M' * middle[0][1]}{two}{'d' * last[1]}"
    if last[1] == 4 and first[1] in short and middle[0][1] in short:
        yield f"{'d' * first[1]}{one}{'M' * middle[0][1]}{two}yyyy"
        yield f"{'M' * first[1]}{one}{'d' * middle[0][1]}{two}yyyy"


_ISO_DATE: Shape = (("D", 4), ("=", "-"), ("D", 2), ("=", "-"), ("D", 2))


def _next(shape: Shape, goals: Sequence[Shape]) -> Iterator[tuple[Shape, Mapping[str, str]]]:
    """Shapes one transform away, with that transform."""
    if shape and (shape[0][0] == "S" or shape[-1][0] == "S"):
        yield shape[shape[0][0] == "S" : len(shape) - (shape[-1][0] == "S")], {"transform": "trim"}
    for kind, other, name in (("L", "U", "upper"), ("U", "L", "lower")):
        if any(k == kind for k, _ in shape):
            yield _merged([(other if k == kind else k, n) for k, n in shape]), {"transform": name}
    for goal in goals:
        if len(shape) == len(goal) == 1 and shape[0][0] == goal[0][0] in ("D", "U") and shape[0][1] < goal[0][1]:
            pad = "0" if shape[0][0] == "D" else "A"
            yield goal, {"transform": "left_pad", "length": str(goal[0][1]), "pad": pad}
        runs = [t for t in goal if t[0] != "=" and t != ("S", 1)]
        if len(shape) == 1 and len(runs) > 1 and _merged(runs) == shape:
            groups, text, k = "".join(f"({_CLASS[c]}{{{n}}})" for c, n in runs), "", 0
            for t in goal:
                k += t in runs
                text += f"${k}" if t[0] != "=" and t != ("S", 1) else (t[1] if t[0] == "=" else " ")
            yield goal, _replaced(f"^{groups}$", text)
    if _ISO_DATE in goals:
        for pattern in _dates(shape):
            yield _ISO_DATE, {"transform": "to_date", "from_format": pattern}
    own = _separators([shape])
    for c in own:
        seen = ("S", 1) if c == " " else ("=", c)
        pattern = r"\s" if c == " " else re.escape(c)
        yield _merged([t for t in shape if t != seen]), _replaced(pattern)
        for d in _separators(goals):
            if d != c:
                new = ("S", 1) if d == " " else ("=", d)
                yield _merged([new if t == seen else t for t in shape]), _replaced(pattern, d.replace("$", r"\$"))
    for i in range(1, len(shape)):
        yield shape[i:], _replaced(f"^{_regex(shape[:i])}")
        yield shape[:-i], _replaced(f"{_regex(shape[-i:])}$")


def chains_between(failing: Sequence[Shape], passing: Sequence[Shape], most: int = CHAINS) -> list[Chain]:
    """Chains that turn one of the failing shapes into a passing one, the shortest first."""
    goals, found = set(passing), {}
    for start in failing:
        level: dict[Shape, list[Chain]] = {start: [()]}
        reached = {start}
        for _ in range(STEPS):
            after: dict[Shape, list[Chain]] = {}
            for shape, chains in level.items():
                for to, step in _next(shape, passing):
                    if to in goals:
                        for chain in chains:
                            found.setdefault(tuple(tuple(sorted(s.items())) for s in (*chain, step)), (*chain, step))
                    elif to and to not in reached:
                        after.setdefault(to, []).extend((*c, step) for c in chains[:2])
            reached |= set(after)
            level = after
    return sorted(found.values(), key=len)[:most]


def induced_candidates(
    failing: DataFrame, passing: DataFrame, checks: Sequence[Mapping | Check], shapes: int = SHAPES
) -> dict[str, list[Chain]]:
    """Chains for each rule of one column, from its failing values and the column's passing ones.

    ``failing`` has ``rule_violations``. A passing value is one that the check itself lets pass.
    """
    tried = [
        c
        for c in parse_checks(checks)
        if c.function in VALUE_CHECKS and len(c.columns) == 1 and c.columns[0] in failing.columns and c.columns[0] in passing.columns
    ]
    if not tried:
        return {}

    def pairs(frame: DataFrame, mine) -> DataFrame:
        entries = [
            F.when(mine(c), F.struct(F.lit(c.name).alias("rule"), F.col(c.columns[0]).cast("string").alias("value"))) for c in tried
        ]
        return frame.select(F.inline(F.array_compact(F.array(*entries)))).filter("value is not null")

    bad = _commonest(pairs(failing, lambda c: F.array_contains("rule_violations", c.name)), "rule", shapes)
    good = _commonest(
        pairs(passing, lambda c: F.expr(f"NOT {value_fails(c, value_of(c.columns[0], passing.columns))}")), "rule", shapes
    )
    return {rule: chains_between(shapes_, good.get(rule, [])) for rule, shapes_ in bad.items()}
