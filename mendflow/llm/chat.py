"""Reply trees formatted as chat conversations.

Messages point at their parents. Every root-to-leaf path is one conversation. Paths are found by
self-joins that double: after round k each leaf knows 2^k ancestors, so a tree of depth n takes
log2(n) rounds of equi-joins on message ids, without texts. Branches of a tree are ranked by the
sum of their messages' scores; the chosen ones are joined with their texts and formatted.

The template is, for each turn, ``<s>[INST]role[/INST]text</s>``. Control strings inside a role or
text get a backslash after their first character and a backslash gets another one, so no control
string is left inside and ``unescaped`` gives the text back. The loss mask is a list of spans of
the formatted string: the texts of the roles that are trained on.

Only expressions and joins are used. A message whose parent is missing is a root. A null id, of
which there may be several, is an id that no message replies to. Of messages with the same tree
and id the one of the smallest role, text and parent counts. Paths that run into a cycle have no
root and give no conversation. Null roles and texts are empty, null scores 0, a null tree is a
tree of its own. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mendflow.sources.tables import cut_lineage

BEGIN, OPEN, CLOSE, END = "<s>", "[INST]", "[/INST]", "</s>"
TRAINED = ("assistant",)


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in (BEGIN, END, OPEN, CLOSE):
        out = F.replace(out, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
    return out


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _paths(nodes: DataFrame) -> DataFrame:
    """Every ancestor of every leaf, the leaf itself included, with its distance."""
    links = nodes.select("tree", "node", "parent")
    known = links.select(F.col("tree").alias("t"), F.col("node").alias("up"))
    same = F.col("tree").eqNullSafe(F.col("t"))
    jumps = cut_lineage(
        links.join(known, same & (F.col("parent") == F.col("up")), "left").select("tree", "node", "up")
    )
    roots = jumps.filter("up is null").select("tree", "node")
    replied = jumps.filter("up is not null").select(
        F.col("tree").alias("t"), F.col("up").alias("answered")
    ).distinct()
    leaves = jumps.join(replied, same & (F.col("node") == F.col("answered")), "left_anti").select("tree", "node")
    paths = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("distance"))
    largest = jumps.groupBy("tree").count().agg(F.max("count")).head()[0] or 0
    jumps, step = jumps.filter("up is not null"), 1
    while step <= largest and not jumps.isEmpty():
        over = jumps.select(F.col("tree").alias("t"), F.col("node").alias("at"), F.col("up").alias("top"))
        further = paths.join(over, same & (F.col("node") == F.col("at"))).select(
            "tree", "leaf", F.col("top").alias("node"), (F.col("distance") + step).alias("distance")
        )
        paths = cut_lineage(paths.unionByName(further))
        jumps = cut_lineage(
            jumps.join(over, same & (F.col("up") == F.col("at"))).select("tree", "node", F.col("top").alias("up"))
        )
        step *= 2
    ends = roots.select(F.col("tree").alias("t"), F.col("node").alias("root"))
    rooted = paths.join(ends, same & (F.col("node") == F.col("root")), "left_semi").select(
        F.col("tree").alias("t"), F.col("leaf").alias("end")
    )
    return paths.join(rooted, same & (F.col("leaf") == F.col("end")), "left_semi")


def _formatted(turns: Column) -> list[Column]:
    """The conversation and its loss spans, from turns with escaped role and text."""
    whole = F.transform(
        turns, lambda t: F.concat(F.lit(BEGIN + OPEN), t["role"], F.lit(CLOSE), t["text"], F.lit(END))
    )
    spans = F.aggregate(
        turns,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda a, t: F.struct(
            (
                a["at"] + F.length(t["role"]) + F.length(t["text"]) + len(BEGIN + OPEN + CLOSE + END)
            ).alias("at"),
            F.when(
                t["trained"],
                F.array_append(
                    a["spans"],
                    F.struct(
                        (a["at"] + F.length(t["role"]) + len(BEGIN + OPEN + CLOSE)).alias("start"),
                        (a["at"] + F.length(t["role"]) + len(BEGIN + OPEN + CLOSE) + F.length(t["text"])).alias("end"),
                    ),
                ),
            )
            .otherwise(a["spans"])
            .alias("spans"),
        ),
        lambda a: a["spans"],
    )
    return [F.array_join(whole, "").alias("formatted"), spans.alias("loss_spans")]


def format_trees(messages: DataFrame, keep: int = 1, trained: tuple[str, ...] = TRAINED) -> DataFrame:
    """The ``keep`` best branches of each tree as conversations.

    ``messages``: tree, node, parent, role, text, score. Returns tree, leaf, rank, score,
    formatted, loss_spans (of code points).
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    node = F.coalesce(
        F.concat(F.lit("n"), F.col("node").cast("string")),
        F.concat(F.lit("?"), F.md5(F.concat_ws("|", role, F.coalesce(F.col("parent").cast("string"), F.lit("")), text))),
    )
    nodes = cut_lineage(
        messages.select(
            "tree",
            node.alias("node"),
            F.struct(
                role.alias("role"),
                text.alias("text"),
                F.concat(F.lit("n"), F.col("parent").cast("string")).alias("parent"),
                F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
            ).alias("m"),
        )
        .groupBy("tree", "node")
        .agg(F.min("m").alias("m"))
        .select("tree", "node", "m.parent", "m.role", "m.text", "m.score")
    )
    paths = _paths(nodes)
    mine = nodes.select(F.col("tree").alias("t"), F.col("node").alias("own"), "role", "text", "score")
    same = F.col("tree").eqNullSafe(F.col("t"))
    scored = (
        paths.join(mine.drop("role", "text"), same & (F.col("node") == F.col("own")))
        .groupBy("tree", "leaf")
        .agg(F.sum("score").alias("score"))
    )
    best = Window.partitionBy("tree").orderBy(F.col("score").desc(), "leaf")
    chosen = scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= keep)
    chosen = chosen.select(F.col("tree").alias("ct"), F.col("leaf").alias("cl"), "rank", F.col("score").alias("total"))
    turn = F.struct(
        (-F.col("distance")).alias("order"),
        escaped(F.col("role")).alias("role"),
        escaped(F.col("text")).alias("text"),
        F.col("role").isin(*trained).alias("trained"),
    )
    gathered = (
        paths.join(chosen, F.col("tree").eqNullSafe(F.col("ct")) & (F.col("leaf") == F.col("cl")))
        .join(mine.drop("score"), same & (F.col("node") == F.col("own")))
        .groupBy("tree", "leaf", "rank", F.col("total").alias("score"))
        .agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    )
    return gathered.select("tree", F.substring("leaf", 2, 1 << 30).alias("leaf"), "rank", "score", *_formatted(F.col("turns")))


def parsed(formatted: Column) -> Column:
    """The turns, role and text, of a formatted conversation."""
    marked = F.filter(F.split(formatted, END, -1), lambda x: x != "")
    head = len(BEGIN + OPEN)
    return F.transform(
        marked,
        lambda x: F.struct(
            unescaped(F.substr(F.substring_index(x, CLOSE, 1), F.lit(head + 1))).alias("role"),
            unescaped(
                F.substr(x, F.length(F.substring_index(x, CLOSE, 1)) + F.lit(len(CLOSE) + 1))
            ).alias("text"),
        ),
    )


def loss_text(formatted: str, spans: str) -> Column:
    """All text under the loss mask, unescaped."""
    pieces = F.transform(spans, lambda s: F.substr(formatted, s["start"] + 1, s["end"] - s["start"]))
    return F.array_join(F.transform(pieces, unescaped), "")


def chains(conversations: DataFrame) -> DataFrame:
    """Linear conversations (conv_id, turn, role, text) as reply trees: each row replies to the one before."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.withColumn("node", F.row_number().over(order))
    return rows.select(
        F.col("conv_id").alias("tree"),
        "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )


def digest(conversations: DataFrame) -> DataFrame:
    """Formats conversations and reads the result back: counts and digests of turns and loss text."""
    shown = cut_lineage(format_trees(chains(conversations)))
    read = shown.select(
        F.col("tree").alias("conv_id"),
        parsed(F.col("formatted")).alias("turns"),
        loss_text("formatted", "loss_spans").alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


ORACLE = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(role) + length(text)
    + len(regexp_extract_all(role || text, '\\\\|<s>|</s>|\\[INST\\]|\\[/INST\\]')) + 20 AS n FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(n) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
