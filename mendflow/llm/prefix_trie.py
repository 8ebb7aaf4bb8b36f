"""The trie of all conversations' turn sequences, with what sharing each prefix would save.

The digest of a prefix is the xor of the hashes of its turns, each hashed with its depth, so it comes
from running sums and the texts themselves stay behind. A count-min sketch of all prefix digests
screens them: a cell is never less than a digest's count, so an estimate of one proves that only
one conversation has the prefix. Such nodes are written where they are, without a shuffle; only
prefixes that may be shared are grouped, exactly. A larger corpus than the sketch has cells for
makes more of them go that way and changes no result.

Numbers over subtrees need no walk. Every node belongs to its smallest member; then a conversation's
nodes are the lower end of its path, a node's subtree is that of its members, and sums over a
subtree are sums over members of what each one owns at or below that depth.

Conversations are ordered by turn (null first), ties by role and text; null role or text is empty;
rows without ``conv_id`` belong to no conversation; repeated rows are turns of their own; an empty
table gives no rows; other columns don't matter. ``%`` takes the sign of the id, as SQL does.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mendflow.llm.words import mixed
from mendflow.sources.tables import cut_lineage

#: Conversations whose ids differ below this begin like the first of them.
FAMILY = 100
#: Turns taken from the family's first conversation are fewer than this.
HEADS = 6
#: Rows of the sketch, cells for each prefix, and cells of a row at most (a byte each).
SKETCH_ROWS, CELLS_EACH, MOST_CELLS = 3, 8, 1 << 24
SKETCH_BLOCK = 1 << 16
#: Turns of one conversation that are summed by one task.
BLOCK_TURNS = 1 << 16
#: Ids in a piece of a node's list of conversations.
IDS_TOGETHER = 1 << 15

_TURNS = "conv_id long, part int, place long, t1 long, t2 long, chars long"


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The place of each turn among those of its conversation in this task; rows are sorted."""
    from pyspark import TaskContext

    part, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        ids = batch.column(0).to_numpy()
        if not len(ids):
            continue
        starts = np.append(0, np.flatnonzero(np.diff(ids)) + 1)
        before = np.zeros(len(starts), np.int64)
        if ids[0] == last:
            before[0] = seen
        sizes = np.diff(np.append(starts, len(ids)))
        place = np.arange(len(ids)) - np.repeat(starts - before, sizes) + 1
        last, seen = ids[-1], int(place[-1])
        columns = [batch.column(0), pa.array(np.full(len(ids), part, np.int32)), pa.array(place), *batch.columns[1:]]
        yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _TURNS.split(", ")])


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``pos`` (from 1), two hashes of role and text, and the text's length, of every turn.

    Turns are dealt by ranges and numbered range by range, so a long conversation is split.
    """
    n = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text")
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    hashes = [F.xxhash64("role", "text").alias("t1"), F.xxhash64(F.lit("second"), "role", "text").alias("t2")]
    sorted_rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = cut_lineage(
        sorted_rows.select("conv_id", *hashes, F.length("text").cast("long").alias("chars")).mapInArrow(_numbered, _TURNS)
    )
    ends = placed.groupBy("conv_id", "part").agg(F.max("place").alias("n"))
    before = ends.withColumn("before", F.sum("n").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("n"))
    late = before.filter("before > 0").select("conv_id", "part", "before")  # of conversations over several ranges
    return placed.join(late, ["conv_id", "part"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("pos"), "t1", "t2", "chars"
    )


def rebuild(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation (its length ``len``), and its turns after the head comes from the family's first."""
    own = rows.groupBy("conv_id").agg(F.max("pos").alias("own"))
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("taken")
    first = own.filter(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
    convs = (
        own.select("conv_id", "own", base.alias("base"), taken)
        .join(first, "base", "left")
        .withColumn("head", F.least("taken", F.coalesce("there", F.lit(0).cast("long"))))
        .withColumn("len", F.col("head") + F.greatest(F.col("own") - F.col("taken"), F.lit(0).cast("long")))
    )
    convs = cut_lineage(convs.select("conv_id", "base", "taken", "head", "len"))
    heads = rows.filter((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < HEADS)).withColumnRenamed("conv_id", "base")
    content = ["t1", "t2", "chars"]
    head = heads.join(convs, "base").filter("pos <= taken").select("conv_id", "len", F.col("pos").alias("depth"), *content)
    rest = rows.join(convs, "conv_id").filter("pos > taken")
    rest = rest.select("conv_id", "len", (F.col("head") + F.col("pos") - F.col("taken")).alias("depth"), *content)
    return convs.select("conv_id", "len"), head.unionByName(rest)


def prefixes(rebuilt: DataFrame) -> DataFrame:
    """Digests of each prefix (``d1``, ``d2``) and of its parent (``p1``, ``p2``)."""
    rows = rebuilt.withColumns(
        {f"e{i}": F.xxhash64("depth", f"t{i}") for i in (1, 2)} | {"block": F.floor((F.col("depth") - 1) / BLOCK_TURNS)}
    ).drop("t1", "t2")
    running = Window.partitionBy("conv_id", "block").orderBy("depth")
    rows = rows.withColumns({f"x{i}": F.bit_xor(f"e{i}").over(running) for i in (1, 2)})
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        rebuilt.withColumn("block", F.floor((F.col("depth") - 1) / BLOCK_TURNS))
        .filter(F.col("len") > BLOCK_TURNS)
        .groupBy("conv_id", "block")
        .agg(*[F.bit_xor(F.xxhash64("depth", f"t{i}")).alias(f"y{i}") for i in (1, 2)])
    )
    late = blocks.select("conv_id", "block", *[F.bit_xor(f"y{i}").over(earlier).alias(f"b{i}") for i in (1, 2)])
    rows = rows.join(late, ["conv_id", "block"], "left")
    digest = {i: F.col(f"x{i}").bitwiseXOR(F.coalesce(f"b{i}", F.lit(0).cast("long"))) for i in (1, 2)}
    return rows.select(
        "conv_id",
        "len",
        "depth",
        "chars",
        *[digest[i].alias(f"d{i}") for i in (1, 2)],
        *[digest[i].bitwiseXOR(F.col(f"e{i}")).alias(f"p{i}") for i in (1, 2)],
    )


def _cells(d1: np.ndarray, d2: np.ndarray, row: int, cells: int) -> np.ndarray:
    return (mixed(d1.view(np.uint64) ^ mixed(d2.view(np.uint64), row), row) & np.uint64(cells - 1)).astype(np.int64)


def _added(total: np.ndarray, more: np.ndarray) -> None:
    """Add to counters that stop at two."""
    total += more
    np.minimum(total, 2, out=total)


def _sketched(cells: int):
    block = min(cells, SKETCH_BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((SKETCH_ROWS, cells), np.uint8)
        for batch in batches:
            d1, d2 = (np.ascontiguousarray(c.to_numpy()) for c in batch.columns)
            for row in range(SKETCH_ROWS):
                cell, n = np.unique(_cells(d1, d2, row, cells), return_counts=True)
                total[row, cell] = np.minimum(total[row, cell] + n, 2)
        by_block = total.reshape(-1, block)
        for i in np.flatnonzero(by_block.any(1)):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([by_block[i].tobytes()])], names=["block", "data"])

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of equal blocks, which follow each other."""
    now, total = None, None

    def out():
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([total.tobytes()])], names=["block", "data"])

    for batch in batches:
        for i, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            own = np.frombuffer(data.as_py(), np.uint8)
            if i == now:
                _added(total, own)
                continue
            if now is not None:
                yield out()
            now, total = i, own.copy()
    if now is not None:
        yield out()


def sketch(rows: DataFrame, cells: int) -> np.ndarray:
    """Counters of all digests, from partial ones of each task; the size is bounded by ``MOST_CELLS``."""
    schema = "block int, data binary"
    parts = rows.select("d1", "d2").mapInArrow(_sketched(cells), schema)
    merged = parts.repartition("block").sortWithinPartitions("block").mapInArrow(_merged, schema)
    total = np.zeros((SKETCH_ROWS * cells // min(cells, SKETCH_BLOCK), min(cells, SKETCH_BLOCK)), np.uint8)
    for row in merged.toLocalIterator():
        total[row["block"]] = np.frombuffer(row["data"], np.uint8)
    return total.reshape(SKETCH_ROWS, cells)


def _screened(known):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = known.value
        for batch in batches:
            proven = []
            for a, b in (("d1", "d2"), ("p1", "p2")):
                d1, d2 = (np.ascontiguousarray(batch.column(batch.schema.get_field_index(c)).to_numpy()) for c in (a, b))
                least = np.full(len(d1), 2, np.uint8)
                for row in range(SKETCH_ROWS):
                    least = np.minimum(least, counters[row, _cells(d1, d2, row, counters.shape[1])])
                proven.append(least == 1)
            # The root isn't in the sketch; it is never proven.
            proven[1] &= batch.column(batch.schema.get_field_index("depth")).to_numpy() > 1
            columns = [*batch.columns, pa.array(proven[0]), pa.array(proven[1])]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "alone", "parent_alone"])

    return run


def screen(rows: DataFrame, most_cells: int = MOST_CELLS) -> DataFrame:
    """The prefixes, with ``alone`` if the sketch proves that one conversation has it (and its parent)."""
    n = rows.count()
    cells = min(most_cells, 1 << max(6, (CELLS_EACH * n - 1).bit_length()))
    known = rows.sparkSession.sparkContext.broadcast(sketch(rows, cells))
    schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes) + ", alone boolean, parent_alone boolean"
    return rows.mapInArrow(_screened(known), schema)


_PIECES = "d1 long, d2 long, first long, ids string"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of each digest joined to pieces; rows are sorted."""
    for batch in batches:
        if not len(batch):
            continue
        d1, d2, ids = (c.to_numpy() for c in batch.columns)
        change = (np.diff(d1) != 0) | (np.diff(d2) != 0)
        starts = np.append(0, np.flatnonzero(change) + 1)
        sizes = np.diff(np.append(starts, len(ids)))
        texts = ids.astype(str).tolist()
        own = [
            (d1[s], d2[s], ids[s], ",".join(texts[s : min(s + IDS_TOGETHER, end)]))
            for first, end in zip(starts.tolist(), (starts + sizes).tolist(), strict=True)
            for s in range(first, end, IDS_TOGETHER)
        ]
        columns = [pa.array(v, t) for v, t in zip(zip(*own, strict=True), [pa.int64()] * 3 + [pa.string()], strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=["d1", "d2", "first", "ids"])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of all pieces of a digest, which follow each other; only one piece is held."""
    now, running = None, None
    for batch in batches:
        done = []
        for d1, d2, _, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if (d1, d2) == now:
                running.update(("," + ids).encode())
                continue
            if now is not None:
                done.append((*now, running.hexdigest()))
            now, running = (d1, d2), hashlib.sha256(ids.encode())
        if done:
            columns = [pa.array(v) for v in zip(*done, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["d1", "d2", "ends"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*now, running.hexdigest())], names=["d1", "d2", "ends"])


def ends_of(rows: DataFrame) -> DataFrame:
    """SHA-256 of the sorted ids of the conversations that end at each digest, joined by commas."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["d1", "d2", "conv_id"]
    pieces = rows.select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(_packed, _PIECES)
    by = ["d1", "d2"]
    return pieces.repartition(*by).sortWithinPartitions(*by, "first").mapInArrow(_digested, "d1 long, d2 long, ends string")


def _sha(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def trie(conversations: DataFrame, most_cells: int = MOST_CELLS) -> DataFrame:
    """A row for each node: its smallest member ``conv_id``, ``depth``, its parent's, and its numbers."""
    convs, rebuilt = rebuild(turns(conversations))
    convs = cut_lineage(convs)
    rows = cut_lineage(screen(cut_lineage(prefixes(rebuilt)), most_cells))
    maybe, alone = rows.filter("not alone"), rows.filter("alone")
    by = ["d1", "d2"]

    groups = maybe.groupBy(*by).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), F.max("len").alias("longest"), F.first("depth").alias("depth")
    )
    owned = groups.select("conv_id", "depth", "n", "longest")
    path = Window.partitionBy("conv_id").orderBy("depth")
    below = Window.partitionBy("conv_id").orderBy(F.desc("depth"))
    mine = F.col("n").isNotNull()
    next_alone = (F.coalesce("next", F.lit(-1)) != F.col("depth") + 1) & (F.col("depth") < F.col("len"))
    # The last row here is followed by nodes that are the conversation's own, the last of them a leaf.
    leaf = F.when(mine & (F.col("longest") == F.col("depth")) | F.col("next").isNull() & (F.col("depth") < F.col("len")), 1)
    values = (
        maybe.join(owned, ["conv_id", "depth"], "left")
        .withColumns({"next": F.lead("depth").over(path), "next_mine": F.lead(mine).over(path)})
        .withColumns(
            {
                "child": (next_alone | (F.col("next") == F.col("depth") + 1) & F.col("next_mine")).cast("long"),
                "leaves": F.sum(F.coalesce(leaf, F.lit(0)).cast("long")).over(below),
                "saved": F.sum(F.when(mine, (F.col("n") - 1) * F.col("chars")).otherwise(F.lit(0).cast("long"))).over(below),
            }
        )
    )
    nodes = values.groupBy(*by).agg(
        F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"),
        F.count("*").alias("n_convs"),
        F.sum(F.coalesce("child", F.lit(0).cast("long"))).alias("n_children"),
        F.sum("leaves").alias("n_leaves"),
        F.sum("saved").alias("saved_tokens"),
        F.first("p1").alias("p1"),
        F.first("p2").alias("p2"),
        F.first("parent_alone").alias("parent_alone"),
        (F.max(F.col("chars")) * (F.count("*") - 1)).alias("own_saved"),
    )
    nodes = cut_lineage(nodes)

    zero = F.lit(0).cast("long")
    nothing = convs.filter("len = 0").select(zero.alias("d1"), zero.alias("d2"), "conv_id")
    ends = cut_lineage(ends_of(maybe.filter("depth = len").select(*by, "conv_id").unionByName(nothing)))
    single = alone.select(
        "conv_id",
        "depth",
        F.lit(1).cast("long").alias("n_convs"),
        (F.col("depth") < F.col("len")).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        zero.alias("saved_tokens"),
        _sha(F.when(F.col("depth") == F.col("len"), F.col("conv_id").cast("string")).otherwise("")).alias("ends_sha256"),
        "p1",
        "p2",
        "parent_alone",
    )
    grouped = nodes.join(ends, by, "left").select(
        *[c for c in single.columns if c != "ends_sha256"], F.coalesce("ends", _sha(F.lit(""))).alias("ends_sha256")
    )
    lower = single.unionByName(grouped)

    # One row: the root.
    parts = [
        convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")),
        nodes.agg(F.sum("own_saved").alias("saved"), F.count_if(F.expr("n_children = 0")).alias("leaves"), F.count_if(F.expr("depth = 1")).alias("tops")),
        alone.agg(F.count_if(F.expr("depth = len")).alias("lone_leaves"), F.count_if(F.expr("depth = 1")).alias("lone_tops")),
        ends.filter("d1 = 0 and d2 = 0").agg(F.max("ends").alias("ends")),
    ]
    together = functools.reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    one = together.agg(*[F.max(c).alias(c) for c in together.columns]).filter("n_convs > 0")
    root = cut_lineage(
        one.select(
            "conv_id",
            zero.alias("depth"),
            F.lit(None).cast("long").alias("parent_conv_id"),
            "n_convs",
            (F.col("tops") + F.col("lone_tops")).alias("n_children"),
            F.greatest(F.col("leaves") + F.col("lone_leaves"), F.lit(1).cast("long")).alias("n_leaves"),
            F.coalesce("saved", zero).alias("saved_tokens"),
            F.coalesce("ends", _sha(F.lit(""))).alias("ends_sha256"),
        )
    )
    first = root.head()
    out = root.columns
    known = lower.filter("parent_alone").withColumn("parent_conv_id", F.col("conv_id")).select(*out)
    tops = lower.filter("depth = 1").withColumn("parent_conv_id", F.lit(first and first["conv_id"]).cast("long")).select(*out)
    parents = nodes.select(F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    others = lower.filter("depth > 1 and not parent_alone").join(parents, ["p1", "p2"]).select(*out)
    return root.unionByName(known).unionByName(tops).unionByName(others)


#: crc32 of a decimal number, eight shifts a character.
_CRC = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({c}::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), "
    "lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"
)

ORACLE = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, count(*) AS own, conv_id - conv_id % 100 AS base, {_CRC.format(c="conv_id")} % 6 AS taken FROM t GROUP BY conv_id
), m AS (
  SELECT c.*, least(c.taken, coalesce(b.own, 0)) AS head FROM c LEFT JOIN c b ON b.conv_id = c.base
), r AS (
  SELECT m.conv_id, t.pos AS depth, role, text FROM m JOIN t ON t.conv_id = m.base WHERE t.pos <= m.taken
  UNION ALL
  SELECT m.conv_id, m.head + t.pos - m.taken, role, text FROM m JOIN t ON t.conv_id = m.conv_id WHERE t.pos > m.taken
), p AS (
  SELECT conv_id, depth, length(text) AS chars, list({{'role': role, 'text': text}}) OVER (
    PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING) AS path FROM r
  UNION ALL
  SELECT conv_id, 0, 0, [] FROM m
), l AS (
  SELECT conv_id, max(depth) AS len FROM p GROUP BY conv_id
), n AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars, max(len) = depth AS leaf,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len = depth), '') AS ends
  FROM p JOIN l USING (conv_id) GROUP BY path, depth
), s AS (
  SELECT path[1:k] AS path, sum((n_convs - 1) * chars) AS saved, count(*) FILTER (leaf) AS leaves, count(*) FILTER (depth = k + 1) AS children
  FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM n) GROUP BY 1
)
SELECT n.conv_id::BIGINT AS conv_id, n.depth::BIGINT AS depth, q.conv_id::BIGINT AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
  s.children::BIGINT AS n_children, s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN s ON s.path = n.path LEFT JOIN n q ON n.depth > 0 AND q.path = n.path[1:n.depth - 1] AND q.depth = n.depth - 1
"""
