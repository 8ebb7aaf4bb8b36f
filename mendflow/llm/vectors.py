"""Near-duplicate vectors by sorted projection passes.

Equal vectors are one from the start. In each pass a vector's key is 64 sign bits of its projections
on random directions; vectors are ordered by that key over range partitions, each is compared
with the ``WINDOW`` before it by its true cosine, also across the edges of partitions, and what is
at least ``SIMILARITY`` is linked. A task hands on a spanning set of the links it finds, so a group
gives rows in proportion to its vectors. The links of all passes are united to components. The number
of passes follows from the number of vectors, so that a pair at the threshold is missed with a
probability of ``MISS`` if other vectors lie evenly.

Numbers of links are then counted exactly inside each component. In a component up to ``GROUP``
vectors all are compared. In a larger one, vectors within half the angle of its centre are linked with
each other without a look at them; only the others are compared with all, in blocks.

Vectors that are null, zero or hold null or infinite components or NaN link with nothing, nor do
vectors of different length. Rows are vectors: repeated rows are copies and link with each other. A
null ``vec_id`` is no component's name unless all its vectors have none. An empty table gives no rows;
other columns don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mendflow.llm.components import components
from mendflow.llm.runs import runs
from mendflow.sources.tables import cut_lineage

SIMILARITY = 0.95
WINDOW = 32
MISS = 0.01
#: Bits of a key that vectors of one topic are taken to share besides those chance gives.
TOPIC_BITS = 3
#: Passes in one job; each reads and shuffles the vectors once.
PASSES_AT_ONCE = 6
GROUP, BLOCK = 512, 2048
#: Numbers in a slice of vectors that is compared at once.
SLICE_NUMBERS = 1 << 20


def passes_for(n: int, similarity: float = SIMILARITY) -> int:
    """Passes after which a pair at the threshold is missed with probability ``MISS``."""
    same_bit = 1 - math.acos(similarity) / math.pi
    bits = max(0.0, math.log2(max(n, 1) / WINDOW)) + TOPIC_BITS
    return math.ceil(math.log(MISS) / math.log1p(-(same_bit**bits)))


def vectors_of(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """The unit vectors of a list column in double precision, by length: which rows, and their vectors."""
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy().astype(np.float64)
    begin = np.cumsum(size) - size
    out = []
    for d in np.unique(size):
        rows = np.flatnonzero(size == d)
        v = flat[begin[rows][:, None] + np.arange(d)]
        v /= np.abs(v).max(1, keepdims=True)
        out.append((rows, v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]))
    return out


def sign_keys(v: np.ndarray, turn: int) -> np.ndarray:
    """64 sign bits of each vector's projections in a pass, so that signed order is that of the bits."""
    directions = np.random.default_rng([turn, v.shape[1]]).standard_normal((v.shape[1], 64))
    bits = np.packbits(v @ directions >= 0, axis=1)
    return (bits.view(">u8")[:, 0].astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)


def window_links(v: np.ndarray, piece: np.ndarray, window: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that connect all vectors which are similar to one up to ``window`` places before, in one piece."""
    if len(v) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    near = (np.einsum("ij,ij->i", v[1:], v[:-1]) >= similarity) & (piece[1:] == piece[:-1])
    label = np.append(0, np.cumsum(~near))
    first, second = [np.flatnonzero(near)], [np.flatnonzero(near) + 1]
    parent = np.arange(label[-1] + 1)

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for step in range(2, min(window, len(v) - 1) + 1):
        near = np.einsum("ij,ij->i", v[step:], v[:-step]) >= similarity
        at = np.flatnonzero(near & (piece[step:] == piece[:-step]) & (label[step:] != label[:-step]))
        if not len(at):
            continue
        _, one = np.unique(label[at] * len(parent) + label[at + step], return_index=True)
        kept = []
        for i in at[one].tolist():
            a, b = root(label[i]), root(label[i + step])
            if a != b:
                parent[max(a, b)] = min(a, b)
                kept.append(i)
        while (parent[parent] != parent).any():
            parent = parent[parent]
        label = parent[label]
        first.append(np.array(kept, np.int64))
        second.append(np.array(kept, np.int64) + step)
    return np.concatenate(first), np.concatenate(second)


def _projected(turns: range):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            for rows, v in vectors_of(batch.column(2)):
                own = batch.take(pa.array(rows))
                size = pa.array(np.full(len(rows), v.shape[1], np.int32))
                for turn in turns:
                    columns = [pa.array(np.full(len(rows), turn, np.int32)), size, pa.array(sign_keys(v, turn)), *own.columns]
                    yield pa.RecordBatch.from_arrays(columns, names=["turn", "size", "h", "k1", "k2", "v"])

    return run


_FOUND = "kind int, part int, place int, turn int, size int, a1 long, a2 long, b1 long, b2 long, v array<{}>"
_LINK, _HEAD, _TAIL = 0, 1, 2


def _compared(window: int, similarity: float):
    """Links in the windows of a sorted partition, and the rows at its edges."""

    def rows_out(kind: int, part: int, place, table: pa.RecordBatch | pa.Table) -> pa.RecordBatch:
        n = len(table)
        same = [pa.array(np.full(n, x, np.int32)) for x in (kind, part)]
        none = pa.nulls(n, pa.int64())
        columns = [*same, pa.array(np.asarray(place, np.int32)), *[table.column(c) for c in ("turn", "size", "k1", "k2")]]
        columns += [none, none, table.column("v")]
        return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _FOUND.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, held, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            at = 0
            while at < len(batch):
                size = batch.column("size")[at].as_py()
                own = batch.slice(at, max(window, SLICE_NUMBERS // max(size, 1)))
                at += len(own)
                if seen < window:
                    head = own.slice(0, window - seen)
                    yield rows_out(_HEAD, part, seen + np.arange(len(head)), head)
                seen += len(own)
                whole = own if held is None else pa.concat_batches([held, own])
                yield from _links(whole, window, similarity, part)
                held = whole.slice(max(0, len(whole) - window))
        if held is not None:
            yield rows_out(_TAIL, part, np.arange(len(held)), held)

    return run


def _links(rows: pa.RecordBatch, window: int, similarity: float, part: int) -> Iterator[pa.RecordBatch]:
    piece = rows.column("turn").to_numpy().astype(np.int64) << 32 | rows.column("size").to_numpy()
    for which, v in vectors_of(rows.column("v")):
        a, b = window_links(v, piece[which], window, similarity)
        a, b = (rows.take(pa.array(which[x])) for x in (a, b))
        none = [pa.array(np.full(len(a), x, np.int32)) for x in (_LINK, part, 0)]
        columns = [*none, a.column("turn"), a.column("size"), *[x.column(k) for x in (a, b) for k in ("k1", "k2")]]
        columns.append(pa.nulls(len(a), rows.column("v").type))
        yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _FOUND.split(", ")])


def _across(window: int, similarity: float):
    """Links between the end of one partition and the beginning of the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in runs(batches, ["edge"], lambda rows: _links(rows, window, similarity, 0)):
            yield found.select(["a1", "a2", "b1", "b2"])

    return run


def _pass_links(distinct: DataFrame, turns: range, similarity: float) -> DataFrame:
    """Links (a, b) that passes find, enough to connect all that they find."""
    element = dict(distinct.dtypes)["v"][6:-1]
    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = distinct.select("k1", "k2", "v").mapInArrow(
        _projected(turns), f"turn int, size int, h long, k1 long, k2 long, v array<{element}>"
    )
    order = ["turn", "size", "h", "k1", "k2"]
    ordered = keyed.repartitionByRange(n, *order).sortWithinPartitions(*order)
    found = cut_lineage(ordered.mapInArrow(_compared(WINDOW, similarity), _FOUND.format(element)))
    parts = found.select("part").distinct()  # one row for each partition
    after = parts.select(F.col("part").alias("edge"), F.lead("part").over(Window.orderBy("part")).alias("part"))
    columns = ["place", "turn", "size", F.col("a1").alias("k1"), F.col("a2").alias("k2"), "v"]
    tails = found.filter(f"kind = {_TAIL}").select(F.col("part").alias("edge"), F.lit(0).alias("side"), *columns)
    heads = found.filter(f"kind = {_HEAD}").join(F.broadcast(after), "part").select("edge", F.lit(1).alias("side"), *columns)
    edges = tails.unionByName(heads).repartition("edge").sortWithinPartitions("edge", "side", "place")
    between = edges.mapInArrow(_across(WINDOW, similarity), "a1 long, a2 long, b1 long, b2 long")
    links = found.filter(f"kind = {_LINK}").select("a1", "a2", "b1", "b2").unionByName(between)
    return links.select(*[F.struct(F.col(f"{x}1").alias("k1"), F.col(f"{x}2").alias("k2")).alias(x) for x in "ab"])


def _small_counts(similarity: float):
    """Weights of all vectors that each vector of a component is linked with."""

    def work(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        copies = rows.column("copies").to_numpy()
        for which, v in vectors_of(rows.column("v")):
            near = v @ v.T >= similarity
            np.fill_diagonal(near, True)
            own = rows.take(pa.array(which))
            yield pa.RecordBatch.from_arrays(
                [own.column("k1"), own.column("k2"), pa.array(near @ copies[which] - 1)], names=["k1", "k2", "n_links"]
            )

    return lambda batches: runs(batches, ["r1", "r2"], work)


def _block_counts(similarity: float):
    """Weights of linked vectors between the outer ones of a block and all of another block."""

    def work(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        outer = rows.column("outer").to_numpy(zero_copy_only=False)
        one, all_rows = (rows.filter(pa.array(rows.column("side").to_numpy() == s)) for s in (0, 1))
        if not len(one) or not len(all_rows):
            return
        (_, a), (_, b) = vectors_of(one.column("v"))[0], vectors_of(all_rows.column("v"))[0]
        near = a @ b.T >= similarity
        keys = [np.stack([x.column(k).to_numpy() for k in ("k1", "k2")], 1) for x in (one, all_rows)]
        same = (keys[0][:, None, 0] == keys[1][None, :, 0]) & (keys[0][:, None, 1] == keys[1][None, :, 1])
        near &= ~same
        core = ~all_rows.column("outer").to_numpy(zero_copy_only=False)
        for x, n in (
            (one, near @ all_rows.column("copies").to_numpy()),
            (all_rows.filter(pa.array(core)), (one.column("copies").to_numpy() @ near)[core]),
        ):
            yield pa.RecordBatch.from_arrays([x.column("k1"), x.column("k2"), pa.array(n)], names=["k1", "k2", "n_links"])

    return lambda batches: runs(batches, ["r1", "r2", "i", "j"], work)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of unit vectors by component."""
    for batch in batches:
        if not len(batch):
            continue
        roots = np.stack([batch.column(k).to_numpy() for k in ("r1", "r2")], 1)
        for rows, v in vectors_of(batch.column("v")):
            names, which = np.unique(roots[rows], axis=0, return_inverse=True)
            total = np.zeros((len(names), v.shape[1]))
            np.add.at(total, which.reshape(-1), v)
            d = v.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    *[pa.array(np.repeat(names[:, i], d)) for i in (0, 1)],
                    pa.array(np.tile(np.arange(d, dtype=np.int32), len(names))),
                    pa.array(total.reshape(-1)),
                ],
                names=["r1", "r2", "at", "x"],
            )


def _outer(similarity: float):
    """Whether a vector is further than half the allowed angle from its component's centre."""
    half = math.acos(similarity) / 2 - 1e-7

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            outer = np.ones(len(batch), bool)
            if len(batch):
                centre = batch.column("centre").flatten().to_numpy()
                for rows, v in vectors_of(batch.column("v")):
                    d = v.shape[1]
                    c = centre.reshape(-1, d)[rows] if len(centre) == d * len(batch) else None
                    if c is not None:
                        norm = np.sqrt(np.einsum("ij,ij->i", c, c))
                        cosine = np.einsum("ij,ij->i", v, c) / np.where(norm > 0, norm, np.inf)
                        outer[rows] = np.arccos(np.clip(cosine, -1, 1)) > half
            yield batch.drop_columns(["centre"]).append_column("outer", pa.array(outer))

    return run


def link_counts(members: DataFrame, similarity: float = SIMILARITY, group: int = GROUP, block: int = BLOCK) -> DataFrame:
    """``n_links`` of every vector of the components (``r1``, ``r2``), copies included, itself not."""
    by = ["r1", "r2"]
    schema = "k1 long, k2 long, n_links long"
    sizes = cut_lineage(members.groupBy(*by).agg(F.count("*").alias("n")))
    sized = cut_lineage(members.join(sizes, by))
    few = sized.filter(F.col("n") <= group).select(*by, "k1", "k2", "copies", "v").repartition(*by).sortWithinPartitions(*by)
    small = few.mapInArrow(_small_counts(similarity), schema)
    large = sized.filter(F.col("n") > group)
    if large.isEmpty():
        return small
    element = dict(members.dtypes)["v"][6:-1]
    sums = large.select(*by, "v").mapInArrow(_sums, "r1 long, r2 long, at int, x double").groupBy(*by, "at").agg(F.sum("x").alias("x"))
    # A list has one number for each dimension.
    centres = cut_lineage(
        sums.groupBy(*by).agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "x"))), lambda s: s["x"]).alias("centre"))
    )
    plain = f"r1 long, r2 long, n long, k1 long, k2 long, copies long, v array<{element}>"
    names = [x.split()[0] for x in plain.split(", ")]
    marked = cut_lineage(
        large.join(centres, by).select(*names, "centre").mapInArrow(_outer(similarity), f"{plain}, outer boolean")
    )
    totals = cut_lineage(
        marked.groupBy(*by).agg(
            F.sum(F.when(F.col("outer"), 0).otherwise(F.col("copies"))).alias("core"), F.count_if("outer").alias("rim")
        )
    )
    marked = marked.join(totals, by)
    base = marked.select("k1", "k2", F.when(F.col("outer"), F.col("copies")).otherwise(F.col("core")).alias("n_links"))
    base = base.withColumn("n_links", F.col("n_links") - 1)

    def blocks(n: str) -> Column:
        return F.greatest(F.ceil(F.col(n) / block), F.lit(1).cast("long"))

    def dealt(n: str) -> Column:
        return F.pmod(F.xxhash64(F.lit("block"), "k1", "k2"), blocks(n))

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), blocks(n) - 1))

    rows = marked.filter("rim > 0")
    columns = ["k1", "k2", "copies", "v", "outer"]
    one = rows.filter("outer").select(*by, dealt("rim").alias("i"), every("n").alias("j"), F.lit(0).alias("side"), *columns)
    other = rows.select(*by, every("rim").alias("i"), dealt("n").alias("j"), F.lit(1).alias("side"), *columns)
    key = [*by, "i", "j"]
    pairs = one.unionByName(other).repartition(*key).sortWithinPartitions(*key)
    more = pairs.mapInArrow(_block_counts(similarity), schema)
    summed = base.unionByName(more).groupBy("k1", "k2").agg(F.sum("n_links").alias("n_links"))
    return small.unionByName(summed)


def classify(
    embeddings: DataFrame, similarity: float = SIMILARITY, group: int = GROUP, block: int = BLOCK
) -> DataFrame:
    """A row for each vector (``vec_id``, ``embedding``): ``n_links``, ``component_id``, and if it is ``kept``."""
    v = F.col("embedding")
    infinite = F.lit(math.inf)
    usable = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite)) & F.exists(v, lambda x: x != 0)
    key = F.when(F.coalesce(usable, F.lit(False)), F.struct(F.xxhash64(v).alias("k1"), F.xxhash64(F.lit("second"), v).alias("k2")))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), key.alias("key"))
    distinct = cut_lineage(
        rows.filter(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("v").alias("v"))
        .select("key.k1", "key.k2", "id", "copies", "v")
    )
    links, total = [], passes_for(distinct.count(), similarity)
    for start in range(0, total, PASSES_AT_ONCE):
        turns = range(start, min(start + PASSES_AT_ONCE, total))
        links.append(cut_lineage(_pass_links(distinct, turns, similarity)))
    united = links[0]
    for more in links[1:]:
        united = united.unionByName(more)
    of = components(united).select("node.k1", "node.k2", F.col("root.k1").alias("r1"), F.col("root.k2").alias("r2"))
    members = cut_lineage(distinct.join(of, ["k1", "k2"]))
    counts = link_counts(members, similarity, group, block)
    # Written first, so that what is joined back is a plain table and a large component can be split.
    named = cut_lineage(members.groupBy("r1", "r2").agg(F.min("id").alias("component_id")))
    found = members.select("k1", "k2", "r1", "r2").join(named, ["r1", "r2"]).join(counts, ["k1", "k2"])
    stats = cut_lineage(
        distinct.select("k1", "k2", "id", "copies")
        .join(found.select("k1", "k2", "component_id", "n_links"), ["k1", "k2"], "left")
        .select(
            "k1",
            "k2",
            F.coalesce("component_id", "id").alias("component_id"),
            F.coalesce("n_links", F.col("copies") - 1).alias("n_links"),
        )
    )
    keyed = rows.select("vec_id", "key.k1", "key.k2", F.col("key").isNull().alias("alone"))
    return keyed.join(stats, ["k1", "k2"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("alone"), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(F.col("alone"), True).otherwise(F.col("vec_id").eqNullSafe(F.col("component_id"))).alias("kept"),
    )


ORACLE = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS row, vec_id, embedding::DOUBLE[] AS v,
    embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS usable
  FROM embeddings
), l AS (
  SELECT a.row AS a, b.row AS b FROM v a JOIN v b ON a.row <> b.row AND len(a.v) = len(b.v)
    AND CASE WHEN a.usable AND b.usable THEN list_cosine_similarity(a.v, b.v) >= 0.95 ELSE false END
), r AS (
  SELECT row AS a, row AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b
), c AS (
  SELECT r.a, min(v.vec_id) AS component_id FROM r JOIN v ON v.row = r.b GROUP BY r.a
), n AS (
  SELECT a, count(*) AS n FROM l GROUP BY a
)
SELECT v.vec_id::BIGINT AS vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id::BIGINT AS component_id,
  v.vec_id IS NOT DISTINCT FROM c.component_id AS kept
FROM v JOIN c ON c.a = v.row LEFT JOIN n ON n.a = v.row
"""
