"""Near-duplicate documents by ProbMinHash.

The elements of a text are its distinct runs of ``SHINGLE`` words, all of weight 1 however often
they occur, since that is what the decision compares. Each element is a Poisson process whose rate is its weight: its arrivals fall into random components of
the signature, and a component belongs to the element that arrives first. Arrivals end as soon as
they are later than every component's first. Two signatures agree in a component with the texts'
probability Jaccard similarity, which for equal weights is the Jaccard similarity.

Signatures are cut into bands; texts that share a band are candidates. A bucket of any size gives
a number of pairs in proportion to its members: each is paired with the bucket's most connected
text, then, if that left them in different classes, with texts drawn by hash, which differ from
bucket to bucket. What is then still in different classes is compared exactly: in buckets of at
most ``SMALL`` members all pairs, in the others, of which those that share members are one group, all
pairs by blocks, so no pair depends on a drawn text. A pair counts if the Jaccard similarity of the two texts' distinct shingles,
computed from the whole texts, is at least ``SIMILARITY``. Classes are the connected components.

Exact copies are one text from the start, so thousands of copies cost one row a task. Texts of
fewer words than a shingle have all their words as one; texts without words are only ever copies
of equal texts. Null text is empty. The class id is the least ``doc_id`` of the class, null if it
has none. Repeated rows are all classified alike; an empty table gives no rows; other columns
don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mendflow.llm.components import components
from mendflow.llm.runs import runs
from mendflow.llm.words import CHAIN, STEP, Words, mixed, pieces, text_key, windows, words_of
from mendflow.sources.tables import cut_lineage

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
#: Texts of a bucket, drawn by hash, that each of its members is paired with.
DRAWN = 3
#: Members up to which all pairs of a bucket that are in different classes are compared.
SMALL = 16
#: Texts and shingles of a block that is compared with another one, and numbers of a matrix that is held for it.
BLOCK, BLOCK_SHINGLES, DENSE_NUMBERS = 512, 1 << 18, 1 << 21


def shingles(words: Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of each shingle, repeats included."""
    h, owner, counts = words.hashes(), words.owner(), words.counts
    run, at = windows(h, words.first, k)
    owners, hashes = [owner[at]], [run]
    short = (counts > 0) & (counts < k)
    if short.any():
        h = h[short[owner]]
        which = np.flatnonzero(short)
        first = np.concatenate([[0], np.cumsum(counts[which])])
        mine = np.repeat(which, counts[which])
        for n in range(1, k):
            run, at = windows(h, first, n)
            whole = counts[mine[at]] == n
            owners.append(mine[at][whole])
            hashes.append(run[whole])
    return np.concatenate(owners), np.concatenate(hashes)


def distinct(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A key of each distinct shingle of a text, where it is first, and how often it occurs."""
    keys = mixed(hashes + owner.astype(np.uint64) * STEP)
    return np.unique(keys, return_index=True, return_counts=True)


def signatures(owner: np.ndarray, hashes: np.ndarray, weights: np.ndarray, texts: int, size: int) -> np.ndarray:
    """The winning element of each component for each text, 0 for texts without elements."""
    first = np.full(texts * size, np.inf)
    winner = np.zeros(texts * size, np.uint64)
    clock, arrival = np.zeros(len(hashes)), 0
    while len(hashes):
        arrival += 1
        r = mixed(hashes, arrival)
        clock = clock - np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weights
        component = ((mixed(r) >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)
        slot = owner * size + component.astype(np.int64)
        np.minimum.at(first, slot, clock)
        won = first[slot] == clock
        winner[slot[won]] = hashes[won]
        alive = clock < first.reshape(texts, size).max(1)[owner]
        owner, hashes, weights, clock = owner[alive], hashes[alive], weights[alive], clock[alive]
    return winner.reshape(texts, size)


def band_hashes(signature: np.ndarray, bands: int) -> np.ndarray:
    rows = signature.reshape(len(signature), bands, -1)
    total = np.zeros(rows.shape[:2], np.uint64)
    for i in range(rows.shape[2]):
        total = total * CHAIN + rows[:, :, i]
    return mixed(total + np.arange(bands, dtype=np.uint64) * STEP)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            words = words_of(piece.column(2))
            owner, hashes = shingles(words)
            one = distinct(owner, hashes)[1]
            own = np.flatnonzero(words.counts > 0)
            if not len(own):
                continue
            place = np.cumsum(words.counts > 0) - 1
            found = signatures(place[owner[one]], hashes[one], np.ones(len(one)), len(own), BANDS * ROWS)
            bands = band_hashes(found, BANDS).view(np.int64)
            lists = pa.ListArray.from_arrays(np.arange(len(own) + 1, dtype=np.int32) * BANDS, pa.array(bands.reshape(-1)))
            sizes = pa.array(np.bincount(owner[one], minlength=len(words.counts))[own])
            yield pa.RecordBatch.from_arrays(
                [piece.column(0).take(pa.array(own)), piece.column(1).take(pa.array(own)), sizes, lists],
                names=["k1", "k2", "size", "bands"],
            )


def jaccard(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Similarity of the distinct shingles of each pair of texts."""
    sets = [distinct(*found) + (found[0],) for found in (shingles(words_of(a)), shingles(words_of(b)))]
    (ka, one, _, owner), (kb, other, _, owner_b) = sets
    both = owner[one[np.intersect1d(ka, kb, assume_unique=True, return_indices=True)[1]]]
    shared = np.bincount(both, minlength=len(a))
    total = np.bincount(owner[one], minlength=len(a)) + np.bincount(owner_b[other], minlength=len(a)) - shared
    return shared / np.maximum(total, 1)


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for half in pieces(batch, "text_a", 1 << 20):
            for piece in pieces(half, "text_b", 1 << 20):
                near = jaccard(piece.column(2), piece.column(3)) >= SIMILARITY
                yield piece.select(["a", "b"]).filter(pa.array(near))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of texts that are similar."""
    left = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    schema = "a struct<k1:long,k2:long>, b struct<k1:long,k2:long>"
    return cut_lineage(
        pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(_similar, schema)
    )


def _pairs(rows: DataFrame, centre: str) -> DataFrame:
    return (
        rows.filter(F.col("key") != F.col(centre))
        .select(F.least("key", centre).alias("a"), F.greatest("key", centre).alias("b"))
        .distinct()
    )


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct(*text_key("text")).alias("key"), F.coalesce("text", F.lit("")).alias("text"))


def _sided(rows: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of groups with several classes: those outside the group's largest class, and all."""
    counts = rows.groupBy(*by, "root").agg(F.count("*").alias("count"))
    largest = counts.groupBy(*by).agg(F.max(F.struct("count", "root"))["root"].alias("largest"), F.count("*").alias("classes"))
    own = cut_lineage(rows.join(largest.filter("classes > 1").drop("classes"), by))
    return own.filter(F.col("root") != F.col("largest")), own


def _across(sides: tuple[DataFrame, DataFrame], by: list[str]) -> DataFrame:
    """Pairs of one group, in different classes, whose sizes let them be similar."""
    few, own = (
        x.select(*by, F.col("key").alias(f"key{i}"), F.col("root").alias(f"root{i}"), F.col("size").alias(f"size{i}"))
        for i, x in enumerate(sides)
    )
    near = F.least("size0", "size1") >= SIMILARITY * F.greatest("size0", "size1") - 1e-6
    return (
        few.join(own, by)
        .filter((F.col("root0") != F.col("root1")) & near)
        .select(F.least("key0", "key1").alias("a"), F.greatest("key0", "key1").alias("b"))
        .distinct()
    )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct shingles of each text as sorted 64-bit hashes."""
    for batch in batches:
        for piece in pieces(batch, "text", 1 << 20):
            owner, hashes = shingles(words_of(piece.column(1)))
            one = distinct(owner, hashes)[1]
            order = one[np.lexsort((hashes[one], owner[one]))]
            cuts = np.searchsorted(owner[order], np.arange(1, len(piece)))
            own = [x.tobytes() for x in np.split(hashes[order], cuts)]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(own, pa.large_binary())], names=["key", "elements"])


def _dense(which: np.ndarray, column: np.ndarray, rows: int, columns: int) -> np.ndarray:
    out = np.zeros((rows, columns), np.float32)
    out[which, column] = 1
    return out


def similar_between(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Which set of one list is similar to which of the other; only elements of both lists are looked at."""
    sizes = [np.array([len(x) for x in side], np.int64) for side in (a, b)]
    flat = [np.concatenate(side) for side in (a, b)]
    owner = [np.repeat(np.arange(len(n)), n) for n in sizes]
    vocabulary = np.intersect1d(*[np.unique(x) for x in flat], assume_unique=True)
    near = np.zeros((len(a), len(b)), bool)
    if not len(vocabulary):
        return near
    at = []
    for x, o in zip(flat, owner, strict=True):
        where = np.minimum(np.searchsorted(vocabulary, x), len(vocabulary) - 1)
        known = vocabulary[where] == x
        at.append((o[known], where[known]))
    step = max(1, DENSE_NUMBERS // len(vocabulary))
    for s in range(0, len(b), step):
        some = (at[1][0] >= s) & (at[1][0] < s + step)
        right = _dense(at[1][0][some] - s, at[1][1][some], min(step, len(b) - s), len(vocabulary))
        for r in range(0, len(a), step):
            some = (at[0][0] >= r) & (at[0][0] < r + step)
            left = _dense(at[0][0][some] - r, at[0][1][some], min(step, len(a) - r), len(vocabulary))
            shared = (left @ right.T).astype(np.int64)
            total = sizes[0][r : r + step, None] + sizes[1][None, s : s + step] - shared
            near[r : r + step, s : s + step] = shared >= SIMILARITY * np.maximum(total, 1)
    return near


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Similar pairs between the two sides of each block, enough to connect the classes that they connect."""

    def work(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        side = rows.column("side").to_numpy()
        one, other = (rows.filter(pa.array(side == s)) for s in (0, 1))
        if not len(one) or not len(other):
            return
        sets = [[np.frombuffer(x.as_py(), np.uint64) for x in half.column("elements")] for half in (one, other)]
        names, label = np.unique([str(x) for half in (one, other) for x in half.column("root").to_pylist()], return_inverse=True)
        label_a, label_b = label[: len(one)], label[len(one) :]
        i, j = np.nonzero(similar_between(*sets) & (label_a[:, None] != label_b[None, :]))
        low, high = np.minimum(label_a[i], label_b[j]), np.maximum(label_a[i], label_b[j])
        kept = np.unique(low.astype(np.int64) * len(names) + high, return_index=True)[1]
        yield pa.RecordBatch.from_arrays(
            [one.column("key").take(pa.array(i[kept])), other.column("key").take(pa.array(j[kept]))], names=["a", "b"]
        )

    return runs(batches, ["g1", "g2", "i", "j"], work)


def _group_links(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs of similar texts in different classes, among all texts of buckets that share members.

    A group's texts outside its largest class are compared with all of the group, block by block, as
    sets of shingles; a block hands on one pair for each two classes it connects, never its pairs.
    """
    least = members.groupBy("bucket").agg(F.min("key").alias("least"))
    groups = components(members.join(least, "bucket").select(F.col("key").alias("a"), F.col("least").alias("b")))
    rows = members.select("key", "root", "size").distinct().join(groups.select(F.col("node").alias("key"), F.col("root").alias("g")), "key")
    few, own = _sided(cut_lineage(rows), ["g"])
    # Long texts make smaller blocks.
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") / BLOCK_SHINGLES))
    counts = few.groupBy("g").agg(blocks.alias("few")).join(own.groupBy("g").agg(blocks.alias("own")), "g")
    counts = cut_lineage(counts)
    wanted = texts.join(own.select("key"), "key", "left_semi").select("key", "text")
    sets = cut_lineage(wanted.mapInArrow(_sets, "key struct<k1:long,k2:long>, elements binary"))

    def dealt(n: str) -> Column:
        return F.pmod(F.xxhash64(F.lit("block"), "key"), F.col(n))

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    columns = ["key", "root", "elements"]
    sides = []
    for side, x, i, j in ((0, few, dealt("few"), every("own")), (1, own, every("few"), dealt("own"))):
        full = x.select("g", "key", "root").join(counts, "g").join(sets, "key")
        sides.append(full.select("g.k1", "g.k2", i.alias("i"), j.alias("j"), F.lit(side).alias("side"), *columns))
    by = ["g1", "g2", "i", "j"]
    both = sides[0].unionByName(sides[1]).withColumnsRenamed({"k1": "g1", "k2": "g2"})
    ordered = both.repartition(*by).sortWithinPartitions(*by)
    return cut_lineage(ordered.mapInArrow(_block_links, "a struct<k1:long,k2:long>, b struct<k1:long,k2:long>"))


def similar_texts(docs: DataFrame) -> DataFrame:
    """``node`` and ``root`` of every text (its key) that is similar to another one."""
    signed = docs.select(*text_key("text"), "text").mapInArrow(_signed, "k1 long, k2 long, size long, bands array<long>")
    signed = cut_lineage(signed.dropDuplicates(["k1", "k2"]))
    rows = signed.select(F.struct("k1", "k2").alias("key"), "size", F.explode("bands").alias("bucket"))
    draws = [
        F.min(F.struct(F.xxhash64(F.lit(i), "bucket", "key").alias("h"), "key"))["key"].alias(f"drawn{i}")
        for i in range(DRAWN)
    ]
    shared = rows.groupBy("bucket").agg(F.count("*").alias("n"), *draws).filter("n > 1")
    members = cut_lineage(rows.join(shared, "bucket"))
    reach = members.groupBy("key").agg(F.sum("n").alias("reach"))
    middle = members.join(reach, "key").groupBy("bucket").agg(
        F.max(F.struct("reach", "key"))["key"].alias("middle")
    )
    first = cut_lineage(_pairs(members.join(middle, "bucket"), "middle"))
    drawn = _pairs(
        members.select("key", F.explode(F.array(*[f"drawn{i}" for i in range(DRAWN)])).alias("other")), "other"
    )
    wanted = members.select("key").distinct()
    texts = cut_lineage(_keyed(docs).join(wanted, "key", "left_semi").dropDuplicates(["key"]))
    linked = _verified(first, texts)
    roots = components(linked)
    of = {x: roots.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}")) for x in "ab"}
    apart = (
        drawn.join(first, ["a", "b"], "left_anti")
        .join(of["a"], "a", "left")
        .join(of["b"], "b", "left")
        .filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b"))
        .select("a", "b")
    )
    known = cut_lineage(linked.unionByName(_verified(apart, texts)))
    roots = components(known)
    placed = (
        members.select("bucket", "n", "key", "size")
        .join(roots.select(F.col("node").alias("key"), "root"), "key", "left")
        .withColumn("root", F.coalesce("root", "key"))
    )
    several = placed.groupBy("bucket").agg(F.min("root").alias("one"), F.max("root").alias("other")).filter("one != other")
    rest = cut_lineage(placed.join(several.select("bucket"), "bucket", "left_semi"))
    if rest.isEmpty():
        return roots
    left = _across(_sided(rest.filter(F.col("n") <= SMALL), ["bucket"]), ["bucket"])
    near = known.unionByName(_verified(left.join(first, ["a", "b"], "left_anti"), texts))
    return components(near.unionByName(_group_links(rest.filter(F.col("n") > SMALL), texts)))


def _rooted(docs: DataFrame) -> DataFrame:
    """``doc_id``, the text's ``key`` and the ``root`` of its class, for each document."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct(*text_key("text")).alias("key"))
    found = similar_texts(docs).select(F.col("node").alias("key"), "root")
    return cut_lineage(ids.join(found, "key", "left").withColumn("root", F.coalesce("root", "key")))


def classify(docs: DataFrame) -> DataFrame:
    """A row for each document (``doc_id``, ``text``): its class, and the class's size.

    ``key`` is the text's key and ``root`` that of the class's text by which it is named.
    """
    rooted = _rooted(docs)
    # Written first, so that what is joined back is a plain table and a large class can be split.
    classes = cut_lineage(
        rooted.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    )
    return rooted.join(classes, "root").select("doc_id", "class_id", "class_size", "key", "root")


def deduplicate(docs: DataFrame) -> DataFrame:
    """One document of each class, that of the least ``doc_id``, all columns as they were."""
    first = (
        _rooted(docs)
        .groupBy("root")
        .agg(F.min(F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("id"), "key")).alias("first"))
        .select("first.id", "first.key")
    )
    rows = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("id"),
        F.struct(*text_key("text")).alias("key"),
    )
    # Of rows with the same id and text one is taken; each task drops its own repeats first.
    rest = [c for c, t in docs.dtypes if c != "text" and "map<" not in t and "variant" not in t]
    same = Window.partitionBy("id", "key").orderBy(F.xxhash64(*[F.col("row")[c] for c in rest], F.lit(0)))
    one = rows.withColumn("n", F.row_number().over(same)).filter("n = 1")
    return one.join(first, ["id", "key"], "left_semi").select("row.*")
