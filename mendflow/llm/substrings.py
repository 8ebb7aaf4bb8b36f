"""Removal of repeated passages by super-k-mer partitioning.

A window is ``k`` consecutive words of a document. Its minimiser is the least of its runs of ``m``
words under a fixed hash order. Consecutive windows with the same minimiser travel as one string,
their words joined by single spaces, to the minimiser's bucket; equal windows have equal minimisers
and so meet there. In a bucket windows are sorted by hash, neighbours are compared byte by byte,
and those found twice or more are marked. The marks go back to the documents by the strings' keys,
and every word that a marked window covers is removed.

A passage that many documents share would pull the different windows at its edges into few
buckets. Runs of words that are very common in a bounded sample are therefore last in the order,
so windows that reach beyond the passage are dealt by what is beside it. The sample only steers
where windows meet, not which are found. Equal strings of one task travel once, and the work on a
bucket is bounded by the strings' number, not the copies'.

Null text has no words. Documents shorter than a window lose nothing. Equal rows lose the same
words, all of them if they are long enough. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mendflow.llm.words import CHAIN, Words, mixed, pieces, text_key, windows, words_of
from mendflow.sources.tables import cut_lineage

WINDOW, MINIMISER = 35, 6
#: Buckets for each partition of the input, so that a bucket's size doesn't depend on the input's.
BUCKETS = 16
#: Documents in the sample of common runs, the least share of them that has one, and most runs.
SAMPLE_DOCUMENTS, COMMON_SHARE, MOST_COMMON = 20_000, 0.002, 1 << 16
SAMPLE_TASKS = 8

_PLACE = np.uint64((1 << 28) - 1)


def _sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    size = 1
    while size * 2 <= width:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    return np.minimum(v[: len(v) - (width - size)], v[width - size :]) if width > size else v


@dataclass
class Strings:
    """Super-k-mers of some texts."""

    words: Words
    start: np.ndarray  # first word
    windows: np.ndarray  # number of windows
    bucket: np.ndarray
    key: np.ndarray  # two columns


def super_kmers(words: Words, common: np.ndarray, k: int, m: int) -> Strings:
    """``common`` holds sorted hashes of runs that come last in the order."""
    h = words.hashes()
    one, at = windows(h, words.first, k)
    if not len(at):
        none = np.zeros(0, np.int64)
        return Strings(words, none, none, none.astype(np.uint64), np.zeros((0, 2), np.uint64))
    two, _ = windows(mixed(h, 1), words.first, k)
    runs, place = windows(h, words.first, m)
    order = ((mixed(runs, 2) >> np.uint64(29)) << np.uint64(28)) & np.uint64(2**63 - 1)
    if len(common):
        near = np.minimum(np.searchsorted(common, runs), len(common) - 1)
        order |= (common[near] == runs).astype(np.uint64) << np.uint64(63)
    ranked = np.full(len(h), np.uint64(2**64 - 1))
    ranked[place] = order | place.astype(np.uint64)
    least = _sliding_min(ranked, k - m + 1)[at]
    new = np.concatenate([[True], (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1)])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(at))
    whole = np.zeros(len(h), np.uint64)
    whole[place] = runs
    minimiser = whole[(least[begin] & _PLACE).astype(np.int64)]
    n = (end - begin).astype(np.uint64)
    # The first and last window of a string and their distance say all of its words.
    key = np.stack([mixed((x[begin] * CHAIN + x[end - 1]) * CHAIN + n) for x in (one, two)], 1)
    return Strings(words, at[begin], end - begin, mixed(minimiser, 3), key)


def joined(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """All words, a space after each, and where each begins; plus the end."""
    at = np.concatenate([[0], np.cumsum(words.lengths + 1)])
    out = np.full(at[-1], 0x20, np.uint8)
    place = np.arange(int(words.lengths.sum()))
    before = at[:-1] - np.arange(len(words.starts))
    source = place + np.repeat(words.starts - before, words.lengths)
    out[place + np.repeat(at[:-1] - before, words.lengths)] = words.buf[source]
    return out, at


_BLOBS = "bucket long, keys binary, repeated binary, strings binary"


def _packed(common: np.ndarray, buckets: int, k: int, m: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for piece in pieces(batch, "text"):
                found = super_kmers(words_of(piece.column(0)), common, k, m)
                if not len(found.start):
                    continue
                _, one, count = np.unique(found.key[:, 0], return_index=True, return_counts=True)
                bucket = (found.bucket[one] % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                one, count, bucket = one[order], count[order], bucket[order]
                text, at = joined(found.words)
                data = text.tobytes()
                a = at[found.start[one]].tolist()
                b = (at[found.start[one] + found.windows[one] + k - 1] - 1).tolist()
                cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])).tolist()
                rows = [[], [], [], []]
                for x, y in zip(cuts, cuts[1:], strict=False):
                    rows[0].append(int(bucket[x]))
                    rows[1].append(found.key[one[x:y]].tobytes())
                    rows[2].append((count[x:y] > 1).tobytes())
                    rows[3].append(press.compress(b"\n".join([data[s:e] for s, e in zip(a[x:y], b[x:y], strict=True)])))
                kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(rows, kinds, strict=True)], names=["bucket", "keys", "repeated", "strings"]
                )

    return run


def repeated_windows(strings: list[bytes], k: int) -> list[np.ndarray]:
    """For each of some different strings, which of its windows occur anywhere else in them."""
    if not strings:
        return []
    words = words_of(pa.array(strings, pa.large_binary()).cast(pa.large_string()))
    h, at = windows(words.hashes(), words.first, k)
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    marked = np.zeros(len(at), bool)
    if same.any():
        data = words.buf.tobytes()
        begin = words.starts[at]
        end = words.starts[at + k - 1] + words.lengths[at + k - 1]
        left, right = order[:-1][same], order[1:][same]
        alike = [
            data[a:b] == data[c:d]
            for a, b, c, d in zip(*(x.tolist() for x in (begin[left], end[left], begin[right], end[right])), strict=True)
        ]
        if all(alike):
            marked[left] = marked[right] = True
        else:  # windows whose hashes are equal by chance: sort these by their text
            group = np.concatenate([[0], np.cumsum(~same)])
            seen: dict[tuple[int, bytes], int] = {}
            for g, i in zip(group.tolist(), order.tolist(), strict=True):
                other = seen.setdefault((g, data[begin[i] : end[i]]), i)
                if other != i:
                    marked[other] = marked[i] = True
    return np.split(marked, np.cumsum(np.maximum(words.counts - k + 1, 0))[:-1])


def _bucket_marks(k: int):
    def run(table: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor()
        which: dict[bytes, int] = {}
        keys, often = [], []
        for key, again, text in zip(*(table.column(c) for c in ("keys", "repeated", "strings")), strict=True):
            key = np.frombuffer(key.as_py(), np.uint64).reshape(-1, 2)
            again = again.as_py()
            for i, s in enumerate(unpack.decompress(text.as_py()).split(b"\n")):
                n = which.setdefault(s, len(which))
                if n == len(keys):
                    keys.append(key[i])
                    often.append(bool(again[i]))
                else:
                    often[n] = True
        marks = repeated_windows(list(which), k)
        hit = [i for i, mark in enumerate(marks) if often[i] or mark.any()]
        flags = [np.packbits(marks[i] | often[i], bitorder="little").tobytes() for i in hit]
        found = np.array([keys[i] for i in hit], np.uint64).reshape(-1, 2).view(np.int64)
        sizes = pa.array([len(marks[i]) for i in hit], pa.int32())
        return pa.table({"s1": found[:, 0], "s2": found[:, 1], "n": sizes, "flags": pa.array(flags, pa.binary())})

    return run


def _occurrences(common: np.ndarray, k: int, m: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                words = words_of(piece.column(2))
                found = super_kmers(words, common, k, m)
                owner = np.searchsorted(words.first, found.start, "right") - 1
                rows = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0).take(rows),
                        piece.column(1).take(rows),
                        pa.array(found.key[:, 0].view(np.int64)),
                        pa.array(found.key[:, 1].view(np.int64)),
                        pa.array((found.start - words.first[owner]).astype(np.int32)),
                    ],
                    names=["k1", "k2", "s1", "s2", "start"],
                )

    return run


def _common_runs(docs: DataFrame, m: int) -> np.ndarray:
    """Sorted hashes of the runs of ``m`` words that are very common in a sample of the documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                words = words_of(piece.column(0))
                run, n = np.unique(windows(words.hashes(), words.first, m)[0], return_counts=True)
                run, n = run[n > 1].view(np.int64), n[n > 1]
                yield pa.RecordBatch.from_arrays([pa.array(run), pa.array(n)], names=["run", "n"])

    share = min(1.0, SAMPLE_DOCUMENTS / max(docs.count(), 1))
    sample = docs.filter(F.pmod(F.xxhash64(F.lit("sample"), "text", "doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    # All tasks read; the bounded sample then meets in few tasks, which see more of what is common.
    counted = sample.select("text").repartition(SAMPLE_TASKS).mapInArrow(count, "run long, n long").groupBy("run").agg(F.sum("n").alias("n"))
    least = max(4, int(COMMON_SHARE * share * docs.count()))
    rows = counted.filter(F.col("n") >= least).orderBy(F.col("n").desc(), "run").limit(MOST_COMMON).collect()
    return np.sort(np.array([r["run"] for r in rows], np.int64).view(np.uint64))


def _cut(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                words = words_of(piece.column(1))
                covered = np.zeros(len(words.starts) + 1, np.int64)
                for first, marks in zip(words.first.tolist(), piece.column(2), strict=False):
                    for x in marks.as_py() or ():
                        bits = np.unpackbits(np.frombuffer(x["flags"], np.uint8), bitorder="little")
                        at = first + x["start"] + np.flatnonzero(bits[: x["n"]])
                        covered[at] += 1
                        covered[at + k] -= 1
                gone = np.cumsum(covered[:-1]) > 0
                kept = Words(words.buf, words.starts[~gone], words.lengths[~gone], None)
                text, at = joined(kept)
                ends = np.concatenate([[0], np.cumsum(~gone)])[words.first]
                data = text.tobytes()
                texts = [
                    data[at[a] : at[b] - 1].decode() if b > a else ""
                    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)
                ]
                n = words.counts
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(n), pa.array(n - np.diff(ends)), pa.array(texts, pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept"],
                )

    return run


def remove_repeats(docs: DataFrame, k: int = WINDOW, m: int = MINIMISER) -> DataFrame:
    """For each document its words, how many were removed, and the kept ones joined by spaces."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    common = _common_runs(docs, m)
    buckets = BUCKETS * docs.rdd.getNumPartitions()
    marks = (
        docs.select("text")
        .mapInArrow(_packed(common, buckets, k, m), _BLOBS)
        .groupBy("bucket")
        .applyInArrow(_bucket_marks(k), "s1 long, s2 long, n int, flags binary")
    )
    keyed = docs.select(*text_key("text"), "text")
    marked = (
        keyed.mapInArrow(_occurrences(common, k, m), "k1 long, k2 long, s1 long, s2 long, start int")
        .join(cut_lineage(marks), ["s1", "s2"])
        .groupBy("k1", "k2")
        .agg(F.collect_set(F.struct("start", "n", "flags")).alias("marks"))
    )
    return (
        docs.select(*text_key("text"), "doc_id", "text")
        .join(cut_lineage(marked), ["k1", "k2"], "left")
        .select("doc_id", "text", "marks")
        .mapInArrow(_cut(k), "doc_id long, n_words long, n_removed long, kept string")
    )
