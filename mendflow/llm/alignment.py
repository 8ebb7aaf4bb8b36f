"""Alignment of two tokenizers over a corpus, each distinct text once.

Copies are found by a shuffle on the full text, counted on the map side first, so a group of
copies of any size is one row a task. Each distinct text is tokenised by both tokenizers, A with
byte-level BPE and B with pieces, and aligned by byte offsets of a space and the text: where
tokens of both end, a group ends, and an A and a B token are linked if their bytes overlap. A pair of
ids counts once for each link in each document, so a distinct text's links count as often as the
text occurs. The measures are joined to the documents by the text's 128-bit key.

Texts repeat their words, so a task aligns each distinct chunk once (``chunks``). The pairs' counts
are needed for every link again. At most ``FREQUENT`` of them, those of the highest counts, go to
every task; links of all others meet their counts by a shuffle, after each text's equal links are one row.

Texts that are null or empty, or whose tokens of A or B don't give the bytes of space and text
back, have no tokens: zeros, and ``groups_sha256`` is empty. A null ``doc_id`` stays null; repeated
rows give repeated rows and count each; an empty table gives no rows; other columns don't matter.
Control strings inside texts are plain text.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mendflow.llm import chunks, words
from mendflow.sources.tables import cut_lineage

#: Pairs of ids whose counts every task may hold (12 bytes each).
FREQUENT = 1 << 21
#: Pairs a task sums up before it hands them on.
HELD_PAIRS = 1 << 21
#: Bytes of chunks given to a tokenizer as one text.
TOGETHER = 1 << 10
#: Chunks over this size go to the tokenizer by themselves.
LONG = 1 << 14
#: Splits of a byte-level BPE before its merges. Fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_of() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: visible ones for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteTokenizer:
    """A byte-level BPE vocabulary (JSON) whose merges are in the order of their ids."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        of = byte_of()
        special = {t["id"] for t in stored["added_tokens"]}
        vocabulary = {bytes(of[c] for c in t): i for t, i in stored["model"]["vocab"].items() if i not in special}
        merged = [m if isinstance(m, list) else m.split(" ") for m in stored["model"]["merges"]]
        order = [stored["model"]["vocab"][a + b] for a, b in merged]
        if order != sorted(order):
            raise ValueError(f"{path}: merges are not in the order of their ids")
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for data, i in vocabulary.items():
            self.bytes[i] = data
        self.fast = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=vocabulary, special_tokens={})
        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True

    def __call__(self, joined: bytes) -> list[int]:
        text = joined.decode()
        if len(joined) > LONG:
            return self.plain.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class PieceTokenizer:
    """A SentencePiece model that puts a space before a text, called on texts that begin with it."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("▁" in p.lstrip("▁") or "\n" in p for p in pieces):
            raise ValueError(f"{path}: a piece goes on after a space")
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.space = self.model.piece_to_id("▁")

    def __call__(self, joined: bytes) -> list[int]:
        if joined[:1] == b" ":
            return self.model.encode(joined[1:].decode()) or [self.space]
        return self.model.encode(joined.decode())[1:]  # a line feed, which no piece takes in


def _tokens(tokenizer, new: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all chunks that give their bytes back, how many each has, and which ones give them back."""
    ids: list[np.ndarray] = []
    counts, good = np.zeros(len(new), np.int64), np.ones(len(new), bool)
    sizes = np.array([len(b) for b in tokenizer.bytes], np.int64)
    for a, b in chunks.groups_of(new, TOGETHER):
        joined = b"".join(new[a:b])
        own = tokenizer(joined)
        if b"".join([tokenizer.bytes[i] for i in own]) == joined:
            own = np.array(own, np.int64)
            counts[a:b] = chunks.counts_by_chunk(new[a:b], sizes[own])
            ids.append(own)
            continue
        for k in range(a, b):
            own = tokenizer(new[k])
            good[k] = b"".join([tokenizer.bytes[i] for i in own]) == new[k]
            if good[k]:
                counts[k] = len(own)
                ids.append(np.array(own, np.int64))
    return np.concatenate(ids) if ids else np.zeros(0, np.int64), counts, good


class Aligner:
    """Alignments of texts, with those of the chunks seen lately."""

    def __init__(self, path_a: str, path_b: str, limit: int = chunks.CACHE_CHUNKS):
        self.a, self.b = ByteTokenizer(path_a), PieceTokenizer(path_b)
        self.width = len(self.b.bytes)
        names_a, names_b = ([str(i) for i in range(len(t.bytes))] for t in (self.a, self.b))
        self.names = [np.array([n + end for n in names], object) for names in (names_a, names_b) for end in ",|"]
        self.names[3] = np.array([n + ";" for n in names_b], object)
        self.cache = chunks.ChunkCache(self._learn, limit)

    def _learn(self, new: Sequence[bytes]) -> dict:
        """Numbers of tokens and groups, links and the groups' string of chunks; those that don't come back get none."""
        a, count_a, good = _tokens(self.a, new)
        b, count_b, back = _tokens(self.b, new)
        if not back.all() or not good.all():
            a = a[np.repeat(back[good], count_a[good])]
            b = b[np.repeat(good[back], count_b[back])]
            good = good & back
            count_a, count_b = count_a * good, count_b * good
        ends_a = np.cumsum(np.array([len(x) for x in self.a.bytes], np.int64)[a])
        ends_b = np.cumsum(np.array([len(x) for x in self.b.bytes], np.int64)[b])
        ends = np.cumsum(np.array([len(c) for c in new], np.int64) * good)
        cuts = np.union1d(ends_a, ends_b)  # between two of these lies one token of each side
        links = a[np.searchsorted(ends_a, cuts)] * self.width + b[np.searchsorted(ends_b, cuts)]
        both = np.intersect1d(ends_a, ends_b)
        strings = self._strings(a, b, ends_a, ends_b, both)
        n_links, n_groups = (np.diff(np.searchsorted(x, ends, "right"), prepend=0) for x in (cuts, both))
        last = np.cumsum(n_groups)
        own = np.empty(len(new), object)
        own[:] = ["".join(strings[e - n : e]) for e, n in zip(last.tolist(), n_groups.tolist(), strict=True)]
        return {
            "good": good, "n_a": count_a, "n_b": count_b, "n_groups": n_groups, "string": own, "links": (n_links, links),
        }

    def _strings(self, a, b, ends_a, ends_b, both) -> list[str]:
        parts, groups = [], []
        for ids, ends, inner, last in ((a, ends_a, *self.names[:2]), (b, ends_b, *self.names[2:])):
            closes = np.isin(ends, both, assume_unique=True)
            parts.append(np.where(closes, last[ids], inner[ids]))
            groups.append(np.searchsorted(both, ends))
        order = np.argsort(np.concatenate([groups[0] * 2, groups[1] * 2 + 1]), kind="stable")
        flat = np.concatenate(parts)[order].tolist()
        sizes = np.bincount(np.concatenate(groups), minlength=len(both))
        ends = np.cumsum(sizes)
        return ["".join(flat[e - n : e]) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]

    def align(self, column: pa.Array) -> dict:
        """Measures of each text, and its distinct links with how often each occurs."""
        empty, space = (pa.scalar(x, pa.large_string()) for x in ("", " "))
        spaced = pc.binary_join_element_wise(empty, column.cast(pa.large_string()), space)
        buf, at = words.text_buffer(spaced)
        starts, lengths, first = chunks.chunks_of(buf, at)
        place = self.cache.places(buf, starts, lengths)
        texts = len(column)
        owner = np.repeat(np.arange(texts), np.diff(first))
        good = np.bincount(owner, ~self.cache.one["good"][place], minlength=texts) == 0
        found = {
            n: (np.bincount(owner, self.cache.one[n][place], minlength=texts) * good).astype(np.int64)
            for n in ("n_a", "n_b", "n_groups")
        }
        strings = self.cache.one["string"][place]
        found["sha"] = [
            hashlib.sha256("".join(strings[s:e].tolist())[:-1].encode()).hexdigest() if ok else ""
            for s, e, ok in zip(first[:-1].tolist(), first[1:].tolist(), good.tolist(), strict=True)
        ]
        size, links = self.cache.values("links", place)
        of = np.repeat(owner, size)
        if not good.all():
            links, of = links[good[of]], of[good[of]]
        span = np.uint64(len(self.a.bytes) * self.width)
        keys, times = np.unique(of.astype(np.uint64) * span + links.astype(np.uint64), return_counts=True)
        of = (keys // span).astype(np.int64)
        found["links"], found["times"] = (keys % span).astype(np.int64), times.astype(np.int32)
        found["n_pairs"] = np.bincount(of, minlength=texts)
        found["n_links"] = np.bincount(of, times, minlength=texts).astype(np.int64)
        return found


@functools.lru_cache(maxsize=2)
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


_MEASURES = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_ALIGNED = f"k1 long, k2 long, copies long, {_MEASURES}, links array<long>, times array<int>"


def _aligned(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        for batch in batches:
            for piece in words.pieces(batch, "text"):
                found = aligner.align(piece.column(3))
                ends = np.append(0, np.cumsum(found["n_pairs"])).astype(np.int32)
                columns = [
                    *piece.columns[:3],
                    *[pa.array(found[n]) for n in ("n_a", "n_b", "n_groups", "n_links")],
                    pa.array(found["sha"]),
                    *[pa.ListArray.from_arrays(ends, pa.array(found[n])) for n in ("links", "times")],
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _ALIGNED.split(", ")])

    return run


def align_texts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row for each distinct text (its key): its copies, measures, distinct links and their times."""
    distinct = docs.filter(F.length("text") > 0).groupBy("text").agg(F.count("*").alias("copies"))
    rows = distinct.select(*words.text_key("text"), "copies", "text")
    return rows.mapInArrow(_aligned(path_a, path_b), _ALIGNED)


def _summed(links: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, which = np.unique(links, return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, which, n)
    return keys, total


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and values of a list column."""
    return np.diff(column.offsets.to_numpy()), column.flatten().to_numpy()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the links of a task's texts, handed on whenever many pairs are held."""
    names, links, n, fresh = ["link", "n"], np.zeros(0, np.int64), np.zeros(0, np.int64), []
    waiting = 0

    def merged():
        return _summed(np.concatenate([links, *[x for x, _ in fresh]]), np.concatenate([n, *[x for _, x in fresh]]))

    for batch in batches:
        size, own = _flat(batch.column(1))
        copies = np.repeat(batch.column(0).to_numpy(), size)
        fresh.append(_summed(own, batch.column(2).flatten().to_numpy() * copies))
        waiting += len(fresh[-1][0])
        if waiting > HELD_PAIRS:
            (links, n), fresh, waiting = merged(), [], 0
            if len(links) > HELD_PAIRS:
                yield pa.RecordBatch.from_arrays([pa.array(links), pa.array(n)], names=names)
                links, n = links[:0], n[:0]
    links, n = merged()
    yield pa.RecordBatch.from_arrays([pa.array(links), pa.array(n)], names=names)


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """``link`` (A id times ``width`` plus B id), its ``count`` over all documents, and if that is its B id's ``best``."""
    partial = aligned.select("copies", "links", "times").mapInArrow(_counted, "link long, n long")
    counts = cut_lineage(partial.groupBy("link").agg(F.sum("n").alias("count")))
    # One row for each id of B, so its size is bounded by the vocabulary.
    most = counts.groupBy((F.col("link") % width).alias("b")).agg(F.max("count").alias("most"))
    return counts.join(F.broadcast(most), F.col("link") % width == F.col("b")).select(
        "link", "count", (F.col("count") == F.col("most")).alias("best")
    )


def _measured(known):
    """Sums over each text's links whose counts are known, and the other links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        link, count, best = known.value
        for batch in batches:
            size, own = _flat(batch.column(2))
            times = batch.column(3).flatten().to_numpy().astype(np.int64)
            where = np.minimum(np.searchsorted(link, own), max(len(link) - 1, 0))
            found = link[where] == own if len(link) else np.zeros(len(own), bool)
            ends = np.append(0, np.cumsum(size))
            n_best = np.append(0, np.cumsum(np.where(found & best[where], times, 0) if len(link) else 0 * times))
            total = np.append(0, np.cumsum(np.where(found, times * count[where], 0) if len(link) else 0 * times))
            rest = np.diff(np.append(0, np.cumsum(~found))[ends])
            at = np.append(0, np.cumsum(rest)).astype(np.int32)
            columns = [
                *batch.columns[:2],
                pa.array(np.diff(n_best[ends])),
                pa.array(np.diff(total[ends])),
                pa.ListArray.from_arrays(at, pa.array(own[~found])),
                pa.ListArray.from_arrays(at, pa.array(times[~found])),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["k1", "k2", "n_best", "count_sum", "links", "times"])

    return run


def link_measures(aligned: DataFrame, pairs: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """``n_best`` and ``count_sum`` of each distinct text."""
    spark = aligned.sparkSession
    pairs = cut_lineage(pairs)
    # At most 64 rows: how many pairs have a count of so many bits.
    by_bits = {r["bits"]: r["n"] for r in pairs.groupBy(F.length(F.bin("count")).alias("bits")).agg(F.count("*").alias("n")).collect()}
    least, held = max(by_bits, default=0) + 1, 0
    while least > 1 and held + by_bits.get(least - 1, 0) <= frequent:
        least, held = least - 1, held + by_bits.get(least - 1, 0)
    often = pairs.filter(F.col("count") >= F.shiftleft(F.lit(1).cast("long"), max(least - 1, 0)))
    table = often.toArrow() if held else pa.table({"link": np.zeros(0, np.int64), "count": np.zeros(0, np.int64), "best": np.zeros(0, bool)})
    link, count, best = (table.column(n).to_numpy() for n in ("link", "count", "best"))
    order = np.argsort(link)
    known = spark.sparkContext.broadcast((link[order], count[order], best[order]))
    schema = "k1 long, k2 long, n_best long, count_sum long, links array<long>, times array<long>"
    measured = aligned.select("k1", "k2", "links", "times").mapInArrow(_measured(known), schema)
    if held == sum(by_bits.values()):
        return measured.drop("links", "times")
    measured = cut_lineage(measured)
    rare = measured.select("k1", "k2", F.explode(F.arrays_zip("links", "times")).alias("x")).select(
        "k1", "k2", F.col("x.links").alias("link"), F.col("x.times").alias("times")
    )
    more = rare.join(pairs, "link").select(
        "k1", "k2", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"), (F.col("times") * F.col("count")).alias("count_sum")
    )
    return (
        measured.select("k1", "k2", "n_best", "count_sum")
        .unionByName(more)
        .groupBy("k1", "k2")
        .agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    )


def align(docs: DataFrame, path_a: str, path_b: str, frequent: int = FREQUENT) -> DataFrame:
    """A row for each document (``doc_id``, ``text``) with its text's measures."""
    aligned = cut_lineage(align_texts(docs, path_a, path_b))
    pairs = pair_counts(aligned, PieceTokenizer(path_b).model.get_piece_size())
    measures = aligned.select("k1", "k2", *[x.split()[0] for x in _MEASURES.split(", ")])
    # Written first, so that what is joined back is a plain table and a large group of copies can be split.
    measures = cut_lineage(measures.join(link_measures(aligned, pairs, frequent), ["k1", "k2"]))
    zero = F.lit(0).cast("long")
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *words.text_key("text"))
    return ids.join(measures, ["k1", "k2"], "left").select(
        "doc_id",
        *[F.coalesce(n, zero).alias(n) for n in numbers],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
