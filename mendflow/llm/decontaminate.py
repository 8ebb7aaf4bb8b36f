"""Benchmark decontamination by latent semantic retrieval.

Documents are cut into passages, overlapping by half, and weighted by TF-IDF over the words of the
benchmark; words of more than ``STOP_SHARE`` of all passages have no weight. A randomised SVD of
the benchmark's passages and the documents' gives a latent space; every passage of
every document is projected into it and compared with every benchmark item by cosine. Candidates
are checked on the words themselves: the longest common subsequence of the item with the passage's
surroundings must hold ``EXACT`` of the item's words, or, for a paraphrase, ``PARAPHRASE`` of them
and, word by word, the item's answer, which is its last sentence if there is no such column.

An item of which less than ``WEIGHTED`` of the words have weight has no vector to be found by. It is
looked up by runs of half its words, ``RUN`` at most, that a text repeats, and holds if the words
around such a run hold ``RUN_EXACT`` of it: exact copies are found, from seven words on also those with
one word changed; with more changes only if such a run is left. Such items of under ``RUN_LEAST`` words are common phrases and leak nothing.

Passage frequencies are counted over all documents, and the SVD is fitted on all items of a block and
all passages of all documents: ``FIT_PASSES`` power iterations, each a pass of the documents. The
documents whose hash falls in a share of ``FIT_DOCUMENTS`` only give the directions in which these
begin. Partial products are made and added in the tasks, of which there are a few for each core, so
what they write does not grow with the documents; only matrices of a block's vocabulary by the rank
come to the driver. Items are handled in blocks of bounded number and size. ``PASS_BLOCKS`` blocks
share the passes, so what tasks receive does not grow with the benchmark.

Texts are compared in lower case; words are runs of ASCII letters, digits and all non-ASCII
characters. Null texts, and texts without words, neither leak nor are
leaked. Repeated rows are judged alike. An empty benchmark leaks nothing; an empty table gives no
rows. ``remove_leaks`` passes all columns through.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mendflow.llm.words import Words, pieces, windows, words_of
from mendflow.sources.tables import cut_lineage

#: Words of half a passage.
HALF = 32
RANK, OVERSAMPLE = 96, 16
STOP_SHARE = 0.125
FIT_DOCUMENTS, FIT_TASKS = 4096, 8
#: Power iterations over all documents, and tasks a core that make their partial products.
FIT_PASSES, FIT_TASKS_A_CORE = 2, 4
#: Rows of a matrix that are gathered, or come together, at once; these stay in a core's cache or a task.
GATHERED, ADDED = 2048, 256
COSINE = 0.45
EXACT, PARAPHRASE = 0.7, 0.5
#: Items with a smaller share of words with weight are looked up by runs of words.
WEIGHTED = 0.5
RUN, RUN_EXACT, RUN_LEAST = 8, 0.85, 5
#: Items of a block and characters of its texts on average; these bound its terms.
BLOCK_ITEMS, BLOCK_CHARACTERS = 512, 1 << 19
PASS_BLOCKS = 8

_GAP = np.ones(256, bool)
_GAP[48:58] = _GAP[65:91] = _GAP[97:123] = _GAP[128:] = False


def plain_words(column: pa.Array) -> Words:
    return words_of(pc.utf8_lower(column), _GAP)


@dataclass
class Vocabulary:
    terms: np.ndarray  # sorted hashes of words

    def __getstate__(self) -> dict:  # the table is made where it is used
        return {k: v for k, v in self.__dict__.items() if k != "_table"}

    @cached_property
    def _table(self) -> tuple[np.uint64, np.ndarray, np.ndarray]:
        """A mask of hashes, by masked hash the number of the last such term, and whether there are more."""
        mask = np.uint64((1 << (16 * len(self.terms)).bit_length()) - 1)
        slots = (self.terms & mask).astype(np.int64)
        numbers = np.zeros(int(mask) + 1, np.int32)
        numbers[slots] = np.arange(len(slots))
        return mask, numbers, np.bincount(slots, minlength=int(mask) + 1) > 1

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Number of each word's term, -1 for words that are no terms."""
        mask, numbers, shared = self._table
        slots = (h & mask).astype(np.int64)
        near = numbers[slots].astype(np.int64)
        found = np.where(self.terms[near] == h, near, -1)
        rest = np.flatnonzero((found < 0) & shared[slots])
        if len(rest):
            near = np.minimum(np.searchsorted(self.terms, h[rest]), len(self.terms) - 1)
            found[rest] = np.where(self.terms[near] == h[rest], near, -1)
        return found


@dataclass
class Items(Vocabulary):
    """A block of benchmark items, as broadcast to the tasks; ``terms`` are their words and answers."""

    ids: list
    words: list[list[int]]  # term numbers
    answers: list[list[int]]
    part_item: np.ndarray
    part_terms: list[np.ndarray]


def _answer(text: str) -> str:
    """The last sentence, if there are several."""
    found = [s for s in re.split(r"(?<=[.!?])\s+|\n", text.strip()) if s.strip()]
    return found[-1] if len(found) > 1 else ""


def _read_items(rows: list) -> Items | None:
    texts = [r["text"] or "" for r in rows]
    answers = [r["answer"] if r["answer"] is not None else _answer(t) for r, t in zip(rows, texts, strict=True)]
    words, replies = plain_words(pa.array(texts, pa.string())), plain_words(pa.array(answers, pa.string()))
    own = [np.array(x) for x in np.split(words.hashes(), words.first[1:-1])]
    ends = np.split(replies.hashes(), replies.first[1:-1])
    keep = [i for i, x in enumerate(own) if len(x)]
    if not keep:
        return None
    terms = np.unique(np.concatenate(own + ends))
    numbers = [np.searchsorted(terms, own[i]) for i in keep]
    parts = [(n, x[a : a + 2 * HALF]) for n, x in enumerate(numbers) for a in range(0, max(len(x) - HALF, 1), HALF)]
    return Items(
        terms,
        [rows[i]["item_id"] for i in keep],
        [x.tolist() for x in numbers],
        [np.searchsorted(terms, ends[i]).tolist() for i in keep],
        np.array([n for n, _ in parts]),
        [x for _, x in parts],
    )


@dataclass
class Passages:
    """Weighted terms of the half passages of some texts."""

    term: np.ndarray
    half: np.ndarray  # of each term, ascending
    weight: np.ndarray
    halves: np.ndarray  # number for each text
    all_terms: np.ndarray  # of every word of the texts, -1 if not in the vocabulary
    first: np.ndarray  # first word of each text

    def left(self) -> np.ndarray:
        """The first half of each passage: all but a text's last, or its only one."""
        ends = np.cumsum(self.halves)
        drop = ends[self.halves > 1] - 1
        return np.delete(np.arange(int(self.halves.sum())), drop)

    def right(self, left: np.ndarray) -> np.ndarray:
        """The second half of each passage; the number of halves for none."""
        ends = np.repeat(np.cumsum(self.halves), self.halves)[left]
        return np.where(left + 1 < ends, left + 1, int(self.halves.sum()))

    def times(self, matrix: np.ndarray) -> np.ndarray:
        """Half passages by the columns of ``matrix``, and a row of zeros."""
        return _row_sums(matrix, self.term, self.weight, self.half, int(self.halves.sum()) + 1)

    def transposed_times(self, matrix: np.ndarray, terms: int) -> np.ndarray:
        order = np.argsort(self.term, kind="stable")
        return _row_sums(matrix, self.half[order], self.weight[order], self.term[order], terms)


def _row_sums(matrix: np.ndarray, at: np.ndarray, weight: np.ndarray, to: np.ndarray, n: int) -> np.ndarray:
    """The weighted rows ``at`` of a matrix, added up to ``n`` rows by their numbers ``to``, which ascend."""
    out = np.zeros((n, matrix.shape[1]), np.float32)
    if len(at):
        begin = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
        ends = np.append(begin, len(at))
        cuts = np.unique(np.append(np.searchsorted(begin, np.arange(0, len(at), GATHERED)), len(begin)))
        for a, b in zip(cuts, cuts[1:], strict=False):
            some = slice(ends[a], ends[b])
            rows = matrix[at[some]]
            rows *= weight[some, None]
            out[to[begin[a:b]]] = np.add.reduceat(rows, begin[a:b] - ends[a])
    return out


def _passages(column: pa.Array, vocabulary: Vocabulary, idf: np.ndarray | None) -> Passages:
    words = plain_words(column)
    return _passages_of(words, words.hashes(), vocabulary, idf)


def _passages_of(words: Words, hashes: np.ndarray, vocabulary: Vocabulary, idf: np.ndarray | None) -> Passages:
    terms = vocabulary.lookup(hashes)
    halves = -(-words.counts // HALF)
    begin = np.cumsum(halves) - halves
    owner = words.owner()
    half = begin[owner] + (np.arange(len(terms)) - words.first[owner]) // HALF
    used = terms >= 0 if idf is None else (terms >= 0) & (idf[terms] > 0)
    term = terms[used]
    weight = np.ones(len(term), np.float32) if idf is None else idf[term]
    return Passages(term, half[used], weight, halves, terms, words.first)


def _frequencies(vocabulary: Vocabulary):
    size = len(vocabulary.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, halves = np.zeros(size, np.int64), 0
        for batch in batches:
            for piece in pieces(batch, "text"):
                p = _passages(piece.column(0), vocabulary, None)
                one = np.unique(p.half * size + p.term) % size
                n += np.bincount(one, minlength=size)
                halves += int(p.halves.sum())
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), pa.array(np.append(n[used], halves))], names=["term", "n"]
        )

    return run


def _gram(p: Passages, q: np.ndarray) -> np.ndarray:
    """The passages' unit TF-IDF matrix, transposed, by itself, by ``q``."""
    left = p.left()
    right = p.right(left)
    halves = int(p.halves.sum())
    # Repeats of a term in a passage count by their own weights.
    size = np.bincount(p.half, p.weight**2, halves + 1).astype(np.float32)
    norm = np.maximum(size[left] + size[right], 1e-9)[:, None]
    y = p.times(q)
    y = (y[left] + y[right]) / norm
    back = np.zeros((halves + 1, q.shape[1]), np.float32)
    back[left] = y  # a half begins one passage at most, and ends one at most
    back[right] += y
    return p.transposed_times(back, q.shape[0])


_PRODUCTS = "block int, part int, product binary, n long"


def _products(blocks: list[Items], idfs: list[np.ndarray], qs: list[np.ndarray]):
    """Of each block the product with a task's passages, in parts of ``ADDED`` terms, and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, passages = [np.zeros_like(q) for q in qs], 0
        for batch in batches:
            for piece in pieces(batch, "text"):
                words = plain_words(piece.column(0))
                hashes = words.hashes()
                for items, idf, q, total in zip(blocks, idfs, qs, totals, strict=True):
                    p = _passages_of(words, hashes, items, idf)
                    total += _gram(p, q)
                passages += len(p.left())
        for block, total in enumerate(totals):
            for part, a in enumerate(range(0, len(total), ADDED)):
                yield _product_row(block, part, total[a : a + ADDED], passages)

    return run


def _product_row(block: int, part: int, product: np.ndarray, n: int) -> pa.RecordBatch:
    columns = [pa.array([block], pa.int32()), pa.array([part], pa.int32()), pa.array([product.tobytes()]), pa.array([n])]
    return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _PRODUCTS.split(", ")])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block and part of those that the partial products of all tasks have."""
    totals: dict[tuple[int, int], np.ndarray] = {}
    passages: dict[tuple[int, int], int] = defaultdict(int)
    for batch in batches:
        for block, part, product, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            one = np.frombuffer(product, np.float32).astype(np.float64)
            totals[block, part] = totals[block, part] + one if (block, part) in totals else one
            passages[block, part] += n
    for (block, part), total in totals.items():
        yield _product_row(block, part, total.astype(np.float32), passages[block, part])


def _multiplied(
    docs: DataFrame, blocks: list[Items], idfs: list[np.ndarray], qs: list[np.ndarray]
) -> tuple[list[np.ndarray], int]:
    """The Gram matrix of all passages, by each block's ``q``, and the number of passages."""
    made = docs.mapInArrow(_products(blocks, idfs, qs), _PRODUCTS)
    products, passages = [np.zeros_like(q) for q in qs], 0
    for r in made.repartition("block", "part").mapInArrow(_added, _PRODUCTS).collect():
        rows = np.frombuffer(r["product"], np.float32).reshape(-1, qs[r["block"]].shape[1])
        products[r["block"]][r["part"] * ADDED :][: len(rows)] = rows
        passages = r["n"]
    return products, passages


def _starting_sample(docs: DataFrame) -> DataFrame:
    """The documents whose passages give the directions that the fit on all documents begins with."""
    share = min(1.0, FIT_DOCUMENTS / max(docs.count(), 1))
    sample = docs.filter(F.pmod(F.xxhash64(F.lit("fit"), "doc_id", "text"), F.lit(1 << 20)) < int(share * (1 << 20)))
    return cut_lineage(sample.select("text").repartition(FIT_TASKS))


def _latent(
    start: DataFrame, docs: DataFrame, blocks: list[Items], idfs: list[np.ndarray]
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each block the basis of the latent space, terms by rank, and the items' passages in it, of length 1."""
    every, qs = [], []
    for items, idf in zip(blocks, idfs, strict=True):
        parts = np.zeros((len(items.part_terms), len(idf)), np.float32)
        for row, terms in zip(parts, items.part_terms, strict=True):
            np.add.at(row, terms, idf[terms])
        every.append(parts / np.maximum(np.linalg.norm(parts, axis=1, keepdims=True), 1e-9))
        width = min(RANK + OVERSAMPLE, len(idf))
        qs.append(np.random.default_rng(0).standard_normal((len(idf), width)).astype(np.float32))
    whole = docs.select("text").coalesce(FIT_TASKS_A_CORE * docs.sparkSession.sparkContext.defaultParallelism)
    for passages in (start, *[whole] * FIT_PASSES):
        bases = [np.linalg.qr(q)[0].astype(np.float32) for q in qs]
        products, n = _multiplied(passages, blocks, idfs, bases)
        # The items weigh as much as the documents: they are what is searched for.
        qs = [
            product + max(1.0, n / len(parts)) * (parts.T @ (parts @ q))
            for product, parts, q in zip(products, every, bases, strict=True)
        ]
    found = []
    for parts, basis, q in zip(every, bases, qs, strict=True):
        values, vectors = np.linalg.eigh((basis.T @ q + q.T @ basis) / 2)
        basis = (basis @ vectors[:, np.argsort(-values)[:RANK]]).astype(np.float32)
        latent = parts @ basis
        found.append((basis, latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)))
    return found


def lcs_length(masks: dict[int, int], n: int, words: list[int]) -> int:
    """Longest common subsequence with the ``n`` words that ``masks`` has the places of."""
    full = v = (1 << n) - 1
    for w in words:
        u = v & masks.get(w, 0)
        if u:
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def _contains(words: list[int], run: list[int]) -> bool:
    n = len(run)
    return any(words[i] == run[0] and words[i : i + n] == run for i in range(len(words) - n + 1))


class Search:
    """Leaks of a block of items in texts."""

    def __init__(self, items: Items, idf: np.ndarray, basis: np.ndarray, latent: np.ndarray):
        self.items, self.idf, self.latent = items, idf, latent
        self.basis = basis
        self.masks: dict[int, dict[int, int]] = {}
        self.runs = self._runs_of_weak_items()

    def _runs_of_weak_items(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By length, the hashes of runs, sorted, with their items and places in them."""
        runs = defaultdict(list)
        for i, words in enumerate(self.items.words):
            n = len(words)
            if n >= RUN_LEAST and (self.idf[words] > 0).sum() < WEIGHTED * n:
                length = min(RUN, n // 2)
                h, at = windows(self.items.terms[words], np.array([0, n]), length)
                runs[length].append((h, np.full(len(h), i), at))
        out = {}
        for length, found in runs.items():
            h, item, at = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.argsort(h, kind="stable")
            out[length] = h[order], item[order], at[order]
        return out

    def _share(self, item: int, words: list[int]) -> float:
        if item not in self.masks:
            places: dict[int, int] = {}
            for i, w in enumerate(self.items.words[item]):
                places[w] = places.get(w, 0) | 1 << i
            self.masks[item] = places
        n = len(self.items.words[item])
        return lcs_length(self.masks[item], n, words) / n

    def leaks(self, words: Words, hashes: np.ndarray) -> dict[tuple[int, int], tuple[float, float, bool]]:
        """Cosine, share of the item's words and whether the answer is there, by text and item."""
        p = _passages_of(words, hashes, self.items, self.idf)
        left = p.left()
        embedded = p.times(self.basis)
        passages = embedded[left] + embedded[p.right(left)]
        size = np.linalg.norm(passages, axis=1, keepdims=True)
        passages /= np.maximum(size, 1e-9)
        begin = np.cumsum(p.halves) - p.halves
        text = np.repeat(np.arange(len(p.halves)), p.halves)[left]
        found: dict[tuple[int, int], tuple[float, float, bool]] = {}

        def add(t: int, item: int, near: float, low: int, high: int, least: float, told_least: float) -> None:
            around = p.all_terms[max(low, p.first[t]) : min(high, p.first[t + 1])].tolist()
            share = self._share(item, around)
            if share < min(least, told_least):
                return
            answer = self.items.answers[item]
            told = bool(answer) and _contains(around, answer)
            if share >= least or told:
                old = found.get((t, item), (-1.0, -1.0, False))
                found[t, item] = (max(old[0], near), max(old[1], share), old[2] or told)

        for a in range(0, len(left), 8192):
            cosine = passages[a : a + 8192] @ self.latent.T
            at, part = np.nonzero(cosine >= COSINE)
            items = self.items.part_item[part]
            rows = zip(at.tolist(), items.tolist(), cosine[at, part].tolist(), strict=True)
            for i, item, near in rows:
                t = int(text[a + i])
                half = int(left[a + i] - begin[t])
                n = len(self.items.words[item])
                low, high = p.first[t] + half * HALF - n // 2, p.first[t] + (half + 2) * HALF + n // 2
                add(t, item, near, low, high, EXACT, PARAPHRASE)
        for t, item, start in self._repeated_runs(hashes, p.first):
            n = len(self.items.words[item])
            add(t, item, 0.0, start - n // 8, start + n + n // 8, RUN_EXACT, RUN_EXACT)
        return found

    def _repeated_runs(self, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Text, weak item and the word with which the item would begin, once each."""
        for length, (h, item, place) in self.runs.items():
            w, at = windows(hashes, first, length)
            low = np.searchsorted(h, w)
            n = np.searchsorted(h, w, "right") - low
            run = np.repeat(low - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            start = np.repeat(at, n) - place[run]
            text = np.repeat(np.searchsorted(first, at, "right") - 1, n)
            yield from map(tuple, np.unique(np.stack([text, item[run], start], axis=1), axis=0).tolist())


_LEAKS = "doc_id long, item_id long, cosine double, share double, answer boolean"


def _listed(searches: list[Search]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                words = plain_words(piece.column(1))
                hashes = words.hashes()
                for search in searches:
                    found = search.leaks(words, hashes)
                    at = pa.array([t for t, _ in found], pa.int64())
                    cosine, share, answer = zip(*found.values(), strict=True) if found else ((), (), ())
                    columns = [
                        piece.column(0).take(at),
                        pa.array([search.items.ids[i] for _, i in found], pa.int64()),
                        pa.array(cosine, pa.float64()),
                        pa.array(share, pa.float64()),
                        pa.array(answer, pa.bool_()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _LEAKS.split(", ")])

    return run


def _clean(searches: list[Search], at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(len(batch), bool)
            done = 0
            for piece in pieces(batch, "text"):
                words = plain_words(piece.column(at))
                hashes = words.hashes()
                for search in searches:
                    for t, _ in search.leaks(words, hashes):
                        keep[done + t] = False
                done += len(piece)
            yield batch.filter(pa.array(keep))

    return run


def _blocks(benchmark: DataFrame) -> Iterator[list[Items]]:
    """The blocks of each pass that have words."""
    answer = F.col("answer") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text", answer.alias("answer"))
    size = items.agg(F.count("*").alias("n"), F.sum(F.length(F.coalesce("text", F.lit("")))).alias("size")).head()
    blocks = max(-(-size["n"] // BLOCK_ITEMS), -(-(size["size"] or 0) // BLOCK_CHARACTERS))
    numbered = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1))))
    for b in range(0, blocks, PASS_BLOCKS):
        rows = defaultdict(list)
        for row in numbered.filter((F.col("block") >= b) & (F.col("block") < b + PASS_BLOCKS)).collect():
            rows[row["block"]].append(row)
        found = [_read_items(rows[i]) for i in sorted(rows)]
        found = [x for x in found if x is not None]
        if found:
            yield found


def _searches(docs: DataFrame, benchmark: DataFrame) -> Iterator[list[Search]]:
    """The searches of each pass, fitted on all documents; the sample that the fits begin with is drawn once."""
    start = None
    for blocks in _blocks(benchmark):
        vocabulary = Vocabulary(np.unique(np.concatenate([x.terms for x in blocks])))
        counts = (
            docs.select("text").mapInArrow(_frequencies(vocabulary), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
        )
        n = {r["term"]: r["n"] for r in counts}
        total = max(n.pop(-1, 0), 1)
        if start is None:
            start = _starting_sample(docs)
        idfs = []
        for block in blocks:
            df = np.array([n.get(i, 0) for i in vocabulary.lookup(block.terms).tolist()], np.float64)
            idfs.append(np.where(df > STOP_SHARE * max(total, 64), 0, np.log((total + 1) / (df + 1)) + 1e-3).astype(np.float32))
        fitted = _latent(start, docs, blocks, idfs)
        yield [Search(block, idf, *x) for block, idf, x in zip(blocks, idfs, fitted, strict=True)]


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents (``doc_id``, ``text``) and the items (``item_id``, ``text``, ``answer``) they hold.

    ``cosine`` is 0 for an item that was looked up by its runs alone.
    """
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = spark.createDataFrame([], _LEAKS)
    for searches in _searches(own, benchmark):
        found = found.unionByName(own.mapInArrow(_listed(searches), _LEAKS))
    return found.groupBy("doc_id", "item_id").agg(
        F.max("cosine").alias("cosine"), F.max("share").alias("share"), F.max("answer").alias("answer")
    )


def remove_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item, all columns as they were."""
    left = docs
    for searches in _searches(docs, benchmark):
        left = left.mapInArrow(_clean(searches, docs.columns.index("text")), docs.schema)
    return left
