"""Token ids of documents as canonical Huffman-coded binary files.

Documents are ordered by ``doc_id`` (nulls first, ties by text), or as they are stored, over range partitions; each task
encodes its documents with the tokenizer, ends each with id 0 and packs whole documents into
records. The id counts of all records give one code book. The coded records are written by
Spark, so they are committed atomically to any store, and hold what their readers need::

    codebook/   id int, bits int
    records/    part int, seq int, first long (ids before the record), doc_ids array<long>,
                lengths array<long>, checkpoints binary (bit offset of each block, uint64
                little-endian), data binary

Texts repeat their words, so a task tokenizes each distinct chunk once (``chunks``), many chunks
in one call. Results are those of encoding
the whole text without adding special tokens; a control string in a text gets its own id, as the
tokenizer gives it by default.

Null text is empty and gives the end id alone; a null ``doc_id`` stays null; repeated rows give
repeated documents; an empty table gives files without records. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import os
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mendflow.llm import chunks, huffman, words
from mendflow.sources.tables import cut_lineage

END_ID = 0
#: Ids in a record, one document at least.
RECORD_IDS = 1 << 18
#: Bytes of chunks given to the tokenizer as one text, and texts at once; its results are much larger than the ids in them.
TOGETHER, ENCODED_AT_ONCE = 1 << 10, 64

class Encoder:
    """Ids of texts, with the ids of the chunks seen lately; control strings are ordinary text or, if not encoded, their own ids."""

    def __init__(self, path: str, encode_special_tokens: bool = True, limit: int = 2 * chunks.CACHE_CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = encode_special_tokens
        special = set(self.tokenizer.get_added_tokens_decoder())
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        # A byte-level vocabulary has one character for each byte, but for control strings.
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for text, i in vocabulary.items():
            self.sizes[i] = len(text.encode()) if i in special else len(text)
        self.cache = chunks.ChunkCache(self._learn, limit)

    def _learn(self, new: Sequence[bytes]) -> dict:
        """Ids of new chunks. Many are given to the tokenizer as one text, since it splits there anyway."""
        groups = chunks.groups_of(new, TOGETHER)
        ids, sizes = [], []
        for i in range(0, len(groups), ENCODED_AT_ONCE):
            part = groups[i : i + ENCODED_AT_ONCE]
            texts = [b"".join(new[a:b]).decode() for a, b in part]
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            own = np.fromiter(itertools.chain.from_iterable(e.ids for e in found), np.int64)
            sizes.append(chunks.counts_by_chunk(new[part[0][0] : part[-1][1]], self.sizes[own]))
            ids.append(own.astype(np.uint32))
        return {"ids": (np.concatenate(sizes), np.concatenate(ids))}

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and how many each text has."""
        buf, at = words.text_buffer(column)
        starts, lengths, first = chunks.chunks_of(buf, at)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(at) - 1, np.int64)
        size, ids = self.cache.values("ids", self.cache.places(buf, starts, lengths))
        return ids, np.diff(np.append(0, np.cumsum(size))[first])


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path, encode_special_tokens=False)
    return _encoders[path]


_TOKENS = "part int, seq int, begin long, doc_ids array<long>, lengths array<long>, ids binary"


def _tokenized(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, begin = TaskContext.get().partitionId(), 0, 0
        encoder = _encoder(path)
        for batch in batches:
            for piece in words.pieces(batch, "text"):
                ids, counts = encoder.encode(piece.column(1))
                ends = np.cumsum(counts)
                whole = np.insert(ids, ends, END_ID)
                counts, ends = counts + 1, ends + np.arange(1, len(ends) + 1)
                docs = piece.column(0)
                group = (ends - 1) // RECORD_IDS
                cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(counts)]
                for a, b in zip(cuts, cuts[1:], strict=False):
                    start = int(ends[a - 1]) if a else 0
                    own = whole[start : int(ends[b - 1])].astype(np.uint32)
                    row = [[part], [seq], [begin], [docs[a:b].to_pylist()], [counts[a:b].tolist()], [own.tobytes()]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, t) for v, t in zip(row, _arrow(_TOKENS), strict=True)], names=_names(_TOKENS)
                    )
                    seq, begin = seq + 1, begin + len(own)

    return run


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _arrow(schema: str) -> list[pa.DataType]:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    return [kinds[x.split()[1]] for x in schema.split(", ")]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        for data in batch.column(0):
            own = np.bincount(np.frombuffer(data.as_py(), np.uint32))
            size = max(len(own), len(total))
            total = np.pad(total, (0, size - len(total))) + np.pad(own, (0, size - len(own)))
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["id", "n"])


_RECORDS = "part int, seq int, first long, doc_ids array<long>, lengths array<long>, checkpoints binary, data binary"


def _coded(bits: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = huffman.canonical_codes(bits)
        for batch in batches:
            data, marks = [], []
            for x in batch.column(5):
                coded, at = huffman.encode(np.frombuffer(x.as_py(), np.uint32), bits, codes)
                data.append(coded)
                marks.append(at.astype("<u8").tobytes())
            columns = [*batch.columns[:5], pa.array(marks, pa.binary()), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=_names(_RECORDS))

    return run


def stored_order(docs: DataFrame) -> list[Column]:
    """The order of the rows in the Parquet files that ``docs`` are read from, none if they are not."""
    return [F.col(f"_metadata.{c}") for c in ("file_path", "row_index")] if docs.inputFiles() else []


def write_token_ids(docs: DataFrame, folder: str, tokenizer_path: str, order: Sequence[Column] = ()) -> None:
    """Write the files for ``docs`` (``doc_id``, ``text``) to a new folder that all executors reach.

    Documents come in the given ``order``, by default by ``doc_id``.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [c.alias(f"by{i}") for i, c in enumerate([*order, F.col("doc_id").cast("long"), F.xxhash64("text")])]
    names = [f"by{i}" for i in range(len(by))]
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *by)
        .repartitionByRange(n, *names)
        .sortWithinPartitions(*names)
        .select("doc_id", "text")
    )
    tokens = cut_lineage(ordered.mapInArrow(_tokenized(tokenizer_path), _TOKENS))
    # At most one count for each id of the tokenizer comes to the driver.
    counts = tokens.select("ids").mapInArrow(_counted, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(max([END_ID, *(r["id"] for r in counts)]) + 1, np.int64)
    for r in counts:
        total[r["id"]] = r["n"]
    bits = huffman.code_lengths(total)
    # One row for each partition.
    ends = tokens.groupBy("part").agg(F.max(F.col("begin") + F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("ids"))
    before = ends.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("before"))
    placed = tokens.join(F.broadcast(before), "part").select(
        "part", "seq", (F.col("before") + F.col("begin")).alias("first"), "doc_ids", "lengths", "ids"
    )
    placed.mapInArrow(_coded(bits), _RECORDS).write.parquet(f"{folder}/records")
    book = [(int(i), int(bits[i])) for i in np.flatnonzero(bits)]
    spark.createDataFrame(book, "id int, bits int").coalesce(1).write.parquet(f"{folder}/codebook")


_DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _decoded(bits: np.ndarray, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = huffman.decoding_table(bits)
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], np.int64)
                marks = np.frombuffer(row["checkpoints"], "<u8")
                ids = huffman.decode(row["data"], marks, int(lengths.sum()), table)
                ends = np.cumsum(lengths)
                data = memoryview(ids.astype("<u4").tobytes())
                own = [data[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                columns = [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["first"] + ends - lengths, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array([zlib.crc32(x) for x in own], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=_names(_DOCS) + ["ids"] * with_ids)

    return run


def read_token_ids(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """A row for each document of the files: doc_id, start, n_tokens, ids_crc32 and, if asked, its ids."""
    book = spark.read.parquet(f"{folder}/codebook").collect()
    bits = np.zeros(max([END_ID, *(r["id"] for r in book)]) + 1, np.uint8)
    for r in book:
        bits[r["id"]] = r["bits"]
    records = spark.read.parquet(f"{folder}/records").select("first", "doc_ids", "lengths", "checkpoints", "data")
    return records.mapInArrow(_decoded(bits, with_ids), _DOCS + ", ids array<int>" * with_ids)
