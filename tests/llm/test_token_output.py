import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from mendflow.llm import huffman, token_output
from mendflow.sources.tables import scratch_folder
from tests.llm import fixtures as X

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("seed", range(8))
def test_round_trip_of_ids(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(0, 5000))
    ids = np.minimum(rng.zipf(1.3, n), 3000).astype(np.uint32) if seed else np.full(n, 7, np.uint32)
    bits = huffman.code_lengths(np.bincount(ids, minlength=8))
    data, marks = huffman.encode(ids, bits, huffman.canonical_codes(bits))
    assert huffman.decode(data, marks, n, huffman.decoding_table(bits)).tolist() == ids.tolist()
    assert len(marks) == -(-n // huffman.BLOCK)


def test_blocks_are_independent():
    ids = np.random.default_rng(1).integers(0, 900, 3000).astype(np.uint32)
    bits = huffman.code_lengths(np.bincount(ids))
    data, marks = huffman.encode(ids, bits, huffman.canonical_codes(bits))
    table = huffman.decoding_table(bits)
    assert huffman.decode(data, marks[2:3], huffman.BLOCK, table).tolist() == ids[1024:1536].tolist()


@pytest.mark.parametrize("limit", [5, 6, 8, 20])
def test_lengths_are_optimal_and_limited(limit):
    rng = random.Random(limit)
    counts = np.array([rng.choice([0, 1, 1, 2, 3, 5, 8, 1000, 10**9]) for _ in range(40)])
    used = int((counts > 0).sum())
    bits = huffman.code_lengths(counts, max(limit, used.bit_length()))
    assert (bits[counts == 0] == 0).all() and bits.max() <= max(limit, used.bit_length())
    assert sum(2.0 ** -int(b) for b in bits if b) == 1.0
    if limit == 20:
        import heapq

        heap = [int(c) for c in counts if c]
        heapq.heapify(heap)
        cost = 0
        while len(heap) > 1:
            x = heapq.heappop(heap) + heapq.heappop(heap)
            cost += x
            heapq.heappush(heap, x)
        assert int((bits.astype(np.int64) * counts).sum()) == cost
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(9), 3)


ODD = ["", " ", "\n", "a  b", "a \n b", " lead", "trail ", "\n\nx\n\ny", "don't we'll", "a\u00a0 b\u00a0\nc", "tab\tx", "漢字 é😀 1234 $$$",
       "x\u2003 y \u2003z", "a\x1c b", "crlf\r\nline", "word " * 50, "  \n ", "a\nb\nc", "\u0085 q", "<|endoftext|> z", "'s 's\n's"]


def test_chunks_give_the_ids_of_whole_texts():
    whole = Tokenizer.from_file(PATH)
    whole.encode_special_tokens = True
    rng = random.Random(0)
    texts = ODD + ["".join(rng.choice(ODD + list(" \n  ab1.é")) for _ in range(rng.randrange(12))) for _ in range(1500)]
    encoder = token_output.Encoder(PATH)
    for _ in range(2):  # the second time from the cache
        ids, counts = encoder.encode(pa.array(texts))
        got = np.split(ids, np.cumsum(counts)[:-1])
        for t, x in zip(texts, got, strict=True):
            assert x.tolist() == whole.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("record", [1 << 18, 40])
def test_files_hold_all_documents(spark, monkeypatch, record):
    monkeypatch.setattr(token_output, "RECORD_IDS", record)
    folder = scratch_folder(spark)
    token_output.write_token_ids(X.awkward_docs(spark), folder, PATH)
    rows = sorted(token_output.read_token_ids(spark, folder, with_ids=True).collect(), key=lambda r: r.start)
    whole = Tokenizer.from_file(PATH)
    want = sorted((-1 if r[0] is None else r[0], tuple(whole.encode(r[1] or "", add_special_tokens=False).ids) + (0,)) for r in X.awkward())
    assert sorted((-1 if r.doc_id is None else r.doc_id, tuple(r.ids)) for r in rows) == want
    ids = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert ids == sorted(ids)
    start = 0
    for r in rows:
        assert (r.start, r.n_tokens) == (start, len(r.ids))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens


def test_control_strings_get_the_ids_of_the_plain_call(spark):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x\n<|endoftext|>\ny<|endoftext|>'s", "<|endoftext|> <|endoftext|>  z"]
    folder = scratch_folder(spark)
    docs = spark.createDataFrame([X.doc(i, t) for i, t in enumerate(texts + ODD)], X.DOCS)
    token_output.write_token_ids(docs, folder, PATH)
    rows = {r.doc_id: list(r.ids) for r in token_output.read_token_ids(spark, folder, with_ids=True).collect()}
    whole = Tokenizer.from_file(PATH)
    assert rows == {i: [*whole.encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(texts + ODD)}


def test_empty(spark):
    folder = scratch_folder(spark)
    token_output.write_token_ids(X.empty_docs(spark), folder, PATH)
    assert token_output.read_token_ids(spark, folder).collect() == []
