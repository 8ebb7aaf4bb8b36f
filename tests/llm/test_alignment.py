"""Cross-tokenizer alignment against a plain version that tokenises each whole text with both libraries."""

import hashlib
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from mendflow.llm import alignment
from tests.llm.fixtures import awkward, awkward_docs, empty_docs, real_docs

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
TRICKY = [
    "a<|endoftext|> b <s> </s> <unk>",
    " leading", "  two", "\n", "\nline\nline\n\n last \t\r\n", " ", "trailing ",
    "no   break 　 wide　   x\u0085 y     z",
    "é́ ﬁ 日本語 と \U0001f600\U0001f468‍\U0001f469 emoji",
    "holds ▁ a piece mark", "▁", "nul \x00 byte \x1c x", "don't we'll it's 12345 67", "a  b", "a \nb \u0085c",
]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(text, tokenizers):
    """Ids of both sides and the bytes they end at, none if they don't give the text back."""
    a, b = tokenizers
    if not text:
        return None
    want = (" " + text).encode()
    of = alignment.byte_of()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(of[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [
        bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
        for i, p in ((i, b.id_to_piece(i)) for i in ids_b)
    ]
    if b"".join(bytes_a) != want or b"".join(bytes_b) != want:
        return None
    sides = []
    for ids, data in ((ids_a, bytes_a), (ids_b, bytes_b)):
        at, spans = 0, []
        for i, d in zip(ids, data, strict=True):
            spans.append((i, at, at + len(d)))
            at += len(d)
        sides.append(spans)
    return sides


def links_of(a, b):
    """Each pair of tokens whose bytes overlap."""
    j, found = 0, []
    for i, s, e in a:
        while b[j][2] <= s:
            j += 1
        k = j
        while k < len(b) and b[k][1] < e:
            found.append((i, b[k][0]))
            k += 1
    return found


def plain(rows, tokenizers):
    seen = [(r[0], tokens(r[1], tokenizers)) for r in rows]
    links = [links_of(*t) if t else [] for _, t in seen]
    counts = Counter(x for own in links for x in own)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    out = []
    for (doc_id, t), own in zip(seen, links, strict=True):
        if not t:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        ends = sorted({e for _, _, e in t[0]} & {e for _, _, e in t[1]})
        groups, start = [], 0
        by_side = [iter(t[0]), iter(t[1])]
        for e in ends:
            sides = []
            for it in by_side:
                ids = []
                while True:
                    i, _, to = next(it)
                    ids.append(str(i))
                    if to == e:
                        break
                sides.append(",".join(ids))
            groups.append("|".join(sides))
            start = e
        assert start == t[0][-1][2]
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        best = sum(counts[x] == most[x[1]] for x in own)
        out.append((doc_id, len(t[0]), len(t[1]), len(groups), len(own), best, sum(counts[x] for x in own), digest))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_awkward_documents(spark, tokenizers):
    tricky = [(100 + i, t) for i, t in enumerate(TRICKY)]
    docs = awkward_docs(spark).select("doc_id", "text", "k1", "bucket")
    more = spark.createDataFrame([(i, t, "clash", "clash") for i, t in tricky], docs.schema)
    result = found(alignment.align(docs.unionByName(more), A, B))
    assert result == plain([(r[0], r[1]) for r in awkward()] + tricky, tokenizers)
    assert [r[1] for r in result if r[0] in (1, 2)] == [0, 0]
    assert {r[7] for r in result if r[0] in (109, 110)} == {""}  # the mark comes back as a space


def test_rare_pairs_meet_their_counts_by_a_shuffle(spark, tokenizers):
    docs = real_docs(spark)
    expected = plain([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], tokenizers)
    for frequent in (0, 500, alignment.FREQUENT):
        assert found(alignment.align(docs, A, B, frequent)) == expected


def test_empty_table(spark):
    assert found(alignment.align(empty_docs(spark), A, B)) == []


def test_very_long_texts(tokenizers):
    texts = ["x" * 300_000, " " * 20_000 + "end", "\n" * 20_000, "ab " * 50_000]
    measures = alignment.Aligner(A, B).align(pa.array(texts))
    for i, text in enumerate(texts):
        a, b = tokens(text, tokenizers)
        assert [measures[n][i] for n in ("n_a", "n_b", "n_links")] == [len(a), len(b), len(links_of(a, b))]


def test_chunks_that_end_in_white_space_are_not_joined(tokenizers):
    texts = [f"{a}{b}" for a in ("日", "«", "x", "ß") for b in (" ", "  ", "\n", "\n\n", "\u00a0", "")]
    texts += [t[::-1] for t in texts] + [f"{t}{t}" for t in texts]
    measures = alignment.Aligner(A, B).align(pa.array(texts))
    for i, text in enumerate(texts):
        a, b = tokens(text, tokenizers)
        assert [measures[n][i] for n in ("n_a", "n_b", "n_links")] == [len(a), len(b), len(links_of(a, b))], text


def test_forgotten_chunks_are_learnt_again(tokenizers):
    texts = [r[1] or "" for r in awkward()] + TRICKY
    wide, narrow = alignment.Aligner(A, B), alignment.Aligner(A, B, limit=20)
    for i in range(0, len(texts), 3):
        part = pa.array([t for t in texts[i : i + 3] if t] or ["x"])
        one, other = wide.align(part), narrow.align(part)
        assert all(list(one[n]) == list(other[n]) for n in one)
