import random

import numpy as np
import pyarrow as pa
import pytest

from mendflow.llm import decontaminate
from tests.llm import fixtures as X


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def plain(text):
    w = decontaminate.plain_words(pa.array([text or ""], pa.string()))
    return [bytes(w.buf[s : s + n]) for s, n in zip(w.starts, w.lengths, strict=True)]


@pytest.fixture(scope="module")
def planted(spark):
    """Real documents; every fifth gets an item, exact or with some words changed, among its words."""
    rng = random.Random(3)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{X.SF}/benchmark.parquet").collect()]
    docs, want = [], set()
    for r in X.real_docs(spark).collect():
        text = r.text
        if r.doc_id % 5 == 0:
            item, said = rng.choice(items)
            w = said.split()
            for at in rng.sample(range(len(w)), rng.choice([0, 0, 1, len(w) // 8])):
                w[at] = f"changed{at}"
            own = text.split()
            at = rng.randrange(len(own) + 1)
            text = " ".join(own[:at] + w + own[at:])
            want.add((r.doc_id, item))
        docs.append(X.doc(r.doc_id, text))
    return docs, items, want


def brute(docs, items):
    """Pairs by sliding the item over every document, word by word."""
    out = set()
    split = [(i, plain(t)) for i, t in items]
    for d, text, *_ in docs:
        words = plain(text)
        for i, own in split:
            known = set(own)
            if sum(w in known for w in words) < 0.7 * len(own):
                continue
            size = 2 * len(own)
            if any(lcs(own, words[a : a + size]) >= 0.7 * len(own) for a in range(0, max(len(words) - size, 0) + len(own), len(own))):
                out.add((d, i))
    return out


def test_planted_items_are_found_and_clean_documents_left(spark, planted):
    docs, items, want = planted
    df = spark.createDataFrame(docs, X.DOCS).repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(df, bench).collect()}
    assert want <= found
    exact = brute(docs, items)
    assert len(found & exact) >= 0.99 * len(exact)
    # Whatever else is reported holds half of an item and its answer.
    by_doc, by_item = {d[0]: d[1] for d in docs}, dict(items)
    for d, i in found - exact:
        own = plain(by_item[i])
        assert lcs(own, plain(by_doc[d])) >= 0.5 * len(own)
    left = decontaminate.remove_leaks(df, bench)
    assert left.columns == df.columns
    assert {r.doc_id for r in left.collect()} == {d[0] for d in docs} - {d for d, _ in found}


def test_recall_does_not_hang_on_the_fitting_sample(spark, planted, monkeypatch):
    """The basis of the index fitted on a twentieth of the documents finds what a comparison of all finds."""
    docs, items, want = planted
    df = spark.createDataFrame(docs, X.DOCS).repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "FIT_DOCUMENTS", len(docs) // 20)
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(df, bench).collect()}
    exact = brute(docs, items)
    assert want <= found and len(found & exact) >= 0.99 * len(exact)


def test_blocks_give_the_same(spark, planted, monkeypatch):
    docs, items, want = planted
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 15)
    df = spark.createDataFrame(docs, X.DOCS)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert want <= {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(df, bench).collect()}


def test_paraphrase_needs_the_answer(spark):
    base = X.some_words(30, 31, 5000)
    item = " ".join(base) + ". The answer is forty two"
    half = " ".join(w if i % 3 else f"other{i}" for i, w in enumerate(base))
    docs = [X.doc(1, half + " the answer is forty two"), X.doc(2, " ".join(f"o{i}" if i % 2 else w for i, w in enumerate(base)) + " the answer was else")]
    docs += [X.doc(10 + i, " ".join(X.some_words(200, 40 + i, 5000))) for i in range(40)]
    df = spark.createDataFrame(docs, X.DOCS)
    bench = spark.createDataFrame([(7, item), (8, None), (9, "")], "item_id long, text string")
    found = decontaminate.find_leaks(df, bench).collect()
    assert [(r.doc_id, r.item_id) for r in found] == [(1, 7)]


def test_awkward_rows(spark):
    df = X.awkward_docs(spark)
    shared = " ".join(X.some_words(60, 2))
    bench = spark.createDataFrame([(1, shared), (2, None), (None, "not there at all")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(df, bench).collect()} == {(7, 1), (8, 1)}
    assert decontaminate.remove_leaks(df, bench).count() == df.count() - 2
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_leaks(df, none).count() == 0
    assert decontaminate.remove_leaks(df, none).count() == df.count()
    assert decontaminate.find_leaks(X.empty_docs(spark), bench).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_lcs_length(seed):
    rng = random.Random(seed)
    a, b = ([rng.randrange(9) for _ in range(rng.randrange(1, 90))] for _ in range(2))
    masks = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << i
    assert decontaminate.lcs_length(masks, len(a), b) == lcs(a, b)


def test_gram_is_that_of_the_dense_matrix():
    rng = np.random.default_rng(0)
    column = pa.array([" ".join(f"t{rng.integers(30)}" for _ in range(n)) for n in (150, 5, 64, 33, 1)] + [None])
    items = decontaminate._read_items([{"item_id": 1, "text": " ".join(f"t{i}" for i in range(25)), "answer": None}])
    idf = np.linspace(0.5, 2, len(items.terms)).astype(np.float32)
    p = decontaminate._passages(column, items, idf)
    rows = np.zeros((int(p.halves.sum()) + 1, len(idf)))
    np.add.at(rows, (p.half, p.term), p.weight)
    left = p.left()
    dense = rows[left] + rows[p.right(left)]
    q = rng.standard_normal((len(idf), 4)).astype(np.float32)
    size = np.zeros(len(rows))
    np.add.at(size, p.half, p.weight**2)
    norm = size[left] + size[p.right(left)]
    want = dense.T @ ((dense @ q) / np.maximum(norm, 1e-9)[:, None])
    assert np.allclose(decontaminate._gram(p, q), want, atol=1e-3)


def test_copies_in_capitals_are_leaks(spark):
    item = " ".join(X.some_words(30, 60, 5000))
    docs = [X.doc(1, "é ñ " + item.upper())] + [X.doc(10 + i, " ".join(X.some_words(100, 70 + i, 5000))) for i in range(20)]
    found = decontaminate.find_leaks(spark.createDataFrame(docs, X.DOCS), spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert [(r.doc_id, r.item_id) for r in found.collect()] == [(1, 7)]


def test_copies_of_a_text_are_in_the_fitting_sample_by_their_share(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "FIT_DOCUMENTS", 100)
    sizes = []
    cut = decontaminate.cut_lineage
    monkeypatch.setattr(decontaminate, "cut_lineage", lambda df: sizes.append(df.count()) or cut(df))
    item = " ".join(X.some_words(40, 77))
    docs = spark.createDataFrame([X.doc(i, "copied " + item) for i in range(1000)], X.DOCS)
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    decontaminate.find_leaks(docs, benchmark)
    assert len(sizes) == 1 and 50 < sizes[0] < 200


def test_items_of_frequent_words_are_found_by_their_runs(spark):
    """Words of every passage have no weight: an item of them has no vector."""
    common = [f"often{i}" for i in range(12)]
    rng = random.Random(5)

    def filler(n):
        return " ".join(rng.choice(common) if i % 2 else f"rare{rng.randrange(9000)}" for i in range(n))

    short, long = common[:8], [rng.choice(common) for _ in range(40)]
    one_off = [*short[:3], "changed", *short[4:]]
    docs = [X.doc(i, filler(150)) for i in range(200)]
    planted = {500: short, 501: one_off, 502: long, 503: [*long[:20], "new", "words", *long[22:]], 504: [*short[:4], *short[:4:-1]]}
    docs += [X.doc(i, f"{filler(70)} {' '.join(w)} {filler(70)}") for i, w in planted.items()]
    docs += [X.doc(505, " ".join(short)), X.doc(506, " ".join(common[:4]))]
    items = [(1, " ".join(short)), (2, " ".join(long)), (3, " ".join(common[:4]))]
    df, bench = spark.createDataFrame(docs, X.DOCS), spark.createDataFrame(items, "item_id long, text string")
    want = {(500, 1), (501, 1), (505, 1), (502, 2), (503, 2)}
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(df, bench).collect()} == want
    left = {r.doc_id for r in decontaminate.remove_leaks(df, bench).select("doc_id").collect()}
    assert left == {d[0] for d in docs} - {d for d, _ in want}


def test_blocks_share_a_pass(spark, planted, monkeypatch):
    docs, items, want = planted
    df = spark.createDataFrame(docs, X.DOCS)
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 5)
    passes = list(decontaminate._searches(df, bench))
    assert len(passes) == 1 and len(passes[0]) > 4
    assert sorted(i for s in passes[0] for i in s.items.ids) == sorted(i for i, _ in items)
    monkeypatch.setattr(decontaminate, "PASS_BLOCKS", 3)
    passes = list(decontaminate._searches(df, bench))
    assert len(passes) > 1 and sorted(i for p in passes for s in p for i in s.items.ids) == sorted(i for i, _ in items)
    assert want <= {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(df, bench).collect()}


def test_the_basis_is_fitted_on_all_documents(spark, monkeypatch):
    """It holds as much of all passages as the best of its rank, however few documents the fit begins with."""
    monkeypatch.setattr(decontaminate, "FIT_DOCUMENTS", 2)
    monkeypatch.setattr(decontaminate, "RANK", 6)
    monkeypatch.setattr(decontaminate, "OVERSAMPLE", 4)
    rng = random.Random(8)
    terms = [f"t{i}" for i in range(90)]
    texts = []
    for _ in range(400):  # each of one of fifteen subjects, some of them rarer
        about = min(int(rng.expovariate(0.4)), 14)
        texts.append(" ".join(rng.choice(terms[6 * about : 6 * about + 6]) for _ in range(rng.choice([20, 50, 90]))))
    df = spark.createDataFrame([X.doc(i, t) for i, t in enumerate(texts)], X.DOCS).repartition(4)
    items = spark.createDataFrame([(1, " ".join(terms))], "item_id long, text string")
    (search,) = next(decontaminate._searches(df, items))

    def dense(rows):
        unit = rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
        return unit.T @ unit

    p = decontaminate._passages(pa.array(texts), search.items, search.idf)
    halves = np.zeros((int(p.halves.sum()) + 1, len(search.idf)))
    np.add.at(halves, (p.half, p.term), p.weight)
    parts = np.zeros((len(search.items.part_terms), len(search.idf)))
    for row, own in zip(parts, search.items.part_terms, strict=True):
        np.add.at(row, own, search.idf[own])
    left = p.left()
    # The fit's rows count repeats of a term in a passage by their own weights in the length.
    size = np.zeros(len(halves))
    np.add.at(size, p.half, p.weight**2)
    docs_rows = (halves[left] + halves[p.right(left)]) / np.sqrt(np.maximum(size[left] + size[p.right(left)], 1e-9))[:, None]
    whole = docs_rows.T @ docs_rows + max(1.0, len(left) / len(parts)) * dense(parts)
    best = np.linalg.eigvalsh(whole)[::-1][:6].sum()
    basis = search.basis.astype(np.float64)
    assert np.trace(basis.T @ whole @ basis) >= 0.97 * best


def test_words_that_share_a_slot_of_the_table_are_looked_up():
    rng = np.random.default_rng(1)
    terms = np.unique(np.concatenate([rng.integers(0, 2**63, 500).astype(np.uint64), np.arange(20, dtype=np.uint64) << np.uint64(40)]))
    words = np.concatenate([terms, terms + np.uint64(1), np.uint64(1 << 50) * np.arange(1, 9, dtype=np.uint64)])
    at = {int(t): i for i, t in enumerate(terms)}
    assert decontaminate.Vocabulary(terms).lookup(words).tolist() == [at.get(int(w), -1) for w in words]
