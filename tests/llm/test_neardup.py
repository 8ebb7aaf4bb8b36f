import numpy as np
import pyarrow as pa
import pytest

from mendflow.llm import neardup
from mendflow.llm.components import components
from mendflow.llm.words import words_of
from tests.llm import fixtures as X


def shingle_set(text):
    w = X.words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute(rows):
    """Class of each distinct text: the least id of the texts it is linked with."""
    texts = sorted({t or "" for _, t in rows})
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                root[find(i)] = find(j)
    where = {t: find(i) for i, t in enumerate(texts)}
    least = {}
    for i, t in rows:
        c = where[t or ""]
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return sorted(((i, least.get(where[t or ""])) for i, t in rows), key=repr)


def got(df):
    return sorted(((r.doc_id, r.class_id) for r in neardup.classify(df).collect()), key=repr)


def test_awkward_rows(spark):
    assert got(X.awkward_docs(spark)) == brute([r[:2] for r in X.awkward()])


def test_documents(spark):
    df = X.real_docs(spark)
    assert got(df) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_empty(spark):
    assert got(X.empty_docs(spark)) == []
    assert neardup.deduplicate(X.empty_docs(spark)).count() == 0


def test_one_document_of_each_class_stays(spark):
    df = X.awkward_docs(spark)
    left = neardup.deduplicate(df)
    assert left.columns == df.columns
    kept = sorted(((r.doc_id, r.text) for r in left.collect()), key=repr)
    classes = dict(brute([r[:2] for r in X.awkward()]))
    assert sorted((i for i, _ in kept if i is not None)) == sorted({c for i, c in classes.items() if i is not None and c is not None})
    assert len(kept) == len(set(kept))


def test_a_group_whose_members_are_near_their_origin_only(spark):
    # Copies of one text with a few words changed at places of their own: similar to the origin, not to each other.
    base = X.some_words(300, 11, 10_000)
    rows = [X.doc(0, " ".join(base))]
    for i in range(1, 60):
        w = list(base)
        for j in range(5):
            w[(i * 53 + j * 57) % 300] = f"new{i}-{j}"
        rows.append(X.doc(i, " ".join(w)))
    df = spark.createDataFrame(rows, X.DOCS)
    assert got(df) == brute([r[:2] for r in rows])


def test_copies_that_differ_by_a_much_repeated_line(spark):
    rows = []
    for i in range(12):
        base = " ".join(X.some_words(200, 50 + i, 100_000))
        line = " ".join(X.some_words(10, 90 + i, 100_000))
        rows += [X.doc(2 * i, base), X.doc(2 * i + 1, base + f"\n{line}" * 200)]
    assert got(spark.createDataFrame(rows, X.DOCS)) == brute([r[:2] for r in rows])


def test_near_copies_on_one_template_that_meet_no_centre(spark):
    template = X.some_words(104, 31, 100_000)
    rows = []
    for i in range(300):
        group = [f"group{i}-{j}" for j in range(8)]
        for k in (0, 1):
            rows.append(X.doc(2 * i + k, " ".join(template + group + [f"own{i}-{k}-{j}" for j in range(12)])))
    df = spark.createDataFrame(rows, X.DOCS)
    want = sorted(((i, i - i % 2) for i in range(600)), key=repr)
    assert got(df) == want == brute([r[:2] for r in rows])


def test_signatures_estimate_probability_jaccard():
    a, b = X.some_words(400, 21, 100_000), X.some_words(400, 22, 100_000)
    texts = [" ".join(a), " ".join(a[:300] + b[:100])]
    owner, hashes = neardup.shingles(words_of(pa.array(texts)))
    _, one, count = neardup.distinct(owner, hashes)
    size = 4096
    found = neardup.signatures(owner[one], hashes[one], count.astype(float), 2, size)
    sets = [shingle_set(t) for t in texts]
    want = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
    assert abs(np.mean(found[0] == found[1]) - want) < 4 * (want * (1 - want) / size) ** 0.5


def test_weights_count():
    # One element of weight 3 against 1, one shared of weight 1: sum of least probabilities over all.
    owner, hashes = np.array([0, 0, 1, 1]), np.array([5, 9, 5, 9], np.uint64)
    weights = np.array([3.0, 1.0, 1.0, 1.0])
    found = neardup.signatures(owner, hashes, weights, 2, 1 << 14)
    # Jp: sum over elements of 1 / sum of max ratios.
    want = 1 / (max(1, 1) + max(1 / 3, 1)) + 1 / (max(3, 1) + max(1, 1))
    assert abs(np.mean(found[0] == found[1]) - want) < 0.02


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = np.random.default_rng(seed)
    pairs = [tuple(map(int, rng.integers(0, 300, 2))) for _ in range(140)] + [(i, i + 1) for i in range(1000, 1060)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    rows = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    want = {(x, find(x)) for a, b in pairs if a != b for x in (a, b)}
    assert {(r.node, r.root) for r in rows} == want
    assert len(rows) == len(want)
