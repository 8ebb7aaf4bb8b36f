import hashlib
from collections import Counter

import numpy as np
import pytest

from mendflow.llm import substrings
from tests.llm import fixtures as X


def brute(rows, k):
    found = [(i, X.words(t)) for i, t in rows]
    seen = Counter(tuple(w[j : j + k]) for _, w in found for j in range(len(w) - k + 1))
    out = []
    for i, w in found:
        gone = set()
        for j in range(len(w) - k + 1):
            if seen[tuple(w[j : j + k])] > 1:
                gone.update(range(j, j + k))
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=repr)


def got(df, **sizes):
    return sorted((tuple(r) for r in substrings.remove_repeats(df, **sizes).collect()), key=repr)


@pytest.mark.parametrize(("k", "m"), [(35, 6), (8, 3), (5, 5)])
def test_awkward_rows(spark, k, m):
    df = X.awkward_docs(spark)
    assert got(df, k=k, m=m) == brute([r[:2] for r in X.awkward()], k)


def test_documents(spark):
    df = X.real_docs(spark)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = brute(rows, 35)
    assert got(df) == want
    assert sum(r[2] for r in want) > 0


def test_empty(spark):
    assert got(X.empty_docs(spark)) == []


def test_common_runs_come_last_and_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(substrings, "COMMON_SHARE", 0.0)
    df = X.awkward_docs(spark)
    assert len(substrings._common_runs(df, 6)) > 0
    assert got(df) == brute([r[:2] for r in X.awkward()], 35)


def test_equal_hashes_are_told_apart(monkeypatch):
    strings = [b"a b c d e", b"v w x y z", b"q a b c d"]
    monkeypatch.setattr(substrings, "windows", lambda h, first, k: (np.zeros(6, np.uint64), np.array([0, 1, 5, 6, 10, 11])))
    marks = substrings.repeated_windows(strings, 4)
    assert [m.tolist() for m in marks] == [[True, False], [False, False], [False, True]]


def test_query_digests(spark):
    from mendflow.llm.queries import QUERIES

    rows = QUERIES["op6_substring_dedup"](spark, X.SF).collect()
    want = {r[0]: r for r in brute([(r.doc_id, r.text) for r in X.real_docs(spark).collect()], 35)}
    for r in rows:
        assert (r.n_words, r.n_removed) == want[r.doc_id][1:3]
        assert r.kept_sha256 == hashlib.sha256(want[r.doc_id][3].encode()).hexdigest()
