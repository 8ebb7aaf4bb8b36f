"""Near-duplicate vectors against all pairs."""

import math

import numpy as np
import pytest

from mendflow.llm import vectors
from tests.llm.fixtures import SF

SCHEMA = "vec_id long, embedding array<float>, label int, k1 string, h int, side string"


def unit(rng, d=24):
    v = rng.standard_normal(d)
    return v / np.linalg.norm(v)


def near(rng, v, cosine):
    other = rng.standard_normal(len(v))
    other -= (other @ v) * v
    return cosine * v + math.sqrt(1 - cosine**2) * other / np.linalg.norm(other)


def planted(seed=1):
    """Loose and tight groups, pairs about the threshold, chains, copies and vectors that link with nothing."""
    rng, found = np.random.default_rng(seed), []
    found += [unit(rng) for _ in range(300)]
    for cosine in np.linspace(0.93, 0.999, 60):
        found += [(v := unit(rng)), near(rng, v, cosine)]
    centre = unit(rng)
    found += [near(rng, centre, 0.995) for _ in range(90)]  # all linked
    centre = unit(rng)
    found += [near(rng, centre, rng.uniform(0.95, 0.99)) for _ in range(80)]  # some linked
    chain = unit(rng)
    for _ in range(12):
        found.append(chain := near(rng, chain, 0.96))
    found += [found[5]] * 40 + [found[5] * 3]
    found += [unit(rng, 8)] * 2
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(found)]
    bad = [None, [], [0.0] * 24, [1.0, None] * 12, [math.nan] + [1.0] * 23, [math.inf] + [1.0] * 23, [None] * 24]
    rows += [(len(rows) + i, v) for i, v in enumerate(bad)]
    rows += [(None, rows[7][1]), (None, None), rows[8], rows[8]]
    return [(*r, 0, "clash", 1, "clash") for r in rows]


def plain(rows, similarity=0.95):
    at = [r[1] for r in rows]
    ok = [v is not None and None not in v and np.isfinite(v).all() and np.any(v) for v in at]
    vs = [np.asarray(v, np.float32).astype(float) if k else None for v, k in zip(at, ok, strict=True)]
    n = len(rows)
    parent, links = list(range(n)), [0] * n

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and len(vs[i]) == len(vs[j]):
                if vs[i] @ vs[j] / (np.linalg.norm(vs[i]) * np.linalg.norm(vs[j])) >= similarity:
                    links[i], links[j] = links[i] + 1, links[j] + 1
                    parent[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(r[0], least.get(root(i), r[0]))
    return sorted(((r[0], links[i], (c := least.get(root(i))), r[0] == c) for i, r in enumerate(rows)), key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


@pytest.mark.parametrize("group, block", [(512, 2048), (20, 16), (0, 1000)])
def test_planted_links(spark, group, block):
    """Small groups are compared whole, large ones by their centre and in blocks, with the same result."""
    rows = planted()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got, want = found(vectors.classify(df, group=group, block=block)), plain(rows)
    assert sum(r[1] for r in got) <= sum(r[1] for r in want)
    wrong = [x for x in want if x not in set(got)]
    assert len(got) == len(want) and len(wrong) <= 4, wrong  # pairs may be missed, at MISS


def test_real_vectors(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert found(vectors.classify(df)) == plain(rows)


def test_windows_reach_over_partitions_and_slices(monkeypatch, spark):
    monkeypatch.setattr(vectors, "SLICE_NUMBERS", 1)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in near(rng, np.eye(24)[0], 0.99)], 0, "", 0, "") for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert {(r[1] > 0, r[2]) for r in found(vectors.classify(df))} == {(True, 0)}
    assert found(vectors.classify(df)) == plain(rows)


def test_window_links_connect_all_that_is_in_reach():
    rng = np.random.default_rng(5)
    v = np.stack([near(rng, np.eye(16)[i % 3], 0.99) for i in range(200)])
    piece = np.repeat([0, 1], 100)
    a, b = vectors.window_links(v, piece, 8, 0.95)
    want = [(i, j) for j in range(200) for i in range(max(0, j - 8), j) if piece[i] == piece[j] and v[i] @ v[j] >= 0.95]
    assert len(a) <= 200 - 6 and set(zip(a.tolist(), b.tolist(), strict=True)) <= set(want)

    def parts(pairs):
        label = list(range(200))
        for _ in range(200):
            before = list(label)
            for i, j in pairs:
                label[i] = label[j] = min(label[i], label[j])
            if label == before:
                return label

    assert parts(list(zip(a.tolist(), b.tolist(), strict=True))) == parts(want)


def test_passes_grow_slowly_with_the_number_of_vectors():
    assert [vectors.passes_for(n) for n in (0, 1)] == [vectors.passes_for(1)] * 2
    assert 2 * vectors.passes_for(10**5) < vectors.passes_for(10**9) < 10 * vectors.passes_for(10**5)


def test_empty_table(spark):
    assert found(vectors.classify(spark.createDataFrame([], SCHEMA))) == []
    assert found(vectors.classify(spark.createDataFrame([(3, None, 0, "", 0, "")], SCHEMA))) == [(3, 0, 3, True)]
