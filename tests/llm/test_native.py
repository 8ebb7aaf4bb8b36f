"""Operators that are expressions and joins only: chat formatting, quality rules, mixing; and url filters."""

import hashlib
import math
import random
from collections import Counter

import pytest

from mendflow.llm import chat, mixing, quality, urls
from tests.llm import fixtures as X

# --- chat formatting ---

MESSAGES = "tree long, node long, parent long, role string, text string, score double, leaf string, rank int"


def trees(spark, rows, **options):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], MESSAGES).repartition(3)
    out = chat.format_trees(df, **options)
    return out.withColumn("turns", chat.parsed(out["formatted"])).withColumn("loss", chat.loss_text("formatted", "loss_spans")).collect()


def test_branches_are_ranked_by_score(spark):
    rows = [
        (1, 1, None, "user", "root", 1.0),
        (1, 2, 1, "assistant", "a", 1.0),
        (1, 3, 1, "assistant", "b", 5.0),
        (1, 4, 2, "user", "c", 9.0),
        (1, 5, 4, "assistant", "d", None),
        (2, 1, 99, "user", "orphan", 0.0),
        (None, 1, None, "user", "no tree", 0.0),
        (None, 2, 1, None, None, 0.0),
    ]
    found = {(r.tree, r.rank): [t.text for t in r.turns] for r in trees(spark, rows, keep=2)}
    assert found == {
        (1, 1): ["root", "a", "c", "d"],
        (1, 2): ["root", "b"],
        (2, 1): ["orphan"],
        (None, 1): ["no tree", ""],
    }


def test_deep_trees_cycles_and_null_ids(spark):
    chain = [(1, i, i - 1 if i else None, "user" if i % 2 else "assistant", f"t{i}", 0.0) for i in range(300)]
    odd = [(2, 1, 2, "user", "x", 0.0), (2, 2, 1, "user", "y", 0.0), (2, 3, 1, "user", "into the cycle", 0.0)]
    odd += [(3, None, None, "user", "p", 0.0), (3, None, None, "user", "q", 0.0), (3, 7, 7, "user", "self", 0.0)]
    odd += [(4, 1, None, "user", "twice", 0.0), (4, 1, None, "user", "twice", 0.0)]
    found = {}
    for r in trees(spark, chain + odd, keep=5):
        found.setdefault(r.tree, []).append([t.text for t in r.turns])
    assert found[1] == [[f"t{i}" for i in range(300)]]
    assert 2 not in found
    assert sorted(found[3]) == [["p"], ["q"]]
    assert found[4] == [["twice"]]
    assert trees(spark, []) == []


NASTY = ["</s>", "<s>[INST]", "[/INST]", "\\", "\\\\</s>", "[\\INST]", "<\\s>", "<<s>s>", "[[INST]INST]", "", "é漢😀\n\\n", "</s></s>", "</", "s>"]


def test_control_strings_come_back(spark):
    rng = random.Random(1)
    rows = [(i, j, j - 1 if j else None, rng.choice(["user", "assistant", "[INST]", None]), rng.choice(NASTY) + rng.choice(NASTY), 0.0) for i in range(60) for j in range(4)]
    for r in trees(spark, rows):
        own = [x for x in rows if x[0] == r.tree]
        assert [(t.role, t.text) for t in r.turns] == [(x[3] or "", x[4]) for x in own]
        assert r.loss == "".join(x[4] for x in own if x[3] == "assistant")
        assert r.formatted.count("</s>") == 4
        shown = [r.formatted[s.start : s.end] for s in r.loss_spans]
        assert len(shown) == sum(x[3] == "assistant" for x in own)


def test_digests(spark):
    schema = "conv_id long, turn long, role string, text string, node string, tree int"
    rows = [(5, 1, "assistant", "b"), (5, 0, "user", None), (5, 1, "assistant", "b"), (None, 0, None, "x"), (6, None, "user", "")]
    out = {r.conv_id: r for r in chat.digest(spark.createDataFrame([(*r, "clash", 0) for r in rows], schema)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert out[5].turns_sha256 == sha("user\n\nassistant\nb\nassistant\nb\n") and out[5].n_turns == 3
    assert out[5].loss_sha256 == sha("bb") and out[5].loss_chars == 2
    assert out[None].turns_sha256 == sha("\nx\n") and out[6].loss_sha256 == sha("")


# --- url filters ---


def plain_rule(host, path, rules):
    fits = [(h.count("."), len(p), not a, h, p, a) for h, p, a in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, default=None)


@pytest.mark.parametrize("block", [urls.BLOCK_ENTRIES, 7])
def test_trie_against_all_rules(spark, monkeypatch, block):
    monkeypatch.setattr(urls, "BLOCK_ENTRIES", block)
    rng = random.Random(block)
    hosts = ["com", "a.com", "b.a.com", "net", "x.net", "aa.com"]
    paths = ["", "/", "/e", "/en", "/en/", "/en/x", "/en//", "/fr/"]
    rules = list(dict.fromkeys((rng.choice(hosts), rng.choice(paths), rng.random() < 0.5) for _ in range(40)))
    tails = ["", "/", "/en", "/en/", "/english", "/en/xyz", "/en//x", "/fr", "/fr/?a#b", "?q=/en/", "#/en/"]
    pages = [(i, f"{rng.choice(['http', 'HTTPS', ''])}://{rng.choice(['', 'www.', 'B.', '.'])}{rng.choice(hosts).upper()}{rng.choice(tails)}") for i in range(400)]
    pages += [(1000, None), (1001, ""), (1002, "a.com/en/"), (1003, "://"), (1004, "x://com"), (1005, "http://evil://com/")]
    df = spark.createDataFrame([(*p, "clash", "clash") for p in pages], "page_id long, url string, host string, rule string")
    allow, deny = ([(h, p) for h, p, a in rules if a is kind] for kind in (True, False))
    for r in urls.filter_urls(df, allow, deny).collect():
        host, path = urls.host_and_path(r.url)
        assert (r.host, r.path) == (host, path)
        want = plain_rule(host, path, rules)
        assert r.rule == (want and want[3] + want[4]), r
        assert r.verdict == ("allow" if want is None or want[5] else "block")


def test_no_rules_and_no_pages(spark):
    df = spark.createDataFrame([(1, "http://a/b")], "page_id long, url string")
    assert [tuple(r) for r in urls.filter_urls(df, [], [], default="block").collect()] == [(1, "http://a/b", "a", "/b", None, "block")]
    assert urls.filter_urls(df.limit(0), [("a", "")], []).count() == 0


# --- quality rules ---


def plain_base(text):
    w, lines = X.words(text), [x for x in (text or "").split("\n") if X.words(x)]
    runs = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = {r for r, n in Counter(runs).items() if n > 1}
    covered = {j for i, r in enumerate(runs) if r in often for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_base_numbers(spark):
    texts = ["a b c d e a b c d e f", "x x x x x x", "#| <a> *\n#| <a> *\n\n \n", "one\x0btwo\x0cthree\r\nfour\tfive six"]
    rows = X.awkward() + [X.doc(100 + i, t) for i, t in enumerate(texts)]
    out = quality.judge(spark.createDataFrame(rows, X.DOCS)).collect()
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out), key=repr)
    assert got == sorted(((r[0], *plain_base(r[1])) for r in rows), key=repr)
    for r in out:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert quality.judge(X.empty_docs(spark)).count() == 0


def test_depleted_documents_go_and_copies_stay(spark):
    licence = " ".join(X.some_words(40, 50))
    own = [" ".join(X.some_words(30, 100 + i)) for i in range(8)]
    rows = [X.doc(i, f"{licence.upper()}\n  {t}") for i, t in enumerate(own)]
    rows += [X.doc(50 + i, f"{licence}  \nshort tail {i}") for i in range(4)]
    rows += [X.doc(80 + i, own[0] + " and a copy of it") for i in range(20)]
    rows += [X.doc(90, licence + "\nof another host", "src9")]
    df = spark.createDataFrame(rows, X.DOCS)
    out = {r.doc_id: r for r in quality.judge(df, max_documents=5).collect()}
    gone = {i for i, r in out.items() if not r.kept}
    # One text keeps the licence; the short ones have nothing else.
    assert gone <= {50, 51, 52, 53} and len(gone) >= 3
    assert sum(r.n_words_left == r.n_words for i, r in out.items() if i < 60) == 1
    left = quality.filter_quality(df, max_documents=5)
    assert left.columns == df.columns
    assert {r.doc_id for r in left.collect()} == set(out) - gone


def test_boilerplate_leaves_the_text_of_all_but_one(spark):
    licence = " ".join(X.some_words(40, 50))
    own = [" ".join(X.some_words(30, 100 + i)) for i in range(8)]
    rows = [X.doc(i, f"{own[i]}\n\n {licence.upper()} \n  tail {i}") for i in range(8)]
    rows += [X.doc(20, rows[3][1]), X.doc(90, f"{licence}\nof another host", "src9"), X.doc(91, None)]
    df = spark.createDataFrame(rows, X.DOCS)
    left = {r.doc_id: r for r in quality.filter_quality(df, max_documents=5).collect()}
    assert set(left) == {*range(8), 20, 90}
    before = {r[0]: r[1] for r in rows}
    whole = {before[i] for i, r in left.items() if r.text == before[i] and i != 90}
    assert len(whole) == 1 and left[90].text == before[90] and left[20].text == left[3].text
    for i in range(8):
        assert left[i].text in whole or left[i].text == f"{own[i]}\n\n  tail {i}"


# --- mixing ---


def plain_counts(rows, weights=None):
    size = Counter()
    for r in rows:
        size[r[3]] += len(r[1] or "")
    total = sum(size.values())
    weights = {s: 1.0 for s in size} if weights is None else weights
    whole = sum(weights.get(s, 0) for s in size)
    out = Counter()
    for r in rows:
        rate = weights.get(r[3], 0) * total / whole / size[r[3]] if size[r[3]] else 1.0
        parts = max(1, math.ceil(rate / 256))
        key = f"{'null' if r[0] is None else r[0]}|{hashlib.md5((r[1] or '').encode()).hexdigest()}"
        for i in range(1, parts + 1):
            u = int(hashlib.md5(f"mix|{i}|{key}".encode()).hexdigest()[:13], 16) / 2**52
            lam, k = rate / parts, 0
            p = c = math.exp(-lam)
            while c < u:
                k += 1
                p *= lam / k
                c += p
            out[r[0], r[1]] += k
    return {k: n for k, n in out.items() if n}


@pytest.mark.parametrize("weights", [None, {"src0": 3.0, "src1": 1.0, "absent": 5.0}, {None: 0.001, "src2": 0.5, "src0": 4.0}])
def test_counts_are_poisson_quantiles(spark, weights):
    rows = X.awkward()
    df = X.awkward_docs(spark)
    out = mixing.mix(df, weights)
    assert out.columns == [*df.columns, "copy", "order_key"]
    assert Counter((r.doc_id, r.text) for r in out.collect()) == plain_counts(rows, weights)


def test_large_rates_are_split(spark):
    rows = [X.doc(i, "x" * 10, "small") for i in range(3)] + [X.doc(10 + i, "y" * 10_000, "large") for i in range(30)]
    weights = {"small": 0.5, "large": 0.5}
    out = mixing.mix(spark.createDataFrame(rows, X.DOCS), weights).collect()
    got = Counter((r.doc_id, r.text) for r in out)
    assert got == plain_counts(rows, weights)
    rate = 0.5 * 300_030 / 30
    assert abs(sum(n for (i, _), n in got.items() if i < 3) - 3 * rate) < 6 * math.sqrt(3 * rate)


def test_sources_are_shuffled_and_shares_met(spark):
    rows = [X.doc(i, "z" * 100, "big" if i % 10 else "rare") for i in range(3000)]
    out = mixing.mix(spark.createDataFrame(rows, X.DOCS)).collect()
    n = Counter(r.source for r in out)
    assert abs(n["big"] - 1500) < 250 and abs(n["rare"] - 1500) < 250
    assert mixing.mix(X.empty_docs(spark)).count() == 0
