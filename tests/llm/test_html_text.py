import random

import pytest

from mendflow.llm import html_text
from tests.llm import fixtures as X

SCHEMA = "page_id long, url string, html string, host string, text string"


def got(spark, rows):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(3)
    return {r.page_id: r.text for r in html_text.extract(df).collect()}


def test_chrome_goes_and_the_article_stays(spark):
    page = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>"
        '<script>var t="</p>";</script><noscript>no</noscript><nav><ul><li>Home</ul></nav><!-- x --><div class="ad box">Buy</div>'
        "<article><h1>A &amp; B</h1><p>one\n\t two&nbsp;three<br>four <b>bo</b>ld<p>five&#33;"
        '<form><input value="q"><button>Go</button></form><div id="comments"><p>nice</p></div>'
        "<aside>side</aside><p>last &lt;tag&gt;</article><footer>&copy; host</footer>"
    )
    texts = got(spark, [(1, "http://h/a/1", page), (2, "http://h/a/2", None), (3, None, ""), (4, "no scheme", "plain text")])
    assert texts == {1: "A & B one two three four bold five! last <tag>", 2: "", 3: "", 4: "plain text"}


def test_shared_lines_outside_an_article_go(spark):
    def page(*lines):
        return "<body>" + "".join(f"<div>{x}</div>" for x in lines) + "</body>"

    rows = [
        (1, "http://h/a/1", page("Top", "own one", "Bottom")),
        (2, "http://h/a/2", page("Top", "own two", "more", "Bottom")),
        (3, "http://h/b/1", page("Other top", "own three", "Bottom")),
        (4, "http://alone/a", page("Top", "own four")),
        (5, "http://h/a/1", page("Top", "own one", "Bottom")),
    ]
    texts = got(spark, rows)
    assert texts == {1: "own one", 2: "own two more", 3: "Other top own three", 4: "Top own four", 5: "own one"}


def test_copies_of_an_article_on_one_host_stay(spark):
    page = "<nav>m</nav><article><p>the same article</article>"
    texts = got(spark, [(i, f"http://h/{i}", page) for i in range(20)])
    assert set(texts.values()) == {"the same article"}


def test_differencing_decides_around_an_article(spark):
    def page(i):
        return (
            f"<nav>m {i}</nav><div>Site</div><div>lead {i}</div><article><p>same words<p>text {i}</article>"
            f"<div>more of {i}</div><div>Imprint</div>"
        )

    texts = got(spark, [(i, f"http://h/{i}", page(i)) for i in range(6)])
    assert texts == {i: f"lead {i} same words text {i} more of {i}" for i in range(6)}


def test_pages_meet_their_neighbours_whatever_the_partitions(spark):
    pages = [(i, f"http://h/{i:03d}", f"<div>own {i}</div><div>shared {i // 2}</div>") for i in range(40)]
    texts = got(spark, pages)
    # Equal prefixes: the path before is taken, so every second page finds its partner before it.
    assert [texts[i] for i in (1, 3, 39)] == ["own 1", "own 3", "own 39"]
    assert texts[0] == "own 0"


@pytest.mark.parametrize("seed", range(20))
def test_common_is_a_longest_common_subsequence(seed):
    rng = random.Random(seed)
    a = [rng.randrange(6) for _ in range(rng.randrange(40))]
    b = [rng.randrange(6) for _ in range(rng.randrange(40))]
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    at = html_text.common(a, b)
    assert len(at) == table[-1][-1] and at == sorted(set(at))
    rest = iter(b)
    assert all(a[i] in rest for i in at)


def test_real_pages(spark):
    import html
    import re

    df = spark.read.parquet(f"{X.SF}/pages.parquet")
    rows = {r.page_id: r.html for r in df.collect()}
    for r in html_text.extract(df).collect():
        article = re.search(r"<article>(.*?)</article>", rows[r.page_id], re.S)[1]
        want = html.unescape(re.sub(r"</?b>", "", article).replace("<", " <"))
        want = " ".join(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", article)).split())
        assert r.text == " ".join(html.unescape(want).split())
        assert r.n_chars == len(r.text)


def test_names_are_whole_words_and_never_hide_the_article(spark):
    pages = {
        '<div class="layout has-sidebar"><div class="left-sidebar">menu</div><article><p>text</article></div>': "text",
        '<div id="page" class="no-header-image"><article>one</article></div>': "one",
        '<div class="modal"><article>two</article></div>': "two",
        '<article>kept <span class="ad-hoc">ad hoc</span> word<div class="site_footer">f</div></article>': "kept ad hoc word",
        '<article>own</article><div id="comments"><article class="x">a comment</article></div>': "own",
        "<nav><article>in a menu</article></nav><article>real</article>": "real",
        "<article>" + "<p>long</p>" * 20_000 + "</article>": " ".join(["long"] * 20_000),
    }
    texts = got(spark, [(i, f"http://n{i}/a", page) for i, page in enumerate(pages)])
    assert [texts[i] for i in range(len(pages))] == list(pages.values())


def test_empty_table_and_malformed_pages(spark):
    assert got(spark, []) == {}
    odd = ["<", "<<<p", "<!--", "<script>x", "<div class='ad'>x", '<a title="x>y', "</p></div>text", "<article>" * 300 + "deep"]
    texts = got(spark, [(i, f"http://o/{i}", x) for i, x in enumerate(odd)])
    assert texts[6] == "text" and texts[7] == "deep" and texts[4] == "" and texts[3] == ""
