"""Quality rules by cross-document line frequency.

Lines are normalised (blanks to one space, trimmed, lower case) and hashed. A line that more than
``max_documents`` different texts of one host hold is boilerplate: it is removed from all of them
but one, the text with the smallest digest. A document of which too few words are left is rejected,
as is one that fails the base rules on its own text. Every line of every document counts; copies
of one text count once, so copying alone rejects nothing.

Only expressions and joins are used. One pass over the texts writes digests and a few numbers for
each line to the shared scratch folder; texts themselves are never grouped. Counting combines
within each task first, and the join that brings counts back to the lines keeps whole rows of a
hot host or line in splittable partitions.

Null text is empty: no words, rejected. A null host counts as the empty host. Repeated rows are
judged alike and both returned; an empty table gives no rows. ``filter_quality`` returns the kept
documents with the removed lines gone from ``text``; other columns pass through it whatever their
names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mendflow.sources.tables import cut_lineage

BLANK = "[\\x20\\x09-\\x0D]+"
SYMBOL = "[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
#: Most words in repeated windows, per cent.
MAX_REPEATED = 20
MAX_DOCUMENTS = 100
#: Least share of a document's words that must be left, and least number.
MIN_LEFT, MIN_WORDS_LEFT = 0.2, 10


def _words(text: Column) -> Column:
    return F.filter(F.split(text, BLANK), lambda w: w != "")


def _host(host: str) -> Column:
    return F.coalesce(F.col(host).cast("string"), F.lit(""))


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _line_hash(line: Column) -> Column:
    return F.xxhash64(F.lower(F.trim(F.regexp_replace(line, BLANK, " "))))


def line_numbers(docs: DataFrame, host: str) -> DataFrame:
    """A row for each document: its digest, its counts, and hash and words of each line."""
    split = docs.select("doc_id", _host(host).alias("host"), _text().alias("t")).select(
        "doc_id",
        "host",
        F.md5("t").alias("digest"),
        F.regexp_count("t", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        _words(F.col("t")).alias("words"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"),
    )
    last = F.size("words") - WINDOW
    # Hashes of the windows of one text; those found twice are looked for within the text only.
    hashed = split.select(
        "doc_id",
        "host",
        "digest",
        "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform(
            "lines",
            lambda x: F.struct(
                _line_hash(x).alias("line"),
                F.size(_words(x)).alias("n"),
            ),
        ).alias("lines"),
        F.when(
            last >= 0,
            F.transform(
                F.sequence(F.lit(0), last),
                lambda i: F.xxhash64(*[F.get("words", i + j) for j in range(WINDOW)]),
            ),
        ).alias("h"),
    )
    ordered = hashed.withColumn(
        "h",
        F.when(
            F.size(F.array_distinct("h")) < F.size("h"),
            F.array_sort(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
        ),
    )
    twice = F.filter(
        F.transform(
            "h",
            lambda x, j: F.when(
                (x["h"] == F.get("h", j - 1)["h"]) | (x["h"] == F.get("h", j + 1)["h"]), x["i"]
            ),
        ),
        lambda i: i.isNotNull(),
    )
    covered = F.aggregate(
        F.array_sort(twice),
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda a, i: F.struct(
            i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")
        ),
        lambda a: a["n"],
    )
    return ordered.withColumn(
        "n_repeat_words", F.when(F.col("h").isNotNull(), covered).otherwise(0).cast("long")
    ).drop("h")


def judge(
    docs: DataFrame,
    host: str = "source",
    max_documents: int = MAX_DOCUMENTS,
    min_left: float = MIN_LEFT,
) -> DataFrame:
    """A row for each document (``doc_id``, ``text``, host): its counts and the verdicts."""
    numbers = cut_lineage(line_numbers(docs, host))
    lines = numbers.select("host", "digest", F.posexplode("lines").alias("pos", "x")).select(
        "host", "digest", "pos", "x.line", "x.n"
    )
    # Copies of a text count once: the distinct count is pre-aggregated in each task.
    frequent = (
        lines.groupBy("host", "line")
        .agg(F.count_distinct("digest").alias("texts"), F.min("digest").alias("first"))
        .filter(F.col("texts") > max_documents)
        .drop("texts")
    )
    removed = F.when(F.col("first") != F.col("digest"), F.col("n")).otherwise(0)
    left = (
        lines.join(frequent, ["host", "line"], "left")
        .groupBy("host", "digest")
        .agg(
            F.sum(removed).alias("gone"),
            F.sum("n").alias("all"),
            F.count_if(F.col("pos") == 0).alias("rows"),
            F.collect_set(F.when(F.col("first") != F.col("digest"), F.col("line"))).alias("gone_lines"),
        )
        .select(
            "host",
            "digest",
            ((F.col("all") - F.col("gone")) / F.col("rows")).cast("long").alias("n_words_left"),
            (F.col("gone") > 0).alias("touched"),
            "gone_lines",
            (
                (F.col("all") - F.col("gone") < min_left * F.col("all"))
                | (F.col("all") - F.col("gone") < MIN_WORDS_LEFT * F.col("rows"))
            ).alias("poor"),
        )
    )
    n = F.col("n_words")
    base_failed = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * n)
    depleted = F.coalesce(F.col("touched") & F.col("poor"), F.lit(False))
    return numbers.drop("lines").join(left, ["host", "digest"], "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        F.coalesce("n_words_left", F.lit(0)).alias("n_words_left"),
        base_failed.alias("base_failed"),
        (~base_failed & ~depleted).alias("kept"),
        "host",
        "digest",
        "gone_lines",
    )


def filter_quality(docs: DataFrame, host: str = "source", **limits) -> DataFrame:
    """The documents that are kept, without the lines that are removed, other columns as they were."""
    kept = judge(docs, host, **limits).filter("kept").dropDuplicates(["host", "digest"]).select("host", "digest", "gone_lines")
    rows = docs.select(F.struct("*").alias("row"), _host(host).alias("host"), F.md5(_text()).alias("digest"))
    text = F.col("row")["text"]
    left = F.filter(F.split(text, "\n"), lambda x: ~F.array_contains("gone_lines", _line_hash(x)))
    cleaned = F.when(F.size("gone_lines") > 0, F.array_join(left, "\n")).otherwise(text)
    return rows.join(kept, ["host", "digest"]).select(
        *[(cleaned if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns]
    )


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, host, t, md5(t) AS digest,
    list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM d),
g AS (
  SELECT doc_id, digest, i, words[i:i + 4] AS win
  FROM (SELECT doc_id, digest, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)),
r AS (SELECT *, count(*) OVER (PARTITION BY doc_id, digest, win) AS c FROM g),
cov AS (
  SELECT doc_id, digest, count(DISTINCT j) AS n_repeat_words
  FROM (SELECT doc_id, digest, unnest(range(i, i + 5)) AS j FROM r WHERE c > 1) GROUP BY 1, 2),
l AS (
  SELECT doc_id, host, digest, lower(trim(regexp_replace(x, '[\\x20\\x09-\\x0D]+', ' ', 'g'))) AS line,
    len(list_filter(regexp_split_to_array(x, '[\\x20\\x09-\\x0D]+'), lambda y: y <> '')) AS n
  FROM (SELECT doc_id, host, digest, unnest(lines) AS x FROM w)),
f AS (
  SELECT host, line, min(digest) AS first FROM l GROUP BY 1, 2 HAVING count(DISTINCT digest) > 100),
k AS (
  SELECT doc_id, l.host, l.digest, sum(n) AS a,
    sum(CASE WHEN first IS NOT NULL AND first <> l.digest THEN n ELSE 0 END) AS gone
  FROM l LEFT JOIN f ON l.host = f.host AND l.line = f.line GROUP BY 1, 2, 3),
m AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(a - gone, 0) AS BIGINT) AS n_words_left,
    coalesce(gone > 0 AND (a - gone < 0.2 * a OR a - gone < 10), false) AS depleted
  FROM w LEFT JOIN cov ON w.doc_id = cov.doc_id AND w.digest = cov.digest
  LEFT JOIN k ON w.doc_id = k.doc_id AND w.digest = k.digest)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words_left,
  (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT depleted AS kept
FROM m
"""
