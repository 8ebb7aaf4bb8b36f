"""Small tables with the awkward cases every operator must take, and plain versions to check against."""

from __future__ import annotations

import random
import re

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, k1 string, bucket string, row int"
WORD = re.compile("[^\x20\x09-\x0d]+")


def words(text):
    return WORD.findall(text or "")


def some_words(n, seed, vocabulary=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}é" if rng.random() < 0.1 else f"word{rng.randrange(vocabulary)}" for _ in range(n)]


def doc(i, text, source="src0"):
    return (i, text, "en", source, len(text or ""), "clash", "clash", 7)


def awkward():
    """Nulls, empty and long texts, ties, repeated rows, copies, shared passages, near copies."""
    base = some_words(120, 1)
    near = list(base)
    near[60] = "changed"
    shared = some_words(60, 2)
    rows = [
        doc(1, None),
        doc(2, ""),
        doc(3, " \n\t "),
        doc(4, " ".join(base)),
        doc(5, " ".join(near)),
        doc(6, "\n".join(base), None),
        doc(7, " ".join(some_words(50, 3) + shared + some_words(40, 4))),
        doc(8, " ".join(some_words(30, 5) + shared + some_words(70, 6)), "src1"),
        doc(9, "one two three"),
        doc(9, "one two three"),
        doc(10, "one two three"),
        doc(None, "a row without id " + " ".join(some_words(20, 7)), "src1"),
        doc(None, None, None),
        doc(11, "same " * 100),
        doc(12, " ".join(some_words(40_000, 8, 100_000)), "src2"),
        doc(13, "x" * 70_000 + " end of a very long word", "src2"),
        doc(14, "\x0b\x0c\r mixed blanks stay in words \u0085 here"),
    ]
    rows += [doc(20 + i, " ".join(some_words(80, 9)), "src1") for i in range(30)]
    return rows


def awkward_docs(spark):
    return spark.createDataFrame(awkward(), DOCS).repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def real_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
