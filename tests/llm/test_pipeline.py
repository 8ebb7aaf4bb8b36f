"""Each stage of the pipeline against a plain version on its own input."""

import pathlib

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import fixtures as X
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_native import plain_base, plain_counts
from tests.llm.test_neardup import brute as classes


def test_stages_on_real_documents(spark):
    docs = X.real_docs(spark)
    columns = docs.columns
    rows = docs.collect()
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, X.SF)
        after = out.collect()
        seen.append(name)
        if name == "quality_rules":
            failed = {r.doc_id for r in rows if (b := plain_base(r.text))[0] < 10 or 100 * b[4] > 20 * b[0]}
            assert {r.doc_id for r in after} == {r.doc_id for r in rows} - failed  # no line is so frequent here
        elif name == "near_dedup":
            assert {r.doc_id for r in after} == {c for _, c in classes([(r.doc_id, r.text) for r in rows])}
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{X.SF}/benchmark.parquet").collect()]
            held = {d for d, _ in leaks([tuple(r) for r in rows], items)}
            gone = {r.doc_id for r in rows} - {r.doc_id for r in after}
            assert held <= gone and len(gone - held) <= 0.02 * len(rows)
        elif name == "source_mixing":
            want = plain_counts([(r.doc_id, r.text, r.lang, r.source) for r in rows])
            assert sorted((r.doc_id, r.text) for r in after) == sorted(k for k, n in want.items() for _ in range(n))
        else:
            tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
            start = 0
            sizes = sorted((r.doc_id, len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1) for r in rows)
            got = sorted((r.start, r.doc_id, r.n_tokens) for r in after)
            for (d, n), r in zip(sizes, got, strict=True):
                assert r == (start, d, n)
                start += n
            break
        assert out.columns == columns
        docs, rows = spark.createDataFrame(after, docs.schema), after
    assert len(seen) == len(corpus_pipeline.STAGES)


def test_run_and_awkward_rows(spark, tmp_path):
    X.awkward_docs(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{X.SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert out.count() > 0


def test_files_keep_the_mixed_order(spark, tmp_path):
    docs = X.real_docs(spark)
    corpus_pipeline.source_mixing(spark, docs, X.SF).write.parquet(f"{tmp_path}/mixed")
    stored = spark.read.parquet(f"{tmp_path}/mixed")
    want = [r.doc_id for r in stored.select("doc_id", "_metadata.file_path", "_metadata.row_index").orderBy("file_path", "row_index").collect()]
    got = corpus_pipeline.token_ids(spark, stored, X.SF).orderBy("start").collect()
    assert [r.doc_id for r in got] == want != sorted(want)
    by_id = {r.doc_id: r.source for r in docs.collect()}
    switches = sum(by_id[a] != by_id[b] for a, b in zip(want, want[1:], strict=False))
    assert switches > 0.3 * len(want)  # sources are not side by side


def test_run_leaves_one_folder(spark):
    root = pathlib.Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))

    def folders():
        return {p for p in root.iterdir() if any(p.rglob("*.parquet"))} if root.exists() else set()

    before = folders()
    assert corpus_pipeline.run(spark, X.SF).count() > 0
    assert len(folders() - before) == 1


def test_run_on_nothing(spark, tmp_path):
    X.empty_docs(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{X.SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
