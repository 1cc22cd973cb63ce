"""The stages on the small tables against what each operator says, and on odd documents."""

import corpus_pipeline
from ledgermill.llm.chosen_path import near_duplicate_groups
from ledgermill.llm.latent import contaminated

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_keep_what_their_operators_keep(spark, small_dir, tmp_path):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    before = {r.doc_id: tuple(r) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = str(tmp_path / name)
        stage(spark, docs, small_dir).write.parquet(out)
        after = spark.read.parquet(out)
        assert after.columns == COLUMNS
        rows = {r.doc_id: tuple(r) for r in after.collect()}
        assert after.count() == len(rows) and rows.items() <= before.items()
        gone = set(before) - set(rows)
        if name == "near_dedup":
            assert gone == {r.doc_id for r in near_duplicate_groups(docs).where("NOT kept").collect()}
        elif name == "decontamination":
            bench = spark.read.parquet(f"{small_dir}/benchmark.parquet")
            assert gone == {r.doc_id for r in contaminated(docs, bench).collect()}
        elif name == "language":
            assert len(gone) < 0.02 * len(before)
        docs, before = after, rows
    result = corpus_pipeline.STAGES[-1][1](spark, docs, small_dir).orderBy("start").collect()
    assert [r.doc_id for r in result] == sorted(before)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(result, result[1:], strict=False))


def test_odd_documents(spark, odd_docs, no_docs, small_dir):
    docs = odd_docs.select(*COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, small_dir)
        assert stage(spark, no_docs.select(*COLUMNS), small_dir).count() == 0
        if name == "language":
            # The model knows one language, and all texts with a letter are in it.
            assert out.count() == docs.count() - 3
        elif name == "near_dedup":
            ids = sorted(r.doc_id for r in out.collect() if r.doc_id is not None)
            assert ids == [0, 1, 2, 3, 4, 5, 8, 9, 10]
        elif name == "token_files":
            assert out.count() == docs.count()


def test_repeated_rows_leave_one(spark):
    rows = [(1, "one two three four five six", "en", "a", 3)] * 3 + [(2, "seven", None, None, None)] * 2 + [(2, "eight", "en", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    left = corpus_pipeline.near_dedup(spark, docs, "")
    assert sorted((r.doc_id, r.text) for r in left.collect()) == [(1, rows[0][1]), (2, "eight"), (2, "seven")]
