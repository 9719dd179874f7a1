"""The pipeline: its contract, and planted cases at each stage."""

from test_near_duplicates import one_of_each_group

import corpus_pipeline
from tidelog.llm import pieces
from tidelog.llm.common import table

DATA = "/root/testdata/sf0.01"


def test_stages_one_by_one(spark, tmp_path):
    docs = table(spark, DATA, "documents")
    first = docs.columns
    rows = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        stage(spark, docs, DATA).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == first
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "pii":
            assert set(after) == set(before) and any("[EMAIL]" in t for t in after.values())
            assert docs.where("n_chars <> length(text)").count() == 0
        else:
            assert 0 < len(after) < len(before) and all(before[i] == t for i, t in after.items())
        if name == "simhash_near_dedup":
            assert set(after) == one_of_each_group(before)
    assert 0.7 * rows < docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    table_ = pieces.ChunkTable(pieces.default_model())
    for r in last.collect():
        assert r["decoded"] == texts[r["doc_id"]] and r["ids"] == table_.model.encode(r["decoded"])


def test_stages_take_odd_rows(spark):
    odd = spark.createDataFrame([(1, None, "en", "s", None), (2, "", "en", "s", 0), (None, "some words here", None, None, 15)],
                                table(spark, DATA, "documents").schema)
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, odd, DATA).count()
        assert kept == (2 if name == "simhash_near_dedup" else 3), name  # null and empty texts are copies
        assert stage(spark, odd.where("false"), DATA).count() == 0


def test_run_applies_all_stages(spark):
    small = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, small)
    assert out.columns == ["doc_id", "ids", "n_tokens", "decoded"]
    docs = table(spark, small, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
    assert sorted(map(str, out.collect())) == sorted(map(str, docs.collect()))
