import corpus_pipeline
import numpy as np
from cases import documents, empty

from wayfare.llm.bpe import WordTokenizer


def test_stages_on_awkward_rows(spark):
    docs = documents(spark)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_dedup", "mixing", "bpe"]
    columns, seen = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        seen = corpus_pipeline.save(stage(spark, seen, None), name)
        assert seen.columns == columns and seen.count() > 0
    last = corpus_pipeline.STAGES[-1][1](spark, seen, None)
    assert last.columns == ["doc_id", "n_tokens", "ids", "decoded"] and last.count() == seen.count()
    with open(corpus_pipeline.tokenizer_path(), encoding="utf-8") as file:
        pieces = WordTokenizer(file.read()).pieces()
    for row in last.collect():
        ids = np.frombuffer(bytes(row.ids), "<u4")
        assert len(ids) == row.n_tokens and " ".join(pieces[i] for i in ids) == row.decoded


def test_stages_on_an_empty_table(spark):
    docs = empty(documents(spark))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, None).count() == 0


def test_decisions_take_effect(spark):
    docs = documents(spark)
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language_id"](spark, docs, None)
    assert not {r.doc_id for r in kept.collect()} & {1, 2, 3, 4, 9}
    once = corpus_pipeline.save(stages["exact_dedup"](spark, kept, None), "once")
    assert once.selectExpr("lower(text)").distinct().count() == once.count()
    near = stages["simhash_dedup"](spark, once, None)
    assert 0 < near.count() <= once.count()


def test_run(spark):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert found.count() > 100 and found.filter("n_tokens = 0").count() == 0
