from collections import Counter

import pytest
from cases import documents, empty

from wayfare.llm.sharding import fisher_yates, shard_documents


@pytest.mark.parametrize("bucket_bytes", [16 << 20, 500])
@pytest.mark.parametrize("shards", [16, 1, 200])
def test_shards_are_even_and_whole(spark, tmp_path, bucket_bytes, shards):
    docs = documents(spark)
    found = shard_documents(docs, str(tmp_path / "s"), shards, bucket_bytes=bucket_bytes)
    assert set(found.columns) == {*docs.columns, "shard_", "slot_"}
    rows = found.collect()
    assert Counter((r.doc_id, r.text, r.source) for r in rows) == Counter((r.doc_id, r.text, r.source) for r in docs.collect())
    counts = Counter(r.shard_ for r in rows)
    sizes = [counts[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows)
    for shard in range(shards):
        assert sorted(r.slot_ for r in rows if r.shard_ == shard) == list(range(counts[shard]))


def test_reruns_agree_and_order_is_shuffled(spark, tmp_path):
    docs = spark.range(2000).selectExpr("id as doc_id", "repeat('x', int(id % 50)) as text")
    one = shard_documents(docs, str(tmp_path / "a"), bucket_bytes=20_000)
    two = shard_documents(docs.repartition(5), str(tmp_path / "b"), bucket_bytes=20_000)
    order = [tuple(r) for r in one.select("shard", "slot", "doc_id").orderBy("shard", "slot").collect()]
    assert order == [tuple(r) for r in two.select("shard", "slot", "doc_id").orderBy("shard", "slot").collect()]
    ids = [r[2] for r in order]
    assert sum(a < b for a, b in zip(ids, ids[1:])) in range(900, 1100)


def test_rows_repeated_in_full_do_not_meet_in_one_bucket(spark, tmp_path):
    docs = spark.range(3000).selectExpr("if(id < 2000, -1, id) as doc_id", "repeat('x', 40) as text", "map('k', 1) as tags")
    one = shard_documents(docs, str(tmp_path / "a"), bucket_bytes=4000)
    two = shard_documents(docs.repartition(7), str(tmp_path / "b"), bucket_bytes=4000)
    order = [tuple(r) for r in one.select("shard", "slot", "doc_id").orderBy("shard", "slot").collect()]
    assert order == [tuple(r) for r in two.select("shard", "slot", "doc_id").orderBy("shard", "slot").collect()]
    counts = Counter(shard for shard, _, _ in order)
    assert len(order) == 3000 and max(counts.values()) - min(counts.values()) <= 1
    hot = Counter(shard for shard, _, doc_id in order if doc_id == -1)
    assert sum(hot.values()) == 2000 and max(hot.values()) < 170 and min(hot.values()) > 80


def test_shuffle_is_uniform():
    counts = Counter(tuple(fisher_yates(3, [7, i]).tolist()) for i in range(6000))
    assert len(counts) == 6 and all(850 < n < 1150 for n in counts.values())
    assert fisher_yates(0, [1]).tolist() == [] and fisher_yates(1, [1]).tolist() == [0]


def test_empty_table(spark, tmp_path):
    assert shard_documents(empty(documents(spark)), str(tmp_path / "s")).count() == 0
    with pytest.raises(ValueError):
        shard_documents(documents(spark), str(tmp_path / "t"), 0)
