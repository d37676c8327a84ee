import re
from collections import Counter

import pytest
from cases import documents, empty
from pyspark.sql import functions as F

from wayfare.llm.common import repeated_rows
from wayfare.llm.exact_dedup import drop_exact_copies
from wayfare.llm.mixing import GOLDEN, golden_point, mix, mixed_documents, schedule, source_targets
from wayfare.llm.simhash import drop_near_copies

WORD = r"[^\x20\x09-\x0D]+"


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, limit=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        if not rest:
            return {s: limit * sizes[s] for s in names}
        level = (total - sum(limit * sizes[s] for s in full)) / sum(weight[s] for s in rest)
        over = {s for s in rest if level * weight[s] > limit * sizes[s]}
        if not over:
            return {s: limit * sizes[s] if s in full else level * weight[s] for s in names}
        full |= over


@pytest.mark.parametrize("sizes", [{"a": 10}, {"a": 5, "b": 5, "c": 5, "d": 900, None: 30}, {"é": 0, "z": 100, "": 7}, {str(i): i * i for i in range(30)}, {"a": 0}])
def test_targets_like_sharing_again_and_again(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    found = {r.source: r.target for r in source_targets(table).collect()}
    assert found == pytest.approx(plain_targets(sizes))


@pytest.mark.parametrize("block", [1024, 3])
def test_mix_meets_its_targets(spark, block):
    docs = documents(spark)
    placed, stretches = mix(docs, block_words=block)
    rows = placed.collect()
    size = Counter()
    for r in docs.collect():
        size[r.source] += len(re.findall(WORD, r.text or ""))
    targets = plain_targets(dict(size))
    taken, per_row, pieces = Counter(), Counter(), stretches.collect()
    for s in pieces:
        taken[s.source] += s.words
        per_row[s.mark] += s.words
    assert len(rows) == docs.count() and {r.source: r.source_size for r in rows} == dict(size)
    assert all(abs(taken[s] - targets[s]) <= 0.5 for s in size)
    assert all(per_row[r.mark] <= 2 * r.size for r in rows)
    by_mark = {r.mark: r for r in rows}
    assert all(0 <= p.first and p.first + p.words <= by_mark[p.mark].size for p in pieces)
    again = mix(docs.repartition(5), block_words=block)[1].groupBy("id").sum("words").collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, stretches.groupBy("id").sum("words").collect()), key=str)


def test_every_stretch_of_the_schedule_has_the_proportions(spark):
    table = spark.createDataFrame([("a", 60_000, 60_000.0), ("b", 30_000, 30_000.0), ("c", 10_000, 10_000.0)], "source string, source_size bigint, target double")
    slots = [r.source for r in schedule(table, 10).orderBy("slot").collect()]
    assert Counter(slots) == {"a": 6000, "b": 3000, "c": 1000}
    for at in range(0, 9_000, 500):
        part = Counter(slots[at : at + 500])
        assert abs(part["a"] - 300) < 8 and abs(part["b"] - 150) < 8 and abs(part["c"] - 50) < 8


def test_points_are_exact_for_large_slots(spark):
    slots = [0, 1, 2, 12345, 2**20 + 7, 2**33 + 5, 2**40 - 1]
    df = spark.createDataFrame([(s,) for s in slots], "slot bigint")
    found = [r[0] for r in df.select(golden_point(F.col("slot"))).collect()]
    assert found == pytest.approx([s * GOLDEN % 2**64 / 2**64 for s in slots], abs=1e-9)


def test_mixed_documents(spark):
    docs = documents(spark)
    found = mixed_documents(docs)
    assert found.columns == docs.columns
    copies = Counter((r.doc_id, r.text) for r in found.collect())
    repeated = Counter((r.doc_id, r.text) for r in docs.collect())
    assert all(n <= 2 * repeated[key] for key, n in copies.items())
    assert all(copies[key] == 1 for key in [(1, None), (2, ""), (3, ""), (4, " \n\t ")])


def test_empty_table(spark):
    placed, stretches = mix(empty(documents(spark)))
    assert placed.count() == 0 and stretches.count() == 0
    assert mixed_documents(empty(documents(spark))).count() == 0


def test_copies_of_a_row_are_made_by_several_tasks(spark):
    rows = spark.createDataFrame([(1, 3, {"a": 1}), (2, 0, {}), (3, 50, {}), (4, 1, {})], "k int, times long, piece map<string,int>")
    for at_once in (1024, 7):
        made = repeated_rows(rows, "times", "number", 50, at_once)
        assert sorted((r.k, r.number) for r in made.collect()) == [(1, i) for i in range(3)] + [(3, i) for i in range(50)] + [(4, 0)]
        assert set(made.columns) == {"k", "times", "piece", "number"}


@pytest.mark.parametrize("drop", [mixed_documents, drop_exact_copies, drop_near_copies])
def test_helper_columns_do_not_clash_and_maps_are_borne(spark, drop):
    names = ["__time", "time", "piece", "wanted_mark", "wanted_id", "wanted_rows", "wanted_times", "mark_"]
    docs = documents(spark).withColumns({n: F.lit(f"my {n}") for n in names})
    docs = docs.withColumn("tags", F.create_map(F.lit("k"), F.coalesce("doc_id", F.lit(0))))
    kept = drop(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert rows and all(r[n] == f"my {n}" for r in rows for n in names) and all(r.tags == {"k": r.doc_id or 0} for r in rows)
