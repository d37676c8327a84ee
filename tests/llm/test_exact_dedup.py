import hashlib
from collections import defaultdict

import pytest
from cases import documents, empty

from wayfare.llm.exact_dedup import drop_exact_copies, exact_groups


def expected(rows, keep):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").encode().lower()].append(doc_id)
    best = {}
    for key, ids in groups.items():
        known = [i for i in ids if i is not None]
        best[key] = (keep(known) if known else None, len(ids), hashlib.sha256(key).hexdigest())
    return sorted(((i, *best[(t or "").encode().lower()]) for i, t in rows), key=str)


@pytest.mark.parametrize("keep", ["max", "min"])
@pytest.mark.parametrize("slice_rows", [200_000, 3])
def test_groups_like_brute_force(spark, keep, slice_rows):
    docs = documents(spark).repartition(7)
    found = exact_groups(docs, keep=keep, fan_in=2, slice_rows=slice_rows).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(((r.id, r.keep_id, r.group_size, r.digest) for r in found), key=str) == expected(rows, max if keep == "max" else min)
    assert sum(r.kept for r in found) == len({r.digest for r in found})


def test_only_ascii_letters_are_folded(spark):
    docs = spark.createDataFrame([(1, "É"), (2, "é"), (3, "A"), (4, "a")], "doc_id int, text string")
    assert {r.id: r.keep_id for r in exact_groups(docs).collect()} == {1: 1, 2: 2, 3: 4, 4: 4}


def test_kept_rows_have_the_columns_of_the_input(spark):
    docs = documents(spark)
    kept = drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.filter("doc_id < 13 or doc_id is null").collect()) == [0, 3, 4, 6, 8, 9, 10, 11, 12]


def test_empty_table(spark):
    assert exact_groups(empty(documents(spark))).count() == 0
    assert drop_exact_copies(empty(documents(spark))).count() == 0


def test_bad_rule(spark):
    with pytest.raises(ValueError):
        exact_groups(documents(spark), keep="first")
