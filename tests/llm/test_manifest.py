import hashlib
import zlib
from collections import defaultdict

import pytest
from cases import documents, empty
from pyspark.sql import functions as F

from wayfare.llm.manifest import COLUMNS, folded, merkle_manifest, proof_digest, row_digest


def digest(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf_of(row):
    texts = [None if row[c] is None else str(row[c]) for c in COLUMNS]
    return digest(*["-" if t is None else f"{len(t.encode())}:{t}" for t in texts])


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def siblings(levels, place):
    """By level: those on the left and on the right."""
    out = []
    for nodes in levels[:-1]:
        run = place // 8 * 8
        out.append(("".join(nodes[run:place]), "".join(nodes[place + 1 : run + 8])))
        place //= 8
    return out


def plain(rows):
    """(id, leaf, subroot, root, path) of every row."""
    groups = defaultdict(list)
    for row in rows:
        groups[row["lang"]].append((row["doc_id"] is not None, row["doc_id"] or 0, leaf_of(row)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {name: levels_of([leaf for *_, leaf in sorted(groups[name])]) for name in names}
    upper = levels_of([trees[name][-1][0] for name in names])
    out = []
    for number, name in enumerate(names):
        for place, (known, doc_id, leaf) in enumerate(sorted(groups[name])):
            path = siblings(trees[name], place) + siblings(upper, number)
            out.append((doc_id if known else None, leaf, trees[name][-1][0], upper[-1][0], path))
    return sorted(out, key=str)


def found_rows(docs):
    return sorted(((r.id, r.leaf, r.subroot, r.root, [tuple(s) for s in r.path]) for r in merkle_manifest(docs).collect()), key=str)


def test_like_brute_force_on_awkward_rows(spark):
    docs = documents(spark).repartition(6)
    assert found_rows(docs) == plain([r.asDict() for r in docs.collect()])


@pytest.mark.parametrize("count", [1, 7, 8, 9, 64, 65, 520])
def test_runs_of_all_sizes(spark, count):
    docs = spark.range(count).selectExpr("id as doc_id", "'t' as text", "'s' as source", "'l' as lang", "cast(id as int) as n_chars")
    assert found_rows(docs) == plain([r.asDict() for r in docs.collect()])


def test_many_groups(spark):
    docs = spark.range(300).selectExpr("id as doc_id", "'t' as text", "'s' as source", "concat('é', id % 70) as lang", "1L as n_chars")
    assert found_rows(docs) == plain([r.asDict() for r in docs.collect()])


def test_altered_rows_do_not_lead_to_the_root(spark):
    docs = documents(spark)
    altered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lower("text")).otherwise(F.col("text"))
    claimed = row_digest([altered if c == "text" else F.col(c) for c in COLUMNS])
    rows = merkle_manifest(docs, carry={"claimed": claimed})
    rows = rows.select("*", folded(F.col("claimed"), F.col("path")).alias("end"), proof_digest(F.col("path")).alias("proof")).collect()
    changed = {
        r.doc_id for r in docs.collect()
        if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and r.text is not None and r.text != r.text.lower()
    }
    assert {r.id for r in rows if r.end != r.root} == changed and changed
    for r in rows:
        end = r.claimed
        for left, right in r.path:
            end = digest(left, end, right)
        assert r.end == end and r.proof == digest(*[left + right for left, right in r.path])


def test_empty_table(spark):
    assert merkle_manifest(empty(documents(spark))).count() == 0
    with pytest.raises(ValueError):
        merkle_manifest(documents(spark), carry={"path": F.lit(1)})
