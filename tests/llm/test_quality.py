import itertools
import zlib

import numpy as np
import pytest
from cases import LONG, documents, empty
from pyspark.sql import functions as F

from wayfare.llm.quality import FEATURES, OWN, QualityModel, _line_scores, chain_features, fit_quality_model, line_features, marginals, score_quality


def test_marginals_like_enumeration():
    draw = np.random.default_rng(0)
    lengths, links = np.array([3, 1, 5, 2]), draw.normal(size=(2, 2))
    scores = draw.normal(size=lengths.sum())
    good, pairs, log_sum = marginals(scores, lengths, links, True)
    expected, counts, total, at = [], np.zeros((2, 2)), 0.0, 0
    for size in lengths:
        own = scores[at : at + size]
        ways = list(itertools.product((0, 1), repeat=int(size)))
        weight = np.array([np.exp(sum(own[i] * y for i, y in enumerate(w)) + sum(links[a, b] for a, b in zip(w, w[1:]))) for w in ways])
        share = weight / weight.sum()
        expected += [sum(s for s, w in zip(share, ways) if w[i]) for i in range(size)]
        for s, w in zip(share, ways):
            for a, b in zip(w, w[1:]):
                counts[a, b] += s
        total += np.log(weight.sum())
        at += size
    assert np.allclose(good, expected) and np.allclose(pairs, counts) and log_sum == pytest.approx(total)


def test_line_features_skip_blank_lines():
    features, sizes = line_features("one two\n\n  \nTHREE!! three.\n")
    assert sizes.tolist() == [7, 14] and len(features) == 2
    assert len(line_features("")[0]) == len(line_features(" \n\t")[0]) == 0
    assert np.isfinite(chain_features(line_features(LONG + "\n" + LONG)[0])).all()


def test_line_scores_are_those_of_the_features():
    draw = np.random.default_rng(1)
    model = QualityModel(draw.normal(size=FEATURES), draw.random(FEATURES) + 0.5, draw.normal(size=FEATURES), np.zeros((2, 2)), 1.0, 0.0)
    for size in (1, 2, 7):
        own = draw.normal(size=(size, OWN)).astype(np.float32)
        assert np.allclose(_line_scores(own, model), ((chain_features(own) - model.mean) / model.scale) @ model.weights)


def corpus(spark):
    good = [(i, f"The house number {i} stands by the river.\nIt has a garden and a wall of stone.") for i in range(120)]
    bad = [(1000 + i, f"BUY!! NOW!! {i}$$$ ### ***\nwin win win win win $$$") for i in range(120)]
    docs = spark.createDataFrame(good + bad, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i < 1000), 0) for i, _ in good + bad] + [(None, 1, 0), (5, None, 0)], "doc_id bigint, quality int, toxic int")
    return docs, labels


def test_held_out_documents_are_told_apart(spark):
    docs, labels = corpus(spark)
    found = score_quality(docs, fit_quality_model(docs, labels)).collect()
    held = [r for r in found if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in found)
    assert all(r.predicted == int(r.id < 1000) == int(r.score >= 0.7) for r in held)


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    docs, labels = corpus(spark)
    changed = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 4 = 2 then 1 - quality else quality end as quality")
    one, two = fit_quality_model(docs, labels), fit_quality_model(docs, changed)
    assert (one.weights == two.weights).all() and (one.links == two.links).all()


def test_a_repeated_identifier_counts_once(spark):
    docs, labels = corpus(spark)
    hot = spark.range(2000).selectExpr("1L as doc_id", "concat('again and again ', id) as text")
    every = docs.union(hot)
    texts = every.filter("doc_id = 1").groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    one = fit_quality_model(docs.filter("doc_id <> 1").union(texts), labels)
    many = fit_quality_model(every.union(docs), labels.union(labels))
    assert (one.weights == many.weights).all() and one.slope == many.slope


def test_the_sample_has_its_bounds(spark):
    docs, labels = corpus(spark)
    few = fit_quality_model(docs, labels, rows=40, lines_per_row=1)
    found = score_quality(docs, few).collect()
    assert sum(r.predicted == int(r.id < 1000) for r in found) > 0.95 * len(found)


def test_awkward_documents(spark):
    docs, labels = corpus(spark)
    model = fit_quality_model(docs, labels)
    cases = documents(spark)
    found = score_quality(cases, model).collect()
    assert len(found) == cases.count() and all(0 <= r.score <= 1 for r in found)
    assert all(r.score == 0 and r.predicted == 0 for r in found if r.id in (1, 2, 3, 4))
    assert score_quality(empty(cases), model).count() == 0
    assert fit_quality_model(empty(docs), labels) is None
    assert {r.score for r in score_quality(docs, None).collect()} == {0.0}
