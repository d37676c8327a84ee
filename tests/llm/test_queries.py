"""Every numbered query, as registered, on small Parquet tables with awkward rows and clashing column names, all columns."""

import base64
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import documents
from test_embedding_dedup import brute
from test_manifest import digest, leaf_of
from test_manifest import plain as plain_manifest
from test_simhash import components, plain_fingerprint
from test_substring_dedup import plain as plain_passages
from test_token_count import library as unigram_library
from test_whitening import plain as plain_whitening
from tokenizers import Tokenizer

from wayfare.llm import language_id, quality
from wayfare.llm.queries import QUERIES
from wayfare.llm.token_count import read_vocabulary

PAGES = [
    (1, "http://a/1", "same" * 9000), (2, "http://a/2", "same" * 9000), (3, None, None), (4, "http://a/4\nx", ""), (5, "u", "é\r\n\r\n" * 9000), (6, "v", "x"),
]
NAN = float("nan")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The folder of the tables, and their rows."""
    folder = str(tmp_path_factory.mktemp("tables"))
    documents(spark).write.parquet(f"{folder}/documents.parquet")
    known = [(i, int(i < 200), 0, "x", 1) for i in range(100, 240)]
    spark.createDataFrame(known, "doc_id bigint, quality int, toxic int, text string, place int").write.parquet(f"{folder}/labels.parquet")
    pages = [(*p, "k", "b", 1, "c") for p in PAGES]
    schema = "page_id bigint, url string, html string, key string, best_id string, rows int, problem string"
    spark.createDataFrame(pages, schema).write.parquet(f"{folder}/pages.parquet")
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(12, 10))
    vectors = [(i, (centres[i % 12] + draw.normal(0, 0.03, 10)).tolist(), i % 2) for i in range(90)]
    vectors += [(90, vectors[0][1], 0), (91, None, 1), (92, [NAN] * 10, 1), (93, [], 0), (94, vectors[1][1], None)]
    vectors = [(*v, "m", 1, "w") for v in vectors]
    spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>, label int, x string, n int, whitened string").write.parquet(f"{folder}/embeddings.parquet")
    docs = [r.asDict() for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    return folder, docs, vectors


def run(spark, tables, name, columns):
    result = QUERIES[name](spark, tables[0])
    assert sorted(result.columns) == sorted(columns.split()), result.columns
    return [tuple(r) for r in result.select(*columns.split()).collect()]


def words_of(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def same(found, expected):
    assert sorted(found, key=str) == sorted(expected, key=str)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_op1(spark, tables):
    rows = run(spark, tables, "op1_mixing", "doc_id size source_size target taken source")
    sizes = sorted(((d["doc_id"], len(words_of(d["text"])), d["source"]) for d in tables[1]), key=str)
    assert sorted(((r[0], r[1], r[5]) for r in rows), key=str) == sizes
    totals = {}
    for _, size, source in sizes:
        totals[source] = totals.get(source, 0) + size
    weights = dict(zip(sorted(totals, key=lambda s: (s is None, s or "")), [3.0, 1.0, 2.0] * len(totals)))
    target, open_, rest = {}, set(totals), 1.5 * sum(totals.values())
    while open_:  # share by weight, close what is full, share the rest anew
        level = rest / sum(weights[s] for s in open_)
        full = {s for s in open_ if level * weights[s] >= 2 * totals[s]}
        for s in full or open_:
            target[s] = 2.0 * totals[s] if full else level * weights[s]
            rest -= target[s]
        open_ -= full or open_
    taken = {}
    for _, size, source_size, aim, took, source in rows:
        assert source_size == totals[source] and aim == pytest.approx(target[source]) and 0 <= took <= 2 * size
        taken[source] = taken.get(source, 0) + took
    assert all(abs(taken[s] - target[s]) <= 1 for s in totals)


def test_op2(spark, tables):
    rows = run(spark, tables, "op2_warc", "page_id payload_bytes payload_digest record_type refers_to problem")
    best = {1: 2, 3: 4}
    expected = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        kind = "revisit" if page in best else "response"
        expected.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), kind, best.get(page), None))
    same(rows, expected)


def test_op3(spark, tables):
    groups = {}
    for d in tables[1]:
        groups.setdefault((d["text"] or "").encode().lower(), []).append(d["doc_id"])
    rows = run(spark, tables, "op3_exact_dedup", "doc_id keep_id group_size text_sha256 kept")
    expected = []
    for d in tables[1]:
        key = (d["text"] or "").encode().lower()
        known = [i for i in groups[key] if i is not None]
        expected.append((d["doc_id"], max(known, default=None), len(groups[key]), sha(key)))
    same([r[:4] for r in rows], expected)
    assert sum(r[4] for r in rows) == len(groups) and all(r[0] == r[1] for r in rows if r[4])


def test_op4(spark, tables):
    tokenizer = unigram_library(*read_vocabulary(str(public_tokenizers.path("piece_bpe_32k.model"))))
    rows = run(spark, tables, "op4_token_counts", "doc_id n_tokens n_words")
    same([r[:2] for r in rows], [(d["doc_id"], len(tokenizer.encode(d["text"] or "", add_special_tokens=False).ids)) for d in tables[1]])


def test_op5(spark, tables):
    same(run(spark, tables, "op5_embedding_dedup", "vec_id n_links component_id kept"), brute(tables[2]))


def test_op6(spark, tables):
    """Scores anew, line by line, from the model that the same rows give."""
    docs, labels = (spark.read.parquet(f"{tables[0]}/{n}.parquet") for n in ("documents", "labels"))
    model = quality.fit_quality_model(docs, labels)
    rows = run(spark, tables, "op6_quality", "doc_id held_out predicted score")
    expected = []
    for d in tables[1]:
        own, sizes = quality.line_features(d["text"] or "")
        score = 0.0
        if len(own):
            given = ((quality.chain_features(own) - model.mean) / model.scale) @ model.weights
            good, _, _ = quality.marginals(given, np.array([len(own)]), model.links)
            share = min(max(float((good * sizes).sum() / sizes.sum()), 1e-9), 1 - 1e-9)
            score = 1 / (1 + math.exp(-(model.slope * math.log(share / (1 - share)) + model.shift)))
        held = d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 4 == 2
        expected.append((d["doc_id"], held, int(score >= 0.7), score))
    for one, two in zip(sorted(rows, key=str), sorted(expected, key=str)):
        assert one[:3] == two[:3] and one[3] == pytest.approx(two[3], abs=1e-4)


def test_op7(spark, tables):
    prints = [plain_fingerprint(d["text"]) for d in tables[1]]
    roots, least = components(prints, 4), {}
    for d, root in zip(tables[1], roots):
        least[root] = min((i for i in (least.get(root), d["doc_id"]) if i is not None), default=None)
    expected = [(d["doc_id"], f"{p:016x}", least[root]) for d, p, root in zip(tables[1], prints, roots)]
    same(run(spark, tables, "op7_simhash", "doc_id fingerprint component_id"), expected)


def test_op8(spark, tables):
    rows = run(spark, tables, "op8_sharding", "doc_id size text_crc32 law shard slot grown_shard")
    texts = [(d["doc_id"], d["text"] or "") for d in tables[1]]
    same([r[:3] for r in rows], [(i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in texts])
    assert {(r[3], r[6]) for r in rows} == {("rows", None)}
    slots = {shard: sorted(r[5] for r in rows if r[4] == shard) for shard in range(16)}
    assert all(found == list(range(len(found))) for found in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1 and sum(map(len, slots.values())) == len(texts)


def test_op9(spark, tables):
    """Predicts anew, n-gram by n-gram, from the model that the same rows give."""
    model = language_id.fit_language_model(spark.read.parquet(f"{tables[0]}/documents.parquet"))
    rows = run(spark, tables, "op9_language_id", "doc_id held_out lang_pred accepted score")
    expected = []
    for d in tables[1]:
        buckets = np.concatenate([b for b in language_id._features(language_id._codes(d["text"] or ""))])
        label, score = "und", 0.0
        if len(buckets):
            logits = (model.scores[buckets].astype(float).mean(0) + model.bias) / model.temperature
            chances = np.exp(logits - logits.max()) / np.exp(logits - logits.max()).sum()
            label, score = model.languages[int(chances.argmax())], float(chances.max())
        held = d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 4 == 2
        expected.append((d["doc_id"], held, label, score))
    found = sorted(((r[0], r[1], r[2], r[4]) for r in rows), key=str)
    for one, two in zip(found, sorted(expected, key=str)):
        assert one[:3] == two[:3] and one[3] == pytest.approx(two[3], abs=1e-4)
    assert not any(r[3] for r in rows if r[2] == "und")


def test_op10(spark, tables):
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    expected = []
    for d in tables[1]:
        ids = tokenizer.encode(d["text"] or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        expected.append((d["doc_id"], len(ids), sha(np.array(ids, "<u4").tobytes()), sha(decoded.encode())))
    same(run(spark, tables, "op10_bpe", "doc_id n_tokens ids_sha256 decoded_sha256"), expected)


def test_op11(spark, tables):
    marks = {r.text: r.mark for r in spark.read.parquet(f"{tables[0]}/documents.parquet").selectExpr("text", "xxhash64(text) as mark").collect()}
    plain = plain_passages([(d["doc_id"], marks[d["text"]], d["text"] or "") for d in tables[1]], 20)
    expected = [(i, n, gone, sha(kept.encode())) for i, n, gone, kept in plain]
    same(run(spark, tables, "op11_substring_dedup", "doc_id n_words n_removed kept_sha256"), expected)


def test_op12(spark, tables):
    rows = run(spark, tables, "op12_embedding_whitening", "vec_id component n deviation whitened explained identity_error")
    usable = [v[:2] for v in tables[2] if v[1] and all(map(math.isfinite, v[1]))]
    n, deviations, values, projected, trace = plain_whitening(usable)
    whitened = projected / np.sqrt(values)
    whitened *= np.sign(whitened[0])  # either sign, the same for all rows
    found = {(r[0], r[1]): r for r in rows}
    assert len(found) == len(rows) == 8 * len(usable)
    signs = [math.copysign(1, found[usable[0][0], c + 1][4]) for c in range(8)]
    for place, (i, _) in enumerate(usable):
        for c in range(8):
            _, _, count, deviation, value, explained, error = found[i, c + 1]
            assert (count, deviation) == (n, deviations[place]) and error < 1e-9
            assert value * signs[c] == pytest.approx(whitened[place, c], abs=1e-8) and explained == pytest.approx(values[c] / trace)


def test_op13(spark, tables):
    rows = run(spark, tables, "op13_merkle_manifest", "doc_id leaf subroot root proof_sha256 folded_root verified")
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    claims = {}
    for d in tables[1]:
        changed = d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 3 == 0 and d["text"] is not None
        claims[leaf_of(d)] = leaf_of(d | {"text": d["text"].translate(upper)}) if changed else leaf_of(d)
    expected = []
    for i, leaf, subroot, root, path in plain_manifest(tables[1]):
        end = claims[leaf]
        for left, right in path:
            end = digest(left, end, right)
        expected.append((i, leaf, subroot, root, digest(*[a + b for a, b in path]), end, end == root))
    same(rows, expected)
