import random
import re

import numpy as np
import pytest
import xxhash
from cases import LONG, documents, empty

from wayfare.llm import simhash
from wayfare.llm.common import connected_components
from wayfare.llm.simhash import anchors, close_links, drop_near_copies, fingerprints, near_groups


def plain_fingerprint(text, width=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, threshold):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= threshold:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(values))]


def near_values(count, seed):
    """Unsigned fingerprints in clusters, many of them within a few bits of each other."""
    draw = random.Random(seed)
    out = []
    for _ in range(count // 8):
        centre = draw.getrandbits(64)
        for _ in range(8):
            out.append(centre ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 5))))
    return sorted(set(out))


def test_fingerprints_like_brute_force():
    texts = [None, "", " \t", "one", "A b", "a b c d", "Word " * 50, "the quick brown fox jumps over the lazy dog", "é　è a\x0bb c d e f", LONG]
    found = fingerprints([(t or "").encode() for t in texts])
    assert [int(f) for f in found] == [plain_fingerprint(t) for t in texts]


def test_long_texts_are_hashed_in_stretches(monkeypatch):
    text = " ".join(f"w{i}" for i in range(3000)).encode()
    whole = fingerprints([text])
    blocks = simhash._word_blocks
    monkeypatch.setattr(simhash, "_word_blocks", lambda data: blocks(data, 50))
    assert fingerprints([text]) == whole


def test_every_close_pair_meets_at_a_home():
    values = np.array(near_values(400, 5), "<u8")
    row, key, home = anchors(values)
    homes, visits = {}, {}
    for r, k, h in zip(row.tolist(), key.tolist(), home.tolist()):
        visits.setdefault(k, set()).add(r)
        if h:
            homes.setdefault(k, set()).add(r)
    met = {(a, b) for k, mine in homes.items() for a in mine for b in visits[k]}
    for i in range(len(values)):
        for j in range(len(values)):
            if int(values[i] ^ values[j]).bit_count() <= 4:
                assert (i, j) in met


@pytest.mark.parametrize("hot", [4096, 3])
def test_links_connect_like_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT_RESIDENTS", hot)
    values = near_values(600, 7)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = close_links(spark.createDataFrame([(v,) for v in signed], "fp bigint"))
    found = {r.node: r.component for r in connected_components(links, "a", "b").collect()}
    roots = components(values, 4)
    mine = [found.get(s, s) for s in signed]
    assert len(set(zip(mine, roots))) == len(set(roots)) == len(set(mine))


def test_groups_like_brute_force(spark):
    docs = documents(spark)
    rows = docs.select("doc_id", "text").collect()
    roots = components([plain_fingerprint(r.text) for r in rows], 4)
    least = {}
    for row, root in zip(rows, roots):
        least[root] = min((x for x in (least.get(root), row.doc_id) if x is not None), default=None)
    found = near_groups(docs).collect()
    expected = [(r.doc_id, f"{plain_fingerprint(r.text):x}", least[root]) for r, root in zip(rows, roots)]
    assert sorted(((r.id, f"{r.fp % (1 << 64):x}", r.component_id) for r in found), key=str) == sorted(expected, key=str)
    assert sum(r.kept for r in found) == len(set(roots))
    assert drop_near_copies(docs).count() == len(set(roots))
    assert drop_near_copies(docs).columns == docs.columns


def test_empty_table(spark):
    assert near_groups(empty(documents(spark))).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100)] + [(1000, 1001 + i) for i in range(300)] + [(5000, 5000), (None, 7)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()}
    assert found == {i: 0 for i in range(101)} | {i: 1000 for i in range(1000, 1301)}
