import math

import numpy as np
import pyarrow as pa
import pytest

from wayfare.llm import embedding_dedup
from wayfare.llm.embedding_dedup import CELL, MET, OCCUPANCY, calibrated_count, cell_chance, cell_tables, collision_chance, near_vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int, mark string, links string, component_id string"


def clusters(count, size, seed, spread=0.02):
    draw = np.random.default_rng(seed)
    rows = []
    for c in range(count):
        centre = draw.normal(size=size)
        centre /= np.linalg.norm(centre)
        for _ in range(6):
            rows.append(([float(x) for x in centre + draw.normal(0, spread, size)], c % 3))
    return [(i, v, label, None, None, None) for i, (v, label) in enumerate(rows)]


def brute(rows, threshold=0.98):
    def usable(v):
        return bool(v) and None not in v and all(map(math.isfinite, v)) and any(v)

    parent, links = {}, {}
    good = [(k, np.float32(r[1]).astype(float), r[2]) for k, r in enumerate(rows) if r[2] is not None and r[1] is not None and usable(r[1])]
    parent = {k: k for k in range(len(rows))}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x, la) in enumerate(good):
        for b, y, lb in good[:i]:
            if la == lb and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links[a] = links.get(a, 0) + 1
                links[b] = links.get(b, 0) + 1
                parent[find(a)] = find(b)
    least = {}
    for k, r in enumerate(rows):
        least[find(k)] = min((x for x in (least.get(find(k)), r[0]) if x is not None), default=None)
    return sorted(((r[0], links.get(k, 0), least[find(k)], r[0] is not None and r[0] == least[find(k)]) for k, r in enumerate(rows)), key=str)


def found(df, **options):
    return sorted(((r.id, r.n_links, r.component_id, r.kept) for r in near_vectors(df, **options).collect()), key=str)


@pytest.mark.parametrize("block_rows", [2048, 7])
def test_links_like_brute_force(spark, block_rows):
    rows = clusters(40, 24, 3)
    assert found(spark.createDataFrame(rows, SCHEMA), block_rows=block_rows) == brute(rows)
    assert any(r[1] for r in brute(rows))


def test_tables_are_calibrated():
    for size in (1, 50, 5000, 10**6, 10**9):
        own, tables = cell_tables(size, 0.98)
        near, far = cell_chance(CELL), cell_chance(CELL * math.sqrt(0.02))
        assert 1 - (1 - near**own) ** tables >= MET and size * far**own <= OCCUPANCY
    assert cell_tables(10**9, 0.98)[1] < 8 * cell_tables(5000, 0.98)[1]  # a label 200,000 times as large
    draw = np.random.default_rng(2)
    gaps, ends = draw.normal(size=200_000), draw.random(200_000)
    assert np.mean(np.floor(gaps / 3 + ends) == 0) == pytest.approx(cell_chance(3.0), abs=0.005)


def test_pairs_met_stay_in_proportion_to_the_rows(monkeypatch):
    """Unrelated vectors of one label: what a vector shares a cell with does not grow with the label."""
    met = []
    for size in (1000, 8000):
        draw = np.random.default_rng(size)
        data = [v.tobytes() for v in draw.normal(size=(size, 32))]
        batch = pa.RecordBatch.from_arrays([pa.array(["l"] * size), pa.array(range(size)), pa.array([1] * size), pa.array(data, pa.binary())], ["label", "rep", "copies", "vector"])
        tables = cell_tables(size, 0.98)
        (placed,) = embedding_dedup._project_step(16, tables, 0.2, 1)([batch])
        cells = placed.column("cells").flatten().to_numpy().reshape(size, tables[1])
        shared = [np.unique(cells[:, t], return_counts=True)[1] for t in range(tables[1])]
        met.append(sum((n * (n - 1) // 2).sum() for n in shared) / size / tables[1])
    assert met[0] < 0.5 and met[1] < 0.5


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (4, [1.0, 0.0], 2)]
    vectors += [(5, [1.0, 0.0], None), (6, None, 1), (7, [], 1), (8, [0.0, 0.0], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 1)]
    vectors += [(11, [None, 1.0], 1), (12, [1.0, 0.0, 0.0], 1), (None, None, None), (13, [-1.0, 0.0], 1), (14, [-1.0, -0.0], 1)]
    rows = [(*v, None, None, None) for v in vectors]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_one_large_group(spark):
    rows = clusters(1, 16, 9, 0.001)
    rows = [(i, *rows[i % 6][1:]) for i in range(300)]
    result = found(spark.createDataFrame(rows, SCHEMA), block_rows=2)
    assert all(r[1] == 299 and r[2] == 0 for r in result) and len(result) == 300


def test_count_is_calibrated():
    count, p = calibrated_count(), collision_chance()
    reach = lambda c: sum(math.comb(16, k) * p**k * (1 - p) ** (16 - k) for k in range(c, 17))
    assert reach(count) >= 0.9999 > reach(count + 1)


def test_empty_table_and_bad_threshold(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert near_vectors(df).count() == 0
    with pytest.raises(ValueError):
        near_vectors(df, threshold=1.5)
