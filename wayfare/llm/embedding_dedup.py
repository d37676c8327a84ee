"""Embedding near-duplicates by collision-counting projections.

Vectors of unit length are projected on many random directions. Two vectors collide on a direction when their
projections lie within a window around each other; close vectors collide on nearly all directions, others on few. The
collisions of a pair over all counted directions are added up, and pairs that reach the calibrated count are verified by
cosine.

The pairs to count come from several tables of cells. A table cuts its own directions into strips, and vectors in the same
strip of every one of them share a cell. A table has as many directions as make cells of unrelated vectors nearly empty
(by the size of the largest label), and there are as many tables as give pairs at the threshold the wanted recall. So a
vector meets a fixed few unrelated ones, however large its label, besides those that are close to it; the number of
tables grows with about the eighth root of the label's size. Cells of one vector are dropped before any vector is
shuffled, and crowded cells are dealt out in pairs of blocks. A pair that shares cells of several tables is counted in
the first. A task returns link counts and a forest of links, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import connected_components, forest, save

DIRECTIONS = 16
WINDOW = 2.5  # in standard deviations of the projected difference of two vectors at the threshold
CELL = 8.0  # width of a cell, in the same measure
RECALL = 0.9999  # share of pairs at the threshold that the count lets pass
MET = 0.99999  # share of pairs at the threshold that share a cell of some table
OCCUPANCY = 0.25  # unrelated vectors that a vector meets in a table
MOST_TABLES = 256
BLOCK_ROWS = 2048
_PAIRS = 1 << 19
_FIRST = 2  # tables whose pairs are left out before collisions are counted
_MIX = np.uint64(0x9E3779B97F4A7C15)


def collision_chance(window: float = WINDOW) -> float:
    """Chance that two vectors exactly at the threshold collide on a direction."""
    return math.erf(window / math.sqrt(2))


def calibrated_count(directions: int = DIRECTIONS, window: float = WINDOW, recall: float = RECALL) -> int:
    """The largest number of collisions that pairs at the threshold reach with the given chance."""
    p, above = collision_chance(window), 0.0
    for count in range(directions, -1, -1):
        above += math.comb(directions, count) * p**count * (1 - p) ** (directions - count)
        if above >= recall:
            return count
    return 0


def cell_chance(width: float) -> float:
    """Chance that two points share a strip, in standard deviations of their difference, the strips' ends being random."""
    return math.erf(width / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * width) * (1 - math.exp(-width * width / 2))


def cell_tables(size: int, threshold: float, met: float = MET) -> tuple[int, int]:
    """Directions of a table, and the number of tables, for labels of up to ``size`` vectors."""
    near, far = cell_chance(CELL), cell_chance(CELL * math.sqrt(1 - threshold))
    directions = max(1, math.ceil(math.log(max(size, 1) / OCCUPANCY) / -math.log(far)))
    while True:
        tables = math.ceil(math.log(1 - met) / math.log(1 - near**directions))
        if tables <= MOST_TABLES or directions == 1:
            return directions, tables
        directions -= 1


def _project_step(directions: int, tables: tuple[int, int], gap: float, seed: int):
    own, count = tables

    def rays(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        draw = np.random.default_rng([seed, size])
        return draw.normal(size=(size, directions)), draw.normal(size=(size, own * count)), draw.random(own * count)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple] = {}
        for batch in batches:
            vectors = [np.frombuffer(data, "<f8") for data in batch.column("vector").to_pylist()]
            sizes = np.array([len(v) for v in vectors], np.int32)
            units, places, cells = [b""] * len(vectors), [b""] * len(vectors), np.zeros((len(vectors), count), np.int64)
            for size in np.unique(sizes).tolist():
                if size not in known:
                    known[size] = rays(size)
                counted, cut, offset = known[size]
                mine = np.flatnonzero(sizes == size)
                unit = np.stack([vectors[i] for i in mine])
                unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
                place = unit @ counted
                strips = np.floor(unit @ cut / (CELL * gap) + offset).astype(np.int64).view(np.uint64).reshape(len(mine), count, own)
                cell = np.broadcast_to(np.arange(count, dtype=np.uint64), (len(mine), count)).copy()
                for i in range(own):
                    cell = (cell + strips[:, :, i]) * _MIX
                    cell ^= cell >> np.uint64(29)
                cells[mine] = cell.view(np.int64)
                for k, i in enumerate(mine.tolist()):
                    units[i], places[i] = unit[k].tobytes(), place[k].tobytes()
            shared = pa.ListArray.from_arrays(pa.array(np.arange(len(vectors) + 1) * count, pa.int32()), pa.array(cells.ravel()))
            made = [pa.array(sizes), pa.array(units, pa.binary()), pa.array(places, pa.binary()), shared]
            kept = [batch.column(c) for c in ("label", "rep", "copies")]
            yield pa.RecordBatch.from_arrays(kept + made, ["label", "rep", "copies", "size", "unit", "places", "cells"])

    return step


def _vector_step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes of doubles; NULL where they cannot be compared."""
    for batch in batches:
        found = []
        for values in batch.column("embedding").to_pylist():
            usable = bool(values) and None not in values
            vector = np.array(values, "<f8") if usable else None
            with np.errstate(over="ignore", invalid="ignore"):
                usable = usable and bool(np.isfinite(vector).all()) and 0 < float(np.linalg.norm(vector)) < math.inf
            # adding zero makes -0.0 and 0.0 one
            found.append((vector + 0.0).tobytes() if usable else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("mark"), batch.column("label"), pa.array(found, pa.binary())], ["id", "mark", "label", "vector"]
        )


def _partners(task: np.ndarray, role: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the range of rows that it is to be compared with, for rows sorted by task and role.

    Where a task is a block with itself (``same``), its rows meet each other; else those of role 0 meet those of role 1.
    """
    starts = np.flatnonzero(np.append(True, task[1:] != task[:-1]))
    sizes = np.diff(np.append(starts, len(task)))
    end = np.repeat(starts + sizes, sizes)
    others = np.add.reduceat(role.astype(np.int64), starts)
    low = np.where(same, np.arange(len(task)) + 1, end - np.repeat(others, sizes))
    return low, np.where(~same & (role == 1), low, end)


def _close_pairs(rows: dict[str, np.ndarray], threshold: float, width: float, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of row numbers that are linked, each met in the first table that has both."""
    low, high = _partners(rows["task"], rows["role"], rows["same"])
    counts = np.maximum(high - low, 0)
    ends = np.cumsum(counts)
    cells, place, unit, table = rows["cells"], rows["places"], rows["unit"], rows["table"]
    at = 0
    while at < len(counts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PAIRS, "right")))
        some = counts[at:to]
        a = np.repeat(np.arange(at, to), some)
        b = low[a] + np.arange(len(a)) - np.repeat(np.cumsum(some) - some, some)
        at = to
        fresh_ = rows["kind"][a] == rows["kind"][b]
        for earlier in range(min(_FIRST, cells.shape[1])):
            fresh_ &= (table[a] <= earlier) | (cells[a, earlier] != cells[b, earlier])
        a, b = a[fresh_], b[fresh_]
        hits = np.zeros(len(a), np.int16)
        for k in range(place.shape[1]):
            hits += np.abs(place[a, k] - place[b, k]) <= width
            left = place.shape[1] - 1 - k
            if k % 4 == 3:  # out are those that can't reach the count any more
                able = hits + left >= least
                a, b, hits = a[able], b[able], hits[able]
        for earlier in range(_FIRST, int(table[a].max(initial=0))):
            new = (table[a] <= earlier) | (cells[a, earlier] != cells[b, earlier])
            a, b = a[new], b[new]
        for part in range(0, len(a), 1 << 16):
            i, j = a[part : part + (1 << 16)], b[part : part + (1 << 16)]
            near = np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold
            yield i[near], j[near]


def _linked(rows: dict[str, np.ndarray], threshold: float, width: float, least: int) -> Iterator[pa.RecordBatch]:
    """``a, b, links``: nodes, the root of each in the forest of these rows' links, and the vectors it is linked with."""
    rep, copies = rows["rep"], rows["copies"]
    for i, j in _close_pairs(rows, threshold, width, least):
        if len(i):
            nodes, index = np.unique(np.concatenate((rep[i], rep[j])), return_inverse=True)
            links = np.bincount(index, np.concatenate((copies[j], copies[i])), len(nodes)).astype(np.int64)
            root = nodes[forest(index[: len(i)], index[len(i) :], len(nodes))]
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(root), pa.array(links)], ["a", "b", "links"])


def _compare_step(threshold: float, width: float, least: int):
    """For rows sorted by vector size, task and role. A task has two blocks of rows at most, so what is held has a bound."""
    plain = ("task", "role", "same", "table", "kind", "rep", "copies")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        size = None

        def read(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
            rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in plain}
            for c in ("unit", "places"):
                rows[c] = np.frombuffer(b"".join(batch.column(c).to_pylist()), "<f8").reshape(batch.num_rows, -1)
            rows["cells"] = batch.column("cells").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            return rows

        for whole in batches:
            sizes = whole.column("size").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(sizes)]
            for start, end in zip(cuts, cuts[1:]):
                if start == end:
                    continue
                rows = read(whole.slice(start, end - start))
                if size not in (None, sizes[start]):
                    yield from _linked(held, threshold, width, least)
                    held = {}
                size = sizes[start]
                rows = {c: np.concatenate((held[c], v)) for c, v in rows.items()} if held else rows
                open_ = rows["task"] == rows["task"][-1]  # its last rows may be still to come
                yield from _linked({c: v[~open_] for c, v in rows.items()}, threshold, width, least)
                held = {c: v[open_] for c, v in rows.items()}
        if held:
            yield from _linked(held, threshold, width, least)

    return step


def near_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    threshold: float = 0.98,
    directions: int = DIRECTIONS,
    window: float = WINDOW,
    recall: float = RECALL,
    met: float = MET,
    block_rows: int = BLOCK_ROWS,
    seed: int = 1,
) -> DataFrame:
    """One row per vector: ``id, n_links, component_id, kept``.

    Vectors of one label and length are linked when found with a cosine of at least ``threshold`` in double precision;
    none below it is. ``n_links`` counts the other vectors linked directly, copies of itself and of them included;
    ``component_id`` is the smallest identifier that links reach. Vectors without a label, and those that are NULL, empty,
    zero or hold NULL, infinite or NaN components, link with nothing. Equal vectors of a label are one point of the
    search. ``kept`` marks rows whose identifier is that of their component: rows that repeat it are kept alike; a NULL
    identifier counts as the largest and is never kept. Other columns are not read; an empty table gives no rows.
    """
    if not 0 < threshold < 1:
        raise ValueError("the threshold must lie between 0 and 1")
    gap = math.sqrt(2 - 2 * threshold)
    rows = vectors.select(
        F.col(id_column).cast("bigint").alias("id"), F.monotonically_increasing_id().alias("mark"),
        F.col(label_column).cast("string").alias("label"), F.col(vector_column).cast("array<double>").alias("embedding"),
    )
    rows = save(rows.mapInArrow(_vector_step, "id bigint, mark bigint, label string, vector binary"), "vectors")
    usable = rows.filter("label is not null and vector is not null")
    points = usable.groupBy("label", "vector").agg(F.min("mark").alias("rep"), F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"))
    points = save(points, "points")
    largest = points.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    tables = cell_tables(largest, threshold, met)
    schema = "label string, rep bigint, copies bigint, size int, unit binary, places binary, cells array<bigint>"
    placed = points.select("label", "rep", "copies", "vector").mapInArrow(_project_step(directions, tables, gap, seed), schema)
    placed = save(placed, "projections")

    cell = ["label", "size", "table", "cell"]
    homes = placed.select("label", "size", "rep", F.posexplode("cells").alias("table", "cell"))
    blocks = F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks")
    crowds = save(homes.groupBy(*cell).agg(blocks, F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "crowds")
    # a vector is in as many crowds as there are tables at most
    crowded = homes.join(crowds, cell).groupBy("rep").agg(F.collect_list(F.struct("table", "cell", "blocks")).alias("crowds"))
    crowded = save(crowded, "crowded")
    dealt = placed.join(crowded, "rep").select(
        "label", "size", "rep", "copies", "unit", "places", "cells", F.inline("crowds").alias("table", "cell", "blocks")
    )
    # a task is a cell, or a pair of blocks of one, the first not after the second
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(F.least(k, F.col("block")).alias("i"), F.greatest(k, F.col("block")).alias("j"), (k < F.col("block")).cast("int").alias("role")),
    )
    tasks = dealt.withColumn("block", block).select("*", F.inline(pairs))
    tasks = tasks.withColumn("task", F.xxhash64(*cell, "i", "j")).withColumn("kind", F.xxhash64("label", "size"))
    tasks = tasks.withColumn("same", F.col("i") == F.col("j")).select("task", "role", "same", "table", "kind", "rep", "copies", "size", "unit", "places", "cells")
    sorted_ = tasks.repartition("task").sortWithinPartitions("size", "task", "role")
    compare = _compare_step(threshold, window * gap, calibrated_count(directions, window, recall))
    found = sorted_.mapInArrow(compare, "a bigint, b bigint, links bigint")
    found = save(found, "links")

    totals = found.groupBy("a").agg(F.sum("links").alias("links"))
    groups = connected_components(found.select("a", "b"), "a", "b")
    named = points.join(totals, points.rep == totals.a, "left").join(groups, points.rep == groups.node, "left")
    named = named.select("label", "vector", "copies", "least", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "rep").alias("group"))
    named = save(named, "named")
    smallest = save(named.groupBy("group").agg(F.min("least").alias("component_id")), "smallest")
    answer = named.join(smallest, "group").select("label", "vector", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = usable.join(answer, ["label", "vector"]).select("id", "n_links", "component_id")
    alone = rows.filter("label is null or vector is null").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))
