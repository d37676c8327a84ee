"""Embedding whitening by a covariance weighted with multiplicities.

Vectors are scaled to whole numbers and equal ones are counted, so the fit and the projection see each distinct vector
once, with its count as weight. Tasks sum exactly, then multiply centred blocks; the matrices, one for each task, are
added in rounds. The whitened distinct vectors are joined back to the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import save, small_batches

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
MATRICES_AT_ONCE = 16
RESULT = (
    "id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _sum_step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, sums = 0, 0
    for batch in batches:
        if batch.num_rows:
            weight = batch.column("weight").to_numpy(zero_copy_only=False)
            rows, sums = rows + int(weight.sum()), sums + weight @ _matrix(batch)
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([rows]), pa.array([sums.tolist()], pa.list_(pa.int64()))], ["rows", "sums"])


def _covariance_step(mean: np.ndarray):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for batch in batches:
            if batch.num_rows:
                centred = _matrix(batch) - mean
                weight = batch.column("weight").to_numpy(zero_copy_only=False)
                product = (centred * weight[:, None]).T @ centred
                total = product if total is None else total + product
        if total is not None:
            place = pa.array([TaskContext.get().partitionId()], pa.int32())
            yield pa.RecordBatch.from_arrays([place, pa.array([total.tobytes()], pa.binary())], ["place", "matrix"])

    return step


def _add_matrices(table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: r["place"])
    total = np.sum([np.frombuffer(r["matrix"]) for r in rows], axis=0)
    place = rows[0]["place"] // MATRICES_AT_ONCE
    return pa.table([pa.array([place], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["place", "matrix"])


def _covariance(distinct: DataFrame, n: int, mean: np.ndarray) -> np.ndarray:
    """The centred covariance with divisor ``n``. Only the sum of all tasks' matrices reaches the driver."""
    schema = "place int, matrix binary"
    tasks = distinct.rdd.getNumPartitions()
    matrices = save(distinct.mapInArrow(_covariance_step(mean), schema), "matrices")
    while tasks > 1:
        matrices = matrices.groupBy(F.expr(f"place div {MATRICES_AT_ONCE}")).applyInArrow(_add_matrices, schema)
        tasks = -(-tasks // MATRICES_AT_ONCE)
    return np.frombuffer(matrices.first().matrix).reshape(len(mean), len(mean)) / n


def exact_squares(rows: np.ndarray) -> list[int | None]:
    """The sum of squares of each row of whole numbers; None where it does not fit in 64 bits."""
    top = np.abs(rows.astype(np.float64)).max(axis=1, initial=0)
    safe = top * top * max(rows.shape[1], 1) < 2.0**62
    found = np.where(safe, np.square(np.where(safe[:, None], rows, 0)).sum(axis=1), 0).tolist()
    for i in np.flatnonzero(~safe).tolist():
        total = sum(v * v for v in rows[i].tolist())
        found[i] = total if total < 1 << 63 else None
    return found


def _project_step(n: int, sums: list[int], mean: np.ndarray, directions: np.ndarray, scales: np.ndarray):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                usable = scales > 0  # a component without variance has no whitened values
                cells = (x - mean) @ directions / np.where(usable, scales, 1)
                values = [[v if ok else None for v, ok in zip(row, usable)] for row in cells.tolist()]
                deviation = pa.array(exact_squares(n * x - np.array(sums, np.int64)), pa.int64())
                columns = [batch.column("x"), batch.column("weight"), deviation, pa.array(values, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, ["x", "weight", "deviation", "z"])

    return step


def _identity_error(white: DataFrame, n: int, components: list[int]) -> float:
    """The largest absolute entry of the whitened values' covariance minus the identity."""
    if not components:
        return 0.0
    z = {i: F.col("z")[i] for i in components}
    means = white.agg(*[(F.sum(F.col("weight") * z[i]) / n).alias(f"m{i}") for i in components]).first()
    centred = {i: z[i] - F.lit(means[f"m{i}"]) for i in components}
    pairs = [(i, j) for i in components for j in components if i <= j]
    found = white.agg(*[(F.sum(F.col("weight") * centred[i] * centred[j]) / n).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per usable vector and component: ``id, component, n, deviation, whitened, explained, identity_error``.

    Rows whose vector is NULL, empty, or has a NULL or non-finite entry are left out; the others are the fit list. An entry
    c becomes x = floor(1024 c) + 100000; n, the sums S and ``deviation``, the sum of (n x - S)^2, are exact, the last NULL
    where it passes 64 bits. Components are numbered from 1 by falling variance, as many as there are dimensions at most;
    one without variance (fewer different vectors than dimensions, say) has ``whitened`` NULL and no part in
    ``identity_error``. Repeated rows count as often as they are there, and rows with the same or no identifier each
    have their own result. Vectors must all have one length, else ValueError. Other columns are not read; a table without
    usable vectors gives no rows.
    """
    small_batches(vectors.sparkSession)
    entry = lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))
    rows = vectors.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{vector_column}`").cast("array<double>").alias("v")
    ).filter((F.size("v") > 0) & F.forall("v", entry))
    whole = F.transform("v", lambda c: F.floor(c * F.lit(float(SCALE))) + F.lit(SHIFT))
    rows = save(rows.select("id", whole.cast("array<bigint>").alias("x")), "vectors")
    distinct = save(rows.groupBy("x").agg(F.count(F.lit(1)).alias("weight")), "distinct-vectors")

    lengths = [r.length for r in distinct.select(F.size("x").alias("length")).distinct().limit(2).collect()]
    if not lengths:
        return vectors.sparkSession.createDataFrame([], RESULT)
    if len(lengths) > 1:
        raise ValueError(f"the vectors have different lengths, such as {lengths[0]} and {lengths[1]}")
    parts = distinct.mapInArrow(_sum_step, "rows bigint, sums array<bigint>")
    totals = parts.select("rows", F.posexplode("sums").alias("at", "value")).groupBy("at").agg(F.sum("rows"), F.sum("value"))
    totals = totals.orderBy("at").collect()  # a row for each dimension
    n, sums = totals[0][1], [r[2] for r in totals]
    mean = np.array([s / n for s in sums])

    covariance = _covariance(distinct, n, mean)
    values, directions = np.linalg.eigh(covariance)
    kept = min(components, len(values))
    values, directions = values[::-1][:kept], directions[:, ::-1][:, :kept]
    trace = float(np.trace(covariance))
    usable = values > trace * len(mean) * np.finfo(float).eps
    scales = np.sqrt(np.where(usable, values, 0))
    explained = [float(max(v, 0) / trace) if trace > 0 else 0.0 for v in values]

    schema = "x array<bigint>, weight bigint, deviation bigint, z array<double>"
    # written, so that both sides of the join are plain shuffles, which AQE splits at a vector that many rows share
    white = save(distinct.mapInArrow(_project_step(n, sums, mean, directions, scales), schema), "whitened")
    error = _identity_error(white, n, np.flatnonzero(usable).tolist())
    joined = rows.join(white, "x").select("id", "deviation", F.posexplode("z").alias("at", "whitened"))
    return joined.select(
        "id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.array(*[F.lit(e) for e in explained])[F.col("at")].alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )
