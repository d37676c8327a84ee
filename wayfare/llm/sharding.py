"""Sharding by a two-pass external shuffle.

The first pass scatters records over buckets by a seeded hash, so that a bucket fits in the memory of one task; the
second brings each bucket into a random order by Fisher and Yates' shuffle. Buckets follow one another in the shuffled
table, which is cut into shards of equal row counts and written.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from wayfare.llm.common import fresh, repeated_rows, row_mark, save

BUCKET_BYTES = 16 << 20


def fisher_yates(size: int, seed: list[int]) -> np.ndarray:
    """A random order of ``size`` places: each place, from the last on, swaps with one drawn among those up to it."""
    order = np.arange(size)
    draws = (np.random.default_rng(seed).random(size) * np.arange(1, size + 1)).astype(np.int64).tolist()
    places = order.tolist()
    for i in range(size - 1, 0, -1):
        j = draws[i]
        places[i], places[j] = places[j], places[i]
    return np.array(places, np.int64)


def _shuffler(seed: int, rows: int, shards: int, names: tuple[str, str, str], kept: list[str], schema: StructType):
    place, bucket, offset = names
    base, extra = divmod(rows, shards)

    def shuffle(table: pa.Table) -> pa.Table:
        # arrival differs from run to run, the hash does not; only rows alike in all columns share one
        table = table.sort_by(place)
        number = table.column(bucket)[0].as_py()
        table = table.take(pa.array(fisher_yates(table.num_rows, [seed, number])))
        position = np.arange(table.num_rows) + table.column(offset)[0].as_py()
        large = extra * (base + 1)  # the first ``extra`` shards have one row more
        shard = np.where(position < large, position // (base + 1), extra + (position - large) // max(base, 1))
        start = shard * base + np.minimum(shard, extra)
        columns = [table.column(c) for c in kept] + [pa.array(shard.astype(np.int32)), pa.array(position - start)]
        return pa.table(columns, names=schema.names)

    return shuffle


def write_shards(docs: DataFrame, folder: str, shards: int = 16, bucket_bytes: int = BUCKET_BYTES, seed: int = 5) -> None:
    """Shuffle ``docs`` and write them as Parquet below ``folder``, one sub-folder ``shard=N`` for each non-empty shard.

    Shards differ by one row at most. Each row keeps its columns and gets ``slot``, its place in the shard; the names
    ``shard`` and ``slot`` are lengthened by underscores where ``docs`` has them. The bucket of a row is a hash of all its
    columns, so equal texts and NULL identifiers spread like any others, and the same table gives the same shards. Rows
    repeated in full that together pass a bucket are numbered and hashed with their numbers, so they spread too. Long records
    stay whole. An empty table writes no row.
    """
    if shards < 1:
        raise ValueError("there must be at least one shard")
    place, bucket, offset, size_, copy = (fresh(docs, n) for n in ("place", "bucket", "offset", "size", "copy"))
    shard, slot = fresh(docs, "shard"), fresh(docs, "slot")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    sizes = [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c, kind in docs.dtypes if kind in ("string", "binary")]
    placed = docs.select(*columns, F.xxhash64(F.lit(seed), row_mark(docs)).alias(place), sum(sizes, F.lit(8)).cast("bigint").alias(size_))
    rows, size = placed.agg(F.count(F.lit(1)), F.sum(size_)).first()
    buckets = max(1, -(-(size or 0) // bucket_bytes))
    hot = placed.groupBy(place).agg(F.sum(size_).alias("bytes"), F.count(F.lit(1)).alias(copy)).filter(F.col("bytes") > bucket_bytes)
    hot = save(hot.filter(F.col(copy) > 1).select(place, copy), "hot-rows")
    placed = placed.drop(size_)
    most = hot.agg(F.max(copy)).first()[0]
    if most:  # one row speaks for its copies, which get numbers instead of meeting in a bucket
        numbered = repeated_rows(placed.join(hot, place).dropDuplicates([place]), copy, offset, most)
        numbered = numbered.withColumn(place, F.xxhash64(place, offset)).select(*columns, place)
        placed = placed.join(hot, place, "left_anti").select(*columns, place).unionByName(numbered)
    placed = placed.withColumn(bucket, F.pmod(F.col(place), F.lit(buckets)))
    counts = placed.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))  # a row for each bucket
    before = F.sum("n").over(Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(bucket, F.coalesce(before, F.lit(0)).alias(offset))
    schema = StructType([*docs.schema.fields, StructField(shard, IntegerType()), StructField(slot, LongType())])
    shuffle = _shuffler(seed, rows, shards, (place, bucket, offset), docs.columns, schema)
    shuffled = placed.join(offsets, bucket).groupBy(bucket).applyInArrow(shuffle, schema)
    shuffled.sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(folder)

    written = read_shards(docs.sparkSession, folder, schema).count()
    if written != rows:
        raise RuntimeError(f"{written} rows were written, not {rows}")


def read_shards(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(folder)


def shard_documents(docs: DataFrame, folder: str, shards: int = 16, **options) -> DataFrame:
    """The written shards, read back: the columns of ``docs``, the shard and the slot."""
    write_shards(docs, folder, shards, **options)
    extra = [StructField(fresh(docs, "shard"), IntegerType()), StructField(fresh(docs, "slot"), LongType())]
    return read_shards(docs.sparkSession, folder, StructType([*docs.schema.fields, *extra]))
