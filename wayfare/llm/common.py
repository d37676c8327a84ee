"""Small helpers that several operators share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayfare.session import work_folder

# A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def save(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back, which cuts its lineage and fixes its rows."""
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, most: str = "8m") -> None:
    """Hand texts to Python in Arrow batches of a few megabytes; a session that asks for smaller ones is left alone.

    The default of 64 MB costs each task several times that, in the JVM's direct memory and in Python.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, None) or "64m"
    size = int(re.sub(r"\D", "", now)) * {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(now.lower().rstrip("b")[-1:], 1)
    if size > 8 << 20 or size <= 0:
        spark.conf.set(key, most)


def row_mark(docs: DataFrame) -> Column:
    """A hash of the whole row: only rows alike in all columns share it, but for chance. Columns that hold maps, which
    have no hash, count by their JSON."""
    unhashed = [c for c, kind in docs.dtypes if "map<" in kind or "variant" in kind]
    plain = [F.col(f"`{c}`") for c in docs.columns if c not in unhashed]
    return F.xxhash64(*plain, *[F.to_json(F.struct(F.col(f"`{c}`"))) for c in unhashed])


def repeated_rows(rows: DataFrame, times: str, number: str, most: int, at_once: int = 1024) -> DataFrame:
    """Each row as often as its column ``times`` says, ``most`` at most, numbered from 0 in a new column.

    Where a row has over ``at_once`` copies, rows are first made one for each so many, and those are dealt out, so that no
    task makes all copies of a row.
    """
    copies, first = rows.filter(F.col(times) > 0), F.lit(0).cast("bigint")
    piece = fresh(rows, "piece")
    if most > at_once:
        plain = [F.col(f"`{c}`") for c, kind in rows.dtypes if "map<" not in kind and "variant" not in kind]
        copies = copies.withColumn(piece, F.explode(F.sequence(first, F.floor((F.col(times) - 1) / at_once))))
        copies = copies.repartition(F.col(piece), F.xxhash64(*plain))
        first = F.col(piece) * at_once
    last = F.least(first + at_once, F.col(times).cast("bigint")) - 1
    return copies.withColumn(number, F.explode(F.sequence(first, last))).drop(piece)


def take_rows(docs: DataFrame, id_column: str, wanted: DataFrame) -> DataFrame:
    """Rows of ``docs`` as often as wanted, with its columns.

    ``wanted`` has ``id, mark, rows, times``: the identifier and ``row_mark`` of a row, how many rows of ``docs`` are alike
    in both, and how often that row is to appear, however many there are. The texts are shuffled once and not sorted.
    """
    wanted = save(wanted.filter("times > 0"), "wanted")
    mark, key, columns = fresh(docs, "mark"), F.col(f"`{id_column}`"), [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.withColumn(mark, row_mark(docs))
    names = {c: fresh(docs, f"wanted_{c}") for c in wanted.columns}
    named = wanted.select(*[F.col(c).alias(name) for c, name in names.items()]).hint("shuffle_hash")
    same = (F.col(mark) == F.col(names["mark"])) & key.cast("bigint").eqNullSafe(F.col(names["id"]))
    found = marked.join(named, same)
    rows = found.filter(F.col(names["rows"]) == 1)
    if not wanted.filter("rows > 1").isEmpty():  # rows repeated in full: one of them speaks for all
        rows = rows.unionByName(found.filter(F.col(names["rows"]) > 1).dropDuplicates([mark, names["id"]]))
    most = wanted.agg(F.max("times")).first()[0] or 0
    if most > 1:
        rows = repeated_rows(rows, names["times"], fresh(rows, "time"), most)
    return rows.select(*columns)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def in_fold(key: Column, fold: int = 2, folds: int = 4) -> Column:
    """Whether the checksum of a key written as text falls in one fold; a NULL key is in none."""
    return F.coalesce(F.crc32(key.cast("string")) % folds == fold, F.lit(False))


class BoundedCache(dict):
    """What ``make`` makes of words, by word. Long words are not kept, and all are dropped when their estimated size passes
    ``most_bytes``, so that memory has a bound whatever the words are; a word met again after that is made again."""

    def __init__(self, make: Callable[[str], object], bytes_a_letter: int, most_bytes: int = 64 << 20, longest: int = 1024):
        super().__init__()
        self.make, self.bytes_a_letter, self.most_bytes, self.longest = make, bytes_a_letter, most_bytes, longest
        self.held = 0

    def __missing__(self, word: str) -> object:
        made = self.make(word)
        if len(word) <= self.longest:
            size = 160 + self.bytes_a_letter * len(word)
            if self.held + size > self.most_bytes:
                self.clear()
                self.held = 0
            self.held += size
            self[word] = made
        return made


def least_of_groups(rows: DataFrame, group: str, point: str, count: int) -> DataFrame:
    """The distinct (group, point) pairs with the ``count`` least points of each group, exactly: repeated rows are one.

    Points are hashes, spread evenly over all ``bigint`` values, so a group's size tells below which value several times as
    many lie as are asked for; only those are ordered, however large the group.
    """
    distinct = save(rows.select(group, point).distinct(), "points")
    sizes = save(distinct.groupBy(group).agg(F.count(F.lit(1)).alias("size")), "sizes")
    place = F.col(point) / F.lit(2.0**64) + 0.5
    low = distinct.join(sizes, group).filter(place * F.col("size") <= 8 * count + 64)
    turn = F.row_number().over(Window.partitionBy(group).orderBy(point))
    return low.withColumn("turn", turn).filter(F.col("turn") <= count).select(group, point)


def text_slices(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts hold at most ``most_bytes`` together, or one row each."""
    sizes = batch.column(column).cast(pa.large_binary())
    start, held = 0, 0
    for i, value in enumerate(sizes):
        size = len(value.as_buffer()) if value.is_valid else 0
        if i > start and held + size > most_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if batch.num_rows > start:
        yield batch.slice(start)


def forest(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Label of each of ``size`` nodes under the links a-b: the smallest node it hangs together with."""
    label = np.arange(size)
    while True:
        least = np.minimum(label[a], label[b])
        if (label[a] == least).all() and (label[b] == least).all():
            return label
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]


def _checksum(edges: DataFrame) -> tuple:
    total = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(total)


def connected_components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node, component`` for every node of ``links``, the component being its smallest node.

    Large-star and small-star steps in turn: each node links its larger neighbours, then its smaller ones, to the
    smallest node it knows. The number of links never grows, a hub's links are counted before the shuffle and joined
    under AQE's skew rule, and every round ends in a written table, so a lost executor costs one round at most.
    Links to oneself and NULL ends are ignored.
    """
    a, b = F.col(left).cast("bigint"), F.col(right).cast("bigint")
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(a.isNotNull() & b.isNotNull() & (a != b))
    edges = save(edges.distinct(), "components")
    before, now = None, _checksum(edges)
    while now[0] and now != before:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that both sides of the join are plain shuffles, which AQE can split at a hub
        least = save(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "components")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = save(large, "components")
        least = save(large.groupBy("u").agg(F.min("v").alias("m")), "components")
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionAll(least.select("u", F.col("m").alias("v")))
        edges = save(small.distinct(), "components")
        before, now = now, _checksum(edges)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
