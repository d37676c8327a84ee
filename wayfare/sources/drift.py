"""Parquet files whose columns drift: types that change from month to month, columns that come and go.

A scan with one schema fails on such files as soon as it meets the first value of another type. Here the files are sorted
into groups that one schema reads, each group is scanned by its own, and the scans are cast and put together by name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.functions.kinds import common_type, holds

CHANGES = "column string, type string, target string, files bigint, changed bigint"


@dataclass(frozen=True)
class FileGroup:
    """Files that one schema reads. Column names are told apart without regard to case, as Spark resolves them."""

    schema: T.StructType
    paths: tuple[str, ...]

    def field(self, name: str) -> T.StructField | None:
        return next((f for f in self.schema.fields if f.name.lower() == name.lower()), None)

    def kinds(self) -> frozenset[tuple[str, T.DataType]]:
        return frozenset((f.name.lower(), f.dataType) for f in self.schema.fields)


def _merged(spark: SparkSession, paths: Sequence[str]) -> T.StructType | None:
    """The columns of all these files, from their footers in one distributed job; None if some column has two types."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(*paths).schema
    except Exception as error:  # Spark's own exception comes wrapped, or not, by the call
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
        return None


def _grouped(spark: SparkSession, paths: Sequence[str]) -> list[FileGroup]:
    schema = _merged(spark, paths)
    if schema is not None:
        return [FileGroup(schema, tuple(paths))]
    half = len(paths) // 2
    return _grouped(spark, paths[:half]) + _grouped(spark, paths[half:])


def file_groups(spark: SparkSession, path: str) -> list[FileGroup]:
    """The files that a path or pattern names, in groups that one schema reads.

    Files without drift cost one job over their footers. Others are halved, in the order of their names, until every
    part agrees: types that changed a few times over the years take a few jobs for each change, however many files
    there are. Groups that turn out alike are put together.
    """
    paths = sorted(spark.read.parquet(path).inputFiles())
    if not paths:  # a folder with no data file in it
        return [FileGroup(spark.read.parquet(path).schema, ())]
    alike: dict[frozenset, FileGroup] = {}
    for group in _grouped(spark, paths):
        same = alike.get(group.kinds())
        alike[group.kinds()] = replace(same, paths=same.paths + group.paths) if same else group
    return list(alike.values())


def widened_schema(groups: Sequence[FileGroup]) -> T.StructType:
    """All columns of the groups, named and ordered as they are first met, each in the common type of its types."""
    names = dict.fromkeys(f.name.lower() for g in groups for f in g.schema.fields)
    fields = []
    for name in names:
        found = [f for g in groups if (f := g.field(name))]
        try:
            fields.append(T.StructField(found[0].name, common_type(f.dataType for f in found)))
        except TypeError as error:
            raise TypeError(f"column {found[0].name}: {error}") from error
    return T.StructType(fields)


def _value(group: FileGroup, target: T.StructField) -> Column:
    source = group.field(target.name)
    if source is None:
        return F.lit(None).cast(target.dataType).alias(target.name)
    column = F.col(f"`{source.name}`")
    return (column if source.dataType == target.dataType else column.try_cast(target.dataType)).alias(target.name)


def _scan(spark: SparkSession, group: FileGroup) -> DataFrame:
    return spark.read.schema(group.schema).parquet(*group.paths)


def read_drifting(spark: SparkSession, path: str, schema: T.StructType | None = None, lineage: str | None = None) -> DataFrame:
    """The files as one table, whatever types their columns have.

    Without a schema every column has the common type of its types in the files. With one, the result has its columns: those
    that a file lacks are NULL there, others are dropped, and a value that the declared type can't hold is NULL or loses
    what does not fit; ``drift_changes`` counts those. Each group of files is scanned once, with its own filters
    and columns pushed down. ``lineage`` names a column for the path of each row's file.
    """
    groups = file_groups(spark, path)
    target = schema or widened_schema(groups)
    files = [F.col("_metadata.file_path").alias(lineage)] if lineage else []
    if len(groups) == 1 and not groups[0].paths:
        empty = spark.createDataFrame([], target)
        return empty.withColumn(lineage, F.lit("")) if lineage else empty
    parts = [_scan(spark, g).select(*[_value(g, f) for f in target.fields], *files) for g in groups]
    return reduce(DataFrame.unionByName, parts)


def drift_changes(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """``column, type, target, files, changed``: for each type that a column has in the files, how many files have it, and
    how many of its values are not the same in the column of ``read_drifting``.

    Types that their target holds by definition are not read for it; the others take one scan of their columns.
    """
    groups = file_groups(spark, path)
    target = schema or widened_schema(groups)
    parts = []
    for group in groups:
        counts, named = [], []
        for field in target.fields:
            source = group.field(field.name)
            if source is None:
                continue
            named.append((field.name, source.dataType.simpleString(), field.dataType.simpleString(), len(group.paths)))
            if not holds(field.dataType, source.dataType) and group.paths:
                value = F.col(f"`{source.name}`")
                back = value.try_cast(field.dataType).try_cast(source.dataType)
                counts.append(F.count_if(value.isNotNull() & ~value.eqNullSafe(back)).alias(field.name))
        kinds = spark.createDataFrame(named, "column string, type string, target string, files bigint")
        if counts:
            row = _scan(spark, group).agg(*counts)
            changed = row.unpivot([], row.columns, "name", "changed")
            found = kinds.join(changed, kinds.column == changed.name, "left").drop("name")
            parts.append(found.withColumn("changed", F.coalesce("changed", F.lit(0).cast("bigint"))))
        else:
            parts.append(kinds.withColumn("changed", F.lit(0).cast("bigint")))
    both = reduce(DataFrame.unionByName, parts)
    return both.groupBy("column", "type", "target").agg(F.sum("files").alias("files"), F.sum("changed").alias("changed"))


def missing_path(error: AnalysisException) -> bool:
    """Whether a read failed because no file is there."""
    return error.getCondition() == "PATH_NOT_FOUND"
