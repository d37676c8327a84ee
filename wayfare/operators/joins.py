"""Joins with small lookup tables, key-integrity joins and fingerprint matching."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import AbstractContextManager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.session import scoped_conf


def lookup_join(fact: DataFrame, lookup: DataFrame, on: Column | str | Sequence[str], how: str = "inner") -> DataFrame:
    """Join a large table with a lookup table.

    No job runs before the action. A lookup read from files is broadcast by their size, so the large side is not shuffled;
    the size of a computed one is known when it has been computed, and adaptive execution then broadcasts it or
    splits the partitions of hot keys. The limits are ``spark.sql.autoBroadcastJoinThreshold`` and
    ``spark.sql.adaptive.autoBroadcastJoinThreshold``; ``broadcast_limit`` sets both for a while. A lookup that takes work to
    compute and serves a very large table is best written first, for its files to have a size.
    """
    return fact.join(lookup, on, how)


def broadcast_limit(spark: SparkSession, size: str) -> AbstractContextManager[None]:
    """Inside the block, tables up to ``size`` are broadcast, whether their size is known before or while a query runs."""
    name = "autoBroadcastJoinThreshold"
    return scoped_conf(spark, **{f"spark.sql.{name}": size, f"spark.sql.adaptive.{name}": size})


def merge_join(fact: DataFrame, lookup: DataFrame, on: Column | str | Sequence[str], how: str = "inner") -> DataFrame:
    """The same join as a sort-merge join, whatever the size of the lookup. AQE splits hot keys."""
    return fact.hint("merge").join(lookup, on, how)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equally named columns, with NULL equal to NULL. The keys of the right side are not repeated; rows that
    only the right side has bring their keys along."""
    right_keys = {k: f"__right_{k}" for k in keys}
    renamed = right.select(
        *[F.col(k).alias(r) for k, r in right_keys.items()], *[c for c in right.columns if c not in right_keys]
    )
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(r)) for k, r in right_keys.items()))
    joined = left.join(renamed, same, how)
    if how in ("full_outer", "fullouter", "full", "outer", "right", "right_outer", "rightouter"):
        joined = joined.withColumns({k: F.coalesce(k, r) for k, r in right_keys.items()})
    return joined.drop(*right_keys.values())


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Key values of ``child`` that ``parent`` lacks, with their number of rows. NULL keys are not orphans.

    The child is reduced to one row per key before the join, so a hot key costs no more than any other.
    """
    used = child.filter(F.col(key).isNotNull()).groupBy(F.col(key)).agg(F.count(F.lit(1)).alias("child_rows"))
    return used.join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def match_fingerprints(left: DataFrame, right: DataFrame, key: str = "trip_fingerprint") -> DataFrame:
    """How two tables overlap by fingerprint: distinct fingerprints and rows per outcome.

    Both sides are counted per fingerprint in one aggregation; no row of either side meets a row of the other.
    """
    tagged = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(
        right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    counts = tagged.groupBy(key).agg(F.sum("l").alias("left_rows"), F.sum("r").alias("right_rows"))
    outcome = (
        F.when(F.col("right_rows") == 0, "left_only").when(F.col("left_rows") == 0, "right_only").otherwise("matched")
    )
    return counts.groupBy(outcome.alias("outcome")).agg(
        F.count(F.lit(1)).alias("fingerprints"),
        F.sum("left_rows").alias("left_rows"),
        F.sum("right_rows").alias("right_rows"),
    )


def join_on_fingerprint(
    left: DataFrame, right: DataFrame, how: str = "inner", key: str = "trip_fingerprint"
) -> DataFrame:
    """Row-level join of two deduplicated tables on their fingerprint."""
    return left.join(right, key, how)


@dataclass(frozen=True)
class Dimension:
    """A dimension table, the fact column that refers to it, and the prefix for its columns in the result."""

    table: DataFrame
    fact_key: str
    key: str
    prefix: str


def star_lookup(fact: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """Add the attributes of every dimension to the fact rows; unknown keys give NULL attributes.

    The joins are lookup joins, so each dimension is broadcast or not by its own size.
    """
    for dimension in dimensions:
        fact_key = f"{dimension.prefix}__key"
        attributes = dimension.table.select(
            F.col(dimension.key).alias(fact_key),
            *[F.col(c).alias(f"{dimension.prefix}_{c}") for c in dimension.table.columns if c != dimension.key],
        )
        fact = lookup_join(fact, attributes, F.col(dimension.fact_key) == F.col(fact_key), "left").drop(fact_key)
    return fact
