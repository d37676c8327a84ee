"""Merkle manifest of a dataset, with a proof for every row, by nested-interval labels.

Rows are leaves of one tree for each group, and the groups' roots are the leaves of one tree above. A node carries the
interval of leaf ranks that it covers. Going up, runs of ``FAN_OUT`` nodes become their digest. Going down, each node is
joined to the node one level above whose interval contains its own, found by the bucket of that level's width; what the
parent's interval holds beside its own names the siblings, and they come before the parent's own path to the root. So
every level costs a join of its own size, an eighth of the level below.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm.common import save

BITS = 3
FAN_OUT = 1 << BITS
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PART_BITS = 33  # monotonically_increasing_id has the partition above these bits


def row_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 in lower-case hex of the values, each as its size in bytes, a colon and its text; ``-`` for NULL."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _same_tree(left: DataFrame, right: DataFrame) -> Column:
    return left["tree"].eqNullSafe(right["tree"])


def _ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``lo``, the place of each row in its tree, and ``size``, the number of rows of the tree.

    Rows are range-partitioned by all of ``order``, which is unique, so that a large tree is spread over many tasks.
    """
    by = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = save(placed.withColumn("at", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn("part", F.shiftrightunsigned("at", PART_BITS))
    runs = placed.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    tree = Window.partitionBy("tree")  # a row for each partition that has rows of the tree
    before = F.sum("rows").over(tree.orderBy("part")) - F.col("rows")
    runs = runs.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("rows").over(tree).alias("size"))
    runs = save(runs, "runs")
    found = placed.join(runs, _same_tree(placed, runs) & (placed.part == runs.part))
    return found.select(*[placed[c] for c in rows.columns], (F.col("at") + F.col("shift")).alias("lo"), "size")


def _levels(leaves: DataFrame) -> list[DataFrame]:
    """The nodes of all trees, level by level: ``tree, size, lo, hi, digest, children``, and the leaves' other columns."""
    none = F.lit(None).cast("array<struct<lo:bigint,hi:bigint,digest:string>>")
    levels = [save(leaves.withColumn("hi", F.col("lo") + 1).withColumn("children", none), "level")]
    largest = leaves.agg(F.max("size")).first()[0] or 0
    width = FAN_OUT
    while largest > width // FAN_OUT:
        below = levels[-1].filter(F.col("size") > width // FAN_OUT)
        runs = below.groupBy("tree", "size", F.expr(f"lo div {width}").alias("bucket"))
        runs = runs.agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children"))
        digest = F.sha2(F.array_join("children.digest", "").cast("binary"), 256)
        lo, hi = (F.col("bucket") * width).alias("lo"), F.array_max("children.hi").alias("hi")
        levels.append(save(runs.select("tree", "size", lo, hi, digest.alias("digest"), "children"), "level"))
        width *= FAN_OUT
    return levels


def _tops(levels: Sequence[DataFrame]) -> DataFrame:
    """``tree, digest`` of the root of every tree."""
    found = [nodes.filter(F.col("size") <= FAN_OUT**k).select("tree", "digest") for k, nodes in enumerate(levels)]
    both = found[0]
    for more in found[1:]:
        both = both.unionAll(more)
    return both


def _with_paths(levels: Sequence[DataFrame], tops: DataFrame, carried: Sequence[str]) -> DataFrame:
    """The leaves with ``path``, and the columns ``carried`` of ``tops``, which has a row with them for every tree.

    ``path`` has an entry for each level from the leaf up: the digests of the siblings on its left, then on its right.
    """
    above = None
    for k in range(len(levels) - 1, -1, -1):
        nodes, bits = levels[k], BITS * (k + 1)
        roots = nodes.filter(F.col("size") <= FAN_OUT**k)
        found = roots.join(tops, _same_tree(roots, tops)).select(*[roots[c] for c in nodes.columns], *carried, "path")
        if above is not None:
            inner = nodes.filter(F.col("size") > FAN_OUT**k)
            same_bucket = F.shiftright(inner.lo, bits) == F.shiftright(above.lo, bits)
            inside = (inner.lo >= above.lo) & (inner.hi <= above.hi)
            joined = inner.join(above, _same_tree(inner, above) & same_bucket & inside)
            # what the parent covers beside the node: an interval on its left and one on its right
            left = F.filter(above.children, lambda c: c.hi <= inner.lo)
            right = F.filter(above.children, lambda c: c.lo >= inner.hi)
            texts = [F.array_join(F.transform(x, lambda c: c.digest), "") for x in (left, right)]
            step = F.array(F.struct(texts[0].alias("left"), texts[1].alias("right")))
            path = F.concat(step, above.path).alias("path")
            found = found.unionByName(joined.select(*[inner[c] for c in nodes.columns], *[above[c] for c in carried], path))
        above = save(found, "paths") if k else found
    return above


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(path, leaf, lambda digest, step: F.sha2(F.concat(step.left, digest, step.right).cast("binary"), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all digests on a path, from the leaf up and from left to right."""
    texts = F.transform(path, lambda step: F.concat(step.left, step.right))
    return F.sha2(F.array_join(texts, "").cast("binary"), 256)


def merkle_manifest(
    docs: DataFrame,
    columns: Sequence[str] = COLUMNS,
    id_column: str = "doc_id",
    group_column: str = "lang",
    carry: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``id, leaf, subroot, root, path``, and the expressions named in ``carry``.

    ``leaf`` is the digest of ``columns``. The leaves of a group ascend by identifier, NULL first; rows that share one, by
    digest, so that repeated rows, which share both, give the same trees in any order. Every ``FAN_OUT`` nodes in a row
    become one, the last ones fewer, until one is left: the group's ``subroot``. Subroots, by group with NULL first,
    lead to the ``root`` in the same way. A path has an entry of two texts for each level up to the root. Texts may have
    any length, NULL and the empty text differ; no column but those named is read; an empty table gives no rows.
    """
    carry = carry or {}
    if set(carry) & {"tree", "size", "lo", "hi", "digest", "children", "id", "tie", "subroot", "root", "path"}:
        raise ValueError("a carried column has a name that the manifest uses itself")
    leaves = docs.select(
        F.col(f"`{group_column}`").alias("tree"),
        F.col(f"`{id_column}`").alias("id"),
        row_digest([F.col(f"`{c}`") for c in columns]).alias("digest"),
        F.monotonically_increasing_id().alias("tie"),
        *[value.alias(name) for name, value in carry.items()],
    )
    leaves = _ranked(save(leaves, "leaves"), ("id", "digest", "tie"))
    groups = _levels(leaves.drop("tie"))

    subroots = save(_tops(groups), "subroots").select(F.lit(0).alias("tree"), F.col("tree").alias("group"), "digest")
    upper = _levels(_ranked(subroots, ("group",)))
    no_path = F.lit(None).cast("array<struct<left:string,right:string>>")
    root = _tops(upper).select("tree", F.col("digest").alias("root"), F.coalesce(no_path, F.array()).alias("path"))
    above = _with_paths(upper, save(root, "root"), ["root"])
    above = above.select(F.col("group").alias("tree"), F.col("digest").alias("subroot"), "root", "path")
    rows = _with_paths(groups, save(above, "paths"), ["subroot", "root"])
    return rows.select("id", F.col("digest").alias("leaf"), "subroot", "root", "path", *carry)
