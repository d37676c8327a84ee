"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents, in a shuffled order, form one stream of words that is cut into blocks of equal size. The
schedule is a row of slots: the golden-ratio points ``frac(i * phi)`` fall into the sources' shares of [0, 1), so every
stretch of the schedule has the wanted proportions; the k-th slot of a source takes its k-th block, starting over at the
end of the stream. Slots a source no longer needs pass to sources still short, at the end of the schedule, so that every
source gives exactly its target, rounded to words.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm.common import WORD, fresh, row_mark, save, take_rows

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
LIMIT = 2
BLOCK_WORDS = 1024
PIECE_ROWS = 4096  # rows of one window; totals of pieces are summed above it
CELLS = 4096  # cells of [0, 1) by which slots find their source
GOLDEN = 11400714819323198485  # 2^64 over the golden ratio


def running_total(df: DataFrame, group: Sequence[str], piece: str, order: Sequence[str], size: str, name: str) -> DataFrame:
    """Add the sum of ``size`` over the earlier rows of the group, in the order of ``piece`` and then of ``order``.

    Pieces are summed before the shuffle, and only their totals are ordered within a group, so a hot group is many tasks.
    """
    totals = df.groupBy(*group, piece).agg(F.sum(size).alias("__sum"))
    above = Window.partitionBy(*group).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    opened = totals.select(*group, piece, F.coalesce(F.sum("__sum").over(above), F.lit(0)).alias("__opened"))
    within = Window.partitionBy(*group, piece).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("__within", F.coalesce(F.sum(size).over(within), F.lit(0)))
    joined = rows.join(opened, [*group, piece])
    return joined.withColumn(name, (F.col("__opened") + F.col("__within")).cast("bigint")).drop("__opened", "__within")


def source_targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """Add ``weight`` and ``target`` to a table of one row per source with its ``source_size``.

    Sources in code point order, NULL last, take ``weights`` in turn. ``share`` of all sizes is given out by weight; a
    target stops at ``limit`` times its source's size and the excess is shared again by weight among the others.
    All sources below the limit get the same amount per unit of weight, so they are found in one pass: in order of
    limit per weight, sources are full as long as that is less than what the rest would get.
    """
    whole = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(whole) - 1, F.lit(len(weights)))
    weighed = sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
    cap = F.col("source_size") * float(limit)
    order = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum(cap).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy(F.lit(1))) * float(share)
    level = weighed.withColumn("__level", (total - before) / rest).withColumn("__cap", cap)
    level = level.withColumn("__place", F.row_number().over(order))
    open_ = level.withColumn("__open", F.col("__level") < F.col("__cap") / F.col("weight"))
    first = F.min(F.when(F.col("__open"), F.struct("__place", F.col("__level").alias("level"))))
    amount = first.over(Window.partitionBy(F.lit(1)))["level"]
    target = F.coalesce(F.least(F.col("__cap"), amount * F.col("weight")), F.col("__cap"))
    return open_.withColumn("target", target).select(*sources.columns, "weight", "target")


def golden_point(slot: Column) -> Column:
    """``frac(slot / golden ratio)``; high and low parts of the slot are multiplied apart, which keeps 30 bits up to 2^40."""
    step = 1 << 20
    low, high = GOLDEN / 2**64, (GOLDEN * step % 2**64) / 2**64
    return ((slot % step) * F.lit(low) + F.floor(slot / step) * F.lit(high)) % 1


def schedule(sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The slots of the mix: ``slot, source, block, words`` for sources with ``source_size`` and ``target``.

    ``words`` is how much of the block the slot takes: all of it, but for the last slot of a source.
    """
    spark = sources.sparkSession
    size, quota = F.col("source_size"), F.round("target").cast("bigint")
    whole, rest = F.floor(quota / size), quota % size
    sized = sources.filter(quota > 0).select(
        "source",
        size.alias("size"),
        quota.alias("quota"),
        (whole * F.ceil(size / block_words) + F.ceil(rest / block_words)).cast("bigint").alias("slots"),
    )
    order = Window.orderBy(F.col("source").asc_nulls_last())
    upto = F.sum("slots").over(order.rowsBetween(Window.unboundedPreceding, 0))
    all_slots = F.sum("slots").over(Window.partitionBy(F.lit(1)))
    sized = sized.withColumn("number", F.row_number().over(order)).withColumn("to", upto).withColumn("all", all_slots)
    low, high = (F.col("to") - F.col("slots")) / F.col("all"), F.col("to") / F.col("all")
    sized = save(sized.select("source", "number", "size", "quota", "slots", low.alias("low"), high.alias("high")), "sources")
    count = sized.agg(F.sum("slots")).first()[0] or 0

    # a share of [0, 1) is listed under every cell that it touches; a point looks its source up under its own cell
    cell = lambda x: F.least(F.floor(x * CELLS), F.lit(CELLS - 1))
    cells = sized.select("number", "low", "high", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high")))).alias("cell"))
    points = spark.range(count).select(F.col("id").alias("slot"), golden_point(F.col("id")).alias("point"))
    points = points.withColumn("at", cell(F.col("point")))
    drawn = points.join(cells, F.expr("at = cell and point >= low and point < high"))
    drawn = drawn.select("slot", "number", F.floor(F.col("slot") / PIECE_ROWS).alias("piece"), F.lit(1).alias("one"))
    ranked = running_total(drawn, ["number"], "piece", ["slot"], "one", "turn").select("slot", "number", "turn")

    got = drawn.groupBy("number").agg(F.count(F.lit(1)).alias("got"))
    short = sized.join(got, "number", "left").select("number", "slots", F.coalesce("got", F.lit(0)).alias("got")).filter("got < slots")
    spare = short.select("number", F.explode(F.sequence(F.col("got"), F.col("slots") - 1)).alias("turn"))
    spare = spare.select(  # a handful for each source
        (F.lit(count - 1) + F.row_number().over(Window.orderBy("turn", "number"))).cast("bigint").alias("slot"), "number", "turn"
    )

    turns = ranked.unionByName(spare).join(sized, "number").filter(F.col("turn") < F.col("slots"))
    blocks = F.ceil(F.col("size") / block_words)
    first = F.floor(F.col("turn") / blocks) * F.col("size") + F.col("turn") % blocks * block_words
    length = F.least(F.lit(block_words), F.col("size") - F.col("turn") % blocks * block_words, F.col("quota") - first)
    return turns.select(
        "slot", "source", (F.col("turn") % blocks).cast("bigint").alias("block"), length.cast("bigint").alias("words")
    ).filter("words > 0")


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    mark: str | None = None,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    limit: float = LIMIT,
    block_words: int = BLOCK_WORDS,
    seed: int = 11,
) -> tuple[DataFrame, DataFrame]:
    """The documents with their sources' targets, and the mix as stretches of documents.

    First table: ``id, mark, source, size, source_size, target, start`` for every row; ``size`` counts the words of the
    text (NULL: 0) and ``start`` is the row's place in its source's stream. Second table: ``slot, source, start, id,
    mark, first, words``: in slot order, each document's stretch of words from ``first`` on that the slot takes. A block
    is taken ``limit`` times at most, so a document is too. NULL is a source of its own. The order within a source is a
    hash of identifier and text, so reruns agree; rows that agree in both are alike in everything the mix reads. An empty
    table gives two empty ones. ``mark`` names a unique integer column and is made up where there is none.
    """
    marks = F.col(mark) if mark else F.monotonically_increasing_id()
    text = F.col(text_column)
    rows = save(
        docs.select(
            F.col(id_column).alias("id"),
            marks.alias("mark"),
            F.col(source_column).cast("string").alias("source"),
            F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
            F.xxhash64(F.lit(seed), F.col(id_column), text).alias("place"),
        ),
        "sized",
    )
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    targets = save(source_targets(sources, weights, share, limit), "targets")
    named = rows.join(targets.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    # the hash order is cut into as many pieces as the source needs; NULL gets a name of its own for grouping
    pieces = F.ceil(F.col("rows") / PIECE_ROWS)
    spread = (F.col("place") / F.lit(2.0**64) + 0.5) * pieces
    named = named.withColumn("piece", F.least(F.floor(spread), pieces - 1)).withColumn("has", F.col("source").isNotNull())
    placed = running_total(
        named.withColumn("key", F.coalesce("source", F.lit(""))), ["has", "key"], "piece", ["place", "id", "size", "mark"], "size", "start"
    )
    placed = save(placed.select("id", "mark", "source", "size", "source_size", "target", "start"), "placed")

    last = F.floor((F.col("start") + F.col("size") - 1) / block_words)
    cut = placed.filter("size > 0").select(
        "id", "mark", "source", "start", "size", F.explode(F.sequence(F.floor(F.col("start") / block_words), last)).alias("block")
    )
    slots = schedule(targets.select("source", "source_size", "target"), block_words).select(
        "slot", F.col("source").alias("__s"), F.col("block").alias("__b"), F.col("words").alias("taken")
    )
    # documents of a block share its key, never more than the block has words
    meet = cut.join(slots, (F.col("block") == F.col("__b")) & F.col("source").eqNullSafe(F.col("__s")))
    low = F.greatest(F.col("start"), F.col("block") * block_words)
    high = F.least(F.col("start") + F.col("size"), F.col("block") * block_words + F.col("taken"))
    stretches = meet.filter(high > low).select(
        "slot", "source", "start", "id", "mark", (low - F.col("start")).alias("first"), (high - low).alias("words")
    )
    return placed, stretches


def mixed_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", **options) -> DataFrame:
    """The mix in whole documents, with the columns of ``docs``.

    A document appears once for every pass of its source's stream in which its first word is taken: not at all, once or,
    with the usual limit, twice. Its source's words thus come to the target within one document. Texts without a word
    stay once, as they weigh nothing.
    """
    mark = fresh(docs, "mark")
    placed, stretches = mix(docs.withColumn(mark, row_mark(docs)), id_column, text_column, source_column, mark, **options)
    # rows alike in all columns share a mark; their passes are added up
    there = placed.select("id", "mark", F.lit(1).alias("row"), (F.col("size") == 0).cast("int").alias("time"))
    passes = stretches.filter("first = 0").select("id", "mark", F.lit(0).alias("row"), F.lit(1).alias("time"))
    wanted = there.unionAll(passes).groupBy("id", "mark").agg(F.sum("row").alias("rows"), F.sum("time").alias("times"))
    return take_rows(docs, id_column, wanted)
