"""SimHash near-duplicates by anchor-point covering.

A fingerprint's 64 bits are cut into three segments; two fingerprints that differ in at most ``THRESHOLD`` = 4 bits
differ in at most one bit of some segment. On every segment the anchors are the words of a covering code of radius 1:
a [15, 11] Hamming code on its first 15 bits, all words on the rest. A fingerprint is at home at its nearest anchor and
is also sent to every anchor within the covering radius plus one differing bit, so it meets all fingerprints at home
there that may be close; each anchor compares its residents with its visitors over all 64 bits.

Over all 64 bits at once a code that is fine enough for large tables would need over a thousand anchors for each
fingerprint (1,230 for two Golay codes); by segments it is 43.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import connected_components, forest, fresh, row_mark, save, small_batches, take_rows, text_slices

THRESHOLD = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and width
CODE_BITS = 15
HOT_RESIDENTS = 4096  # an anchor with more residents is split over several tasks
_PAIRS = 1 << 21
_ROWS = 200_000
_GAP = re.compile(rb"[\x20\x09-\x0D]")


# ---------------------------------------------------------------------------------------------- fingerprints


def _word_blocks(data: bytes, step: int = 4 << 20) -> Iterator[list[bytes]]:
    """The words of a text, by stretches that end at white space."""
    at = 0
    while at < len(data):
        gap = _GAP.search(data, at + step)
        end = gap.start() if gap else len(data)
        yield data[at:end].split()
        at = end


def _shingle_hashes(data: bytes, width: int, seed: int) -> Iterator[list[int]]:
    """Hashes of all shingles of ``width`` words, or of all words together where they are fewer."""
    carried: list[bytes] = []
    whole = True
    for words in _word_blocks(data):
        words = carried + words
        if len(words) >= width:
            joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
            starts = np.concatenate(([0], ends[:-width])).tolist()
            digest = xxhash.xxh64_intdigest
            yield [digest(joined[a:b], seed) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist())]
            whole = False
        carried = words[-(width - 1) :] if width > 1 else []
    if whole and carried:
        yield [xxhash.xxh64_intdigest(b" ".join(carried), seed)]


def fingerprints(texts: list[bytes], width: int = 4, seed: int = 42) -> np.ndarray:
    """64-bit SimHash of each text: a bit is set where over half of the shingle hashes have it."""
    ones, totals = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    held: list[int] = []
    owners: list[int] = []
    lengths: list[int] = []

    def flush() -> None:
        bits = np.unpackbits(np.array(held, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
        np.add.at(ones, owners, np.add.reduceat(bits, starts, axis=0, dtype=np.int64))
        np.add.at(totals, owners, lengths)
        for part in (held, owners, lengths):
            part.clear()

    for i, text in enumerate(texts):
        for hashes in _shingle_hashes(text.lower(), width, seed):  # bytes.lower() changes A-Z only
            held += hashes
            owners.append(i)
            lengths.append(len(hashes))
            if len(held) >= 1 << 16:
                flush()
    if held:
        flush()
    set_bits = (2 * ones > totals[:, None]).astype(np.uint8)
    return np.packbits(set_bits, axis=1, bitorder="little").view("<u8")[:, 0]


def _fingerprint_step(width: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, "text", 8 << 20):
                texts = [t.as_py() or b"" for t in batch.column("text").cast(pa.large_binary())]
                found = pa.array(fingerprints(texts, width).view("<i8"))
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("mark"), found], ["id", "mark", "fp"])

    return step


# ---------------------------------------------------------------------------------------------- anchors


def _syndromes() -> np.ndarray:
    """Of each 15-bit word, the XOR of the numbers 1 to 15 of its set bits; 0 for code words."""
    words = np.arange(1 << CODE_BITS)
    found = np.zeros_like(words)
    for bit in range(CODE_BITS):
        found ^= np.where(words >> bit & 1, bit + 1, 0)
    return found


def _corrections() -> list[list[int]]:
    """Of each syndrome, the changes of up to two bits that lead to a code word, the nearest first."""
    single = [0] + [1 << (s - 1) for s in range(1, CODE_BITS + 1)]
    pairs = [[single[i] | single[i ^ s] for i in range(1, CODE_BITS + 1) if i < i ^ s] for s in range(CODE_BITS + 1)]
    return [[0]] + [[single[s], *pairs[s]] for s in range(1, CODE_BITS + 1)]


def anchors(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, anchor and whether it is the row's home, for unsigned 64-bit fingerprints."""
    syndromes, corrections = _syndromes(), _corrections()
    rows, keys, homes = [], [], []

    def add(row: np.ndarray, key: np.ndarray, segment: int, home: bool) -> None:
        rows.append(row)
        keys.append(key | np.int64(segment << 32))
        homes.append(np.full(len(row), home))

    everyone = np.arange(len(values))
    for segment, (first, width) in enumerate(SEGMENTS):
        bits = (values >> np.uint64(first) & np.uint64((1 << width) - 1)).astype(np.int64)
        code, rest = bits & ((1 << CODE_BITS) - 1), bits >> CODE_BITS << CODE_BITS
        of = syndromes[code]
        for s, changes in enumerate(corrections):
            mine = np.flatnonzero(of == s)
            for change in changes:
                add(mine, code[mine] ^ change | rest[mine], segment, change == changes[0])
        near = code ^ np.array([c[0] for c in corrections])[of]
        for bit in range(CODE_BITS, width):
            add(everyone, near | rest ^ (1 << bit), segment, False)
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(homes)


def _anchor_step(homes_only: bool):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy(zero_copy_only=False)
            row, key, home = anchors(values.view("<u8"))
            if homes_only:
                row, key, home = row[home], key[home], home[home]
            for at in range(0, len(row), 1 << 16):
                cut = slice(at, at + (1 << 16))
                cells = [pa.array(key[cut]), pa.array(home[cut]), pa.array(values[row[cut]])]
                yield pa.RecordBatch.from_arrays(cells, ["anchor", "home", "fp"])

    return step


# ---------------------------------------------------------------------------------------------- comparison


def _links(group: np.ndarray, home: np.ndarray, value: np.ndarray, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that hold together what is close, for rows sorted by group with the residents of each group first.

    A group never yields all its close pairs, only enough to connect them, so the output stays in proportion to the rows.
    """
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.append(starts, len(group)))
    residents = np.add.reduceat(home.astype(np.int64), starts)
    first, many = np.repeat(starts, sizes), np.repeat(residents, sizes)
    ends = np.cumsum(many)
    at = 0
    while at < len(group):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PAIRS, "right")))
        counts = many[at:to]
        visitor = np.repeat(np.arange(at, to), counts)
        within = np.arange(len(visitor)) - np.repeat(np.cumsum(counts) - counts, counts)
        resident = first[visitor] + within
        close = (np.bitwise_count(value[visitor] ^ value[resident]) <= threshold) & (visitor != resident)
        if close.any():
            a, b = visitor[close], resident[close]
            nodes, index = np.unique(np.concatenate((a, b)), return_inverse=True)
            label = forest(index[: len(a)], index[len(a) :], len(nodes))
            other = nodes[label]
            yield value[nodes[other != nodes]], value[other[other != nodes]]
        at = to


def _compare_step(threshold: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def send(pairs):
            for a, b in pairs:
                found = np.unique(np.stack((a.view("<i8"), b.view("<i8"))), axis=1)
                found = found[:, found[0] != found[1]]
                if found.size:
                    yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            group = batch.column("anchor").to_numpy(zero_copy_only=False) * 65536 + batch.column("part").to_numpy(zero_copy_only=False)
            columns = [group, batch.column("home").to_numpy(zero_copy_only=False), batch.column("fp").to_numpy(zero_copy_only=False).view("<u8")]
            columns = [np.concatenate((h, c)) for h, c in zip(held, columns)] if held else columns
            cut = int(np.searchsorted(columns[0], columns[0][-1])) if (np.diff(columns[0]) >= 0).all() else None
            if cut is None:
                raise ValueError("rows are not sorted by anchor")
            if cut:
                yield from send(_links(*(c[:cut] for c in columns), threshold))
            held = [c[cut:] for c in columns]
            if len(held[0]) > _ROWS:  # the residents came first, so all of them are here
                yield from send(_links(*held, threshold))
                held = [c[held[1]] for c in held]
        if held:
            yield from send(_links(*held, threshold))

    return step


def close_links(values: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints (column ``fp``) that connect all pairs within ``threshold`` bits."""
    if threshold > 2 * len(SEGMENTS) - 1 or threshold < 0:
        raise ValueError("the anchors find up to five differing bits")
    schema = "anchor bigint, home boolean, fp bigint"
    placed = values.select("fp").mapInArrow(_anchor_step(False), schema).withColumn("part", F.lit(0))
    residents = values.select("fp").mapInArrow(_anchor_step(True), schema)
    hot = residents.groupBy("anchor").count().filter(F.col("count") > HOT_RESIDENTS)
    hot = hot.select("anchor", F.ceil(F.col("count") / HOT_RESIDENTS).cast("int").alias("parts"))
    if not hot.isEmpty():  # residents of a hot anchor are dealt out, its visitors (residents too) go to each part
        hot = save(hot, "hot-anchors")
        both = placed.select("anchor", "fp", F.col("home").alias("here")).join(hot, "anchor", "left")
        both = both.withColumn("parts", F.coalesce("parts", F.lit(1)))
        own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
        at = F.transform(
            F.sequence(F.lit(0), F.col("parts") - 1),
            lambda i: F.struct(i.alias("part"), (F.col("here") & (i == own)).alias("home")),
        )
        placed = both.select("anchor", "fp", F.inline(at)).select("anchor", "home", "fp", "part")
    order = [F.col("anchor"), F.col("part"), F.desc("home")]
    dealt = placed.repartition("anchor", "part").sortWithinPartitions(*order)
    return dealt.mapInArrow(_compare_step(threshold), "a bigint, b bigint")


# ---------------------------------------------------------------------------------------------- operator


def near_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    mark: str | None = None,
    width: int = 4,
    threshold: int = THRESHOLD,
) -> DataFrame:
    """One row per document: ``id, mark, fp, component_id, kept``.

    Documents are linked when their fingerprints differ in at most ``threshold`` bits, and ``component_id`` is the
    smallest identifier that links reach (NULL if none of them has one). One row of each component is kept: that with
    the smallest identifier, and of several such the one with the smallest ``mark`` (a unique integer column; it is made up
    where none is named). NULL counts as the empty text,
    whose fingerprint is zero; a text of fewer than ``width`` words is one shingle. Equal fingerprints are one point of
    the search, so copies cost nothing more. Other columns are not read; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    marks = F.col(mark) if mark else F.monotonically_increasing_id()
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"), marks.alias("mark"))
    points = save(rows.mapInArrow(_fingerprint_step(width), "id bigint, mark bigint, fp bigint"), "fingerprints")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark")).alias("first")
    values = save(points.groupBy("fp").agg(first), "values")
    groups = connected_components(close_links(values, threshold), "a", "b")
    named = values.join(groups, values.fp == groups.node, "left").select("fp", "first", F.coalesce("component", "fp").alias("group"))
    named = save(named, "named")
    best = save(named.groupBy("group").agg(F.min("first").alias("best")), "best")  # for AQE to split a large component
    found = named.join(best, "group").select("fp", F.col("best.id").alias("component_id"), F.col("best.mark").alias("best_mark"))
    best = (F.col("mark") == F.col("best_mark")) & F.col("id").eqNullSafe(F.col("component_id"))
    return points.join(found, "fp").select("id", "mark", "fp", "component_id", best.alias("kept"))


def drop_near_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 4, threshold: int = THRESHOLD
) -> DataFrame:
    """One row of each component, with the columns of ``docs``; the rules are those of ``near_groups``."""
    mark = fresh(docs, "mark")
    groups = near_groups(docs.withColumn(mark, row_mark(docs)), id_column, text_column, mark, width, threshold)
    # rows alike in all columns share a mark, so all of them are marked as kept
    kept = groups.filter("kept").groupBy("id", "mark").agg(F.count(F.lit(1)).alias("rows"), F.lit(1).alias("times"))
    return take_rows(docs, id_column, kept)
