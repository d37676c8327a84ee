"""Exact deduplication by a tree of merged digest runs.

Every input partition becomes a sorted run of text digests with the best identifier of each. Runs are cut into slices
by the leading bits of the digest, so that no task ever holds more than one slice, and the runs of a slice are merged
in rounds: in round ``r`` the runs whose numbers agree above the ``r``-th digit exchange their rows and merge.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import fresh, row_mark, save, small_batches, take_rows, text_slices

RUN = "slice int, run int, keys binary, ids binary, marks binary, counts binary"
KEY_BYTES = 40  # SHA-256, then the length as 8 bytes: equal digests count as one text only if the lengths agree too
NO_ID = np.iinfo(np.int64).min
SLICE_ROWS = 200_000


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in text_slices(whole, "text", 8 << 20):
            keys = []
            for text in batch.column("text").cast(pa.large_binary()):
                data = (text.as_py() or b"").lower()  # bytes.lower() changes A-Z only
                keys.append(hashlib.sha256(data).digest() + len(data).to_bytes(8, "big"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("mark"), pa.array(keys, pa.binary())], ["id", "mark", "key"]
            )


def _reduce(keys: np.ndarray, ids: np.ndarray, marks: np.ndarray, counts: np.ndarray, largest: bool) -> tuple:
    """One entry per key, in key order: the best id, among equal ids the smallest mark, and the number of rows."""
    order = np.argsort(keys, kind="stable")  # keeps to the runs that are sorted already
    keys, ids, marks, counts = keys[order], ids[order], marks[order], counts[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    if largest:
        best = np.maximum.reduceat(ids, starts)
    else:
        best = np.minimum.reduceat(np.where(ids == NO_ID, np.iinfo(np.int64).max, ids), starts)
        best = np.where(np.maximum.reduceat(ids, starts) == NO_ID, NO_ID, best)
    lengths = np.diff(np.append(starts, len(keys)))
    tied = np.where(ids == np.repeat(best, lengths), marks, np.iinfo(np.int64).max)
    return keys[starts], best, np.minimum.reduceat(tied, starts), np.add.reduceat(counts, starts)


def _pack(piece: int, run: int, entries: tuple) -> pa.RecordBatch:
    row = [[piece], [run], *([x.tobytes()] for x in entries)]
    types = [pa.int32(), pa.int32()] + [pa.binary()] * 4
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], ["slice", "run", "keys", "ids", "marks", "counts"])


def _unpack(keys: bytes, ids: bytes, marks: bytes, counts: bytes) -> tuple:
    return np.frombuffer(keys, f"S{KEY_BYTES}"), *(np.frombuffer(x, "<i8") for x in (ids, marks, counts))


def _run_maker(bits: int, runs_made: int, largest: bool):
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        run, held, rows = TaskContext.get().partitionId() % runs_made, [], 0

        def flush():
            columns = [np.concatenate([h[i] for h in held]) for i in range(3)]
            entries = _reduce(*columns, np.ones(len(columns[0]), "<i8"), largest)
            top = np.frombuffer(entries[0].tobytes(), np.uint8).reshape(-1, KEY_BYTES)[:, :4].copy().view(">u4")[:, 0]
            pieces = (top >> (32 - bits)).astype(np.int64) if bits else np.zeros(len(top), np.int64)
            cuts = np.flatnonzero(np.diff(pieces)) + 1  # the keys are sorted, hence the slices too
            for span in zip(np.concatenate(([0], cuts)), np.append(cuts, len(top))):
                yield _pack(int(pieces[span[0]]), run, tuple(x[slice(*span)] for x in entries))

        for batch in batches:
            if batch.num_rows:
                # a NULL identifier loses to any other; a key never contains an unpadded end, so fixed width is safe
                ids = batch.column("id").fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
                keys = np.frombuffer(b"".join(batch.column("key").to_pylist()), f"S{KEY_BYTES}")
                held.append((keys, ids, batch.column("mark").to_numpy(zero_copy_only=False)))
                rows += batch.num_rows
            if rows >= 1 << 20:
                yield from flush()
                held, rows = [], 0
        if held:
            yield from flush()

    return runs


def _merger(fan_in: int, largest: bool):
    def merge(table: pa.Table) -> pa.Table:
        parts = [_unpack(*(r[c] for c in ("keys", "ids", "marks", "counts"))) for r in table.to_pylist()]
        entries = _reduce(*(np.concatenate([p[i] for p in parts]) for i in range(4)), largest)
        run = table.column("run")[0].as_py() // fan_in
        return pa.Table.from_batches([_pack(table.column("slice")[0].as_py(), run, entries)])

    return merge


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            keys, ids, marks, counts = _unpack(r["keys"], r["ids"], r["marks"], r["counts"])
            data = r["keys"]
            cells = [data[i : i + KEY_BYTES] for i in range(0, len(data), KEY_BYTES)]
            for at in range(0, len(cells), 50_000):
                cut = slice(at, at + 50_000)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cells[cut], pa.binary()),
                        pa.array(ids[cut], mask=ids[cut] == NO_ID),
                        pa.array(marks[cut]),
                        pa.array(counts[cut]),
                    ],
                    ["key", "keep_id", "keep_mark", "group_size"],
                )


def exact_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    mark: str | None = None,
    keep: str = "max",
    fan_in: int = 8,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """One row per document: ``id, mark, keep_id, group_size, kept, digest`` (SHA-256 of the normalised text).

    Texts are one group when they are the same after lower-casing A-Z; NULL counts as the empty text. Of a group the
    row with the largest (``keep="max"``) or smallest identifier stays. A NULL identifier loses to any other; among
    rows with the same identifier the one with the smallest ``mark`` stays. ``mark`` names an integer column; where it is
    unique, as the one that is made up without it, exactly one row per group is kept also when rows are repeated. Other
    columns are not read. Texts may have any length; an empty table gives no rows.
    """
    if keep not in ("max", "min"):
        raise ValueError(f"keep must be max or min, not {keep!r}")
    small_batches(docs.sparkSession)
    marks = F.col(mark) if mark else F.monotonically_increasing_id()
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"), marks.alias("mark"))
    digests = save(rows.mapInArrow(_digest_batches, "id bigint, mark bigint, key binary"), "digests")
    slices = max(1, -(-digests.count() // slice_rows))
    bits = (slices - 1).bit_length()

    left = max(1, digests.rdd.getNumPartitions())
    runs = digests.select("id", "mark", "key").mapInArrow(_run_maker(bits, left, keep == "max"), RUN)
    merge = _merger(fan_in, keep == "max")
    while True:
        runs = runs.groupBy("slice", F.expr(f"run div {fan_in}").alias("next")).applyInArrow(merge, RUN)
        left = -(-left // fan_in)
        if left <= 1:
            break
    best = runs.mapInArrow(_open, "key binary, keep_id bigint, keep_mark bigint, group_size bigint")
    return digests.join(best, "key").select(
        "id",
        "mark",
        "keep_id",
        "group_size",
        (F.col("mark") == F.col("keep_mark")).alias("kept"),
        F.lower(F.hex(F.substring("key", 1, 32))).alias("digest"),
    )


def drop_exact_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "max") -> DataFrame:
    """The rows that stay, with the columns of ``docs``; the rules are those of ``exact_groups``."""
    mark = fresh(docs, "mark")
    groups = exact_groups(docs.withColumn(mark, row_mark(docs)), id_column, text_column, mark, keep).filter("kept")
    # rows alike in all columns share a mark, so all of them are marked as kept
    kept = groups.groupBy("id", "mark").agg(F.count(F.lit(1)).alias("rows"), F.lit(1).alias("times"))
    return take_rows(docs, id_column, kept)
