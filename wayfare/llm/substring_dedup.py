"""Substring deduplication by suffix automata of reference shards.

A window is a run of ``window`` words. Texts are cut into stretches of windows that share an anchor, the least hash of
the short word runs inside a window; equal windows have equal anchors, so an anchor's stretches can be looked at apart
from all others. Equal stretches are one: all but the first go, and a task drops them before the shuffle. What is left
of anchors with several different stretches is the reference. It is cut into shards of bounded size; a shard's task
builds the suffix automaton of its words and streams its stretches through it. Matching statistics of ``window`` or more
words whose first place lies earlier give the spans to remove.

Broadcasting every shard to every text would cost shards times texts, which grows with the square of the table; by
anchors a text's stretches meet only the shards that can match them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.anchored import runs_of_words, stretches, word_blocks
from wayfare.llm.common import save, small_batches, text_slices

WINDOW = 20
GRAM = 8
MOST_WINDOWS = 64  # of a stretch
RUN_ROWS = 1 << 19  # stretches that a task sorts at once
SLICE_BYTES = 32 << 20  # of text behind the stretches that one task compares
SHARD_WORDS = 200_000
HOT_WORDS = 50_000  # an anchor with more words in different stretches is compared window by window
NO_ID = np.iinfo(np.int64).max

RUN = "slice bigint, ids binary, marks binary, owners binary, starts binary, sizes binary, anchors binary, digests binary, loops binary"
FOUND = "whole boolean, id bigint, mark bigint, start bigint, size int, anchor bigint"
HIT = "id bigint, mark bigint, start bigint, size int"
KINDS = dict(ids="<i8", marks="<i8", owners="<i4", starts="<i8", sizes="<i4", anchors="<i8", digests="<i8", loops="|i1")


def _planes(values: np.ndarray, kind: str) -> bytes:
    """The values' bytes, the first of each, then the second of each; most planes of small numbers are zeros."""
    cells = np.ascontiguousarray(values, kind)
    return np.ascontiguousarray(cells.view(np.uint8).reshape(-1, cells.itemsize).T).tobytes()


def _from_planes(data: bytes, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind)[:, 0]


def _pack(number: int, docs: tuple[np.ndarray, np.ndarray], rows: dict[str, np.ndarray]) -> pa.RecordBatch:
    used, owners = np.unique(rows["owners"], return_inverse=True)
    columns = rows | {"ids": docs[0][used], "marks": docs[1][used], "owners": owners}
    cells = [pa.array([_planes(columns[name], kind)], pa.binary()) for name, kind in KINDS.items()]
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *cells], ["slice", *KINDS])


def _firsts(docs: tuple[np.ndarray, np.ndarray], rows: dict[str, np.ndarray]) -> tuple[dict, dict]:
    """Of equal stretches the first (by identifier, mark and place), in the order of anchors, and all later ones."""
    order = np.lexsort((docs[1], docs[0]))
    ids, marks = docs[0][order], docs[1][order]
    new = np.append(False, (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1])) if len(ids) else np.zeros(0, bool)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    document = rank[rows["owners"]]
    by = np.lexsort((rows["starts"], document, rows["digests"], rows["anchors"]))
    rows, document = {k: v[by] for k, v in rows.items()}, document[by]
    same = np.zeros(len(by), bool)
    same[1:] = (rows["anchors"][1:] == rows["anchors"][:-1]) & (rows["digests"][1:] == rows["digests"][:-1])
    opens = np.maximum.accumulate(np.where(same, 0, np.arange(len(by))))
    # rows alike in identifier and text are one document: what starts at the same word is the first too
    later = same & ((document != document[opens]) | (rows["starts"] != rows["starts"][opens]))
    return {k: v[~same] for k, v in rows.items()}, {k: v[later] for k, v in rows.items()}


def _scan_step(window: int, gram: int, most: int, slices: int, run_rows: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        apart = -1 - (TaskContext.get().partitionId() << 32)  # later stretches pass the exchange in groups of their own
        docs: list[tuple[np.ndarray, np.ndarray]] = []
        held: list[tuple[np.ndarray, ...]] = []
        count = documents = 0

        def flush():
            nonlocal apart
            table = tuple(np.concatenate([d[i] for d in docs]) for i in range(2))
            names = ("owners", "starts", "sizes", "anchors", "digests", "loops")
            rows = {name: np.concatenate([h[i] for h in held]) for i, name in enumerate(names)}
            first, later = _firsts(table, rows)
            if len(later["owners"]):
                yield _pack(apart, table, later)
                apart -= 1
            numbers = (first["anchors"].view(np.uint64) % np.uint64(slices)).astype(np.int64)
            by = np.argsort(numbers, kind="stable")
            cuts = np.flatnonzero(np.diff(numbers[by])) + 1
            for part in np.split(by, cuts):
                yield _pack(int(numbers[part[0]]), table, {k: v[part] for k, v in first.items()})

        for whole in batches:
            for batch in text_slices(whole, "text", 4 << 20):
                texts = [t.as_py() or b"" for t in batch.column("text").cast(pa.large_binary())]
                ids = batch.column("id").fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
                docs.append((ids, batch.column("mark").to_numpy(zero_copy_only=False)))
                for owner, *rest in stretches(texts, window, gram, most):
                    if len(owner):
                        held.append((owner + documents, *rest))
                    count += len(owner)
                documents += len(texts)
                if max(count, documents) >= run_rows:
                    if held:
                        yield from flush()
                    docs, held, count, documents = [], [], 0, 0
        if held:
            yield from flush()

    return step


def _merge_slice(table: pa.Table) -> pa.Table:
    number = table.column("slice")[0].as_py()
    parts, documents = [], 0
    for row in table.to_pylist():
        part = {name: _from_planes(row[name], kind) for name, kind in KINDS.items()}
        part["owners"] = part["owners"].astype(np.int64) + documents
        documents += len(part["ids"])
        parts.append(part)
    columns = {name: np.concatenate([p[name] for p in parts]) for name in KINDS}
    docs = columns.pop("ids"), columns.pop("marks")
    if number < 0:
        out, whole = columns, np.ones(len(columns["owners"]), bool)
    else:
        first, later = _firsts(docs, columns)
        alike = first["anchors"][1:] == first["anchors"][:-1]
        shared = first["loops"].astype(bool)
        shared[1:] |= alike
        shared[:-1] |= alike
        out = {k: np.concatenate((first[k][shared], later[k])) for k in first}
        whole = np.arange(len(out["owners"])) >= shared.sum()
    ids, marks = docs[0][out["owners"]], docs[1][out["owners"]]
    cells = [whole, ids, marks, out["starts"], out["sizes"].astype(np.int32), out["anchors"]]
    return pa.table([pa.array(c) for c in cells], names=["whole", "id", "mark", "start", "size", "anchor"])


def _words_step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in text_slices(whole, "text", 4 << 20):
            rows = batch.select(["id", "mark", "wanted"]).to_pylist()
            texts, out = batch.column("text").cast(pa.large_binary()), []
            for row, text in zip(rows, texts):
                wanted = sorted((w["start"], w["size"], w["anchor"]) for w in row["wanted"])
                found = runs_of_words(text.as_py() or b"", [w[:2] for w in wanted])
                out += [(row["id"], row["mark"], start, size, anchor, words) for (start, size, anchor), words in zip(wanted, found)]
                if len(out) >= 20_000:
                    yield _columns(out)
                    out = []
            if out:
                yield _columns(out)


def _columns(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
    cells = [pa.array(values, kind) for values, kind in zip(zip(*rows), types)]
    return pa.RecordBatch.from_arrays(cells, ["id", "mark", "start", "size", "anchor", "words"])


class SuffixAutomaton:
    """The suffix automaton of several word sequences; each state knows where its words first end.

    Sequences are added in the order of their places, so the first end of a state is its earliest one.
    """

    def __init__(self) -> None:
        self.following: list[dict[int, int]] = [{}]
        self.suffix = [-1]
        self.length = [0]
        self.first_end = [-1]

    def _state(self, following: dict[int, int], suffix: int, length: int, end: int) -> int:
        self.following.append(following)
        self.suffix.append(suffix)
        self.length.append(length)
        self.first_end.append(end)
        return len(self.length) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """A copy of ``target`` for the shorter words that ``state`` and its suffixes lead to."""
        copy = self._state(dict(self.following[target]), self.suffix[target], self.length[state] + 1, self.first_end[target])
        self.suffix[target] = copy
        while state >= 0 and self.following[state].get(word) == target:
            self.following[state][word] = copy
            state = self.suffix[state]
        return copy

    def add(self, words: list[int], end: int) -> None:
        """Add a sequence whose first word ends at place ``end``, the next one at ``end`` + 1, and so on."""
        last = 0
        for word in words:
            target = self.following[last].get(word)
            if target is not None:  # these words were there before
                last = target if self.length[target] == self.length[last] + 1 else self._split(last, word, target)
            else:
                state, new = last, self._state({}, 0, self.length[last] + 1, end)
                while state >= 0 and word not in self.following[state]:
                    self.following[state][word] = new
                    state = self.suffix[state]
                if state >= 0:
                    target = self.following[state][word]
                    fits = self.length[target] == self.length[state] + 1
                    self.suffix[new] = target if fits else self._split(state, word, target)
                last = new
            end += 1

    def first_ends(self, words: list[int], window: int) -> Iterator[int | None]:
        """At each word, where the last ``window`` words first end; None while fewer than that match."""
        state = matched = 0
        for word in words:
            while state and word not in self.following[state]:
                state = self.suffix[state]
                matched = self.length[state]
            state = self.following[state].get(word)
            if state is None:
                state, matched = 0, 0
            else:
                matched += 1
                while self.length[self.suffix[state]] >= window:  # the state of the last ``window`` words themselves
                    state = self.suffix[state]
                    matched = self.length[state]
            yield self.first_end[state] if matched >= window else None


def earlier_spans(sequences: list[list[int]], window: int) -> Iterator[tuple[int, int, int]]:
    """Number of the sequence, first word and number of words of each maximal run of windows that came before."""
    automaton, ends, place = SuffixAutomaton(), [], 0
    for words in sequences:
        ends.append(place)
        automaton.add(words, place)
        place += len(words) + 1
    for number, words in enumerate(sequences):
        start = stop = -1
        for at, end in enumerate(automaton.first_ends(words, window)):
            if end is not None and end < ends[number] + at:
                if at - window + 1 > stop:
                    if stop > start >= 0:
                        yield number, start, stop - start
                    start = at - window + 1
                stop = at + 1
        if stop > start >= 0:
            yield number, start, stop - start


def _match_step(window: int):
    def match(table: pa.Table) -> pa.Table:
        rows = sorted(table.select(["id", "mark", "start", "words"]).to_pylist(), key=lambda r: (r["id"], r["mark"], r["start"]))
        numbers: dict[bytes, int] = {}
        sequences = [[numbers.setdefault(w, len(numbers)) for w in r["words"].split(b" ")] for r in rows]
        out = [(rows[i]["id"], rows[i]["mark"], rows[i]["start"] + start, size) for i, start, size in earlier_spans(sequences, window)]
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int32())
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=["id", "mark", "start", "size"])

    return match


def _same_document(left: DataFrame, right: DataFrame) -> Column:
    return (left["id"] == right["id"]) & (left["mark"] == right["mark"])


def _hits_by_window(stretches_: DataFrame, window: int) -> DataFrame:
    """The later ones of equal windows, each window counted for itself; for anchors that very many stretches share."""
    words = F.split(F.col("words").cast("string"), " ", -1)
    at = F.explode(F.sequence(F.lit(0), F.col("size") - window))
    rows = stretches_.select("id", "mark", "start", words.alias("words"), at.alias("at"))
    text = F.array_join(F.slice("words", F.col("at") + 1, window), " ")
    keys = [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]
    rows = save(rows.select("id", "mark", (F.col("start") + F.col("at")).alias("start"), *keys), "windows")
    first = F.min(F.struct("id", "mark", "start")).alias("first")
    firsts = save(rows.groupBy("k1", "k2").agg(first), "first-windows")  # for AQE to split a window that many share
    joined = rows.join(firsts, ["k1", "k2"]).filter(F.struct("id", "mark", "start") > F.col("first"))
    return joined.select("id", "mark", "start", F.lit(window).alias("size"))


def repeated_spans(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    shard_words: int = SHARD_WORDS,
    hot_words: int = HOT_WORDS,
    slice_bytes: int = SLICE_BYTES,
    run_rows: int = RUN_ROWS,
) -> DataFrame:
    """``id, mark, spans`` of the documents with windows that also start earlier; ``spans`` are (start, size) in words.

    ``mark`` is ``xxhash64`` of the text and an absent identifier is the largest ``bigint``; the spans may overlap.
    """
    if not 0 < gram <= window:
        raise ValueError("gram must be between 1 and window")
    small_batches(docs.sparkSession)
    rows = _rows(docs, id_column, text_column)
    size = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    slices = max(1, -(-size // slice_bytes))
    runs = rows.mapInArrow(_scan_step(window, gram, max(window, MOST_WINDOWS), slices, run_rows), RUN)
    found = save(runs.groupBy("slice").applyInArrow(_merge_slice, FOUND), "stretches")

    wanted = found.filter("not whole")
    words = wanted.agg(F.sum("size")).first()[0] or 0
    hits = found.filter("whole").select("id", "mark", "start", "size")
    if words:
        lists = wanted.groupBy("id", "mark").agg(F.collect_list(F.struct("start", "size", "anchor")).alias("wanted"))
        lists = save(lists, "wanted").hint("shuffle_hash")
        texts = rows.join(lists, _same_document(rows, lists)).select(rows.id, rows.mark, "text", "wanted")
        reference = texts.mapInArrow(_words_step, f"{HIT}, anchor bigint, words binary")
        # documents repeated in full bring the same stretches
        reference = save(reference.dropDuplicates(["anchor", "id", "mark", "start"]), "reference")
        hot = reference.groupBy("anchor").agg(F.sum("size").alias("n")).filter(F.col("n") > hot_words).select("anchor")
        if not hot.isEmpty():
            hot = save(hot, "hot-anchors")
            hits = hits.unionByName(_hits_by_window(reference.join(hot, "anchor", "left_semi"), window))
            reference = reference.join(hot, "anchor", "left_anti")
        shards = max(1, -(-words // shard_words))
        shard = F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard")
        dealt = reference.select("id", "mark", "start", "words", shard).groupBy("shard")
        hits = hits.unionByName(dealt.applyInArrow(_match_step(window), HIT))
    return save(hits.groupBy("id", "mark").agg(F.collect_list(F.struct("start", "size")).alias("spans")), "spans")


def _rows(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.col(f"`{text_column}`")
    key = F.coalesce(F.col(f"`{id_column}`").cast("bigint"), F.lit(int(NO_ID)))
    return docs.select(key.alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def _cut(text: bytes, spans: list[tuple[int, int]]) -> tuple[int, list[tuple[int, int]], bytes]:
    """Number of words, the spans merged to maximal ones (first word, end), and the words outside them."""
    merged: list[list[int]] = []
    for start, size in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], start + size)
        else:
            merged.append([start, start + size])
    kept, base, at = [], 0, 0
    for words in word_blocks(text):
        left = 0
        while at < len(merged) and merged[at][0] < base + len(words):
            start, end = merged[at]
            kept += words[left : max(start - base, left)]
            left = min(end - base, len(words))
            if end > base + len(words):
                break
            at += 1
        base += len(words)
        kept += words[left:]
        kept = [b" ".join(kept)] if kept else []
    return base, [(a, b) for a, b in merged], b" ".join(kept)


CUT = "id bigint, n_words bigint, n_removed bigint, removed array<struct<start:bigint,end:bigint>>, kept string"


def _cut_step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for whole in batches:
        for batch in text_slices(whole, "text", 4 << 20):
            out = []
            for text, spans in zip(batch.column("text").cast(pa.large_binary()), batch.column("spans").to_pylist()):
                pairs = [(s["start"], s["size"]) for s in spans or ()]
                words, removed, kept = _cut(text.as_py() or b"", pairs)
                out.append((words, sum(b - a for a, b in removed), [{"start": a, "end": b} for a, b in removed], kept.decode()))
            cells = [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), span, pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *cells], ["id", "n_words", "n_removed", "removed", "kept"])


def drop_repeated_passages(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, **options
) -> DataFrame:
    """One row per document: ``id, n_words, n_removed, removed, kept``.

    A word goes if some run of ``window`` words around it also starts earlier: in a document with a smaller identifier, or
    earlier in the same one. All runs are judged on the input. ``removed`` has the maximal spans as (start, end) in words,
    ``kept`` the other words joined by one space. Documents without identifier come after all others; documents that share
    an identifier are ordered by a hash of their text, and rows that share both are one document, so that each of them
    gets the same result. NULL counts as the empty text. Texts are read in blocks and may have any length; other columns
    are not read; an empty table gives no rows. Equal stretches are found by 128 bits of hashes, the rest word by word.
    """
    rows = _rows(docs, id_column, text_column)
    spans = repeated_spans(docs, id_column, text_column, window, **options).hint("shuffle_hash")
    joined = rows.join(spans, _same_document(rows, spans), "left")
    absent = F.when(rows.id != int(NO_ID), rows.id).alias("id")
    return joined.select(absent, "text", "spans").mapInArrow(_cut_step, CUT)
