"""Token counts under a unigram vocabulary, by a Viterbi pass that counts and builds no tokens.

An Aho-Corasick automaton lists, for every end in a word, the vocabulary pieces that end there. The dynamic programme
carries two numbers for each place, the best score of a way to it and the number of pieces on that way.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import BoundedCache, small_batches, text_slices

MARK = "▁"  # stands for the space before a word
UNKNOWN_PENALTY = 10.0  # below the lowest score of the vocabulary
CACHE_BYTES = 64 << 20  # of words whose counts a task keeps


class UnigramCounter:
    """Counts the pieces of the best segmentation of a word.

    Ties go as in the unigram models of the tokenizers library: pieces are tried by their start, and a later way must be
    better to replace an earlier one, so of equal ways to a place the one with the longest last piece stays. Where no
    piece of one character starts, an unknown one does. Unknown pieces that follow each other are one; with byte pieces
    each of its bytes counts.
    """

    def __init__(self, vocabulary: Sequence[tuple[str, float]], unknown: int, byte_fallback: bool):
        self.automaton = ahocorasick.Automaton()
        self.names = {piece for piece, _ in vocabulary}
        for i, (piece, score) in enumerate(vocabulary):
            self.automaton.add_word(piece, (len(piece), float(score), i == unknown))
        if len(self.automaton):
            self.automaton.make_automaton()
        self.longest = max(map(len, self.names), default=0) + 1
        self.unknown_score = min((float(s) for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self.bytes = byte_fallback and all(f"<0x{b:02X}>" in self.names for b in range(256))

    def count(self, word: str) -> int:
        """Number of pieces of ``word``, in memory that does not grow with it."""
        matches = self.automaton.iter(word) if len(self.automaton) else iter(())
        last, way = next(matches, (-1, None))
        # for each place: best score, pieces, and of the unknown stretch it ends: start, bytes, pieces before it
        states, base = [(0.0, 0, 0, 0, 0)], 0
        for end in range(1, len(word) + 1):
            ways = []
            while last == end - 1:
                ways.append(way)
                last, way = next(matches, (-1, None))
            if len(ways) > 1:
                ways.sort(reverse=True)  # the longest first, hence by start
            if not ways or ways[-1][0] > 1:
                ways.append((1, self.unknown_score, True))
            length, score, unknown = ways[0]
            found = states[end - length - base][0] + score
            for other in ways[1:]:
                total = states[end - other[0] - base][0] + other[1]
                if total > found:
                    found, (length, score, unknown) = total, other
            start = end - length
            _, pieces, begun, width, before = states[start - base]
            if unknown:
                if not width:
                    begun, before = start, pieces
                width += len(word[start:end].encode("utf-8", "surrogatepass"))
                known = end - begun <= self.longest and word[begun:end] in self.names
                states.append((found, before + (width if self.bytes and not known else 1), begun, width, before))
            else:
                states.append((found, pieces + 1, end, 0, 0))
            if len(states) > 1 << 16:
                base += len(states) - self.longest
                del states[: len(states) - self.longest]
        return states[-1][1]


@functools.lru_cache(maxsize=2)
def _counter(vocabulary: tuple[tuple[str, float], ...], unknown: int, byte_fallback: bool) -> UnigramCounter:
    return UnigramCounter(vocabulary, unknown, byte_fallback)


def _count_step(model):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(*model.value).count
        counts = BoundedCache(lambda word: count(MARK + word), 4, CACHE_BYTES)
        for whole in batches:
            for batch in text_slices(whole, "text", 8 << 20):
                tokens, words = [], []
                for text in batch.column("text").to_pylist():
                    # every space is the mark of the word after it; only a text that begins with none gets one more
                    text = (text or "").replace(MARK, " ")
                    parts = text.removeprefix(" ").split(" ") if text else []
                    tokens.append(sum(map(counts.__getitem__, parts)))
                    words.append(len(parts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(tokens, pa.int64()), pa.array(words, pa.int64())], ["id", "n_tokens", "n_words"]
                )

    return step


def read_vocabulary(path: str) -> tuple[tuple[tuple[str, float], ...], int, bool]:
    """Pieces with the file's own scores, the number of the unknown piece and whether there are byte pieces.

    ``path`` is a sentencepiece model file; its control pieces, which no text yields, are left out.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not model.is_control(i)]
    rows = tuple((model.id_to_piece(i), float(model.get_score(i))) for i in ids)
    return rows, ids.index(model.unk_id()), any(model.is_byte(i) for i in ids)


def token_counts(
    docs: DataFrame,
    vocabulary: Sequence[tuple[str, float]],
    unknown: int = 0,
    byte_fallback: bool = True,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: ``id, n_tokens, n_words``.

    A text is cut before every space, the space becomes ``MARK``, and each word is segmented for itself, as the tokenizers
    library does with a Metaspace splitter that always puts a mark in front. NULL and the empty text have no tokens. Texts
    may have any length; other columns are not read. The vocabulary goes to every task: its size does not depend on the data.
    """
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast((tuple(vocabulary), unknown, byte_fallback))
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(_count_step(model), f"id {kind}, n_tokens bigint, n_words bigint")
