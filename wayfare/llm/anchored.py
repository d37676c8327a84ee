"""Word windows of texts and the anchors that equal windows share, in numpy."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import xxhash

LONG_WORD = 64  # bytes
BLOCK_BYTES = 1 << 18
_GAP = re.compile(rb"[\x20\x09-\x0D]")
_IS_GAP = np.array([b == 0x20 or 0x09 <= b <= 0x0D for b in range(256)])
# odd numbers that mix bits well
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


@functools.lru_cache(4)
def _powers(base: int, size: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, base, np.uint64))))


def _mixed(values: np.ndarray) -> np.ndarray:
    for factor in _MIX:
        values = (values ^ (values >> np.uint64(33))) * factor
    return values ^ (values >> np.uint64(33))


def _blocks(texts: list[bytes]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """Bytes of whole words, with the starts of the pieces of texts they come from and the texts' numbers."""
    pieces: list[bytes] = []
    owners: list[int] = []
    held = 0

    def joined():
        starts = np.cumsum([0] + [len(p) + 1 for p in pieces[:-1]])
        return b"\n".join(pieces), starts, np.array(owners)

    for owner, text in enumerate(texts):
        at = 0
        while at < len(text):
            gap = _GAP.search(text, at + BLOCK_BYTES)
            end = gap.start() if gap else len(text)
            pieces.append(text[at:end])
            owners.append(owner)
            held += end - at
            at = end
            if held >= BLOCK_BYTES:
                yield joined()
                pieces, owners, held = [], [], 0
    if pieces:
        yield joined()


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte and hash of every word."""
    raw = np.frombuffer(data, np.uint8)
    edges = np.flatnonzero(np.diff(_IS_GAP[raw], prepend=True, append=True))
    first, end = edges[::2], edges[1::2]
    size = 1 << max(len(raw), 1).bit_length()
    ahead, back = _powers(_BASE, size), _powers(_INVERSE, size)
    sums = _sums((raw + np.uint64(1)) * ahead[: len(raw)])
    hashes = _mixed((sums[end] - sums[first]) * back[first])
    for i in np.flatnonzero(end - first > LONG_WORD):  # two long words can be made to agree in such a sum
        hashes[i] = xxhash.xxh64_intdigest(data[first[i] : end[i]])
    return first, hashes


def _sums(values: np.ndarray) -> np.ndarray:
    """Sums of the values before each place, modulo 2^64."""
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - (width - span)], values[width - span :]) if width > span else values


def word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, by blocks that end at white space."""
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + BLOCK_BYTES)
        end = gap.start() if gap else len(text)
        yield text[at:end].split()
        at = end


def runs_of_words(text: bytes, runs: list[tuple[int, int]]) -> Iterator[bytes]:
    """The words of each run (first word, number of words), joined by one space; runs ascend, one past the end is empty."""
    words: list[bytes] = []
    base = at = 0
    for block in word_blocks(text):
        words += block
        while at < len(runs) and sum(runs[at]) <= base + len(words):
            start, count = runs[at]
            yield b" ".join(words[start - base : start - base + count])
            at += 1
        if at == len(runs):
            return
        passed = max(0, min(len(words), runs[at][0] - base))
        words, base = words[passed:], base + passed
    for _ in runs[at:]:
        yield b""


def stretches(texts: list[bytes], window: int, gram: int, most: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Text number, first word, number of words, anchor, digest, and whether a window may come twice, of stretches that
    hold every window of every text once.

    The anchor of a window is the least hash of its ``gram``-word runs, so equal windows have equal anchors, in whatever
    texts they are. Windows in a row that share an anchor are one stretch, of at most ``most`` windows. The digest is a
    64-bit hash of all its words. Texts are taken in blocks of fixed size, so memory does not grow with their length.
    """
    carried_hashes, carried_texts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first_words = np.full(len(texts), -1, np.int64)
    done = 0  # words before the carried ones
    for data, starts, owners in _blocks(texts):
        first, hashes = _word_hashes(data)
        owner = owners[np.searchsorted(starts, first, "right") - 1]
        hashes, owner = np.concatenate((carried_hashes, hashes)), np.concatenate((carried_texts, owner))
        seen, at = np.unique(owner, return_index=True)
        new = first_words[seen] < 0
        first_words[seen[new]] = done + at[new]
        if len(hashes) >= window:
            value = hashes[: len(hashes) - gram + 1].copy()
            for i in range(1, gram):
                value = value * np.uint64(_BASE) + hashes[i : len(hashes) - gram + 1 + i]
            value, width = _mixed(value), window - gram + 1
            anchor = _least(value, width)
            times = np.zeros(len(anchor), np.int16)
            for i in range(width):
                times += value[i : len(anchor) + i] == anchor
            several = np.concatenate(([0], np.cumsum(times > 1)))
            whole = owner[: len(anchor)] == owner[window - 1 :]
            opens = whole.copy()
            opens[1:] &= ~whole[:-1] | (anchor[1:] != anchor[:-1])
            start = np.flatnonzero(opens)
            # a stretch ends where the next opens or a window is not whole
            stops = np.flatnonzero(opens | ~whole)
            end = np.append(stops, len(anchor))[np.searchsorted(stops, start, "right")]
            parts = -(-(end - start) // most)
            part = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            start, end = np.repeat(start, parts) + part * most, np.repeat(end, parts)
            count = np.minimum(end - start, most)
            text, size = owner[start], count + window - 1
            length = 1 << len(hashes).bit_length()
            sums = _sums(hashes * _powers(_BASE, length)[: len(hashes)])
            digest = _mixed((sums[start + size] - sums[start]) * _powers(_INVERSE, length)[start] + size.astype(np.uint64))
            # a window that comes twice has its anchor twice; a single anchor is in ``width`` windows at most
            loops = (several[start + count] > several[start]) | (count > width)
            yield text, done + start - first_words[text], size, anchor[start].view(np.int64), digest.view(np.int64), loops
        keep = min(window - 1, len(hashes))
        done += len(hashes) - keep
        carried_hashes, carried_texts = hashes[len(hashes) - keep :], owner[len(owner) - keep :]
