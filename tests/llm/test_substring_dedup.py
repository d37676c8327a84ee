import random
import re
from collections import defaultdict

import pytest
from cases import LONG, documents, empty

from wayfare.llm import anchored
from wayfare.llm.substring_dedup import drop_repeated_passages, earlier_spans

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def words_of(text):
    return WORDS.findall((text or "").encode())


def plain(rows, window):
    """(id, words, removed, kept) of (id, mark, text) rows: what starts earlier is in the row before or further left."""
    first = {}
    for row in sorted({(i is None, i or 0, mark, text) for i, mark, text in rows}, key=lambda r: r[:3]):
        words = words_of(row[3])
        for at in range(len(words) - window + 1):
            first.setdefault(tuple(words[at : at + window]), (row[:3], at))
    out = []
    for i, mark, text in rows:
        words, gone = words_of(text), set()
        for at in range(len(words) - window + 1):
            if first[tuple(words[at : at + window])] != ((i is None, i or 0, mark), at):
                gone |= set(range(at, at + window))
        out.append((i, len(words), len(gone), b" ".join(w for n, w in enumerate(words) if n not in gone).decode()))
    return sorted(out, key=str)


def assert_like_plain(spark, docs, window, **options):
    rows = [tuple(r) for r in docs.selectExpr("doc_id", "coalesce(xxhash64(text), 0)", "coalesce(text, '')").collect()]
    found = drop_repeated_passages(docs, window=window, **options).collect()
    assert sorted(((r.id, r.n_words, r.n_removed, r.kept) for r in found), key=str) == plain(rows, window)
    for r in found:
        spans = [(s.start, s.end) for s in r.removed]
        assert sum(b - a for a, b in spans) == r.n_removed and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def passages(spark, seed=3):
    """Documents of few words, with passages that many of them share, in whole and in part."""
    draw = random.Random(seed)
    word = lambda: draw.choice(["a", "b", "ce", "dog", "é", "f" * 80])
    shared = [[word() for _ in range(30)] for _ in range(4)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(draw.randint(0, 5)):
            passage = draw.choice(shared)
            start = draw.randint(0, 20)
            parts += [word() for _ in range(draw.randint(0, 6))] + passage[start : start + draw.randint(1, 30)]
        rows.append((None if i % 17 == 0 else i // 2, draw.choice([" ", "\n", " \t"]).join(parts)))
    return spark.createDataFrame(rows, "doc_id bigint, text string")


@pytest.mark.parametrize("window, gram", [(20, 8), (5, 2), (3, 3), (1, 1)])
def test_like_brute_force_on_awkward_rows(spark, window, gram):
    docs = documents(spark).filter("length(text) < 10000 or text is null")
    assert_like_plain(spark, docs, window, gram=gram)


@pytest.mark.parametrize("options", [{}, {"hot_words": 10}, {"shard_words": 50, "slice_bytes": 200}, {"hot_words": 0, "slice_bytes": 50, "run_rows": 1}])
def test_like_brute_force_on_shared_passages(spark, options):
    assert_like_plain(spark, passages(spark).repartition(5), 8, gram=3, **options)


def test_long_repeating_text(spark):
    docs = spark.createDataFrame([(2, LONG), (1, "lorem ipsum dolor sit amet consectetur " * 5)], "doc_id int, text string")
    found = {r.id: r for r in drop_repeated_passages(docs).collect()}
    assert (found[1].n_removed, found[2].n_removed) == (24, 180_000) and found[2].kept == ""
    assert [(s.start, s.end) for s in found[1].removed] == [(6, 30)]


def test_spans_of_the_automaton_like_brute_force():
    draw = random.Random(1)
    for _ in range(800):
        window, letters = draw.choice([1, 2, 3, 5]), draw.choice([1, 2, 3])
        sequences = [[draw.randrange(letters) for _ in range(draw.randrange(25))] for _ in range(draw.randrange(1, 8))]
        seen, expected = set(), []
        for words in sequences:
            gone = set()
            for at in range(len(words) - window + 1):
                if tuple(words[at : at + window]) in seen:
                    gone |= set(range(at, at + window))
                seen.add(tuple(words[at : at + window]))
            expected.append(gone)
        found = [set() for _ in sequences]
        for number, start, size in earlier_spans(sequences, window):
            assert not found[number] & set(range(start, start + size))
            found[number] |= set(range(start, start + size))
        assert found == expected


@pytest.mark.parametrize("block", [1 << 20, 40, 7])
def test_stretches_hold_every_window_once(monkeypatch, block):
    monkeypatch.setattr(anchored, "BLOCK_BYTES", block)
    draw = random.Random(block)
    for _ in range(25):
        texts = ["".join(draw.choice(["a", "bb ", "c ", "é", " ", "\n"]) for _ in range(draw.choice([0, 1, 5, 50, 300]))) for _ in range(6)]
        window, gram, most = draw.choice([4, 5, 20]), draw.choice([1, 2, 4]), draw.choice([1, 3, 64])
        seen, anchors, digests = defaultdict(int), {}, {}
        for columns in anchored.stretches([t.encode() for t in texts], window, gram, most):
            for text, start, size, anchor, digest, loops in zip(*(c.tolist() for c in columns)):
                words = words_of(texts[text])
                assert window <= size <= window + most - 1 and start + size <= len(words)
                assert digests.setdefault(tuple(words[start : start + size]), digest) == digest
                windows = [tuple(words[at : at + window]) for at in range(start, start + size - window + 1)]
                assert loops or len(set(windows)) == len(windows)
                for at, held in enumerate(windows, start):
                    seen[text, at] += 1
                    assert anchors.setdefault(held, anchor) == anchor
        every = {(i, at) for i, t in enumerate(texts) for at in range(len(words_of(t)) - window + 1)}
        assert set(seen) == every and set(seen.values()) <= {1}


def test_empty_table(spark):
    assert drop_repeated_passages(empty(documents(spark))).count() == 0
    with pytest.raises(ValueError):
        drop_repeated_passages(documents(spark), gram=21)
