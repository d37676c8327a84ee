import random

import numpy as np
import public_tokenizers
import pytest
from cases import documents, empty
from tokenizers import Tokenizer

from wayfare.llm.bpe import WordTokenizer, encode_and_decode

PATH = str(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def test_words_and_ids_like_the_library(library):
    with open(PATH, encoding="utf-8") as file:
        words = WordTokenizer(file.read())
    draw = random.Random(4)
    letters = [chr(c) for c in range(1, 0x2C0)] + list("İΣςσ漢字한국어😀ﬁ̣́​")
    texts = [f"a{c}b {c}{c} 1{c}" for c in letters] + ["don't I'LL", "<|endoftext|>x<|startoftext|>", "<|endoftext", "ΑΣ ΣΑΣ", "", " "]
    texts += ["".join(draw.choice(letters) for _ in range(draw.randint(1, 60))) for _ in range(2000)]
    for text in texts:
        assert [i for w in words.words(text) for i in words.ids(w)] == library.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("block_bytes", [16 << 20, 100])
def test_round_trip_like_the_library(spark, library, block_bytes):
    docs = documents(spark).repartition(3)
    found = encode_and_decode(docs, PATH, block_bytes=block_bytes).collect()
    expected = []
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        expected.append((r.doc_id, len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)))
    assert sorted(((r.id, r.n_tokens, bytes(r.ids), r.decoded) for r in found), key=str) == sorted(expected, key=str)


def test_many_long_distinct_words(spark, library):
    """Texts without spaces: words as long as the texts, none of them twice, more than a task keeps."""
    draw = random.Random(8)
    rows = [(i, "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.choice([900, 1500, 4000])))) for i in range(2500)]
    docs = spark.createDataFrame(rows + [(9000, rows[0][1]), (9001, "x" * 300_000)], "doc_id bigint, text string")
    found = {r.id: (r.n_tokens, bytes(r.ids)) for r in encode_and_decode(docs, PATH, part_bytes=1 << 18).collect()}
    for r in docs.filter("doc_id % 100 = 0 or doc_id = 9001").collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert found[r.doc_id] == (len(ids), np.array(ids, "<u4").tobytes())
    assert len(found) == 2502 and found[9000] == found[0]


def test_texts_without_words_only(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "  \n")], "doc_id bigint, text string")
    assert sorted((r.id, r.n_tokens, bytes(r.ids), r.decoded) for r in encode_and_decode(docs, PATH).collect()) == [(i, 0, b"", "") for i in (1, 2, 3)]


def test_empty_table(spark):
    assert encode_and_decode(empty(documents(spark)), PATH).count() == 0


def test_other_tokenizers_are_refused():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file, pytest.raises(ValueError):
        WordTokenizer(file.read())
