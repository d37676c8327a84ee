"""BPE encoding and decoding through a table of distinct words.

Texts are split into words once; each block of texts keeps, instead of its words, their numbers in the block's own word
list. The lists are dealt out by a hash of the word, so that each distinct word of the whole table is encoded in one
place and once, and the ids return to their blocks, where they are joined to the texts by the words' positions.
Decoding joins ids with the id-to-piece table, whose size is that of the vocabulary.

Blocks, word lists and numbers travel packed (zstd): a word occurs once for each block and not for each occurrence.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import BoundedCache, save, small_batches, text_slices

BLOCK_BYTES = 16 << 20  # text of one block
PART_BYTES = 1 << 30  # text behind the distinct words of one part
# characters for which lower case, composition and white space are the same in Python and in the tokenizer
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-\xac\xae-įı-ʯ]*")


class WordTokenizer:
    """The parts of a tokenizer file with word-end BPE: splitting a text, and encoding one word."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        spec = json.loads(definition)
        self.library = Tokenizer.from_str(definition)
        self.library.no_truncation()
        self.library.no_padding()
        kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if kinds != ["NFC", "Replace", "Lowercase"] or [p["type"] for p in parts] != ["Split", "ByteLevel"]:
            raise ValueError("only tokenizers that compose, lower-case, split by a pattern and map bytes are supported")
        self.pattern = regex.compile(parts[0]["pattern"]["Regex"], regex.V1)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.special_pattern = re.compile(f"({'|'.join(names)})") if names else None
        self.bytes = _byte_characters()

    def words(self, text: str) -> list[str]:
        """The words to encode, in order; special tokens stand for themselves."""
        if self.special_pattern and any(name in text for name in self.special):
            out: list[str] = []
            for part in self.special_pattern.split(text):
                out += [part] if part in self.special else self._plain_words(part)
            return out
        return self._plain_words(text)

    def _plain_words(self, text: str) -> list[str]:
        if not text:
            return []
        if _PLAIN.fullmatch(text):
            return self.pattern.findall(text.lower())
        # elsewhere the library itself normalises and splits; it maps each byte to one printable character
        normal = self.library.normalizer.normalize_str(text)
        if normal.isprintable() and max(map(ord, normal), default=0) < 0x300:  # old, settled parts of Unicode
            return self.pattern.findall(normal)
        back = {c: b for b, c in enumerate(self.bytes)}
        split = self.library.pre_tokenizer.pre_tokenize_str(normal)
        return [bytes(back[c] for c in word).decode("utf-8", "surrogatepass") for word, _ in split]

    def ids(self, word: str) -> list[int]:
        if word in self.special:
            return [self.special[word]]
        mapped = "".join(self.bytes[b] for b in word.encode("utf-8"))
        return [t.id for t in self.library.model.tokenize(mapped)]

    def pieces(self) -> list[str | None]:
        table = self.library.get_vocab(with_added_tokens=True)
        out: list[str | None] = [None] * (max(table.values(), default=-1) + 1)
        for piece, number in table.items():
            out[number] = piece
        return out


def _byte_characters() -> list[str]:
    """A printable character for each byte: itself where it prints, else the next free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


@functools.lru_cache(maxsize=2)
def _tokenizer(definition: str) -> WordTokenizer:
    return WordTokenizer(definition)


def _compress(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _pack(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32, low bytes first of all of them, then the next: the planes compress well."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return _compress(planes.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_expand(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4")[:, 0]


def _bundle(fields: list[bytes]) -> bytes:
    return b"".join(len(f).to_bytes(4, "little") + f for f in fields)


def _fields(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        size = int.from_bytes(data[at : at + 4], "little")
        out.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    return out


# ------------------------------------------------------------------------------------------- first pass: split

SPLIT = "kind string, block bigint, part int, data binary"
BUNDLE_WORDS = 1 << 18  # words of the texts that are packed together


def _split_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int32(), pa.binary()]
    names = ["kind", "block", "part", "data"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def _close_block(block: int, parts: int, numbers: dict[str, int], texts: list[tuple]) -> Iterator[pa.RecordBatch]:
    """A block's texts as numbers of its words, and its word list by parts. Frequent words get the low numbers, which
    pack well. In a list the words are joined by line ends, which no word holds."""
    counts = np.bincount(np.concatenate([t[2] for t in texts]), minlength=len(numbers))
    rank = np.empty(len(numbers), np.uint32)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(numbers), dtype=np.uint32)
    start = 0
    while start < len(texts):
        end, held = start, 0
        while end < len(texts) and (end == start or held + len(texts[end][2]) <= BUNDLE_WORDS):
            held += len(texts[end][2])
            end += 1
        some = texts[start:end]
        ids = np.array([0 if t[0] is None else t[0] for t in some], "<i8").tobytes()
        known = bytes(t[0] is not None for t in some)
        marks = np.array([t[1] for t in some], "<i8").tobytes()
        sizes, codes = np.array([len(t[2]) for t in some]), rank[np.concatenate([t[2] for t in some])]
        yield _split_batch([("text", block, None, _bundle([_compress(ids), known, _compress(marks), _pack(sizes), _pack(codes)]))])
        start = end
    lists: list[list[str]] = [[] for _ in range(parts)]
    places: list[list[int]] = [[] for _ in range(parts)]
    words_by_rank = np.array(list(numbers), object)[np.argsort(rank)]
    for place, word in enumerate(words_by_rank.tolist()):
        part = zlib.crc32(word.encode("utf-8", "surrogatepass")) % parts
        lists[part].append(word)
        places[part].append(place)
    for part, words in enumerate(lists):
        if words:
            listed = _compress("\n".join(words).encode("utf-8", "surrogatepass"))
            steps = np.diff(np.array(places[part]), prepend=0)
            yield _split_batch([("words", block, part, _bundle([_pack(steps), listed]))])


def _split_step(definition, parts: int, block_bytes: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizer = _tokenizer(definition.value)
        block, numbers, texts, read = TaskContext.get().partitionId() << 32, {}, [], 0
        for whole in batches:
            for batch in text_slices(whole, "text", 8 << 20):
                for row in batch.to_pylist():
                    text = row["text"] or ""
                    words = tokenizer.words(text)
                    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.uint32, len(words))
                    texts.append((row["id"], row["mark"], codes))
                    read += len(text) + 16
                    if read >= block_bytes:
                        yield from _close_block(block, parts, numbers, texts)
                        block, numbers, texts, read = block + 1, {}, [], 0
        if texts:
            yield from _close_block(block, parts, numbers, texts)

    return step


# ------------------------------------------------------------------------------------------- second pass: encode

ENCODED = "block bigint, data binary"


def _encode_step(definition):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(definition.value)
        known, part = BoundedCache(tokenizer.ids, 44), None  # an id for each byte of a word at most
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != part:  # rows are sorted by part, and a word has one part only
                    part, known = row["part"], BoundedCache(tokenizer.ids, 44)
                places, listed = _fields(row["data"])
                words = _expand(listed).decode("utf-8", "surrogatepass").split("\n")
                found = [known[word] for word in words]
                lengths = np.array([len(i) for i in found])
                flat = np.fromiter((i for ids in found for i in ids), np.uint32, int(lengths.sum()))
                data = _bundle([places, _pack(lengths), _pack(flat)])
                yield pa.RecordBatch.from_arrays([pa.array([row["block"]]), pa.array([data], pa.binary())], ["block", "data"])

    return step


# ------------------------------------------------------------------------------------------- third pass: join by position

JOINED = "id bigint, mark bigint, n_tokens bigint, ids binary, decoded string"


def _gather(starts: np.ndarray, lengths: np.ndarray, flat: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The ids of a text's words, one after the other."""
    many = lengths[codes]
    ends = np.cumsum(many)
    inner = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - many, many)
    return flat[np.repeat(starts[codes], many) + inner]


def _join_step(pieces):
    def join(texts: pa.Table, lists: pa.Table) -> pa.Table:
        table = np.array(pieces.value, object)
        places, sizes, flats = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        for data in lists.column("data").to_pylist():
            fields = [_unpack(f) for f in _fields(data)]
            places.append(np.cumsum(fields[0].astype(np.int64)))
            sizes.append(fields[1].astype(np.int64))
            flats.append(fields[2])
        place, size, flat = map(np.concatenate, (places, sizes, flats))
        starts, lengths = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        starts[place], lengths[place] = np.cumsum(size) - size, size
        out = []
        for data in texts.column("data").to_pylist():
            own, known, mark, sizes, codes = _fields(data)
            names = [i if k else None for i, k in zip(np.frombuffer(_expand(own), "<i8").tolist(), known)]
            ids, decoded, counts = [], [], []
            for part in np.split(_unpack(codes), np.cumsum(_unpack(sizes).astype(np.int64))[:-1]):
                found = _gather(starts, lengths, flat, part)
                ids.append(found.astype("<u4").tobytes())
                counts.append(len(found))
                decoded.append(" ".join(table[found].tolist()))
            columns = [
                pa.array(names, pa.int64()),
                pa.array(np.frombuffer(_expand(mark), "<i8")),
                pa.array(counts, pa.int64()),
                pa.array(ids, pa.binary()),
                pa.array(decoded, pa.string()),
            ]
            out.append(pa.RecordBatch.from_arrays(columns, ["id", "mark", "n_tokens", "ids", "decoded"]))
        return pa.Table.from_batches(out)

    return join


def encode_and_decode(
    docs: DataFrame,
    tokenizer_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    mark: str | None = None,
    block_bytes: int = BLOCK_BYTES,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """One row per document: ``id, mark, n_tokens, ids`` (little-endian 32-bit unsigned integers) and ``decoded``.

    The ids are those of the tokenizer file at ``tokenizer_path`` without added start or end, truncation or padding;
    the strings of special tokens in a text become their ids, as the library has it. ``decoded`` is its decode(ids)
    with special tokens: the pieces with a space between. NULL counts as the empty text, which has no ids. Other columns
    are not read; an empty table gives no rows. ``mark`` is passed through, or made up where there is none. The driver
    reads the tokenizer file and hands it to the tasks; its size does not depend on the data. Words are dealt out to as many
    parts as the session has shuffle partitions, and to more where a part would stand for over ``part_bytes`` of text; a
    task keeps the ids of a part's words up to 64 MB and encodes words anew beyond that.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        text = file.read()
    definition = spark.sparkContext.broadcast(text)
    pieces = spark.sparkContext.broadcast(_tokenizer(text).pieces())

    small_batches(spark)
    marks = F.col(mark) if mark else F.monotonically_increasing_id()
    size = docs.agg(F.sum(F.octet_length(F.col(text_column)).cast("bigint"))).first()[0] or 0
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // part_bytes))
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"), marks.alias("mark"))
    split = save(rows.mapInArrow(_split_step(definition, parts, block_bytes), SPLIT), "split")
    lists = split.filter("kind = 'words'").select("block", "part", "data").repartition(parts, "part").sortWithinPartitions("part")
    encoded = lists.mapInArrow(_encode_step(definition), ENCODED)
    texts = split.filter("kind = 'text'").select("block", "data")
    return texts.groupBy("block").cogroup(encoded.groupBy("block")).applyInArrow(_join_step(pieces), JOINED)
