"""Language identification by averaged hashed subword embeddings.

A text is the average of the embeddings of its hashed character n-grams, followed by a linear softmax. The model is
trained in numpy by stochastic gradient descent on a bounded sample of labelled rows (``rows_per_language`` rows of
every language, ``features_per_row`` n-grams of each); prediction reads every n-gram of every text. As the output is
linear in the average, each n-gram needs only its row of ``embeddings @ weights``.

A softmax is sure of anything, so rejection looks at the text too: how frequent its n-grams are in the language that is
predicted. What clean texts of the same length fall short of is calibrated on rows that training did not see.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import fresh, in_fold, least_of_groups, save, small_batches

UNKNOWN = "und"
ORDERS = (1, 2, 3)
BUCKET_BITS = 15  # buckets travel as 16-bit numbers
CHUNK = 1 << 19  # characters that are hashed at a time
SMOOTHING = 0.01  # share of a language's n-grams that is spread over all buckets
LENGTH_CLASSES = 11  # texts of 1, 2, 4 to 1,024 n-grams and more are calibrated apart
LEAST_ROWS = 20  # held-back rows that a length class needs
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    scores: np.ndarray  # one row per n-gram bucket, one column per language
    bias: np.ndarray
    temperature: float
    threshold: float  # texts whose score is below are rejected
    familiar: np.ndarray  # log frequency of each n-gram bucket in each language
    least_familiar: np.ndarray  # texts of 2^k n-grams whose mean log frequency is below entry k are rejected


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _codes(text: str) -> np.ndarray:
    """Code points in lower case, everything but letters as a space, one space at either end."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(_letters()[points], points, np.uint32(32))


def _grams(codes: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and bucket of every n-gram that holds a letter and no space but at its ends."""
    size = len(codes) - order + 1
    if size <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = codes == 32
    bad = space[:size] & space[order - 1 :]
    for inner in range(1, order - 1):
        bad = bad | space[inner : inner + size]
    starts = np.flatnonzero(~bad)
    value = np.full(len(starts), order, np.uint64)
    for i in range(order):
        value = (value + codes[starts + i]) * _MIX
        value ^= value >> np.uint64(29)
    return starts, ((value * _MIX) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _features(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Buckets of all n-grams, by stretches of ``CHUNK`` starts, so that a text may have any length."""
    reach = max(ORDERS) - 1
    for at in range(0, len(codes), CHUNK):
        for order in ORDERS:
            starts, buckets = _grams(codes[at : at + CHUNK + reach], order)
            yield buckets[starts < CHUNK]


def _score_many(texts: list[str], model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Summed scores and log frequencies of the n-grams, and number of n-grams, of each text."""
    table = np.concatenate((model.scores, model.familiar), 1)
    sums = np.zeros((len(texts), table.shape[1]))
    counts = np.zeros(len(texts))
    held: list[np.ndarray] = []
    owners: list[int] = []

    def flush() -> None:
        offsets = np.cumsum([0, *map(len, held)])
        codes = np.concatenate(held)
        for order in ORDERS:
            starts, buckets = _grams(codes, order)
            cuts = np.searchsorted(starts, offsets)
            rows = table[buckets]
            for k, owner in enumerate(owners):
                if cuts[k + 1] > cuts[k]:
                    sums[owner] += rows[cuts[k] : cuts[k + 1]].sum(0, dtype=np.float64)
                    counts[owner] += cuts[k + 1] - cuts[k]
        held.clear()
        owners.clear()

    size = 0
    for i, text in enumerate(texts):
        codes = _codes(text)
        if len(codes) > CHUNK:
            for buckets in _features(codes):
                sums[i] += table[buckets].sum(0, dtype=np.float64)
                counts[i] += len(buckets)
            continue
        held.append(codes)
        owners.append(i)
        size += len(codes)
        if size >= CHUNK:
            flush()
            size = 0
    if held:
        flush()
    return sums, counts


def _softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(1, keepdims=True))
    return raised / raised.sum(1, keepdims=True)


def _predict(texts: list[str | None], model: LanguageModel) -> tuple[list[str], np.ndarray, np.ndarray]:
    sums, counts = _score_many([t or "" for t in texts], model)
    classes, at = len(model.languages), np.arange(len(texts))
    means = sums / np.maximum(counts, 1)[:, None]
    chances = _softmax((means[:, :classes] + model.bias) / model.temperature)
    known = counts > 0
    best = chances.argmax(1)
    labels = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
    score = np.where(known, chances[at, best], 0.0)
    familiar = means[at, classes + best] >= model.least_familiar[_length_class(counts, len(model.least_familiar))]
    return labels, score, known & (score >= model.threshold) & familiar


def _length_class(counts: np.ndarray, classes: int) -> np.ndarray:
    """The power of two in a number of n-grams, the last class for all longer texts."""
    return np.clip(np.log2(np.maximum(counts, 1)).astype(int), 0, classes - 1)


def _sample_features(limit: int, seed: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                draw = np.random.default_rng([seed, len(row["text"])])
                parts = [(len(b), b[draw.integers(0, len(b), limit)] if len(b) > limit else b) for b in _features(_codes(row["text"]))]
                buckets = np.concatenate([b for _, b in parts])
                if len(buckets) > limit:  # each stretch and order counts by its size
                    weights = np.concatenate([np.full(len(b), n / max(1, len(b))) for n, b in parts])
                    buckets = draw.choice(buckets, limit, p=weights / weights.sum())
                if len(buckets):
                    cells = [pa.array([row["lang"]]), pa.array([buckets.astype("<u2").tobytes()], pa.binary())]
                    yield pa.RecordBatch.from_arrays(cells, ["lang", "buckets"])

    return step


def _train(rows: list[tuple[int, np.ndarray]], classes: int, size: int, epochs: int, rate: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Mini-batch descent; each visit of a row uses a random part of its n-grams, so that short texts are learned too."""
    draw = np.random.default_rng(seed)
    table = draw.normal(0, 0.1, (1 << BUCKET_BITS, size)).astype(np.float32)
    weights, bias = draw.normal(0, 0.1, (size, classes)).astype(np.float32), np.zeros(classes, np.float32)
    steps, done = epochs * -(-len(rows) // 16), 0
    for _ in range(epochs):
        order = draw.permutation(len(rows))
        for at in range(0, len(rows), 16):
            picked = [rows[i] for i in order[at : at + 16]]
            parts = [b[draw.integers(0, len(b), draw.integers(8, 513))] for _, b in picked]
            lengths = np.array([len(p) for p in parts])
            flat = np.concatenate(parts)
            starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            mean = np.add.reduceat(table[flat], starts) / lengths[:, None]
            error = _softmax(mean @ weights + bias)
            error[np.arange(len(picked)), [label for label, _ in picked]] -= 1
            step = rate * (1 - done / steps)
            back = (error @ weights.T) / lengths[:, None]
            weights -= step * mean.T @ error / len(picked)
            bias -= step * error.mean(0)
            np.add.at(table, flat, (-step * np.repeat(back, lengths, 0)).astype(np.float32))
            done += 1
    return table @ weights, bias


def _calibrate(logits: np.ndarray, labels: np.ndarray, rejected_share: float) -> tuple[float, float]:
    """Temperature of the least log loss, and the score below which the given share of right answers falls."""
    if not len(logits):
        return 1.0, 0.0
    at = np.arange(len(labels))
    grid = np.geomspace(0.02, 5, 40)
    loss = [-np.log(np.maximum(_softmax(logits / t)[at, labels], 1e-12)).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    chances = _softmax(logits / temperature)
    right = chances.argmax(1) == labels
    if not right.any():
        return temperature, 0.0
    return temperature, float(min(0.5, np.quantile(chances.max(1)[right], rejected_share)))


def _log_frequencies(rows: list[tuple[int, np.ndarray]], classes: int) -> np.ndarray:
    """Log of each bucket's share of a language's n-grams, every row of it counting alike."""
    share = np.full((1 << BUCKET_BITS, classes), SMOOTHING / (1 << BUCKET_BITS))
    number = np.maximum(np.bincount([label for label, _ in rows], minlength=classes), 1)
    for label, buckets in rows:
        share[:, label] += np.bincount(buckets, minlength=1 << BUCKET_BITS) / (len(buckets) * number[label])
    return np.log(share / share.sum(0)).astype(np.float32)


def _calibrate_familiarity(rows: list[tuple[int, np.ndarray]], familiar: np.ndarray, slack: float, seed: int) -> np.ndarray:
    """By length, what clean texts keep above: from the median, ``slack`` times as far down as their lowest hundredth."""
    draw = np.random.default_rng([seed, 1])
    least: list[float] = []
    for size in 2 ** np.arange(LENGTH_CLASSES):
        long = [(label, buckets) for label, buckets in rows if len(buckets) >= size]
        if len(long) < LEAST_ROWS:
            break
        means = [familiar[buckets[draw.integers(0, len(buckets), size)], label].mean() for label, buckets in long]
        middle, low = np.quantile(means, [0.5, 0.01]).tolist()
        least.append(middle - slack * (middle - low))
    return np.array(least or [-np.inf])


def fit_language_model(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    language_column: str = "lang",
    rows_per_language: int = 1000,
    features_per_row: int = 2048,
    dimensions: int = 16,
    epochs: int = 5,
    rate: float = 2.0,
    rejected_share: float = 0.001,
    slack: float = 4.0,
    seed: int = 7,
) -> LanguageModel:
    """Learn from rows with text and language whose identifier is outside the held-out fold.

    The sample is at most ``rows_per_language`` rows of each language, those with the least hashes of identifier and text;
    rows that repeat both are one. They reach the driver as at most ``features_per_row`` hashed n-grams. A fifth of the
    sample calibrates the rejection: the threshold of the score lets ``rejected_share`` of the right answers fall below
    it and is never above one half; the mean log frequency of a text's n-grams may lie as far below the median of clean
    texts of its length as ``slack`` times their lowest hundredth. Without any labelled row the model knows no language
    and predicts ``und`` for everything.
    """
    labelled = docs.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(language_column).cast("string").alias("lang")
    ).filter(F.col("id").isNotNull() & ~in_fold(F.col("id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    pointed = labelled.select("lang", "text", F.xxhash64(F.lit(seed), "id", "text").alias("point"))
    drawn = save(least_of_groups(pointed, "lang", "point", rows_per_language), "drawn")
    languages = tuple(sorted(r.lang for r in drawn.select("lang").distinct().collect()))
    if not languages:
        none = np.zeros((1 << BUCKET_BITS, 1), np.float32)
        return LanguageModel((UNKNOWN,), none, np.zeros(1), 1.0, 0.0, none, np.array([-np.inf]))
    # the sample is bounded by ``rows_per_language``; rows repeated in full are one row of it
    sample = pointed.join(F.broadcast(drawn), ["lang", "point"]).dropDuplicates(["lang", "point"]).select("lang", "text")
    found = sample.mapInArrow(_sample_features(features_per_row, seed), "lang string, buckets binary").toArrow()
    rows = sorted(zip(found.column("lang").to_pylist(), found.column("buckets").to_pylist()))
    del found
    rows = [(languages.index(lang), np.frombuffer(b, "<u2")) for lang, b in rows]
    rows = [rows[i] for i in np.random.default_rng(seed).permutation(len(rows))]
    held = rows[: len(rows) // 5]
    scores, bias = _train(rows[len(held) :] or rows, len(languages), dimensions, epochs, rate, seed)
    logits = np.array([scores[b].mean(0) + bias for _, b in held]).reshape(len(held), len(languages))
    temperature, threshold = _calibrate(logits, np.array([label for label, _ in held], int), rejected_share)
    familiar = _log_frequencies(rows[len(held) :] or rows, len(languages))
    least = _calibrate_familiarity(held, familiar, slack, seed)
    return LanguageModel(languages, scores.astype(np.float32), bias, temperature, threshold, familiar, least)


def language_of(docs: DataFrame, text: Column, model: LanguageModel) -> Column:
    """A struct of ``lang_pred``, ``score`` (0 to 1) and ``accepted`` for a text column.

    The label is ``und`` with score 0 if the text is NULL or has no letter. The model is a fixed number of bytes per
    language, whatever the data.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            labels, score, accepted = _predict([t if isinstance(t, str) else None for t in texts], shared.value)
            yield pd.DataFrame({"lang_pred": labels, "score": score, "accepted": accepted})

    predict.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(predict, "lang_pred string, score double, accepted boolean")(text)


def predict_language(docs: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: ``id, held_out, lang_pred, score, accepted``; rows repeated in full have the same result each."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    found = rows.select("id", in_fold(F.col("id")).alias("held_out"), language_of(docs, F.col("text"), model).alias("p"))
    return found.select("id", "held_out", "p.lang_pred", "p.score", "p.accepted")


def drop_rejected(docs: DataFrame, model: LanguageModel, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language the model accepts, with their columns."""
    name = fresh(docs, "accepted")
    accepted = language_of(docs, F.col(f"`{text_column}`"), model)["accepted"]
    return docs.withColumn(name, accepted).filter(F.col(name)).drop(name)
