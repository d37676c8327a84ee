"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. Its features describe it and its neighbours; neighbouring labels influence each other.
Training takes a document's label for each of its lines. A document's quality is the mean of its lines' marginal
probabilities of being good, from the forward-backward pass, weighted by their lengths, and calibrated.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import in_fold, small_batches, text_slices

OWN = 18  # features of one line
FEATURES = 3 * OWN + 3  # the line's, its neighbours', whether it has them, and one


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of the good label
    links: np.ndarray  # [label, next label]
    slope: float
    shift: float


def _classes() -> np.ndarray:
    """Of each byte: 0 lower, 1 upper, 2 digit, 3 white space, 4 sentence mark, 5 other symbol, 6 outside ASCII."""
    kind = np.full(256, 6, np.uint8)
    for b in range(128):
        c = chr(b)
        kind[b] = 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 if c.isspace() else 4 if c in ".,;:?!'\"()-" else 5
    return kind


_KIND = _classes()


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and lengths (bytes) of the lines of a text that hold anything but white space."""
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    if not lines:
        return np.zeros((0, OWN), np.float32), np.zeros(0)
    data = [line.encode() for line in lines]
    sizes = np.array([len(d) for d in data])
    starts = np.cumsum(sizes) - sizes
    kind = _KIND[np.frombuffer(b"".join(data), np.uint8)]
    after = np.append(kind[1:], np.uint8(3))
    after[starts[1:] - 1] = 3  # a line ends like a word
    total = lambda mask: np.add.reduceat(mask.astype(np.int32), starts)
    words = [line.split() for line in lines]
    number = np.maximum(np.array([len(w) for w in words]), 1)
    distinct = np.array([len(set(w)) for w in words]) / number
    repeats = np.array([sum(map(eq, w, w[1:])) for w in words]) / number
    seen: dict[str, int] = {}
    for line in lines:
        seen[line] = seen.get(line, 0) + 1
    symbol = kind == 5
    mark = kind == 4
    ends = after == 3
    columns = [
        np.log1p(sizes),
        np.log1p(number),
        sizes / number / 10,
        total(kind == 0) / sizes,
        total(kind == 1) / sizes,
        total(kind == 2) / sizes,
        total(kind == 3) / sizes,
        total(mark) / sizes,
        total(symbol) / sizes,
        total(kind == 6) / sizes,
        total(symbol & ends) / number,
        total(mark & ends) / number,
        total((symbol | mark) & ((after == 4) | (after == 5))) / number,
        distinct,
        repeats,
        np.array([line[-1] in ".?!" for line in lines]),
        np.array([seen[line] > 1 for line in lines]),
        np.array([line[0].isupper() for line in lines]),
    ]
    return np.stack(columns, 1).astype(np.float32), sizes.astype(float)


def chain_features(own: np.ndarray) -> np.ndarray:
    """Each line's features with those of the lines before and after it."""
    size = len(own)
    none = np.zeros((1, OWN), np.float32)
    has = np.ones((size, 3), np.float32)
    has[0, 0] = has[-1, 1] = 0
    return np.concatenate((own, np.concatenate((none, own[:-1])), np.concatenate((own[1:], none)), has), 1)


def marginals(scores: np.ndarray, lengths: np.ndarray, links: np.ndarray, pairs: bool = False) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward-backward over many chains at once, laid end to end in ``scores`` (of the good label; the bad one has 0).

    Returns each line's probability of being good, the expected number of each label pair (if asked for) and the sum of the
    chains' log normalisers. Chains are stepped together, those that are over dropping out.
    """
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    first, size = starts[order], lengths[order]
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), "left")  # chains longer than t
    shift = np.maximum(scores, 0)
    local = np.exp(np.stack((-shift, scores - shift), 1))
    move = np.exp(links)
    alpha, beta = np.zeros_like(local), np.ones_like(local)
    log_sum, expected = float(shift.sum()), np.zeros((2, 2))
    for t in range(longest):
        at = first[: active[t]] + t
        value = local[at] * (1.0 if t == 0 else alpha[at - 1] @ move)
        norm = value.sum(1, keepdims=True)
        alpha[at] = value / norm
        log_sum += float(np.log(norm).sum())
    for t in range(longest - 2, -1, -1):
        at = first[: active[t + 1]] + t
        ahead = local[at + 1] * beta[at + 1]
        if pairs:
            joint = alpha[at][:, :, None] * move * ahead[:, None, :]
            expected += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        value = ahead @ move.T
        beta[at] = value / value.sum(1, keepdims=True)
    both = alpha * beta
    return both[:, 1] / both.sum(1), expected, log_sum


def _line_scores(own: np.ndarray, model: QualityModel) -> np.ndarray:
    """What ``chain_features`` score, without building them: a text may have very many lines."""
    factor = model.weights / model.scale
    out = own @ factor[:OWN] + (factor[-1] - model.mean @ factor)
    out[1:] += own[:-1] @ factor[OWN : 2 * OWN] + factor[-3]
    out[:-1] += own[1:] @ factor[2 * OWN : 3 * OWN] + factor[-2]
    return out


def _document_scores(own: list[np.ndarray], weights: list[np.ndarray], model: QualityModel) -> np.ndarray:
    """Score of each document; one without a line has 0."""
    lengths = np.array([len(o) for o in own])
    out = np.zeros(len(own))
    full = np.flatnonzero(lengths)
    if not len(full):
        return out
    scores = np.concatenate([_line_scores(own[i], model) for i in full])
    good, _, _ = marginals(scores, lengths[full], model.links)
    share = np.concatenate([weights[i] / weights[i].sum() for i in full])
    starts = np.cumsum(lengths[full]) - lengths[full]
    out[full] = _calibrated(np.add.reduceat(good * share, starts), model.slope, model.shift)
    return out


def _calibrated(share: np.ndarray, slope: float, shift: float) -> np.ndarray:
    inner = np.clip(share, 1e-9, 1 - 1e-9)
    return 1 / (1 + np.exp(-(slope * np.log(inner / (1 - inner)) + shift)))


def _score_step(model):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, "text", 8 << 20):
                pairs = [line_features(t or "") for t in batch.column("text").to_pylist()]
                score = _document_scores([f for f, _ in pairs], [w for _, w in pairs], model.value)
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held_out"), pa.array(score)], ["id", "held_out", "score"])

    return step


def _sample_step(lines: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own, _ = line_features(row["text"])
                at = row["place"] % max(1, len(own) - lines + 1)
                cells = [pa.array([row["label"]], pa.int32()), pa.array([row["place"]]), pa.array([own[at : at + lines].tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(cells, ["label", "place", "features"])

    return step


def _fit(chains: list[np.ndarray], labels: np.ndarray, penalty: float, steps: int) -> tuple:
    """Weights by Adam on the conditional log-likelihood, every line carrying its document's label."""
    features = np.concatenate([chain_features(c) for c in chains]).astype(np.float64)
    lengths = np.array([len(c) for c in chains])
    mean, scale = features.mean(0), features.std(0) + 1e-6
    mean[-1], scale[-1] = 0.0, 1.0
    inputs = (features - mean) / scale
    line_labels = np.repeat(labels, lengths)
    pairs = np.zeros((2, 2))
    for label in (0, 1):
        pairs[label, label] = (lengths[labels == label] - 1).sum()
    theta = np.zeros(FEATURES + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        good, expected, _ = marginals(inputs @ theta[:-4], lengths, theta[-4:].reshape(2, 2), True)
        slope = np.concatenate((inputs.T @ (line_labels - good), (pairs - expected).ravel())) / len(chains) - penalty * theta
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        theta = theta + 0.1 * (1 - t / steps) * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return mean, scale, theta[:-4], theta[-4:].reshape(2, 2)


def _fit_calibration(shares: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the log odds, by Newton's method with a light penalty towards (1, 0)."""
    inner = np.clip(shares, 1e-9, 1 - 1e-9)
    inputs = np.stack((np.log(inner / (1 - inner)), np.ones(len(inner))), 1)
    theta, centre = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(inputs @ theta, -40, 40)))
        slope = inputs.T @ (labels - chance) - (theta - centre)
        curve = (inputs * (chance * (1 - chance))[:, None]).T @ inputs + np.eye(2)
        theta = theta + np.clip(np.linalg.solve(curve, slope), -1, 1)
    return max(float(theta[0]), 1e-3), float(theta[1])


def fit_quality_model(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    rows: int = 8000,
    lines_per_row: int = 64,
    penalty: float = 1e-3,
    steps: int = 200,
    seed: int = 3,
) -> QualityModel | None:
    """Learn from labelled documents outside the held-out fold; None if they do not hold both labels.

    The sample is at most ``rows`` labelled documents, those with the least hashes of their identifiers; the driver gets the
    features of up to ``lines_per_row`` neighbouring lines of each. Rows that repeat an identifier count once: with the
    lower label, and with the text of the least hash. A fifth of the sample calibrates the scores. Only the text is an input.
    """
    known = labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("label"))
    known = known.filter(F.col("id").isNotNull() & ~in_fold(F.col("id")) & F.col("label").isin(0, 1))
    known = known.groupBy("id").agg(F.min("label").alias("label"))
    known = known.withColumn("place", F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 30)))
    drawn = known.orderBy("place", "id").limit(rows)
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).filter("text is not null")
    # the sample is bounded by ``rows``, whatever the table; a shuffle would carry every text for its sake
    sample = texts.join(F.broadcast(drawn), "id").groupBy("id", "label", "place").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    features = _sample_step(lines_per_row)
    found = sample.select("label", "place", "text").mapInArrow(features, "label int, place bigint, features binary").toArrow().to_pylist()
    found = sorted((r["place"], r["label"], r["features"]) for r in found if r["features"])
    chains = [np.frombuffer(f, np.float32).reshape(-1, OWN) for _, _, f in found]
    marks = np.array([label for _, label, _ in found], float)
    held = np.arange(len(chains)) % 5 == 0
    if len(set(marks[~held])) < 2:
        return None
    fitted = _fit([c for c, h in zip(chains, held) if not h], marks[~held], penalty, steps)
    plain = QualityModel(*fitted, 1.0, 0.0)
    kept = [c for c, h in zip(chains, held) if h]
    weights = [np.expm1(c[:, 0].astype(float)) for c in kept]  # the first feature is the log of the length
    if len(set(marks[held])) < 2:
        return plain
    return QualityModel(*fitted, *_fit_calibration(_document_scores(kept, weights, plain), marks[held]))


def score_quality(docs: DataFrame, model: QualityModel | None, id_column: str = "doc_id", text_column: str = "text", good: float = 0.7) -> DataFrame:
    """One row per document: ``id, held_out, score`` (0 to 1) and ``predicted``, 1 for scores of ``good`` or more.

    A text without a line that holds anything (NULL, empty, white space) scores 0; without a model every text scores 0.
    Rows repeated in full have one result each, the same.
    Lines end at line feeds. Texts may have any length and any number of lines; other columns are not read.
    """
    kind = dict(docs.dtypes)[id_column]
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).withColumn("held_out", in_fold(F.col("id")))
    if model is None:
        scored = rows.select("id", "held_out", F.lit(0.0).alias("score"))
    else:
        small_batches(docs.sparkSession)
        shared = docs.sparkSession.sparkContext.broadcast(model)
        scored = rows.mapInArrow(_score_step(shared), f"id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= good).cast("int"))
