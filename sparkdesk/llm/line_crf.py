"""Quality of documents by a linear-chain conditional random field over their lines.

Every line is labelled good or bad from its own features and those of the lines before and after it; the
chain's transitions tie neighbouring labels together. A document's score is the mean of its lines' marginal
probabilities of good, weighted by their lengths. The model is fitted here on a bounded sample of labelled documents. Only whole
documents are labelled, so within one no label is seen to change; the sample is therefore fitted on twice, document by document and with
documents of unlike labels one after the other, where the line at which the label changes is known.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkdesk.llm.common import free, ship, text_of
from sparkdesk.llm.wordhash import slices

#: The sample: so many documents at most, and so many neighbouring lines of each, from its middle.
SAMPLE, LINES = 3000, 64
ROUNDS, RATE, DECAY = 250, 0.08, 0.002
THRESHOLD = 0.7

UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
SYMBOLS, LOUD, BARS, POINTS = b"#*$%&<>~^=+_@\\/", b"!?", b"|", b".,;:"


def line_features(line: bytes) -> list[float]:
    n = len(line)
    words = line.split()
    k = len(words)
    if not k:
        return [0.0] * 14 + [1.0]
    share = lambda chars: (n - len(line.translate(None, chars))) / n
    per_word = lambda chars: min(2.0, (n - len(line.translate(None, chars))) / k)
    twins = sum(map(bytes.__eq__, words, words[1:]))
    return [
        math.log1p(n) / 8, math.log1p(k) / 6, min(3.0, n / k / 8), share(UPPER), share(DIGITS), per_word(SYMBOLS), per_word(LOUD),
        per_word(BARS), per_word(POINTS), len(set(words)) / k, twins / k, math.log1p(k) / 6 * (1 - len(set(words)) / k),
        float(share(UPPER) > 0.5), float(k < 4), 0.0,
    ]


def document_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A row per line with its features, those of its neighbours and a one; and the lines' lengths."""
    lines = text.split(b"\n")
    own = np.array([line_features(line) for line in lines], dtype=np.float64)
    edge = np.zeros((1, own.shape[1]))
    one = np.ones((len(own), 1))
    around = [own, np.vstack([edge, own[:-1]]), np.vstack([own[1:], edge]), one]
    return np.hstack(around), np.array([len(line) for line in lines], dtype=np.float64)


@dataclass
class Model:
    """Log-odds weights of good, and the log potentials of going from label to label; ``mean`` and ``scale`` of the features."""

    weights: np.ndarray
    moves: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def odds(self, features: np.ndarray) -> np.ndarray:
        return np.clip(((features - self.mean) / self.scale) @ self.weights, -30, 30)

    def marginals(self, features: np.ndarray) -> np.ndarray:
        """Probability of good for each line: odds passed forward and backward along the chain."""
        own = np.exp(self.odds(features)).tolist()
        (bb, bg), (gb, gg) = np.exp(self.moves).tolist()
        ahead, odds = [], own[0]
        ahead.append(odds)
        for e in own[1:]:
            odds = min(1e12, max(1e-12, e * (bg + gg * odds) / (bb + gb * odds)))
            ahead.append(odds)
        back, behind = 1.0, [1.0]
        for e in reversed(own[1:]):
            back = min(1e12, max(1e-12, (gb + gg * e * back) / (bb + bg * e * back)))
            behind.append(back)
        behind.reverse()
        joint = np.array(ahead) * np.array(behind)
        return joint / (1 + joint)

    def score(self, text: bytes) -> float:
        features, sizes = document_features(text)
        good, weights = self.marginals(features), sizes + 1.0
        return float((good * weights).sum() / weights.sum())


def glued(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Features of two documents as one, in which the lines at the seam are neighbours."""
    own, seam = (first.shape[1] - 1) // 3, len(first)
    rows = np.vstack([first, second])
    rows[seam - 1, 2 * own : 3 * own] = second[0, :own]
    rows[seam, own : 2 * own] = first[-1, :own]
    return rows


def chains(documents: list[tuple[np.ndarray, int]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features and line labels of each document, and of each good document glued to a bad one, either of them first in turn."""
    made = [(x, np.full(len(x), float(y))) for x, y in documents]
    good, bad = [c for c in made if c[1][0]], [c for c in made if not c[1][0]]
    for i, pair in enumerate(zip(good, bad)):
        a, b = pair if i % 2 else pair[::-1]
        made.append((glued(a[0], b[0]), np.concatenate([a[1], b[1]])))
    return made


def fit(documents: list[tuple[np.ndarray, int]], rounds: int = ROUNDS) -> Model:
    """Conditional maximum likelihood of the ``chains`` of (features, label) by gradient ascent; chains of like length run together."""
    if not documents:
        width = 3 * 15 + 1
        return Model(np.zeros(width), np.zeros((2, 2)), np.zeros(width), np.ones(width))
    width = documents[0][0].shape[1]
    every = np.vstack([x for x, _ in documents])
    mean, scale = every.mean(axis=0), every.std(axis=0)
    mean[-1], scale[-1] = 0.0, 1.0
    scale[scale < 1e-6] = 1.0
    every = sorted(chains(documents), key=lambda c: len(c[0]))
    groups = []
    for start in range(0, len(every), 256):
        part = every[start : start + 256]
        longest = len(part[-1][0])
        x, mask, y = np.zeros((len(part), longest, width)), np.zeros((len(part), longest)), np.zeros((len(part), longest))
        for i, (rows, labels) in enumerate(part):
            x[i, : len(rows)], mask[i, : len(rows)], y[i, : len(rows)] = (rows - mean) / scale, 1, labels
        groups.append((x, mask, y))
    model = Model(np.zeros(width), np.zeros((2, 2)), mean, scale)
    first, second = [np.zeros(width), np.zeros((2, 2))], [np.zeros(width), np.zeros((2, 2))]
    for turn in range(1, rounds + 1):
        slope = [-DECAY * model.weights, -DECAY * model.moves]
        for x, mask, y in groups:
            w, m = _slope(model, x, mask, y)
            slope[0] += w / len(every)
            slope[1] += m / len(every)
        for k, value in enumerate((model.weights, model.moves)):
            first[k] = 0.9 * first[k] + 0.1 * slope[k]
            second[k] = 0.99 * second[k] + 0.01 * slope[k] ** 2
            value += RATE * (first[k] / (1 - 0.9**turn)) / (np.sqrt(second[k] / (1 - 0.99**turn)) + 1e-8)
    return model


def _slope(model: Model, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Observed minus expected counts of features and moves under the line labels ``y``, each chain weighted by one over its lines."""
    docs, longest, _ = x.shape
    own = np.zeros((docs, longest, 2))
    own[:, :, 1] = np.clip(x @ model.weights, -30, 30)
    moves = model.moves
    together = lambda a: np.logaddexp(a[..., 0], a[..., 1])
    ahead, behind = np.zeros_like(own), np.zeros_like(own)
    ahead[:, 0] = own[:, 0]
    for t in range(1, longest):
        step = own[:, t] + together(np.moveaxis(ahead[:, t - 1, :, None] + moves, 1, 2))
        ahead[:, t] = np.where(mask[:, t, None] > 0, step, ahead[:, t - 1])
    for t in range(longest - 2, -1, -1):
        step = together(moves + (own[:, t + 1] + behind[:, t + 1])[:, None, :])
        behind[:, t] = np.where(mask[:, t + 1, None] > 0, step, 0)
    whole = together(ahead[:, -1])
    share = mask / mask.sum(axis=1, keepdims=True)
    good = np.exp(ahead[:, :, 1] + behind[:, :, 1] - whole[:, None])
    weights = (((y - good) * share)[:, :, None] * x).sum(axis=(0, 1))
    pairs = ahead[:, :-1, :, None] + moves + (own[:, 1:] + behind[:, 1:])[:, :, None, :] - whole[:, None, None, None]
    linked = (mask[:, 1:] * share[:, 1:])[:, :, None, None]
    expected = (np.exp(pairs) * linked).sum(axis=(0, 1))
    labels = np.stack([1 - y, y], axis=2)
    seen = (labels[:, :-1, :, None] * labels[:, 1:, None, :] * linked).sum(axis=(0, 1))
    return weights, seen - expected


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of ``labels`` (doc_id, quality) on ``docs`` (doc_id, text).

    Only rows whose crc32(doc_id) mod 4 is not 2 are used, ``sample`` of them at most, chosen by a hash of the id, so the
    sample is small enough to be sent to every task. A null quality is no label; of repeated ones the larger
    counts, and of rows of ``docs`` that repeat an id one, that with the smallest features, so at most ``sample`` rows are
    collected. Without any label the model knows nothing, and nothing is rejected for that.
    """
    ship(docs.sparkSession)
    usable = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = usable.groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, "_text"):
            made = []
            for text in texts:
                features, _ = document_features(text)
                first = max(0, len(features) - LINES) // 2
                made.append(features[first : first + LINES].astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(made, pa.binary())], names=["doc_id", "quality", "features"])

    texts = docs.select("doc_id", text_of().alias("_text")).join(F.broadcast(chosen), "doc_id")
    kind = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("quality", T.IntegerType()), T.StructField("features", T.BinaryType())])
    made = texts.select("doc_id", "quality", "_text").mapInArrow(run, kind)
    rows = made.groupBy("doc_id", "quality").agg(F.min("features").alias("features")).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["features"]))
    width = 3 * 15 + 1
    return fit([(np.frombuffer(r["features"], np.float32).reshape(-1, width).astype(float), r["quality"]) for r in rows])


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` for every row of ``docs`` (doc_id, text), from the text alone.

    A null text is an empty one, which is one empty line. Repeated rows each get their row; other columns are not read.
    A model fitted on nothing gives 1.
    """
    ship(docs.sparkSession)
    blank = not model.weights.any()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, "_text"):
            made = [1.0 if blank else model.score(text) for text in texts]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(made, pa.float64())], names=["doc_id", "score"])

    rows = docs.select("doc_id", text_of().alias("_text"))
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], T.StructField("score", T.DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``; a row without an id is not held out."""
    out = scores(docs, train(docs, labels))
    return out.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def drop_bad(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores at least the threshold, all columns as they are, whatever their names.

    A null text is an empty one and is judged as such; rows are judged one by one, so rows that repeat an id, and rows without one, each go or
    stay by their own text. No rows give no rows. Without labels all rows stay.
    """
    model = train(docs, labels)
    ship(docs.sparkSession)
    blank, names = not model.weights.any(), docs.columns
    (held,) = free(docs, "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, held):
            keep = pa.array([blank or model.score(text) >= threshold for text in texts], pa.bool_())
            yield pa.RecordBatch.from_arrays([rows.column(i).filter(keep) for i in range(len(names))], names=names)

    return docs.withColumn(held, text_of()).mapInArrow(run, docs.schema)
