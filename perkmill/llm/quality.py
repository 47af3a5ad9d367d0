"""Quality classifier: a support vector machine on n-gram indicators scaled by naive Bayes.

Every n-gram indicator is multiplied by its class log-count ratio, texts are scaled to unit
length, and a linear hinge-loss model is fitted by dual coordinate descent. Margins become
probabilities by a logistic curve, fitted on texts the model has not seen.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perkmill.llm import wordhash
from perkmill.llm.labelled import labelled_sample
from perkmill.llm.tables import is_held_out, read_table, small_batches

# Bound of the labelled rows used for fitting; a quarter of them fits the logistic curve.
SAMPLE = 8000
BUCKETS = 1 << 18
REPEATED, SHOUTED = 0, 1


class Model:
    def __init__(self, ratio: np.ndarray, weight: np.ndarray, bias: float, slope: float, offset: float):
        self.ratio, self.weight, self.bias, self.slope, self.offset = ratio, weight, bias, slope, offset

    def margins(self, features: list[np.ndarray]) -> np.ndarray:
        out = np.empty(len(features))
        for k, f in enumerate(features):
            r = self.ratio[f]
            out[k] = r @ self.weight[f] / max(np.sqrt(r @ r), 1e-12) + self.bias
        return out

    def scores(self, features: list[np.ndarray]) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * self.margins(features) + self.offset, -500, 500)))


def features(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Distinct feature numbers of each text: words, runs of punctuation, pairs of neighbours,
    and two marks: a word that repeats the one before it, a word in capitals."""
    words = wordhash.Words(data, offsets, wordhash.WORDS_AND_MARKS)
    h = words.hashes
    one = (h % np.uint64(BUCKETS - 2)).astype(np.int64) + 2
    together = np.zeros(len(h), dtype=bool)
    together[1:] = words.text[1:] == words.text[:-1]
    pair = np.zeros(len(h), dtype=np.uint64)
    pair[1:] = wordhash.mix(h[:-1] * np.uint64(3) + h[1:])
    two = np.where(together, (pair % np.uint64(BUCKETS - 2)).astype(np.int64) + 2, one)
    upper, lower = ((data >= lo) & (data <= hi) for lo, hi in ((65, 90), (97, 122)))
    sums = [np.concatenate([[0], np.cumsum(x)]) for x in (upper, lower)]
    ups, lows = (s[words.ends] - s[words.starts] for s in sums)
    shouted = (ups >= 2) & (lows == 0)
    again = together.copy()
    again[1:] &= h[1:] == h[:-1]
    out = []
    for t in range(len(offsets) - 1):
        a, b = words.first[t], words.first[t + 1]
        marks = [m for m, x in ((REPEATED, again), (SHOUTED, shouted)) if x[a:b].any()]
        out.append(np.unique(np.concatenate([one[a:b], two[a:b], np.array(marks, dtype=np.int64)])))
    return out


def fit(texts: list[np.ndarray], labels: np.ndarray, c: float = 1.0, epochs: int = 12, seed: int = 7) -> Model:
    """Model from features and labels (0/1); without both classes every score is the label's share."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    flat = float(np.log(share / (1 - share)))
    empty = Model(np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 0.0, flat)
    held = np.arange(len(labels)) % 4 == 3
    if min(len(set(labels[held])), len(set(labels[~held]))) < 2:
        return empty
    fitted = np.flatnonzero(~held)
    counts = np.ones((2, BUCKETS))
    for i in fitted:
        counts[labels[i], texts[i]] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    lengths = np.array([max(np.sqrt(ratio[f] @ ratio[f]), 1e-12) for f in texts])
    sign = 2.0 * labels - 1
    weigh = {y: len(fitted) / (2.0 * (labels[fitted] == y).sum()) for y in (0, 1)}
    most = np.array([c * weigh[y] for y in labels])
    weight, bias, alpha = np.zeros(BUCKETS), 0.0, np.zeros(len(labels))
    random = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in random.permutation(fitted):
            f = texts[i]
            x = ratio[f] / lengths[i]
            slack = sign[i] * (x @ weight[f] + bias) - 1.0
            new = min(max(alpha[i] - slack / 2.0, 0.0), most[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                weight[f] += step * x
                bias += step
                alpha[i] = new
    model = Model(ratio, weight, bias, 1.0, 0.0)
    model.slope, model.offset = logistic(model.margins([texts[i] for i in np.flatnonzero(held)]), labels[held])
    return model


def logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve, by Newton steps on smoothed targets."""
    ones = labels.sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    x = np.column_stack([margins, np.ones(len(margins))])
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (target - p) - 1e-3 * at)
        at = at + np.clip(step, -2, 2)
    return max(float(at[0]), 0.0), float(at[1])


def _sampled(batches):
    for batch in batches:
        for first, end, data, offsets in wordhash.chunks(batch.column(1)):
            found = features(data, offsets)
            counts = np.array([len(f) for f in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, end - first),
                 wordhash.list_column(np.concatenate(found), counts).cast(pa.list_(pa.int32())), batch.column(2).slice(first, end - first)],
                ["doc_id", "features", "label"])


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", limit: int = SAMPLE) -> Model:
    """A model from a bounded sample, in the order of doc_id: every fourth text fits the curve only."""
    small_batches(docs.sparkSession)
    rows = labelled_sample(docs, labels, label, limit).select("doc_id", "text", "label").mapInArrow(
        _sampled, "doc_id long, features array<int>, label int").toArrow().sort_by("doc_id").combine_chunks()
    column = rows["features"].combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks else pa.array([], pa.list_(pa.int32()))
    places, numbers = column.offsets.to_numpy(), column.values.to_numpy()
    # Views of one array of 4-byte numbers; at most the features of ``limit`` texts.
    return fit([numbers[a:b] for a, b in zip(places[:-1], places[1:])], rows["label"].to_numpy())


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row; a NULL text scores as an empty one."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def scored(batches):
        model = Model(**shared.value)
        for batch in batches:
            for first, end, data, offsets in wordhash.chunks(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(model.scores(features(data, offsets)))],
                    ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        scored, "doc_id long, score double")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = learn(docs, read_table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
