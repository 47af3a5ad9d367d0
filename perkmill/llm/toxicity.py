"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

A lexicon of toxic words and word stems is learned from half of the labelled sample, the
trees from a quarter, and the isotonic curve from the last quarter. The features are densities
of lexicon words and stems, how near they stand to words of address ("you"), capitals,
punctuation and obfuscation rates.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perkmill.llm import wordhash
from perkmill.llm.labelled import labelled_sample
from perkmill.llm.tables import Scratch, is_held_out, read_table, small_batches

# Bound of the labelled rows used for fitting.
SAMPLE = 9000
STEM_BYTES = (4, 5, 6, 7)
# A word or stem is toxic if it is in at least SEEN toxic texts and this much likelier there.
SEEN, LIKELIER = 4, 25.0
NEAR = 5
ADDRESS = ("you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch",
           "tu", "te", "toi", "ton", "ta", "vous", "votre", "tú", "ti", "usted", "ustedes", "vosotros")
FEATURES = ("word_density", "word_count", "stem_density", "stem_count", "address_density", "near_address",
            "capitals", "shouted", "punctuation", "exclamations", "obfuscation", "runs", "length")


def terms(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Distinct hashes of the words and stems of each text; those of stems are odd, of words even."""
    words = wordhash.Words(data, offsets, wordhash.LETTERS)
    parts = [words.hashes & ~np.uint64(1)] + [stems for stems, _ in _stems(words)]
    longer = [np.ones(len(words.hashes), bool)] + [is_longer for _, is_longer in _stems(words)]
    return [np.unique(np.concatenate([p[a:b][m[a:b]] for p, m in zip(parts, longer)]))
            for a, b in zip(words.first[:-1], words.first[1:])]


def _stems(words: wordhash.Words):
    size = words.ends - words.starts
    for n in STEM_BYTES:
        yield wordhash.mix(words.prefix_hashes(n) + np.uint64(n)) | np.uint64(1), size > n


def lexicon(rows: DataFrame) -> np.ndarray:
    """Sorted hashes of toxic words and stems of ``rows`` (doc_id, text, label).

    Terms are counted by Spark; only those of the lexicon come to the driver, at most one for
    every SEEN terms of the toxic texts of a bounded sample.
    """
    n_toxic, n = rows.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count(F.lit(1))).first()
    found = rows.select("doc_id", "text", "label").mapInArrow(_terms, "terms array<long>, label int").select(
        F.explode("terms").alias("term"), "label").groupBy("term").agg(
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
    ratio = ((F.col("toxic") + 0.1) / max(n_toxic, 1)) / ((F.col("clean") + 0.1) / max(n - n_toxic, 1))
    kept = found.where((F.col("toxic") >= SEEN) & (ratio >= LIKELIER)).select("term").toArrow()
    return np.sort(kept["term"].to_numpy().view(np.uint64))


def dense_features(data: np.ndarray, offsets: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """One row of FEATURES per text."""
    words = wordhash.Words(data, offsets, wordhash.LETTERS)
    n_words = np.maximum(words.counts, 1)
    n_bytes = np.maximum(np.diff(offsets), 1)

    def member(hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(toxic, hashes)
        return toxic[np.minimum(at, len(toxic) - 1)] == hashes if len(toxic) else np.zeros(len(hashes), bool)

    def of_words(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[words.first[1:]] - sums[words.first[:-1]]

    def of_bytes(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    word = member(words.hashes & ~np.uint64(1))
    stem = np.zeros(len(word), dtype=bool)
    for hashes, longer in _stems(words):
        stem |= member(hashes) & longer
    address = np.isin(words.hashes, _address())
    places = np.flatnonzero(address)
    near = np.zeros(len(word), dtype=bool)
    hits = np.flatnonzero(word | stem)
    if len(places) and len(hits):
        after = np.searchsorted(places, hits)
        for k in (np.maximum(after - 1, 0), np.minimum(after, len(places) - 1)):
            near[hits] |= (np.abs(places[k] - hits) <= NEAR) & (words.text[places[k]] == words.text[hits])
    upper, lower = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    digit = (data >= 48) & (data <= 57)
    letter = upper | lower | (data >= 128)
    mark = (data > 32) & (data < 127) & ~letter & ~digit
    inner = np.zeros(len(data), dtype=bool)
    inner[1:-1] = (mark | digit)[1:-1] & letter[:-2] & letter[2:]
    run = np.zeros(len(data), dtype=bool)
    run[2:] = (data[2:] == data[1:-1]) & (data[2:] == data[:-2]) & letter[2:]
    ups, lows = (np.concatenate([[0], np.cumsum(x)]) for x in (upper, lower))
    shouted = ((ups[words.ends] - ups[words.starts]) >= 2) & (lows[words.ends] == lows[words.starts])
    letters = np.maximum(of_bytes(upper | lower), 1)
    columns = (
        of_words(word) / n_words, np.log1p(of_words(word)), of_words(stem) / n_words, np.log1p(of_words(stem)),
        of_words(address) / n_words, of_words(near) / np.maximum(of_words(word | stem), 1),
        of_bytes(upper) / letters, of_words(shouted) / n_words, of_bytes(mark) / n_bytes,
        of_bytes(data == 33) / n_bytes, of_bytes(inner) / n_words, of_bytes(run) / n_bytes, np.log1p(words.counts))
    return np.column_stack(columns)


def _address() -> np.ndarray:
    return np.array([wordhash.word_hash(w) for w in ADDRESS], dtype=np.uint64)


def _with_features(docs: DataFrame, toxic: np.ndarray) -> DataFrame:
    """doc_id, FEATURES and the columns after text."""
    shared = docs.sparkSession.sparkContext.broadcast(toxic)
    others = [f for f in docs.schema.fields if f.name not in ("doc_id", "text")]
    schema = ", ".join(["doc_id long"] + [f"{name} double" for name in FEATURES] + [f"{f.name} {f.dataType.simpleString()}" for f in others])

    def run(batches):
        for batch in batches:
            for first, end, data, offsets in wordhash.chunks(batch.column(1)):
                rows = dense_features(data, offsets, shared.value)
                columns = [batch.column(0).slice(first, end - first), *(pa.array(np.ascontiguousarray(c)) for c in rows.T)]
                columns += [batch.column(k).slice(first, end - first) for k in range(2, batch.num_columns)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *FEATURES, *batch.schema.names[2:]])

    return docs.select("doc_id", "text", *[f.name for f in others]).mapInArrow(run, schema)


def _terms(batches):
    for batch in batches:
        for first, end, data, offsets in wordhash.chunks(batch.column(1)):
            found = terms(data, offsets)
            values = np.concatenate(found).astype(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [wordhash.list_column(values, np.array([len(f) for f in found])), batch.column(2).slice(first, end - first)],
                ["terms", "label"])


class Model:
    """The lexicon, the fitted trees and curve; ``share`` scores texts if nothing could be fitted."""

    def __init__(self, toxic, trees=None, curve=None, share: float = 0.5):
        self.toxic, self.trees, self.curve, self.share = toxic, trees, curve, share


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", limit: int = SAMPLE) -> Model:
    """Lexicon, trees and curve from a bounded sample; which part of it a text goes to follows from its hash."""
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "toxicity")
    part = F.pmod(F.xxhash64("text"), F.lit(4))
    rows = scratch.store(labelled_sample(docs, labels, label, limit).select("doc_id", "text", "label", part.alias("part")).coalesce(4))
    toxic = lexicon(rows.where("part < 2"))
    ones, n = rows.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count(F.lit(1))).first()
    model = Model(toxic, share=(ones + 1) / (n + 2))
    vectors = scratch.store(_with_features(rows, toxic))
    classes = {(r.part, r.label) for r in vectors.select("part", "label").distinct().collect()}
    if not {(2, 0), (2, 1), (3, 0), (3, 1)} <= classes:
        return model
    gathered = _assembled(vectors)
    model.trees = GBTClassifier(
        labelCol="label", maxDepth=3, maxIter=16, stepSize=0.3, maxBins=48, seed=3, checkpointInterval=-1,
    ).fit(gathered.where("part = 2"))
    model.curve = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score").fit(
        _raw(model.trees, gathered.where("part = 3")))
    return model


def _assembled(vectors: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(vectors)


def _raw(trees, assembled: DataFrame) -> DataFrame:
    return trees.transform(assembled).withColumn("raw", vector_to_array("probability")[1])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row; a NULL text scores as an empty one."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if model.trees is None:
        return rows.select("doc_id", F.lit(float(model.share)).alias("score"))
    raw = _raw(model.trees, _assembled(_with_features(rows, model.toxic))).select("doc_id", "raw")
    return model.curve.transform(raw).select("doc_id", F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = learn(docs, read_table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
