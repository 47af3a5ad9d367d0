"""Language identification by prediction by partial matching.

One context tree of bytes per language, up to three bytes deep. In a context seen ``n`` times
with ``d`` different next bytes, a byte seen ``c`` times costs -log2(c / (n + d)) bits; any
other byte costs the escape, -log2(d / (n + d)), and is then coded in the context that is one
byte shorter, in the end as one of 256. Statistics are frozen after learning, so the cost of
every (context, byte) is a constant, and the code length of a text is a sum of table entries.
The language with the shortest code is the prediction.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perkmill.llm import wordhash
from perkmill.llm.tables import is_held_out, read_table, small_batches

ORDER = 3
# Learning takes at most this many texts of each language, those with the smallest hashes of
# their ids. Contexts of two bytes and more that were seen less often than RARE are left out.
TEXTS_PER_LANGUAGE = 500
RARE = 8
MOST_LANGUAGES = 1000
UNKNOWN = "und"


class Trees:
    """The frozen cost tables: ``context`` finds the longest known context, ``bits`` its row."""

    def __init__(self, languages: list[str], symbol: np.ndarray, context: np.ndarray, bits: np.ndarray):
        self.languages, self.symbol, self.context, self.bits = languages, symbol, context, bits

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text (rows) under each language's tree (columns)."""
        width = int(self.symbol.max()) + 1
        symbols = self.symbol[data]
        lengths = np.diff(offsets)
        place = np.arange(len(data)) - np.repeat(offsets[:-1], lengths)
        key = np.zeros(len(data), dtype=np.int64)
        for back in range(ORDER, 0, -1):
            key *= width
            key[back:] += np.where(place[back:] >= back, symbols[:-back], 0)
        cell = self.context[key].astype(np.int64) * width + symbols
        out = np.zeros((len(lengths), len(self.languages)))
        some = lengths > 0
        if some.any():
            out[some] = np.add.reduceat(self.bits[cell], offsets[:-1][some], axis=0, dtype=np.float64)
        return out


def _grams(batches):
    for batch in batches:
        langs = np.asarray(batch.column(0).to_pylist(), dtype=object)
        for first, end, data, offsets in wordhash.chunks(batch.column(1)):
            owner = np.repeat(langs[first:end], np.diff(offsets))
            text = np.repeat(np.arange(end - first), np.diff(offsets))
            for lang in sorted(set(owner)):
                mine = owner == lang
                for order in range(ORDER + 1):
                    whole = mine[order:] & (text[order:] == text[:len(text) - order])
                    gram = np.zeros(len(data) - min(order, len(data)), dtype=np.int64)
                    for k in range(order + 1):
                        gram = gram * 256 + data[k:len(data) - order + k]
                    found, times = np.unique(gram[whole], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(found), pa.string()), pa.array(np.full(len(found), order, np.int32)),
                         pa.array(found), pa.array(times)], ["lang", "order", "gram", "times"])


def learning_texts(docs: DataFrame, limit: int = TEXTS_PER_LANGUAGE) -> DataFrame:
    """(lang, text): at most ``limit`` rows of each language that are not held out.

    A hash threshold from the row counts thins each language where it is read, so only about
    twice ``limit`` rows of a language are moved and ranked, however common it is. The counts
    are literals of the plan; more than MOST_LANGUAGES languages are an error.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~is_held_out()).select(
        "doc_id", "lang", "text", (F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30)) / float(1 << 30)).alias("draw"))
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages to learn")
    if not counts:
        return usable.select("lang", "text")
    rows = F.create_map(*[F.lit(v) for r in sorted(counts) for v in r])
    thinned = usable.where(F.col("draw") * F.element_at(rows, F.col("lang")) < 2.0 * limit)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id"))
    return thinned.withColumn("rank", rank).where(F.col("rank") <= limit).select("lang", "text")


def learn(docs: DataFrame, limit: int = TEXTS_PER_LANGUAGE) -> Trees | None:
    """Context trees from doc_id, lang and text of rows that are not held out; None without any."""
    small_batches(docs.sparkSession)
    grams = learning_texts(docs, limit).mapInArrow(_grams, "lang string, order int, gram long, times long")
    table = grams.groupBy("lang", "order", "gram").agg(F.sum("times").alias("times")).toPandas()
    if not len(table):
        return None
    languages = sorted(table.lang.unique())
    seen = np.unique(table.gram[table.order == 0])
    symbol = np.zeros(256, dtype=np.int64)
    symbol[seen] = np.arange(1, len(seen) + 1)
    width = len(seen) + 1
    lookup = np.zeros(width ** ORDER, dtype=np.int32)
    rows = 1
    by_order = [table[table.order == k] for k in range(ORDER + 1)]
    pieces = [np.full((1, width, len(languages)), 8.0, dtype=np.float32)]
    contexts_of = []
    for order in range(ORDER + 1):
        t = by_order[order]
        context, last = t.gram.to_numpy() >> 8, symbol[t.gram.to_numpy() & 255]
        language = np.searchsorted(languages, t.lang.to_numpy().astype(str))
        times = t.times.to_numpy().astype(np.float64)
        known, index = np.unique(context, return_inverse=True) if order else (np.zeros(1, np.int64), np.zeros(len(t), np.int64))
        total = np.zeros((len(known), len(languages)))
        different = np.zeros_like(total)
        np.add.at(total, (index, language), times)
        np.add.at(different, (index, language), 1)
        if order >= 2:
            often = total.max(axis=1) >= RARE
            keep = often[index]
            moved = np.cumsum(often) - 1
            index, last, language, times = moved[index[keep]], last[keep], language[keep], times[keep]
            known, total, different = known[often], total[often], different[often]
        shorter = np.zeros(len(known), dtype=np.int64)
        if order:
            below, start = contexts_of[-1]
            suffix = known & ((1 << (8 * (order - 1))) - 1) if order > 1 else np.zeros(len(known), np.int64)
            at = np.minimum(np.searchsorted(below, suffix), max(len(below) - 1, 0))
            found = below[at] == suffix if len(below) else np.zeros(len(known), bool)
            shorter = np.where(found, start + at, 1)
        base = np.concatenate(pieces)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(total > 0, -np.log2(different / (total + different)), 0.0)
        bits = (base[shorter] if order else base[[0]]) + escape[:, None, :]
        cost = -np.log2(times / (total + different)[index, language])
        bits[index, last, language] = cost
        pieces.append(bits.astype(np.float32))
        contexts_of.append((known, rows))
        if order == 0:
            lookup[:] = rows
        else:
            digits = [symbol[(known >> (8 * k)) & 255] for k in range(order)]
            place = sum(d * width ** k for k, d in enumerate(digits))
            ids = rows + np.arange(len(known))
            step = width ** order
            for p, i in zip(place, ids):
                lookup[p::step] = i
        rows += len(known)
    bits = np.concatenate(pieces).reshape(-1, len(languages))
    return Trees(languages, symbol, lookup, bits)


def predict(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """``docs`` with lang_pred, score and bits_per_byte; existing columns of these names go.

    score is the share of the best language if every language is taken as likely as its code
    is short (2 to the power of minus its bits). Equal codes go to the alphabetically first
    language. A NULL text, or one without a letter, is ``und`` with score 0; so is every text
    if nothing could be learned.
    """
    spark = docs.sparkSession
    small_batches(spark)
    names = [c for c in docs.columns if c not in ("lang_pred", "score", "bits_per_byte")]
    docs = docs.select(*names)
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if trees is None:
        return docs.select("*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("bits_per_byte"))
    shared = spark.sparkContext.broadcast(vars(trees))
    place, count = names.index("text"), len(names)

    def scored(batches):
        trees = Trees(**shared.value)
        for batch in batches:
            for first, end, data, offsets in wordhash.chunks(batch.column(place)):
                bits = trees.code_lengths(data, offsets)
                best = bits.argmin(axis=1)
                least = bits[np.arange(len(bits)), best]
                share = 1.0 / np.exp2(np.maximum(least[:, None] - bits, -1000.0)).sum(axis=1)
                per_byte = least / np.maximum(np.diff(offsets), 1)
                columns = [batch.column(k).slice(first, end - first) for k in range(count)]
                columns += [pa.array([trees.languages[b] for b in best], pa.string()), pa.array(share), pa.array(per_byte)]
                columns.append(batch.column(count).slice(first, end - first))
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:count], "lang_pred", "score", "bits_per_byte", "_lettered"])

    schema = docs.schema.add("lang_pred", "string").add("score", "double").add("bits_per_byte", "double").add("_lettered", "boolean")
    out = docs.withColumn("_lettered", lettered).mapInArrow(scored, schema)
    return out.select(
        *names, F.when(F.col("_lettered"), F.col("lang_pred")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("_lettered"), F.col("score")).otherwise(0.0).alias("score"),
        F.when(F.col("_lettered"), F.col("bits_per_byte")).alias("bits_per_byte"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = predict(docs.select("doc_id", "text"), learn(docs))
    return found.select("doc_id", is_held_out().alias("held_out"), "lang_pred", "score", "bits_per_byte")
