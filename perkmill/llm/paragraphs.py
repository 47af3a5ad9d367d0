"""Substring dedup: lines by MinHash banding, and passages wherever lines end.

A paragraph is a line of a text with at least MIN_WORDS words. With 20 bands of 4 values two paragraphs of similarity 0.8
share a band with a probability above 0.9999. Colliding paragraphs are compared by the
exact Jaccard similarity of their sets of five-word shingles; the first paragraph of every
component (smallest document, then place) stays, the others are removed.

A passage is a run of RUN or more words of a text, each RUN words of which stand in another
document too; line ends count as any white space. Every RUN words hold the ANCHOR words that
have the smallest hash among theirs, so equal runs share an anchor. Only around anchors that
two documents share are all windows of RUN words hashed (to 128 bits) and grouped. A passage
of 30 words or more with one changed word in 45, which is Jaccard 0.8, has an equal run of
RUN words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perkmill.llm import wordhash
from perkmill.llm.banding import link_sets
from perkmill.llm.minhash import SHINGLE_WORDS, band_keys, set_columns
from perkmill.llm.tables import Scratch, read_table, small_batches

MIN_WORDS = 30
BANDS, ROWS = 20, 4
PERCENT = 80
RUN = 21
ANCHOR = 11


def _paragraphs(data: np.ndarray, offsets: np.ndarray, min_words: int):
    """(text index, place in the text, words, set values, set sizes, first byte, end) of long enough lines."""
    breaks = np.flatnonzero(data == 10)
    edges = np.unique(np.concatenate([offsets, breaks]))
    starts = edges[:-1]
    text = np.searchsorted(offsets, starts, side="right") - 1
    first = np.searchsorted(starts, offsets[:-1])
    place = np.arange(len(starts)) - first[text] if len(starts) else np.zeros(0, np.int64)
    words = wordhash.Words(data, edges)
    values, counts = wordhash.shingles(words, SHINGLE_WORDS)
    long_enough = words.counts >= min_words
    values = values[np.repeat(long_enough, counts)]
    members, sizes = wordhash.distinct(values, counts[long_enough])
    return text[long_enough], place[long_enough], words.counts[long_enough], members, sizes, starts[long_enough], edges[1:][long_enough]


def _features(min_words: int):
    def run(batches):
        for batch in batches:
            for first, end, data, offsets in wordhash.chunks(batch.column(1)):
                text, place, n_words, members, sizes, _, _ = _paragraphs(data, offsets, min_words)
                sum_a, sum_b = set_columns(members, sizes)
                keys, sketch = band_keys(members, sizes, BANDS, ROWS)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first).take(pa.array(text)), pa.array(place.astype(np.int64)),
                     pa.array(n_words.astype(np.int64)), pa.array(sizes.astype(np.int64)), pa.array(sum_a.view(np.int64)),
                     pa.array(sum_b.view(np.int64)), wordhash.list_column(keys.reshape(-1), np.full(len(sizes), BANDS)), sketch],
                    ["doc_id", "paragraph", "n_words", "n", "sum_a", "sum_b", "bands", "sketch"])
    return run


def _lines(min_words: int):
    def run(batches):
        for batch in batches:
            for first, end, data, offsets in wordhash.chunks(batch.column(1)):
                text, place, _, members, sizes, starts, ends = _paragraphs(data, offsets, min_words)
                sum_a, sum_b = set_columns(members, sizes)
                lines = pa.array([data[a:b].tobytes().decode() for a, b in zip(starts, ends)], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first).take(pa.array(text)), pa.array(place.astype(np.int64)),
                     pa.array(sum_a.view(np.int64)), pa.array(sum_b.view(np.int64)), lines],
                    ["doc_id", "paragraph", "sum_a", "sum_b", "text"])
    return run


def repeated_paragraphs(docs: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per paragraph that has an equal or near equal elsewhere.

    doc_id, paragraph (place of the line in its text, from 0), n_words, first_doc_id and
    first_paragraph (the one of its component that stays), n_paragraphs of the component,
    n_docs_about (an estimate of its documents), removed. Rows with a NULL doc_id or text have no paragraphs; a line that repeats
    inside one text counts too. Other columns are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "paragraphs")
    text = docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # A place in the text names a paragraph only if ids are unique, so rows get numbers as well.
    wide = scratch.store(text.mapInArrow(
        _features(min_words), "doc_id long, paragraph long, n_words long, n long, sum_a long, sum_b long, bands array<long>, sketch binary")
        .withColumn("pid", F.monotonically_increasing_id()))

    set_key = ["n", "sum_a", "sum_b"]
    classes = scratch.store(wide.groupBy(*set_key).agg(F.min("pid").alias("id"), F.count(F.lit(1)).alias("copies")))
    banded = scratch.store(wide.join(classes.select(F.col("id").alias("pid")), "pid", "left_semi").select(
        F.col("pid").alias("id"), "n", "bands", "sketch"))
    # Bands and sketches are most of the rows and are needed once for each class only.
    features = scratch.store(wide.drop("bands", "sketch"))
    scratch.drop(wide)

    def texts_of(ids: DataFrame) -> DataFrame:
        asked = features.select("pid", "doc_id", "paragraph", "sum_a", "sum_b").join(ids.withColumnRenamed("id", "pid"), "pid")
        found = text.join(asked.select("doc_id").distinct(), "doc_id", "left_semi").mapInArrow(
            _lines(min_words), "doc_id long, paragraph long, sum_a long, sum_b long, text string")
        return found.join(asked, ["doc_id", "paragraph", "sum_a", "sum_b"]).select(
            F.col("pid").alias("id"), "text").dropDuplicates(["id"])

    linked = link_sets(banded, texts_of, percent, SHINGLE_WORDS, scratch)
    repeated = scratch.store(
        classes.join(linked, "id", "left").where("copies > 1 or component is not null")
        .select(*set_key, F.coalesce("component", "id").alias("component")))
    members = scratch.store(features.select("doc_id", "paragraph", "n_words", *set_key).join(repeated, set_key).drop(*set_key))
    scratch.drop_since(0, members)
    firsts = members.groupBy("component").agg(
        F.min(F.struct("doc_id", "paragraph")).alias("first"), F.count(F.lit(1)).alias("n_paragraphs"),
        F.approx_count_distinct("doc_id").alias("about_docs"))
    return members.join(firsts, "component").select(
        "doc_id", "paragraph", "n_words", F.col("first.doc_id").alias("first_doc_id"),
        F.col("first.paragraph").alias("first_paragraph"), "n_paragraphs", F.col("about_docs").alias("n_docs_about"),
        ((F.col("doc_id") != F.col("first.doc_id")) | (F.col("paragraph") != F.col("first.paragraph"))).alias("removed"))


def _windows(words: wordhash.Words, size: int, seed: int) -> np.ndarray:
    """A hash of the ``size`` words from every word on, beyond the ends of texts too."""
    runs = max(len(words.hashes) - size + 1, 0)
    sums = np.zeros(runs, dtype=np.uint64)
    for k, weight in enumerate(wordhash.multipliers(size, seed)):
        sums += words.hashes[k:k + runs] * weight
    return wordhash.mix(sums)


def _least(words: wordhash.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per window of RUN words: whether it stays in its text, and where its anchor begins; and the hashes of all anchors."""
    hashes = _windows(words, ANCHOR, 19)
    runs = max(len(words.hashes) - RUN + 1, 0)
    if not runs:
        return np.zeros(0, dtype=bool), np.zeros(0, dtype=np.int64), hashes
    least = np.lib.stride_tricks.sliding_window_view(hashes, RUN - ANCHOR + 1).argmin(axis=1) + np.arange(runs)
    return words.text[:runs] == words.text[RUN - 1:], least, hashes


def _anchors(batches):
    for batch in batches:
        for first, end, data, offsets in wordhash.chunks(batch.column(2)):
            words = wordhash.Words(data, offsets)
            inside, least, hashes = _least(words)
            at = np.unique(least[inside])
            text = words.text[at]
            taken = batch.slice(first, end - first).select([0, 1]).take(pa.array(text))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array((at - words.first[text]).astype(np.int32)), pa.array(hashes[at].view(np.int64))],
                ["doc_id", "row", "at", "anchor"])


def _runs_at(batches):
    """Per anchor ``at``, the neighbouring windows of RUN words whose anchor it is: first start and hashes."""
    for batch in batches:
        for first, end, data, offsets in wordhash.chunks(batch.column(2)):
            words = wordhash.Words(data, offsets)
            rows = batch.slice(first, end - first)
            inside, least, hashes = _least(words)
            asked = np.zeros(len(words.hashes), dtype=bool)
            for k, at in enumerate(rows.column(3)):
                asked[words.first[k] + at.values.to_numpy()] = True
            start = np.flatnonzero(inside & asked[least])
            begins = np.flatnonzero(np.concatenate([[True], least[start[1:]] != least[start[:-1]]])) if len(start) else start
            counts, start_at = np.diff(np.append(begins, len(start))), start[begins]
            text = words.text[start_at]
            taken = rows.select([0, 1]).take(pa.array(text))
            h_a, h_b = (wordhash.list_column(_windows(words, RUN, seed)[start], counts) for seed in (23, 29))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[least[start_at]].view(np.int64)), *taken.columns,
                 pa.array((start_at - words.first[text]).astype(np.int32)), h_a, h_b],
                ["anchor", "doc_id", "row", "start", "h_a", "h_b"])


def _texts(docs: DataFrame) -> DataFrame:
    """(doc_id, row, text); rows that share a doc_id are told apart by their texts."""
    return docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("row"),
        F.col("text").cast("string").alias("text"))


def repeated_passages(docs: DataFrame) -> DataFrame:
    """One row per longest run of words that stands in another document too.

    doc_id, row (hash of the text), start_word (from 0), n_words (RUN or more), first_doc_id and
    first_word (where it stands in the smallest document that has it), n_docs (most documents
    that share RUN words of it), removed. Runs with different first places are rows of their
    own and may overlap. Rows of one doc_id are one document.
    """
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "passages")
    text = _texts(docs)
    alike = Window.partitionBy("anchor")
    shared = text.mapInArrow(_anchors, "doc_id long, row long, at int, anchor long").withColumns(
        {"low": F.min("doc_id").over(alike), "high": F.max("doc_id").over(alike)}).where("low < high")
    found = scratch.store(shared.groupBy("doc_id", "row").agg(F.collect_set("at").alias("at")))
    # Equal windows have equal anchors: what is dealt by anchor is grouped, and joined again, where it is.
    dealt = text.join(found, ["doc_id", "row"]).dropDuplicates(["doc_id", "row"]).select("doc_id", "row", "text", "at").mapInArrow(
        _runs_at, "anchor long, doc_id long, row long, start int, h_a array<long>, h_b array<long>").repartition("anchor")
    runs = dealt.select("anchor", "doc_id", "row", "start", F.posexplode(F.arrays_zip("h_a", "h_b")).alias("k", "h")).select(
        "anchor", "doc_id", "row", (F.col("start") + F.col("k")).alias("start"), "h.h_a", "h.h_b")
    equal = Window.partitionBy("anchor", "h_a", "h_b")
    placed = runs.withColumn("_docs", F.dense_rank().over(equal.orderBy("doc_id"))).withColumns({
        "n_docs": F.max("_docs").over(equal), "first": F.min(F.struct("doc_id", "start")).over(equal)}).where("n_docs > 1").select(
        "anchor", "doc_id", "row", "start", F.lit(1).alias("k"), F.col("n_docs").cast("long").alias("n_docs"),
        F.col("first.doc_id").alias("first_doc_id"), F.col("first.start").alias("first_word"))
    pieces = scratch.store(_put_together(placed, "anchor", "doc_id", "row").drop("anchor"))
    scratch.drop(found)
    return _put_together(pieces, "doc_id", "row").select(
        "doc_id", "row", F.col("start").alias("start_word"), (F.col("k") + RUN - 1).alias("n_words"), "first_doc_id", "first_word", "n_docs",
        (F.col("doc_id") != F.col("first_doc_id")).alias("removed"))


def _put_together(pieces: DataFrame, *text: str) -> DataFrame:
    """Pieces of ``k`` windows that go on in the text as in their first place, as one."""
    line = Window.partitionBy(*text).orderBy("start")
    before = lambda name: F.lag(name).over(line)
    goes_on = ((before("start") + before("k") == F.col("start")) & (before("first_doc_id") == F.col("first_doc_id"))
               & (before("first_word") + before("k") == F.col("first_word")))
    numbered = pieces.withColumn("_new", F.when(goes_on, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(line))
    return numbered.groupBy(*text, "_run", "first_doc_id").agg(
        F.min("start").alias("start"), F.sum("k").alias("k"), F.min("first_word").alias("first_word"),
        F.max("n_docs").alias("n_docs")).drop("_run")


def _without_runs(batches):
    """Texts without the words of their runs; line ends stay, so lines keep their places."""
    for batch in batches:
        for first, end, data, offsets in wordhash.chunks(batch.column(2)):
            words, rows = wordhash.Words(data, offsets), batch.slice(first, end - first)
            keep = np.ones(len(data), dtype=bool)
            for k, runs in enumerate(rows.column(3).to_pylist()):
                for run in runs:
                    a = words.first[k] + run["start_word"]
                    keep[words.starts[a]:words.ends[a + run["n_words"] - 1]] = False
            keep |= data == 10
            texts = [data[a:b][keep[a:b]].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([*rows.columns[:2], pa.array(texts, pa.string())], ["_doc", "_row", "_cut"])


def without_repeats(docs: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the removed paragraphs and passages taken out of the texts."""
    runs = repeated_passages(docs).where("removed").groupBy("doc_id", "row").agg(
        F.collect_list(F.struct("start_word", "n_words")).alias("runs"))
    cut = _texts(docs).join(runs, ["doc_id", "row"]).dropDuplicates(["doc_id", "row"]).select("doc_id", "row", "text", "runs").mapInArrow(
        _without_runs, "_doc long, _row long, _cut string")
    return _without_lines(
        docs.join(cut, (docs["doc_id"].cast("long") == F.col("_doc")) & (F.xxhash64(docs["text"].cast("string")) == F.col("_row")), "left")
        .withColumn("text", F.coalesce("_cut", "text")).drop("_doc", "_row", "_cut"), docs, percent, min_words)


def _without_lines(cut: DataFrame, docs: DataFrame, percent: int, min_words: int) -> DataFrame:
    gone = repeated_paragraphs(docs, percent, min_words).where("removed").groupBy(F.col("doc_id").alias("_doc")).agg(
        F.collect_set("paragraph").alias("_gone"))
    joined = cut.join(gone, F.col("doc_id") == F.col("_doc"), "left")
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains("_gone", i.cast("long"))), "\n")
    return joined.withColumn("text", F.when(F.col("_gone").isNotNull(), kept).otherwise(F.col("text"))).drop("_doc", "_gone")


def op4_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated lines (with ``paragraph``) and repeated passages (with ``start_word``)."""
    docs = read_table(spark, sf_dir, "documents")
    lines, passages = repeated_paragraphs(docs), repeated_passages(docs).drop("row").withColumnRenamed("n_docs", "n_docs_about")
    return lines.unionByName(passages, allowMissingColumns=True)
