"""A bounded sample of labelled texts for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkmill.llm.tables import is_held_out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """(doc_id, text, label): at most ``limit`` labelled rows that are not held out.

    Taken are the rows with the smallest hashes of their ids. The sample of ids is broadcast,
    which ``limit`` bounds, so no text is shuffled to find the labelled ones. Rows without a
    label or text are left out; of several labels of one id the smallest counts; equal texts
    count once, with the label of the smallest id.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~is_held_out())
        .groupBy("doc_id").agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id", F.lit(label)), "doc_id").limit(limit))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id").where("text is not null")
    return found.groupBy("text").agg(F.min(F.struct("doc_id", "label")).alias("first")).select("first.doc_id", "text", "first.label")
