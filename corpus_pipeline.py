"""Corpus pipeline: language, near duplicates, benchmark passages, personal data, tokens.

Every stage takes (spark, docs, sf_dir) and returns a table that is stored before the next
stage reads it. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perkmill.llm import bpe, decontaminate, language, minhash, surrogates
from perkmill.llm.tables import Scratch, read_table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# A text at least this long is rejected if no language model codes it in fewer bits than it has.
JUDGED_BYTES = 64
UNCODED_BITS = 8.0


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that have no letters or fit no learned language."""
    found = language.predict(docs.select(*COLUMNS), language.learn(docs))
    foreign = (F.octet_length("text") >= JUDGED_BYTES) & (F.coalesce(F.col("bits_per_byte"), F.lit(0.0)) >= UNCODED_BITS)
    return found.where((F.col("lang_pred") != language.UNKNOWN) & ~foreign).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicate texts; different texts under one doc_id all stay.

    Rows without a doc_id cannot be told apart and all stay.
    """
    kept = minhash.kept_rows(docs).select(F.col("doc_id").alias("_doc"), F.col("row").alias("_text"))
    hashed = docs.where("doc_id is not null").withColumn("_hash", minhash.text_hash())
    copies = Window.partitionBy("doc_id", "_hash").orderBy("lang", "source", "n_chars")
    named = hashed.join(kept, (F.col("doc_id") == F.col("_doc")) & (F.col("_hash") == F.col("_text")), "left_semi").withColumn(
        "_row", F.row_number().over(copies))
    return named.where("_row = 1").select(*COLUMNS).unionByName(docs.where("doc_id is null").select(*COLUMNS))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a window of a benchmark item."""
    return decontaminate.clean_documents(docs.select(*COLUMNS), read_table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by surrogates; n_chars follows the new text."""
    out = surrogates.replace(docs.select(*COLUMNS))
    changed = F.size("_surrogates") > 0
    return out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return bpe.tokenized(docs, with_ids=False)


STAGES = [
    ("language", identify_language),
    ("near duplicates", drop_near_duplicates),
    ("benchmark", drop_benchmark),
    ("personal data", replace_personal_data),
    ("tokens", tokenize),
]

# The language models and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; every result is stored and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.store(stage(spark, docs, sf_dir))
    return docs
