"""MinHash near-dedup with min-max signatures.

Every permutation gives two signature values, its minimum and its maximum over the set, so a
signature of 120 values takes 60 hash evaluations per shingle. A band holds values of
different permutations. With 30 bands of 7 values two sets of similarity 0.85 share no band
with a probability of one in 100,000.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perkmill.llm import wordhash
from perkmill.llm.banding import link_sets, sketches_of
from perkmill.llm.components import connected_components
from perkmill.llm.tables import Scratch, read_table, small_batches

SHINGLE_WORDS = 5
BANDS, ROWS = 30, 7
PERCENT = 85


def band_keys(values: np.ndarray, counts: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> tuple[np.ndarray, pa.Array]:
    """Band keys (texts x bands) and sketches of min-max signatures over each text's values."""
    permutations = (bands * rows + 1) // 2
    scale, shift = wordhash.multipliers(permutations, 11), wordhash.multipliers(permutations, 13)
    signature = np.empty((2 * permutations, len(counts)), dtype=np.uint64)
    for k in range(permutations):
        permuted = values * scale[k] + shift[k]
        signature[k] = wordhash.per_text(np.minimum, permuted, counts)
        signature[permutations + k] = wordhash.per_text(np.maximum, permuted, counts)
    keys = np.empty((len(counts), bands), dtype=np.uint64)
    weights = wordhash.multipliers(rows, 17)
    for band in range(bands):
        part = signature[band * rows:(band + 1) * rows]
        keys[:, band] = wordhash.mix((part * weights[:len(part), None]).sum(axis=0) + np.uint64(band))
    return keys, sketches_of(signature)


def set_columns(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that name a set of distinct values."""
    return (wordhash.per_text(np.add, wordhash.mix(values), counts),
            wordhash.per_text(np.add, wordhash.mix(values ^ np.uint64(0x5851F42D4C957F2D)), counts))


def _features(batches):
    for batch in batches:
        ids, texts, rows = batch.column(0), batch.column(1), batch.column(2)
        for first, end, data, offsets in wordhash.chunks(texts):
            values, counts = wordhash.shingles(wordhash.Words(data, offsets), SHINGLE_WORDS)
            members, sizes = wordhash.distinct(values, counts)
            sum_a, sum_b = set_columns(members, sizes)
            keys, sketch = band_keys(members, sizes)
            keys = keys[sizes > 0]
            lists = wordhash.list_column(keys.reshape(-1), np.where(sizes > 0, BANDS, 0))
            yield pa.RecordBatch.from_arrays(
                [ids.slice(first, end - first), rows.slice(first, end - first), pa.array(sizes.astype(np.int64)), pa.array(sum_a.view(np.int64)),
                 pa.array(sum_b.view(np.int64)), lists, sketch], ["doc_id", "row", "n", "sum_a", "sum_b", "bands", "sketch"])


SET = ["n", "sum_a", "sum_b"]


def text_hash() -> Column:
    """Tells rows of one doc_id apart by their texts."""
    return F.xxhash64(F.col("text").cast("string"))


def _linked_classes(docs: DataFrame, percent: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Features of all rows, and (n, sum_a, sum_b, id, doc_id, component) per class of equal sets.

    A class is named by the number of one of its rows, so texts under one doc_id stay apart;
    doc_id is its smallest.
    """
    begun = scratch.made
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), text_hash().alias("row"))
    features = scratch.store(text.mapInArrow(
        _features, "doc_id long, row long, n long, sum_a long, sum_b long, bands array<long>, sketch binary")
        .withColumn("id", F.monotonically_increasing_id()))

    usable = features.where("n > 0 and doc_id is not null")
    classes = scratch.store(usable.groupBy(*SET).agg(F.min(F.struct("doc_id", "id", "row")).alias("least")).select(*SET, "least.*"))
    banded = scratch.store(usable.join(classes.select("id"), "id", "left_semi").select("id", "n", "bands", "sketch"))

    def texts_of(ids: DataFrame) -> DataFrame:
        asked = classes.select("id", "doc_id", "row").join(ids, "id", "left_semi")
        return text.join(asked, ["doc_id", "row"]).select("id", "text").dropDuplicates(["id"])

    linked = link_sets(banded, texts_of, percent, SHINGLE_WORDS, scratch)
    named = scratch.store(
        classes.join(linked, "id", "left").select(*SET, "id", "doc_id", F.coalesce("component", "id").alias("component")))
    scratch.drop_since(begun, features, named)
    return features, named


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text, ...).

    Texts that are NULL, empty or without words have an empty set and link with nothing.
    Equal sets are one class and enter the search once, so copies are never paired. A NULL
    doc_id links with nothing, has a NULL component and is kept. Rows that share a doc_id are
    one document; if their texts differ, the components of all of them are one. Other columns
    are ignored, whatever their names. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "minhash")
    features, classes = _linked_classes(docs, percent, scratch)
    whole = F.struct(*SET)
    several = scratch.store(features.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(
        F.min(whole).alias("low"), F.max(whole).alias("high")).where("low < high").select("doc_id"))
    if not several.isEmpty():
        own = scratch.store(features.where("n > 0").join(several, "doc_id").select("doc_id", *SET).distinct().join(
            classes.select(*SET, "component"), SET))
        firsts = own.groupBy("doc_id").agg(F.min("component").alias("a"))
        edges = own.join(firsts, "doc_id").select("a", F.col("component").alias("b")).where("a <> b").distinct()
        united = connected_components(scratch.store(edges), scratch).withColumnRenamed("component", "united")
        classes = scratch.store(classes.join(united.withColumnRenamed("id", "component"), "component", "left").withColumn(
            "component", F.coalesce("united", "component")).drop("united"))
    names = classes.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    owners = scratch.store(classes.join(names, "component").select(*SET, "component_id"))
    found = features.select("doc_id", *SET).join(owners, SET, "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def kept_rows(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, row) of one row of each component of texts, whatever their ids; ``row`` is :func:`text_hash`.

    Texts without words are kept once under each id. Rows without a doc_id are not named.
    """
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "minhash")
    features, classes = _linked_classes(docs, percent, scratch)
    chosen = classes.groupBy("component").agg(F.min(F.struct("doc_id", "id")).alias("least")).select("least.id")
    wordless = features.where("n = 0 and doc_id is not null").select("doc_id", "row").distinct()
    return features.join(chosen, "id", "left_semi").select("doc_id", "row").unionByName(wordless)


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


OP6_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[s:s + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS s FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 85 * (nx.n + ny.n - k)),
linked AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, linked.y FROM reach JOIN linked ON linked.x = reach.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""
