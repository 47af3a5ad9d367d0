"""Line dedup: lines that many documents share leave all documents but the last one.

Every line gets a key: the line without ASCII white space at its ends, A-Z read as a-z. Lines
with a key of ``min_chars`` code points or more are exploded as 128-bit hashes, once per
document; hashes are counted over all documents, and the positions of dropped lines go back
to their texts, which keep the other lines in order.

Texts are moved once, and only if the dropped positions are too many to broadcast (Spark
decides by the size of the stored table). Before that only hashes of long lines are moved,
combined before every shuffle. Rows are named by (doc_id, hash of the text): rows equal in
both lose the same lines, so no row numbers are needed and a lost executor changes nothing.

Odd rows: a NULL text reads as an empty one, an empty text is one empty line. Rows without a
doc_id are no documents in the count and never the last holder, but lose what others lose.
Rows that share a doc_id count as one document and all keep the lines it keeps. An empty
table gives an empty result. Columns of ``docs`` other than doc_id and text are left alone;
of its own names (n_lines, n_dropped) the new columns replace old ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perkmill.llm.tables import Scratch, read_table

MIN_CHARS = 40
MIN_DOCS = 5
BLANK = b" \t\n\x0b\x0c\r"
_LINES = "doc_id {id}, text_hash long, key binary, positions array<int>"
# Explode this many keys of a batch at most before they are handed on.
_ROWS = 20_000


def line_keys(min_chars: int = MIN_CHARS):
    """Batches (doc_id, text_hash, text) as one row per distinct long key of each text."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, hashes, positions = [], [], []

            def handed_on() -> pa.RecordBatch:
                taken = batch.select(["doc_id", "text_hash"]).take(pa.array(source, pa.int64()))
                return pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(hashes, pa.binary()), pa.array(positions, pa.list_(pa.int32()))],
                    ["doc_id", "text_hash", "key", "positions"])

            for row, text in enumerate(batch["text"]):
                found: dict[bytes, list[int]] = {}
                for at, line in enumerate((text.as_py() or "").encode().lower().split(b"\n")):
                    key = line.strip(BLANK)
                    if len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars):
                        found.setdefault(xxhash.xxh3_128_digest(key), []).append(at)
                source += [row] * len(found)
                hashes += found.keys()
                positions += found.values()
                if len(source) >= _ROWS:
                    yield handed_on()
                    source, hashes, positions = [], [], []
            if source:
                yield handed_on()

    return keys


def dropped_lines(docs: DataFrame, scratch: Scratch, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, text_hash, dropped): sorted positions, from 0, of the lines that a text loses."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    named = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    lines = scratch.store(named.mapInArrow(line_keys(min_chars), _LINES.format(id=kind)))
    # No key of fewer rows can be in enough documents; a row is one key of one text.
    often = scratch.store(lines.groupBy("key").agg(F.count("doc_id").alias("n")).where(F.col("n") >= min_docs).select("key"))
    repeated = scratch.store(lines.join(often, "key"))
    holders = repeated.groupBy("key").agg(F.countDistinct("doc_id").alias("n"), F.max("doc_id").alias("last_id"))
    frequent = scratch.store(holders.where(F.col("n") >= min_docs).select("key", "last_id"))
    lost = repeated.join(frequent, "key").where(~F.col("doc_id").eqNullSafe(F.col("last_id")))
    # Rows that repeat one text would list each position again.
    return lost.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("positions")))).alias("dropped"))


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the kept lines as text; n_lines (before) and n_dropped are added."""
    scratch = Scratch(docs.sparkSession, "lines")
    dropped = scratch.store(dropped_lines(docs, scratch, min_chars, min_docs)).select(
        F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), F.col("dropped").alias("_dropped"))
    joined = docs.join(dropped, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64("text") == F.col("_hash")), "left")
    lines = joined.withColumn("_lines", F.split(F.coalesce("text", F.lit("")), "\n")).withColumn(
        "_lines_n", F.size("_lines").cast("long"))
    # The lines between two dropped ones are one slice, so the work grows with lines plus drops.
    bounds = F.concat(F.array(F.lit(-1)), "_dropped", F.array(F.size("_lines")))
    kept = F.expr("array_join(flatten(transform(sequence(0, size(_dropped)), "
                  "i -> slice(_lines, _bounds[i] + 2, _bounds[i + 1] - _bounds[i] - 1))), '\n')")
    new = {"text": F.when(F.col("_dropped").isNull(), F.coalesce("text", F.lit(""))).otherwise(kept),
           "n_lines": F.col("_lines_n"), "n_dropped": F.coalesce(F.size("_dropped"), F.lit(0)).cast("long")}
    order = [c for c in docs.columns if c not in ("n_lines", "n_dropped")] + ["n_lines", "n_dropped"]
    return lines.withColumn("_bounds", bounds).select(*[new[c].alias(c) if c in new else F.col(c) for c in order])


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP12_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM d),
k AS (SELECT *, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS last_id FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT r, k.doc_id, line, pos, f.key IS NOT NULL AND k.doc_id IS DISTINCT FROM last_id AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
"""
