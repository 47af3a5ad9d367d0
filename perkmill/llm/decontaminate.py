"""Benchmark decontamination: windows of benchmark words searched in whole texts.

Only DataFrame functions are used. The hashes of all benchmark windows form a set that every
task gets (as a literal set in the filter); training windows that hit it are verified by
their words. The set is used while the benchmark has at most MOST_WINDOWS windows; a larger
one is joined with all windows of the texts instead, with the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perkmill.llm.tables import Scratch, read_table

WINDOW = 10
MOST_WINDOWS = 50_000
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text with A-Z read as a-z; NULL has none. Other capitals stay as they are."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(lowered, BETWEEN), "")


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, len, window): all runs of ``size`` words; a shorter item is one window.

    Items without an id or without words have none.
    """
    listed = items.where("item_id is not null").select("item_id", words(F.col("text")).alias("w"))
    n = F.size("w")
    starts = F.when(n >= size, F.sequence(F.lit(1), n - size + 1)).when(n > 0, F.array(F.lit(1)))
    return listed.select("item_id", F.least(n, F.lit(size)).alias("len"), "w", F.explode(starts).alias("s")).select(
        "item_id", "len", F.array_join(F.slice("w", F.col("s"), F.col("len")), " ").alias("window")).distinct()


def _hits_sql(hashes: dict[int, list[int] | None]) -> str:
    """SQL of the windows (start, len, window) of words ``w`` whose hash is wanted; all for None."""
    parts = ["cast(array() as array<struct<start:int,len:int,window:string>>)"]
    for length, wanted in sorted(hashes.items()):
        starts = f"sequence(1, size(w) - {length - 1})"
        if wanted is not None:
            listed = ",".join(f"{h}L" for h in wanted)
            starts = f"filter({starts}, s -> xxhash64(array_join(slice(w, s, {length}), ' ')) IN ({listed}))"
        parts.append(f"if(size(w) >= {length}, transform({starts}, s -> named_struct('start', s, 'len', {length}, "
                     f"'window', array_join(slice(w, s, {length}), ' '))), {parts[0]})")
    return f"concat({', '.join(parts)})"


def find_hits(docs: DataFrame, items: DataFrame, size: int = WINDOW, most_windows: int = MOST_WINDOWS) -> DataFrame:
    """``docs`` rows as (row, doc_id, n_words, item_ids, spans).

    spans are (start, len) of verified windows in words, counted from 1. Every input row gives
    one row, rows that share a doc_id or have none too.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate")
    windows = scratch.store(item_windows(items, size))
    lengths = {r.len: r.n for r in windows.groupBy("len").agg(F.count(F.lit(1)).alias("n")).collect()}
    small = sum(lengths.values()) <= most_windows
    hashes: dict[int, list[int] | None] = {length: None for length in lengths}
    if small and lengths:
        hashes = {length: [] for length in lengths}
        for r in windows.select("len", F.xxhash64("window").alias("h")).distinct().collect():
            hashes[r.len].append(r.h)
    # The words are bound to a name inside one expression, so every text is cut once.
    cut = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id"), F.array(words(F.col("text"))).alias("cut"))
    found = F.expr(f"transform(cut, w -> named_struct('n', cast(size(w) as bigint), 'hits', {_hits_sql(hashes)}))[0]")
    hits = cut.select("row", "doc_id", found.alias("f")).select(
        "row", "doc_id", F.col("f.n").alias("n_words"), F.explode_outer("f.hits").alias("hit"))
    hits = hits.select("row", "doc_id", "n_words", F.col("hit.start").alias("start"), F.col("hit.window").alias("window"))
    table = F.broadcast(windows) if small else windows
    joined = hits.join(table, "window", "left")
    span = F.when(F.col("item_id").isNotNull(), F.struct(F.col("start"), F.col("len")))
    return joined.groupBy("row", "doc_id", "n_words").agg(
        F.collect_set(F.col("item_id").cast("string")).alias("item_ids"), F.collect_set(span).alias("spans"))


def hit_positions(spans: str = "spans") -> Column:
    """The distinct word positions that lie in any span."""
    return F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1))))


def report(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, item_ids per row of ``docs``."""
    found = find_hits(docs, items, size)
    n_hit = F.size(hit_positions()).cast("long")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("item_ids"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"), F.sort_array("item_ids").alias("item_ids"))


def _quoted(texts: list[str]) -> str:
    """SQL literals; words hold neither quotes nor backslashes."""
    return ",".join(f"'{t}'" for t in texts)


def clean_documents(docs: DataFrame, items: DataFrame, size: int = WINDOW, most_windows: int = MOST_WINDOWS) -> DataFrame:
    """``docs`` without the contaminated rows; rows with NULL or empty texts stay.

    While the benchmark is small enough for the set, the words of every window are looked up in
    the row itself and nothing is shuffled. Beyond that, rows are stored with a number each and
    judged by it, whatever their doc_id, so both ways give the same rows.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate")
    windows = scratch.store(item_windows(items, size).select("len", "window").distinct())
    if windows.count() <= most_windows:
        by_length: dict[int, list[str]] = {}
        for r in windows.collect():
            by_length.setdefault(r.len, []).append(r.window)
        if not by_length:
            return docs
        rules = " or ".join(
            f"if(size(w) >= {length}, exists(sequence(1, size(w) - {length - 1}), "
            f"s -> array_join(slice(w, s, {length}), ' ') IN ({_quoted(texts)})), false)"
            for length, texts in sorted(by_length.items()))
        # The words are bound to a name inside one expression: a filter on a column of their own
        # would be pushed below it and cut the text anew for every window.
        bound = docs.withColumn("_words", F.array(words(F.col("text"))))
        return bound.where(F.expr(f"not exists(_words, w -> {rules})")).drop("_words")
    numbered = scratch.store(docs.withColumn("_number", F.monotonically_increasing_id()))
    rows = numbered.select(F.col("_number").alias("doc_id"), "text")
    dirty = find_hits(rows, items, size, most_windows).where(F.size("spans") > 0).select(F.col("doc_id").alias("_number"))
    return numbered.join(dirty, "_number", "left_anti").select(*docs.columns)


def cut_spans(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc_id, text): whole texts with the hit words taken out, other characters kept.

    Rows are stored with a number each and judged by it: rows that share a doc_id, or have
    none, lose their own hit words only. NULL texts stay NULL.
    """
    numbered = Scratch(docs.sparkSession, "decontaminate").store(
        docs.select("doc_id", "text").withColumn("_number", F.monotonically_increasing_id()))
    found = find_hits(numbered.select(F.col("_number").alias("doc_id"), "text"), items, size).where(F.size("spans") > 0).select(
        F.col("doc_id").alias("_dirty"), hit_positions().alias("_hit"))
    own = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    both = numbered.join(found, F.col("_number") == F.col("_dirty"), "left").select(
        "doc_id", "text", "_hit", F.split("text", own).alias("_gaps"), F.regexp_extract_all("text", F.lit(own), F.lit(0)).alias("_words"))
    kept = F.expr("array_join(transform(_gaps, (g, i) -> concat(g, if(i < size(_words) and not array_contains(_hit, i + 1), _words[i], ''))), '')")
    return both.select("doc_id", F.when(F.col("_hit").isNotNull(), kept).otherwise(F.col("text")).alias("text"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP5_SQL = """
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS k, array_to_string(ws[s:s + least(len(ws), 10) - 1], ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS s FROM b WHERE len(ws) > 0)),
dw AS (
  SELECT doc_id, k, s, array_to_string(ws[s:s + k - 1], ' ') AS win
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS s
        FROM w, (SELECT DISTINCT k FROM bw) WHERE len(ws) >= k)),
hit AS (SELECT doc_id, dw.k, s, item_id FROM dw JOIN bw USING (k, win)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS item_ids FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  CAST(coalesce(len(item_ids), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(item_ids, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated, coalesce(item_ids, CAST([] AS VARCHAR[])) AS item_ids
FROM w LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
