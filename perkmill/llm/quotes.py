"""Quotation linking: quoted passages back to the messages they come from.

Lines that begin with quotation marks (``>``) are quoted, once per mark; lines that announce a
quote ("On ... wrote:") belong to nobody. Neighbouring lines of one level are a passage, blank
lines divide it into paragraphs. Passages, paragraphs and lines are normalised (marks off, white
space joined, lower case, so that reflowed lines agree) and hashed, and joined to the nearest
earlier message of the same conversation that holds them as its own whole text, passage,
paragraph or line. A quoted line comes from where its passage comes from, else its paragraph,
else the line itself. A message answers the source of its outermost quoted lines: that of whole
passages before that of paragraphs and lines, then that of most lines, then the latest.
Conversations are then put in reply order, and the quotes are taken out.

Nearest holders are found in blocks of turns: no holder is paired with all quotes of a line.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkmill.llm.tables import Scratch, read_table, small_batches

MARKS = r"^((?:\s*>)+)"
ATTRIBUTION = r"^\s*(?:On\b.{0,200}\bwrote|Am\b.{0,200}\bschrieb.{0,80}|Le\b.{0,200}\ba écrit|El\b.{0,200}\bescribió)\s*:\s*$"
MOST_ROUNDS = 40
# Turns of a conversation that one task looks through for the nearest holder of a text.
BLOCK_TURNS = 1024
UNITS = T.ArrayType(T.StructType([
    T.StructField("level", T.IntegerType()), T.StructField("line", T.IntegerType()), T.StructField("rank", T.IntegerType()), T.StructField("hash", T.BinaryType())]))


def quoted_lines(text: Column) -> Column:
    """array<struct<level, line>> of a text; own lines have level 0, attribution lines of any level -1."""
    def one(line: Column) -> Column:
        level = F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), r"\s", ""))
        own = F.regexp_replace(line, MARKS + r"[ \t]?", "")
        return F.struct(
            F.when(own.rlike(ATTRIBUTION), -1).otherwise(level).cast("int").alias("level"), own.alias("line"))

    return F.transform(F.split(F.coalesce(text, F.lit("")), r"\r?\n"), one)


def units(lines) -> list[dict]:
    """Hashes of the passages (rank 0), paragraphs (1) and lines (2) that each line is part of.

    Own lines give each hash once, quoted ones once for every line, which ``line`` numbers.
    """
    out, own = [], []
    for level, run in groupby(enumerate(lines), key=lambda x: x[1]["level"]):
        words = [(i, x["line"].lower().split()) for i, x in run]
        if level < 0:
            continue
        paragraphs = [list(p) for filled, p in groupby(words, key=lambda x: bool(x[1])) if filled]
        filled = [line for p in paragraphs for line in p]
        for rank, parts in enumerate(([filled], paragraphs, [[line] for line in filled])):
            for part in parts:
                digest = _digest(part)
                out += [{"level": level, "line": i, "rank": rank, "hash": digest} for i, _ in (part if level else part[:1])]
        own += [line for line in filled if not level]
    if own:
        out.append({"level": 0, "line": own[0][0], "rank": 0, "hash": _digest(own)})
    return out


def _digest(lines: list) -> bytes:
    return hashlib.blake2b(" ".join(w for _, words in lines for w in words).encode("utf-8", "surrogatepass"), digest_size=16).digest()


@F.pandas_udf(UNITS)
def _units(lines: pd.Series) -> pd.Series:
    return lines.map(units)


def nearest_holders(texts: DataFrame) -> DataFrame:
    """(conv_id, hash, turn, source) of quoted texts that an earlier turn holds, the nearest one.

    ``texts`` has conv_id, turn, hash, own (whether the turn holds the text or quotes it).
    """
    turns = texts.groupBy("conv_id", "hash", "turn").agg(F.max("own").alias("own"), F.min("own").alias("only_own"))
    turns = turns.withColumn("block", F.floor(F.col("turn") / BLOCK_TURNS))
    held = F.when(F.col("own"), F.col("turn"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    blocks = turns.groupBy("conv_id", "hash", "block").agg(F.max(held).alias("latest")).withColumn(
        "carried", F.max("latest").over(before(Window.partitionBy("conv_id", "hash").orderBy("block"))))
    inside = turns.withColumn("inside", F.max(held).over(before(Window.partitionBy("conv_id", "hash", "block").orderBy("turn"))))
    found = inside.where(~F.col("only_own")).join(blocks.where("carried is not null").select("conv_id", "hash", "block", "carried"), ["conv_id", "hash", "block"], "left")
    return found.select("conv_id", "hash", "turn", F.coalesce("inside", "carried").alias("source")).where("source is not null")


def link_quotes(messages: DataFrame) -> DataFrame:
    """One row per row of ``messages`` (conv_id, turn, role, text), in reply order by its sort keys.

    conv_id, turn, role, own_text (without quotes and attributions), n_quoted, n_linked (quoted
    lines, and those found in an earlier message), quote_depth, reply_to (turn answered; NULL if
    none), root_turn and depth of the reply tree. Ordering by (conv_id, root_turn, depth, turn)
    gives the conversation. Messages whose conv_id or turn is NULL link with nothing; rows that
    share both have the same links, and their quoted lines count together. A NULL or empty text
    has no words and links with nothing. Other columns are ignored.
    """
    scratch = Scratch(messages.sparkSession, "quotes")
    rows = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
        quoted_lines(F.col("text").cast("string")).alias("lines"))
    rows = scratch.store(rows)
    small_batches(messages.sparkSession)
    parts = scratch.store(rows.where("conv_id is not null and turn is not null").select("conv_id", "turn", F.explode(_units("lines")).alias("unit")).select(
        "conv_id", "turn", "unit.*"))
    sources = nearest_holders(parts.select("conv_id", "turn", "hash", (F.col("level") == 0).alias("own")))
    quoted = parts.where("level > 0").groupBy("conv_id", "turn", "level", "line", "rank", "hash").agg(F.count(F.lit(1)).alias("times"))
    lines = quoted.join(sources, ["conv_id", "turn", "hash"]).groupBy("conv_id", "turn", "level", "line").agg(
        F.min(F.struct("rank", "source", "times")).alias("found")).select("conv_id", "turn", "level", "found.*")
    per_source = lines.groupBy("conv_id", "turn", "level", "rank", "source").agg(F.sum("times").alias("n"))
    per_message = scratch.store(per_source.groupBy("conv_id", "turn").agg(
        F.sum("n").alias("n_linked"),
        F.max_by("source", F.struct(-F.col("level"), -F.col("rank"), F.col("n"), F.col("source"))).alias("reply_to")))
    parents = per_message.where("reply_to is not null").select("conv_id", "turn", "reply_to")
    placed = _roots(parents, scratch)

    own_text = F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["line"]), "\n")
    shown = rows.select(
        "conv_id", "turn", "role", F.regexp_replace(own_text, r"^\s+|\s+$", "").alias("own_text"),
        F.size(F.filter("lines", lambda x: x["level"] > 0)).cast("long").alias("n_quoted"),
        F.greatest(F.array_max(F.transform("lines", lambda x: x["level"])), F.lit(0)).alias("quote_depth"))
    linked = per_message.join(placed, ["conv_id", "turn"], "left")
    return shown.join(linked, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "own_text", "n_quoted", F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        "quote_depth", "reply_to", F.coalesce("root_turn", "turn").alias("root_turn"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"))


def _roots(parents: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, turn, root_turn, depth) of messages that answer one, by doubling the steps.

    A message always answers an earlier one, so there are no rings. Messages that have reached
    their root are set aside; only the others are joined again, so a few long conversations
    do not make all messages take part in every round.
    """
    climbing = scratch.store(parents.select("conv_id", "turn", F.col("reply_to").alias("root_turn"), F.lit(1).cast("long").alias("depth")))
    settled = None
    for _ in range(MOST_ROUNDS):
        known = climbing.withColumn("open", F.lit(True))
        if settled is not None:
            known = known.unionByName(settled.withColumn("open", F.lit(False)))
        up = known.select("conv_id", F.col("turn").alias("root_turn"), F.col("root_turn").alias("up"), F.col("depth").alias("more"), "open")
        moved = scratch.store(climbing.join(up, ["conv_id", "root_turn"], "left").select(
            "conv_id", "turn", F.coalesce("up", "root_turn").alias("root_turn"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.coalesce("open", F.lit(False)).alias("open")))
        arrived = moved.where(~F.col("open")).drop("open")
        settled = arrived if settled is None else settled.unionByName(arrived)
        climbing = moved.where("open").drop("open")
        if climbing.isEmpty():
            return settled
    raise RuntimeError("reply chains are too long")


def quoting_messages(conversations: DataFrame) -> DataFrame:
    """Messages as mail clients send them: every turn quotes the turn before it and, one level
    deeper, the turn before that. Of eight turns one quotes in a single line, one without the
    first line, and one with a line that nobody wrote. Turns are joined by number, one text each."""
    texts = conversations.where("conv_id is not null and turn is not null").groupBy("conv_id", "turn").agg(F.min("text").alias("before"))
    back = lambda k: texts.select("conv_id", (F.col("turn") + k).alias("turn"), F.col("before").alias(f"back{k}"))
    both = conversations.join(back(1), ["conv_id", "turn"], "left").join(back(2), ["conv_id", "turn"], "left")
    kind = F.crc32(F.concat_ws(":", "conv_id", "turn").cast("binary")) % 8
    first = (
        F.when(kind == 0, F.regexp_replace("back1", r"\s+", " ")).when(kind == 1, F.regexp_replace("back1", r"^[^\n]*", "[...]"))
        .when(kind == 2, F.concat("back1", F.lit("\nnobody wrote this line"))).otherwise(F.col("back1")))
    quote = lambda c, marks: F.concat(F.lit(marks), F.regexp_replace(c, "\n", "\n" + marks))
    return both.select("conv_id", "turn", "role", F.concat_ws(
        "\n", "text", F.when(F.col("back1").isNotNull(), F.concat(F.lit("On turn "), (F.col("turn") - 1).cast("string"), F.lit(" somebody wrote:"))),
        quote(first, "> "), quote(F.col("back2"), ">> ")).alias("text"))


def op2_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations table holds no quotes, so its turns are made to quote each other first."""
    return link_quotes(quoting_messages(read_table(spark, sf_dir, "conversations")))
