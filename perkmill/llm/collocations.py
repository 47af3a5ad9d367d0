"""Phrase collocations: frequent runs of words, scored by their weakest cut.

Words are what spaces and tabs leave of a piece, pieces what ``. , ; : ! ?`` and line ends
leave of a text, A-Z read as a-z. Everything is counted per language (NULL: ``und``).

The texts are read four times, whole each time; no text is moved:

1. Words are counted by hash, and so are the occurrences that every hash partition of longer
   runs will hold (its mass).
2. Misra-Gries summaries of pairs of frequent words. Each task keeps one summary per hash
   partition with room for ``SLACK * mass / threshold`` counters; when it is over-full, the
   count of the first one without room is taken from all. The summaries of one partition are
   merged the same way, and what was taken is added up with them: a run whose count plus that
   sum stays below the threshold cannot be frequent, every other one survives.
3. The same for runs of 3 to 5 words whose pairs all survived.
4. All survivors are counted exactly, by their words; what is below the threshold goes.

Runs are known by 64-bit hashes in passes 1 to 3; in pass 4 occurrences in one task are
joined by 128 bits, and tasks by the words themselves: a task hands on one table of runs for each
hash partition, and the tables of a partition are added up. A set of hashes is given to the tasks
while it has MOST_KNOWN members at most. Beyond that nothing is looked up: all runs are summarised
or counted, with the same result.

Odd rows: NULL and empty texts have no words; rows without a doc_id count like others, repeated
rows count again; an empty table gives no rows. Only text and lang are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perkmill.llm import wordhash
from perkmill.llm.tables import Scratch, read_table

LONGEST = 5
THRESHOLD = 100
TOP = 2000
SLACK = 4
# Sets of at most this many 64-bit hashes are broadcast (32 MB).
MOST_KNOWN = 4_000_000
UNKNOWN_LANG = "und"
_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = wordhash.byte_table(b" \t" + _ENDS)
_IS_END = np.zeros(256, dtype=bool)
_IS_END[list(_ENDS)] = True
# Frequent runs are counted in at most this many hash partitions.
MOST_PARTS = 1024
# A summary is merged with this many new occurrences at a time, and handed on beyond so many counters.
_BUFFERED = 1 << 21
_MOST_COUNTERS = 1 << 22
# Different runs that a task counts before it hands them on.
_MOST_TALLIED = 1 << 19


class Runs:
    """The runs of words of some texts, by their first word; languages are told apart."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: list[str]):
        self.words = words = wordhash.Words(data, offsets, _TABLE)
        self.data, self.langs = data, langs
        salts = np.array([_lang_salt(lang) for lang in langs], dtype=np.uint64)
        self.hashes = wordhash.mix(words.hashes + salts[words.text]) if len(words.text) else words.hashes
        ends = np.concatenate([[0], np.cumsum(_IS_END[data])])
        # Words of one text and one piece have one number; texts are apart by their own.
        self.piece = ends[words.starts] + words.text
        self.whole: dict[int, np.ndarray] = {}

    def places(self, size: int) -> np.ndarray:
        """Whether a run of ``size`` words begins at each word and stays in its piece."""
        out = np.zeros(len(self.hashes), dtype=bool)
        n = len(self.hashes) - size + 1
        if n > 0:
            out[:n] = self.piece[:n] == self.piece[size - 1:]
        return out

    def of(self, size: int, seed: int = 5) -> np.ndarray:
        """Hashes of the runs of ``size`` words; those beyond ``places`` mean nothing."""
        if size == 1 and seed == 5:
            return self.hashes
        weights = wordhash.multipliers(LONGEST + 1, seed)
        n = max(len(self.hashes) - size + 1, 0)
        sums = np.repeat(weights[LONGEST:] * np.uint64(size), n)
        for k in range(size):
            sums += self.hashes[k:k + n] * weights[k]
        return np.concatenate([wordhash.mix(sums), np.zeros(len(self.hashes) - n, dtype=np.uint64)])

    def all_at(self, flags: np.ndarray, size: int) -> np.ndarray:
        """Where ``size`` neighbouring flags are all set."""
        out = flags.copy()
        for k in range(1, size):
            out[:len(flags) - k] &= flags[k:]
            out[max(len(flags) - k, 0):] = False
        return out

    def phrase(self, first: int, size: int) -> str:
        raw = self.data[self.words.starts[first]:self.words.ends[first + size - 1]].tobytes().lower()
        return " ".join(w for w in raw.decode().replace("\t", " ").split(" ") if w)


_salts: dict[str, int] = {}


def _lang_salt(lang: str) -> int:
    if lang not in _salts:
        _salts[lang] = int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")
    return _salts[lang]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Runs]:
    for batch in batches:
        langs = batch["lang"].to_pylist()
        for row, end, data, offsets in wordhash.chunks(batch["text"]):
            yield Runs(data, offsets, langs[row:end])


def _member(values: np.ndarray, known: np.ndarray | None) -> np.ndarray:
    """Whether each value is in the sorted set; all are if there is no set."""
    if known is None:
        return np.ones(len(values), dtype=bool)
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def _counted(hashes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in ascending order and how often each occurs."""
    if counts is None:
        return np.unique(hashes, return_counts=True)
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    firsts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, int)
    return hashes[firsts], np.add.reduceat(counts, firsts) if len(firsts) else counts


class Summary:
    """Misra-Gries summaries of hash partitions: the upper bits of a hash name its partition.

    ``taken`` holds, per partition, what was subtracted from its counters so far; a true count
    is at most the counter (0 if there is none) plus that.
    """

    def __init__(self, rooms: np.ndarray):
        self.rooms = rooms
        self.shift = np.uint64(64 - int(len(rooms)).bit_length() + 1)
        self.taken = np.zeros(len(rooms), dtype=np.int64)
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(self, hashes: np.ndarray, counts: np.ndarray):
        self.hashes, self.counts = _counted(np.concatenate([self.hashes, hashes]), np.concatenate([self.counts, counts]))
        self._shrink()

    def edges(self) -> np.ndarray:
        return np.searchsorted(self.hashes >> self.shift, np.arange(len(self.rooms) + 1, dtype=np.uint64))

    def _shrink(self):
        edges = self.edges()
        over = np.flatnonzero(np.diff(edges) > self.rooms)
        for part in over:
            inside = self.counts[edges[part]:edges[part + 1]]
            at = len(inside) - int(self.rooms[part]) - 1
            least = int(np.partition(inside, at)[at])
            inside -= least
            self.taken[part] += least
        if len(over):
            left = self.counts > 0
            self.hashes, self.counts = self.hashes[left], self.counts[left]


_SUMMARY = "part int, taken long, hashes binary, counts binary"


def _summary_rows(summary: Summary) -> Iterator[pa.RecordBatch]:
    edges = summary.edges()
    parts = np.flatnonzero((np.diff(edges) > 0) | (summary.taken > 0))
    for some in np.array_split(parts, max(1, len(parts) // 256)):
        yield pa.RecordBatch.from_arrays([
            pa.array(some, pa.int32()), pa.array(summary.taken[some], pa.int64()),
            pa.array([summary.hashes[edges[p]:edges[p + 1]].tobytes() for p in some], pa.binary()),
            pa.array([summary.counts[edges[p]:edges[p + 1]].tobytes() for p in some], pa.binary())],
            ["part", "taken", "hashes", "counts"])


def _count_words(parts: int):
    """(kind, hash, n): words by hash (kind 0), mass per partition of pairs (1) and of longer runs (2)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = np.uint64(64 - parts.bit_length() + 1)
        masses = np.zeros((2, parts), dtype=np.int64)

        def rows(kind, hashes, counts):
            return pa.RecordBatch.from_arrays([
                pa.array(np.full(len(hashes), kind), pa.int32()), pa.array(hashes.view(np.int64)), pa.array(counts, pa.int64())],
                ["kind", "hash", "n"])

        for runs in _blocks(batches):
            for size in range(2, LONGEST + 1):
                there = (runs.of(size)[runs.places(size)] >> shift).astype(np.int64)
                masses[min(size - 2, 1)] += np.bincount(there, minlength=parts)
            if len(runs.hashes):
                yield rows(0, *_counted(runs.hashes))
        for kind in (0, 1):
            yield rows(kind + 1, np.arange(parts, dtype=np.uint64), masses[kind])

    return count


def _summarise(sizes: tuple[int, ...], rooms, known):
    """Summaries of the runs of ``sizes`` words that can be frequent after ``known``: words for pairs, else pairs."""
    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary, waiting = Summary(rooms.value), []
        for runs in _blocks(batches):
            if sizes[0] == 2:
                flags, inner = _member(runs.hashes, known.value), 0
            else:
                flags, inner = _member(runs.of(2), known.value) & runs.places(2), 1
            for size in sizes:
                waiting.append(runs.of(size)[runs.places(size) & runs.all_at(flags, size - inner)])
            if sum(map(len, waiting)) >= _BUFFERED:
                summary.merge(*_counted(np.concatenate(waiting)))
                waiting = []
                if len(summary.hashes) > _MOST_COUNTERS:
                    yield from _summary_rows(summary)
                    summary = Summary(rooms.value)
        if waiting:
            summary.merge(*_counted(np.concatenate(waiting)))
        yield from _summary_rows(summary)

    return summaries


def _survivors(rooms, threshold: int):
    """Rows of summaries, ordered by partition, as the hashes that may reach the threshold."""
    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, summary = None, None

        def left() -> pa.RecordBatch:
            may = summary.counts + summary.taken[part] >= threshold
            return pa.RecordBatch.from_arrays([pa.array(summary.hashes[may].view(np.int64))], ["hash"])

        for batch in batches:
            for p, taken, hashes, counts in zip(*(batch[c].to_pylist() for c in ("part", "taken", "hashes", "counts"))):
                if p != part:
                    if part is not None:
                        yield left()
                    part, summary = p, Summary(rooms.value)
                summary.taken[p] += taken
                summary.merge(np.frombuffer(hashes, np.uint64), np.frombuffer(counts, np.int64))
        if part is not None:
            yield left()

    return merged


class Tally:
    """How often each run of a task's blocks occurs: hashes in ascending order, counts, and the words once."""

    def __init__(self):
        self.first, self.second = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.counts, self.places = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.named = []

    def add(self, runs: Runs, size: int, first: np.ndarray, second: np.ndarray, counts: np.ndarray, at: np.ndarray):
        """``first`` ascends; a run whose first hash another one has already may get several rows."""
        slot = np.searchsorted(self.first, first)
        inside = np.minimum(slot, max(len(self.first) - 1, 0))
        seen = (self.first[inside] == first) & (self.second[inside] == second) if len(self.first) else np.zeros(len(first), dtype=bool)
        np.add.at(self.counts, inside[seen], counts[seen])
        new = np.flatnonzero(~seen)
        if len(new):
            self.named.append(pa.array([(runs.langs[runs.words.text[k]], runs.phrase(int(k), size)) for k in at[new]], _NAMED))
            places = np.arange(len(self.first), len(self.first) + len(new))
            self.first, self.second = np.insert(self.first, slot[new], first[new]), np.insert(self.second, slot[new], second[new])
            self.counts, self.places = np.insert(self.counts, slot[new], counts[new]), np.insert(self.places, slot[new], places)

    def table(self, size: int) -> pa.Table:
        """lang, size, phrase and n, in the order of ``first``."""
        lang, phrase = pa.concat_arrays(self.named).take(pa.array(self.places)).flatten()
        return pa.table({"lang": lang, "size": pa.array(np.full(len(lang), size, np.int32)), "phrase": phrase, "n": pa.array(self.counts)})


_NAMED = pa.struct([("lang", pa.string()), ("phrase", pa.string())])
_PACKED = "part int, runs binary"
_COUNTED = "lang string, size int, phrase string, f long"


def _bytes_of(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _packed(tallies: list[Tally], parts: int) -> Iterator[pa.RecordBatch]:
    """One row for each hash partition that has runs, holding the table of them."""
    full = [(size, tally) for size, tally in enumerate(tallies, 1) if len(tally.first)]
    if not full:
        return
    part = np.concatenate([t.first for _, t in full]) >> np.uint64(64 - parts.bit_length() + 1)
    order = np.argsort(part, kind="stable")
    table = pa.concat_tables([t.table(size) for size, t in full]).take(pa.array(order))
    edges = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
    for p in np.flatnonzero(np.diff(edges)):
        yield pa.RecordBatch.from_arrays(
            [pa.array([p], pa.int32()), pa.array([_bytes_of(table.slice(edges[p], edges[p + 1] - edges[p]).combine_chunks())], pa.binary())],
            ["part", "runs"])


def _added_up(threshold: int):
    """Packed rows, ordered by partition, as (lang, size, phrase, f) of frequent runs, joined by their words."""
    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tables = None, []

        def total() -> pa.Table:
            return pa.concat_tables(tables).group_by(["lang", "size", "phrase"]).aggregate([("n", "sum")]).rename_columns(
                ["lang", "size", "phrase", "n"])

        def frequent() -> list[pa.RecordBatch]:
            found = total()
            often = np.asarray(found["n"]) >= threshold
            return found.filter(pa.array(often | (np.asarray(found["size"]) == 0))).rename_columns(["lang", "size", "phrase", "f"]).to_batches()

        for batch in batches:
            for p, runs in zip(batch["part"].to_pylist(), batch["runs"]):
                if p != part:
                    if tables:
                        yield from frequent()
                    part, tables, held = p, [], 0
                tables.append(pa.ipc.open_stream(runs.as_buffer()).read_all())
                held += len(tables[-1])
                if held > _MOST_TALLIED:
                    tables, held = [total()], 0
        if tables:
            yield from frequent()

    return merged


def _count_exactly(words, pairs, longer, parts: int):
    """Packed (lang, size, phrase, n) of the known runs; size 0 counts all words.

    A task adds up what its blocks hold and gives a run once, or once for every
    ``_MOST_TALLIED`` different runs.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, int] = {}
        tallies = [Tally() for _ in range(LONGEST)]
        for runs in _blocks(batches):
            if not len(runs.hashes):
                continue
            text_lang = np.array([_lang_salt(lang) for lang in runs.langs], dtype=np.uint64)
            for salt in np.unique(text_lang):
                mine = text_lang == salt
                lang = runs.langs[int(np.flatnonzero(mine)[0])]
                totals[lang] = totals.get(lang, 0) + int(runs.words.counts[mine].sum())
            is_pair = _member(runs.of(2), pairs.value) & runs.places(2)
            for size in range(1, LONGEST + 1):
                if size == 1:
                    there = np.flatnonzero(_member(runs.hashes, words.value))
                elif size == 2:
                    there = np.flatnonzero(is_pair)
                else:
                    there = np.flatnonzero(runs.places(size) & runs.all_at(is_pair, size - 1))
                    there = there[_member(runs.of(size)[there], longer.value)]
                if not len(there):
                    continue
                first, second = runs.of(size)[there], runs.of(size, 11)[there]
                order = np.lexsort((second, first))
                first, second = first[order], second[order]
                begins = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])]))
                tallies[size - 1].add(runs, size, first[begins], second[begins], np.diff(np.append(begins, len(order))), there[order[begins]])
            if sum(len(t.first) for t in tallies) > _MOST_TALLIED:
                yield from _packed(tallies, parts)
                tallies = [Tally() for _ in range(LONGEST)]
        yield from _packed(tallies, parts)
        if totals:
            table = pa.table({
                "lang": pa.array(list(totals), pa.string()), "size": pa.array([0] * len(totals), pa.int32()),
                "phrase": pa.array([""] * len(totals), pa.string()), "n": pa.array(list(totals.values()), pa.int64())})
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([_bytes_of(table)], pa.binary())], ["part", "runs"])

    return count


def _known(spark: SparkSession, hashes: DataFrame, most: int):
    """A broadcast sorted array of the hashes, or of None if there are more than ``most``."""
    if hashes.count() > most:
        return spark.sparkContext.broadcast(None)
    values = hashes.toArrow()["hash"].to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(np.sort(values))


def frequent_runs(docs: DataFrame, threshold: int = THRESHOLD, slack: int = SLACK, most_known: int = MOST_KNOWN) -> DataFrame:
    """(lang, size, phrase, f): all runs of 1 to 5 words with f >= threshold, and per lang its words (size 0)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "collocations")
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"), F.col("text").cast("string").alias("text"))
    # More input, more hash partitions: one partition's summary has to fit into a task.
    splits = max(1, texts.rdd.getNumPartitions())
    parts = 1 << min(max((4 * splits).bit_length(), 6), 16)
    counted = texts.mapInArrow(_count_words(parts), "kind int, hash long, n long").groupBy("kind", "hash").agg(F.sum("n").alias("n"))
    counted = scratch.store(counted.where((F.col("n") >= threshold) | (F.col("kind") > 0)))
    masses = np.zeros((2, parts), dtype=np.int64)
    for r in counted.where("kind > 0 and n > 0").collect():  # one row per hash partition and kind
        masses[r.kind - 1, r.hash] = r.n
    words = _known(spark, counted.where("kind = 0").select("hash"), most_known)
    known = words
    for step, sizes in enumerate(((2,), tuple(range(3, LONGEST + 1)))):
        rooms = spark.sparkContext.broadcast(slack * masses[step] // threshold + 1)
        summaries = texts.mapInArrow(_summarise(sizes, rooms, known), _SUMMARY)
        dealt = summaries.repartition("part").sortWithinPartitions("part")
        known = _known(spark, scratch.store(dealt.mapInArrow(_survivors(rooms, threshold), "hash long")), most_known)
        if step == 0:
            pairs = known
    everything = any(k.value is None for k in (words, pairs, known))
    exact = texts.mapInArrow(_count_exactly(words, pairs, known, parts if everything else min(parts, MOST_PARTS)), _PACKED)
    return exact.repartition("part").sortWithinPartitions("part").mapInArrow(_added_up(threshold), _COUNTED)


def collocations(docs: DataFrame, threshold: int = THRESHOLD, top: int = TOP, **options) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each lang's first ``top`` phrases.

    a counts the phrase, l and r the two sides of its lowest-scoring cut, n the lang's words;
    score is floor(1000 a n / (l r)). A phrase inside a longer one that is as frequent is left out.
    """
    scratch = Scratch(docs.sparkSession, "collocations")
    runs = scratch.store(frequent_runs(docs, threshold, **options))
    total = F.broadcast(runs.where("size = 0").select("lang", F.col("f").alias("n")))  # one row per language
    phrases = runs.where("size > 1")
    split = F.split("phrase", " ")
    words = phrases.select("lang", "phrase", "size", F.col("f").alias("a"), split.alias("w"))
    cuts = words.select("lang", "phrase", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"))
    sides = runs.where("size > 0")
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(sides.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    exact = "cast({} as decimal(38,0))"
    score = f"(1000 * {exact.format('a')} * n) div ({exact.format('l')} * r)"
    weakest = cuts.join(total, "lang").withColumn("score", F.expr(score)).groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = phrases.where("size > 2").select("lang", F.col("f").alias("around"), "size", split.alias("w")).select(
        "lang", "around", "size", "w", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("length")).select(
        "lang", "around", "w", "length", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)).alias("at")).select(
        "lang", "around", F.array_join(F.slice("w", F.col("at"), F.col("length")), " ").alias("phrase"))
    covered = inner.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    left = weakest.join(covered, ["lang", "phrase"], "left").where("around is null or around < a")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return left.select("lang", "phrase", "a", "n", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score")).withColumn(
        "rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


OP11_SQL = """
WITH d AS (SELECT coalesce(lang, 'und') AS lang, regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]') AS ps FROM documents),
p AS (SELECT lang, list_filter(regexp_split_to_array(unnest(ps), '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM d),
g AS (SELECT lang, size, array_to_string(ws[s:s + size - 1], ' ') AS phrase FROM (
        SELECT lang, ws, size, unnest(range(1, len(ws) - size + 2)) AS s FROM p, range(1, 6) z(size) WHERE len(ws) >= size)),
f AS (SELECT lang, size, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(ws)) AS n FROM p GROUP BY lang),
w AS (SELECT lang, phrase, a, size, string_split(phrase, ' ') AS ws FROM f WHERE size > 1),
k AS (SELECT lang, phrase, a, k, array_to_string(ws[1:k], ' ') AS lp, array_to_string(ws[k + 1:size], ' ') AS rp
      FROM (SELECT *, unnest(range(1, size)) AS k FROM w)),
c AS (SELECT k.lang, k.phrase, k.a, k.k, x.a AS l, y.a AS r, CAST(n AS BIGINT) AS n,
        (1000::HUGEINT * k.a * n.n::HUGEINT) // (x.a::HUGEINT * y.a) AS score
      FROM k JOIN f x ON x.lang = k.lang AND x.phrase = lp JOIN f y ON y.lang = k.lang AND y.phrase = rp JOIN n ON n.lang = k.lang),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (SELECT lang, array_to_string(ws[s:s + z - 1], ' ') AS phrase, max(a) AS around FROM (
        SELECT lang, ws, a, z, unnest(range(1, size - z + 2)) AS s FROM w, range(2, 5) q(z) WHERE z < size) GROUP BY ALL),
e AS (SELECT b.* FROM b LEFT JOIN i USING (lang, phrase) WHERE around IS NULL OR around < a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM e QUALIFY rank <= 2000
"""
