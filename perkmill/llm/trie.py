"""Conversation prefix trie: one row per distinct run of first turns, with subtree sums.

A conversation is a path: the 16-byte hashes of its turns, joined. Prefixes of paths are the
nodes. Paths are dealt to shards by ranges, so a node lies whole in one shard unless its path
is a prefix of a splitter between two shards. Those nodes are the skeleton, the trie of the
splitter paths, which every task gets (at most ``shards - 1`` splitters of SPLITTER_TURNS
turns: a bound that does not depend on the corpus). Each shard is sorted and read once, with
one stack of open nodes: it finishes all nodes below the skeleton and gives a partial sum for
each skeleton node it meets. The partial sums are combined per node, then up the skeleton.

Equal paths are one row before they are sorted: their conversations are collected in blocks
of neighbouring ids, each a joined text, so a shared path costs a few rows however many
conversations have it, and its digest is read block by block. A task holds the nodes of one
subtree below the skeleton, some 60 bytes a node, and no texts.

Odd rows: turns are ordered by turn (NULL first), then by role and the md5 of the text;
repeated rows are turns of their own; NULL role or text reads as empty. Rows without a conv_id
belong to no conversation and are left out. An empty table has no conversations and gives no
rows, not even a root. A conversation's own path must fit into a task (16 bytes a turn).
"""

from __future__ import annotations

import hashlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkmill.llm.tables import Scratch, read_table

TURN = 16
SPLITTER_TURNS = 32
SAMPLED_PER_SHARD = 32
# Conversations with one path are joined into texts of at most 2 ** BLOCK_BITS neighbouring ids.
BLOCK_BITS = 12
# Handed on once this many nodes are finished.
_ROWS = 50_000
_NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends_sha256 string, skeleton int, parent_skeleton int, n_words long")
_COUNTS = ("n_convs", "n_children", "n_leaves", "saved_tokens")


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): per conversation its turns in order, as (hash, n_words)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # The length of the role keeps (ab, c) and (a, bc) apart.
    key = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    n_words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn"), role.alias("role"), F.md5(text.cast("binary")).alias("by"), key.alias("hash"), n_words.alias("n_words")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "conv_id", F.transform("t", lambda t: F.struct(t["hash"].alias("hash"), t["n_words"].alias("n_words"))).alias("turns"))


def branched(turns: DataFrame, every: int = 20, most_shared: int = 4) -> DataFrame:
    """Conversations rebuilt to share first turns with the first one of their block of ids.

    Conversation c takes the first h turns of c - c % every, then its own after its first h;
    h is crc32 of the decimal id modulo ``most_shared``.
    """
    heads = turns.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("_base"), F.slice("turns", 1, most_shared - 1).alias("_head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most_shared).cast("int")
    own = turns.withColumn("_h", h).withColumn("_at", F.col("conv_id") - F.col("conv_id") % every)
    joined = own.join(heads, F.col("_at") == F.col("_base"), "left")
    rest = F.slice("turns", F.col("_h") + 1, F.size("turns"))
    shared = F.when(F.col("_head").isNotNull(), F.concat(F.slice("_head", F.lit(1), F.col("_h")), rest)).otherwise(rest)
    return joined.select("conv_id", shared.alias("turns"))


def paths_of(turns: DataFrame) -> DataFrame:
    """(path, n_words per turn, block, ids, n_convs, conv_id): equal paths in blocks of ids."""
    path = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["hash"])), ""))
    flat = turns.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["n_words"]).alias("n_words"))
    blocks = flat.groupBy("path", F.shiftright("conv_id", BLOCK_BITS).alias("block")).agg(
        F.first("n_words").alias("n_words"), F.sort_array(F.collect_list("conv_id")).alias("ids"))
    return blocks.select(
        "path", "n_words", "block", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"),
        F.size("ids").cast("long").alias("n_convs"), F.element_at("ids", 1).alias("conv_id"))


def choose_splitters(paths: DataFrame, shards: int) -> list[bytes]:
    """At most ``shards - 1`` ascending path starts that cut the distinct paths evenly.

    The sample is the paths with the least hashes, SAMPLED_PER_SHARD per shard.
    """
    start = F.substring("path", 1, TURN * SPLITTER_TURNS)
    sample = paths.select("path").distinct().select(start.alias("s"), F.xxhash64("path").alias("h")).orderBy("h", "s").limit(
        SAMPLED_PER_SHARD * shards)
    ordered = sorted(bytes(r.s) for r in sample.select("s").collect())
    cuts = {ordered[len(ordered) * i // shards] for i in range(1, shards)} if ordered else set()
    return sorted(cuts - {b""})


def skeleton_of(splitters: list[bytes]) -> dict[bytes, int]:
    """The numbered prefixes of the splitters, the root first, parents before children."""
    prefixes = {s[:at] for s in splitters for at in range(0, len(s) + 1, TURN)} | {b""}
    return {p: i for i, p in enumerate(sorted(prefixes, key=lambda p: (len(p), p)))}


class _Shard:
    """The nodes of one shard, fed with its paths in ascending order."""

    def __init__(self, skeleton: dict[bytes, int]):
        self.skeleton = skeleton
        self.out: list[list] = [[] for _ in range(11)]
        self.path, self.open = b"", []  # open: rows of the nodes on the current path, from the root on
        self.digests: dict[int, object] = {}
        self._new_rows()

    def _new_rows(self):
        """Columns of the nodes below the current skeleton node, and of the skeleton nodes met."""
        self.conv, self.depth, self.parent = array("q"), array("q"), array("q")
        self.n, self.children, self.leaves, self.saved, self.words = (array("q") for _ in range(5))
        self.bone, self.ends = array("q"), []

    def _push(self, prefix: bytes, depth: int, words: int, conv: int):
        row = len(self.conv)
        bone = self.skeleton.get(prefix, -1) if len(prefix) <= TURN * SPLITTER_TURNS else -1
        for column, value in ((self.conv, conv), (self.depth, depth), (self.parent, self.open[-1] if self.open else -1), (self.n, 0),
                              (self.children, 0), (self.leaves, 0), (self.saved, 0), (self.words, words), (self.bone, bone)):
            column.append(value)
        self.ends.append(None)
        self.open.append(row)

    def _pop(self):
        """Close the deepest open node: its sums go to its parent, a skeleton node's do not."""
        row = self.open.pop()
        digest = self.digests.pop(row, None)
        if digest is not None:
            self.ends[row] = digest.hexdigest()
        if self.bone[row] >= 0:
            return
        if not self.children[row]:
            self.leaves[row] = 1
        self.saved[row] += (self.n[row] - 1) * self.words[row]
        up = self.parent[row]
        self.n[up] += self.n[row]
        self.children[up] += 1
        self.leaves[up] += self.leaves[row]
        self.saved[up] += self.saved[row]
        self.conv[up] = min(self.conv[up], self.conv[row])

    def leave(self, path: bytes):
        """Close the open nodes that ``path``, the next one, does not pass."""
        if path == self.path:
            return
        most = min(len(path), len(self.path))
        at = 0
        while at < most and path[at:at + TURN] == self.path[at:at + TURN]:
            at += TURN
        while len(self.open) > at // TURN + 1:
            self._pop()

    def add(self, path: bytes, n_words, ids: str, n_convs: int, conv: int):
        """The conversations ``ids``, which end at ``path``; nodes off the path have been left."""
        if not self.open:
            self._push(b"", 0, 0, conv)
        for d in range(len(self.open) - 1, len(path) // TURN):
            self._push(path[:(d + 1) * TURN] if d < SPLITTER_TURNS else b"\0", d + 1, n_words[d], conv)
        end = self.open[-1]
        self.n[end] += n_convs
        self.conv[end] = min(self.conv[end], conv)
        if end in self.digests:
            self.digests[end].update(b"," + ids.encode())
        else:
            self.digests[end] = hashlib.sha256(ids.encode())
        self.path = path

    def settled(self) -> bool:
        """Whether only skeleton nodes are open, so that everything else is finished."""
        return all(self.bone[row] >= 0 for row in self.open)

    def finished(self) -> pa.RecordBatch:
        """All finished nodes and the partial sums of skeleton nodes; open ones start anew."""
        nothing = hashlib.sha256(b"").hexdigest()
        bone = [b if b >= 0 else None for b in self.bone]
        up = self.parent
        columns = [
            list(self.conv), list(self.depth),
            [self.conv[u] if u >= 0 and self.bone[u] < 0 else None for u in up],
            list(self.n), list(self.children), list(self.leaves), list(self.saved),
            [e if e or b is not None else nothing for e, b in zip(self.ends, bone)], bone,
            [self.bone[u] if u >= 0 and self.bone[u] >= 0 else None for u in up], list(self.words)]
        still = [(self.depth[r], self.words[r], self.conv[r], self.bone[r], self.digests.get(r)) for r in self.open]
        self._new_rows()
        self.digests, self.open = {}, []
        for at, (depth, words, conv, number, digest) in enumerate(still):
            self._push(b"\0", depth, words, conv)
            self.bone[at] = number
            if digest is not None:
                self.digests[at] = digest
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.string() if i == 7 else pa.int32() if i in (8, 9) else pa.int64()) for i, c in enumerate(columns)],
            [f.split()[0] for f in _NODE.split(", ")])


def _shard_nodes(skeleton: dict[bytes, int]):
    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard(skeleton)
        for batch in batches:
            for path, n_words, ids, n_convs, conv in zip(*(batch[c].to_pylist() for c in ("path", "n_words", "ids", "n_convs", "conv_id"))):
                shard.leave(path)
                if len(shard.conv) >= _ROWS and shard.settled():
                    yield shard.finished()
                shard.add(path, n_words, ids, n_convs, conv)
        while shard.open:
            shard._pop()
        if len(shard.conv):
            yield shard.finished()

    return nodes


def _shard_number(splitters: list[bytes]):
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bisect_right(splitters, path) for path in batch["path"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int32())], [*batch.schema.names, "shard"])

    return number


def prefix_trie(turns: DataFrame, shards: int | None = None) -> DataFrame:
    """The nodes of ``turns`` (conv_id, turns): conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = turns.sparkSession
    scratch = Scratch(spark, "trie")
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    paths = scratch.store(paths_of(turns))
    splitters = choose_splitters(paths, shards)
    skeleton = skeleton_of(splitters)
    numbered = T.StructType([*paths.schema.fields, T.StructField("shard", T.IntegerType())])
    dealt = paths.mapInArrow(_shard_number(splitters), numbered).repartitionById(
        len(splitters) + 1, "shard").sortWithinPartitions("path", "block").drop("shard", "block")
    found = scratch.store(dealt.mapInArrow(_shard_nodes(skeleton), _NODE))
    bones = scratch.store(_skeleton_nodes(found, skeleton))
    own = bones.select(F.col("skeleton").alias("_number"), F.col("conv_id").alias("_parent_conv"))
    inner = found.where("skeleton is null").join(F.broadcast(own), F.col("parent_skeleton") == F.col("_number"), "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "_parent_conv"))
    columns = ("conv_id", "depth", "parent_conv_id", *_COUNTS, "ends_sha256")
    return inner.select(*columns).unionByName(bones.select(*columns))


def _skeleton_nodes(found: DataFrame, skeleton: dict[bytes, int]) -> DataFrame:
    """The finished skeleton nodes, from the partial sums of all shards.

    Each skeleton node is paired with the skeleton nodes above it, at most SPLITTER_TURNS.
    """
    spark = found.sparkSession
    lines = [(number, skeleton.get(path[:-TURN]) if path else None, [skeleton[path[:at]] for at in range(0, len(path) + 1, TURN)])
             for path, number in skeleton.items()]
    tree = F.broadcast(spark.createDataFrame(lines, "skeleton int, up int, line array<int>"))
    partial = found.where("skeleton is not null").groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("n_words").alias("n_words"),
        F.max("ends_sha256").alias("ends_sha256"), *[F.sum(c).alias(c) for c in _COUNTS]).join(tree, "skeleton")
    members = partial.select(F.explode("line").alias("node"), "n_convs", "conv_id").groupBy("node").agg(
        F.sum("n_convs").alias("total"), F.min("conv_id").alias("least"))
    children = partial.where("up is not null").groupBy(F.col("up").alias("node")).agg(F.count(F.lit(1)).alias("more"))
    whole = partial.join(F.broadcast(members), F.col("skeleton") == F.col("node")).drop("node").join(
        F.broadcast(children), F.col("skeleton") == F.col("node"), "left").drop("node")
    n_children = F.col("n_children") + F.coalesce("more", F.lit(0))
    whole = whole.withColumn("n_children", n_children).withColumn(
        "own_leaves", F.when(n_children == 0, F.lit(1)).otherwise(F.col("n_leaves"))).withColumn(
        "own_saved", F.col("saved_tokens") + (F.col("total") - 1) * F.col("n_words"))
    sums = whole.select(F.explode("line").alias("node"), "own_leaves", "own_saved").groupBy("node").agg(
        F.sum("own_leaves").alias("leaves"), F.sum("own_saved").alias("saved"))
    above = whole.select(F.col("skeleton").alias("above"), F.col("least").alias("above_conv"))
    return whole.join(F.broadcast(sums), F.col("skeleton") == F.col("node")).join(
        F.broadcast(above), F.col("up") == F.col("above"), "left").select(
        "skeleton", F.col("least").alias("conv_id"), "depth", F.col("above_conv").alias("parent_conv_id"),
        F.col("total").alias("n_convs"), "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(branched(turns_of(read_table(spark, sf_dir, "conversations"))))


OP13_SQL = """
WITH t AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
    ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS ts
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
c AS (SELECT *, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: ascii(ch)::BIGINT),
    lambda s, b: list_reduce([xor(s, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0],
      lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 4 AS h FROM t),
r AS (SELECT c.conv_id, coalesce(b.ts[1:c.h], []) || c.ts[c.h + 1:] AS ts FROM c LEFT JOIN t b ON b.conv_id = c.conv_id - c.conv_id % 20),
p AS (SELECT conv_id, d, ts[1:d] AS path, d = len(ts) AS ends FROM (SELECT conv_id, ts, unnest(range(0, len(ts) + 1)) AS d FROM r)),
n AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(path[d].t, '[^\\x20\\x09-\\x0D]+')) END AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM p GROUP BY path, d),
k AS (SELECT path[1:d - 1] AS path, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (path)),
s AS (SELECT path[1:a] AS path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
      FROM (SELECT path, n_children, saved, unnest(range(0, d + 1)) AS a FROM f) GROUP BY 1)
SELECT f.conv_id, f.d AS depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM f JOIN s USING (path) LEFT JOIN n u ON f.d > 0 AND u.path = f.path[1:f.d - 1]
"""
