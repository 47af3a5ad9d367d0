"""From band keys to verified links between sets, without pairing whole buckets.

Input are distinct sets (one row per class of equal sets). Sets that share a band key are in
one bucket. Links are found in two rounds:

1. Every member of a bucket is paired with the bucket's smallest id. Sketches (one byte of
   each of up to 128 signature values) rule out pairs far below the similarity asked for. Of
   what remains, every set is compared with the leader most like it. Verified links give
   components.
2. Members that stand apart from the bucket's largest component are paired with the members
   of all other components of the bucket; sketches rule out again. Pairs inside one component
   are never made: they cannot change the result. The join makes a pair only where its first
   common keys meet, so once, however many bands agree.

Buckets of more than ``WIDE`` members are not paired but compared with what their members have
in common. Buckets with the same largest component are one group; its ``common`` set holds the
values of more than half of ``PROBES`` members. Two members of sizes n_x and n_y, of which
``inside`` values are common, share at most the smaller ``inside`` besides values outside the
common set. So they are linked only if they share an outside value, or if both are inside far
enough for their sizes. Outside values are rare by their making, and an index of them (only the
first ones in order, as many as a link needs) gives the pairs. Members of the second kind are
linked to the member most like the common set, as far as they are, and so need no pairs.
Where a set differs from the common one, by values it lacks or has besides, is marked in
``MARKS`` words of bits. A bit that one member has and the other has not is a difference of
its own, which bounds what two members can share; a pair is only made if that is enough.
The choice of probes decides how many pairs are made, never which links are found.

Sketches are off by more than ``MARGIN`` less than once in 200,000 pairs. What they leave is
compared exactly, by the whole sets of the whole texts. It is texts that are moved to each
other, since they take less space than the hashes of their words.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perkmill.llm import wordhash
from perkmill.llm.components import connected_components, grown_components
from perkmill.llm.tables import Scratch

WIDE = 8
PROBES = 16
# Words of 64 bits that mark where a member differs from the common set.
MARKS = 4
MARK_COLUMNS = [f"mark_{word}" for word in range(MARKS)]
COMPARED = ("id", "n", "inside", "differs", *MARK_COLUMNS, "c")
# Bins of sizes for each doubling of the size.
SIZE_BINS = 128
# No caller asks for less similar sets than this, so sizes further apart need no comparison.
NEAREST = 80
SKETCH_BYTES = 128
MARGIN = 20


def link_sets(banded: DataFrame, texts_of: Callable[[DataFrame], DataFrame], percent: int, shingle_words: int,
              scratch: Scratch) -> DataFrame:
    """(id, component) of all linked sets, stored; the tables made on the way are deleted.

    ``banded``: id, n (size of the set), bands (array of keys), sketch, stored.
    ``texts_of(ids)`` gives (id, text) for the ids asked for; a set is the distinct runs of
    ``shingle_words`` words of its text. Two sets are linked if
    100 * intersection >= percent * union.
    """
    if percent < NEAREST:
        raise ValueError("sets that are less similar need more bands")
    begun = scratch.made
    keyed = banded.select("id", "n", F.explode("bands").alias("key"))
    buckets = scratch.store(_buckets(keyed, banded))
    sketches = banded.select("id", "sketch")
    near = scratch.store(_alike(_star(buckets, percent), sketches, percent))
    best = scratch.store(near.groupBy("b").agg(
        F.max_by(F.struct("a", "n_a", "n_b"), F.struct("same", -F.col("a"))).alias("m")).select("m.a", "m.n_a", "b", "m.n_b"))
    ends = scratch.store(best.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    texts = scratch.store(texts_of(ends))
    first = scratch.store(_verified(best, texts, percent, shingle_words))
    components = scratch.store(connected_components(first, scratch))

    mixed = scratch.store(_mixed(buckets.join(components, "id", "left").select(
        "key", "id", "n", "size", F.coalesce("component", "id").alias("component"))))
    scratch.drop(buckets)
    met = F.array_intersect("x_bands", "bands")
    one = scratch.store(_alike(
        _apart(mixed.where(F.col("size") <= WIDE), banded, percent, F.get(met, F.lit(0)) == F.col("key")), sketches, percent))

    members = scratch.store(_members(mixed.where(F.col("size") > WIDE)))
    others = scratch.store(texts_of(scratch.store(members.select("id").distinct().join(ends, "id", "left_anti"))))
    texts = texts.unionByName(others)
    placed = scratch.store(_placed(members, texts, percent, shingle_words))
    central = placed.groupBy("group").agg(F.max_by(F.struct("id", "n"), F.struct("like", -F.col("id"))).alias("most"))
    to_central = placed.join(central, "group").where((F.col("id") != F.col("most.id")) & _size_fits(percent, "n", "most.n")).select(
        F.col("most.id").alias("a"), F.col("most.n").alias("n_a"), F.col("id").alias("b"), F.col("n").alias("n_b")).distinct()
    components = grown_components(
        components, scratch.store(_verified(_alike(to_central, sketches, percent), texts, percent, shingle_words)), scratch)
    known = scratch.store(_known(placed, components, central))
    two = scratch.store(_unlike(known, percent))
    met_again = one.unionByName(_alike(two, sketches, percent))

    of = lambda name: components.select(F.col("id").alias(name), F.col("component").alias(f"c_{name}"))
    open_pairs = lambda pairs: (
        pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
        .where(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).drop("c_a", "c_b"))
    rest = scratch.store(open_pairs(near.unionByName(met_again).select("a", "n_a", "b", "n_b").distinct()).join(
        best.select("a", "b"), ["a", "b"], "left_anti"))
    asked = rest.select(F.col("a").alias("id")).unionByName(rest.select(F.col("b").alias("id"))).distinct()
    missing = scratch.store(asked.join(texts.select("id"), "id", "left_anti"))
    more = scratch.store(_verified(rest, texts.unionByName(texts_of(missing)), percent, shingle_words))
    found = grown_components(components, more, scratch)
    scratch.drop_since(begun, found)
    return found


def sketches_of(signature: np.ndarray) -> pa.Array:
    """One byte of each of the first signature values (values x texts), a binary per text."""
    low = np.ascontiguousarray((wordhash.mix(signature[:SKETCH_BYTES]) >> np.uint64(56)).astype(np.uint8).T)
    width = low.shape[1]
    offsets = np.arange(len(low) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(low), [None, pa.py_buffer(offsets), pa.py_buffer(low.tobytes())])


def _buckets(keyed: DataFrame, sizes: DataFrame) -> DataFrame:
    """(key, id, n, leader, leader_n, size) of keys that several ids have."""
    groups = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("leader")).where("size > 1")
    led = groups.join(sizes.select(F.col("id").alias("leader"), F.col("n").alias("leader_n")), "leader")
    return keyed.join(led, "key").select("key", "id", "n", "leader", "leader_n", "size")


def _size_fits(percent: int, n: str, m: str) -> Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _star(buckets: DataFrame, percent: int) -> DataFrame:
    return buckets.where((F.col("id") != F.col("leader")) & _size_fits(percent, "n", "leader_n")).select(
        F.col("leader").alias("a"), F.col("leader_n").alias("n_a"), F.col("id").alias("b"), F.col("n").alias("n_b")).distinct()


def _mixed(members: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component."""
    mixed = members.groupBy("key").agg(
        F.min("component").alias("least"), F.max("component").alias("most")).where("least < most").select("key")
    return members.join(mixed, "key", "left_semi")


def _apart(members: DataFrame, banded: DataFrame, percent: int, first_meeting: Column) -> DataFrame:
    """Pairs of members of different components; one of each pair is outside the largest."""
    sizes = members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("k"))
    largest = sizes.groupBy("key").agg(
        F.max(F.struct("k", "component")).alias("most"), F.count(F.lit(1)).alias("n_components")).where("n_components > 1")
    marked = members.join(largest, "key").join(banded.select("id", "bands"), "id").select(
        "key", "id", "n", "component", "bands", (F.col("component") == F.col("most.component")).alias("core"))
    outside = marked.where("not core").select(
        F.col("key").alias("x_key"), F.col("id").alias("x"), F.col("n").alias("n_x"), F.col("component").alias("c_x"),
        F.col("bands").alias("x_bands"))
    pairs = outside.join(marked, (F.col("x_key") == F.col("key")) & (F.col("c_x") != F.col("component"))
                         & (F.col("core") | (F.col("x") < F.col("id"))) & _size_fits(percent, "n_x", "n") & first_meeting)
    smaller = F.col("x") < F.col("id")
    return pairs.select(
        F.when(smaller, F.col("x")).otherwise(F.col("id")).alias("a"),
        F.when(smaller, F.col("n_x")).otherwise(F.col("n")).alias("n_a"),
        F.when(smaller, F.col("id")).otherwise(F.col("x")).alias("b"),
        F.when(smaller, F.col("n")).otherwise(F.col("n_x")).alias("n_b"))


def _members(mixed: DataFrame) -> DataFrame:
    """(group, id, n): members of buckets, by the largest component of the bucket."""
    sizes = mixed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("k"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("k", "component")).alias("most"))
    return mixed.join(largest, "key").select(F.col("most.component").alias("group"), "id", "n").distinct()


def _placed(members: DataFrame, texts: DataFrame, percent: int, shingle_words: int) -> DataFrame:
    """``members`` with inside, like (their similarity to the common set), first values outside of it, and marks.

    Values outside are in order of how many probes have them, so the first ones are rare.
    ``differs`` is the number of values that a member lacks or has besides the common set.
    """
    order = Window.partitionBy("group").orderBy(F.xxhash64("id"), "id")
    probes = members.withColumn("_row", F.row_number().over(order)).where(F.col("_row") <= PROBES).select("group", "id")

    def common(pdf: pd.DataFrame) -> pd.DataFrame:
        values, times = np.unique(np.concatenate(_sets(pa.array(pdf.text, pa.string()), shingle_words)), return_counts=True)
        held, some = 2 * times > len(pdf), (2 * times <= len(pdf)) & (times > 1)
        often = values[some][np.argsort(times[some], kind="stable")]
        return pd.DataFrame({"group": [pdf.group.iloc[0]], "common": [values[held].view(np.int64)], "often": [often.view(np.int64)]})

    shared = probes.join(texts, "id").groupBy("group").applyInPandas(common, "group long, common array<long>, often array<long>")

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            table = batch.select(["group", "id", "n"])
            groups = table.column("group").to_numpy()
            sets = _sets(batch.column(batch.schema.get_field_index("text")), shingle_words)
            rows, seldom = (batch.column(batch.schema.get_field_index(name)) for name in ("common", "often"))
            inside, like, differs, marks, outside, held = [], [], [], [], [], None
            for k, x in enumerate(sets):
                if held is None or groups[k] != groups[k - 1]:
                    held, often = (r[k].values.to_numpy().view(np.uint64) for r in (rows, seldom))
                    by_value = np.argsort(often)
                new, lacks = np.setdiff1d(x, held, assume_unique=True), np.setdiff1d(held, x, assume_unique=True)
                inside.append(len(x) - len(new))
                like.append(inside[-1] / max(len(x) + len(lacks), 1))
                differs.append(len(lacks) + len(new))
                marks.append(_marks(np.concatenate([lacks, new])))
                needed = max(1, -(-percent * len(x) // 100) - inside[-1])
                rank = np.zeros(len(new), dtype=np.int64)
                if len(often):
                    at = by_value[np.minimum(np.searchsorted(often, new, sorter=by_value), len(often) - 1)]
                    rank = np.where(often[at] == new, at + 1, 0)
                outside.append(new[np.lexsort((new, rank))][:max(len(new) - needed + 1, 0)].view(np.int64))
            for name, column in (("inside", inside), ("like", like), ("differs", differs)):
                table = table.append_column(name, pa.array(column, pa.float64() if name == "like" else pa.int64()))
            for word, column in enumerate(np.array(marks).T):
                table = table.append_column(f"mark_{word}", pa.array(np.ascontiguousarray(column).view(np.int64)))
            yield table.append_column("outside", pa.array(outside, pa.list_(pa.int64())))

    marked = ", ".join(f"{name} long" for name in MARK_COLUMNS)
    return members.join(texts, "id").join(shared, "group").mapInArrow(
        place, f"group long, id long, n long, inside long, like double, differs long, {marked}, outside array<long>")


def _marks(values: np.ndarray) -> np.ndarray:
    """``MARKS`` words with the bits that ``values`` hash to."""
    bit = wordhash.mix(values) % np.uint64(64 * MARKS)
    words = np.zeros(MARKS, dtype=np.uint64)
    np.bitwise_or.at(words, (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return words


def _may_share_enough(percent: int) -> Column:
    """Whether two members of a group, one with names in _x, can have all they need in common.

    What two sets share is what both have of the common set and outside of it. With d values in
    which both differ from the common set of c values, that is d + inside + inside_x - c.
    """
    both = F.least(*[
        F.col(f"differs{a}") - sum(F.bit_count(F.col(f"{m}{a}").bitwiseAND(F.bitwise_not(f"{m}{b}"))) for m in MARK_COLUMNS)
        for a, b in (("", "_x"), ("_x", ""))])
    common = F.col("differs") - F.col("n") + 2 * F.col("inside")
    return (100 + percent) * (both + F.col("inside") + F.col("inside_x") - common) >= percent * (F.col("n") + F.col("n_x"))


def _known(placed: DataFrame, components: DataFrame, central: DataFrame) -> DataFrame:
    """``placed`` with the component of each member (c), and whether it is apart from the group's central member."""
    core = central.select("group", F.col("most.id").alias("id")).join(components, "id", "left").select(
        "group", F.coalesce("component", "id").alias("core"))
    return placed.join(components, "id", "left").withColumn("c", F.coalesce("component", "id")).join(core, "group").select(
        "group", *COMPARED, "outside", (F.col("c") != F.col("core")).alias("apart"))


def _unlike(known: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of a group, of different components, that may be linked."""
    x = known.where("apart").select("group", *[F.col(k).alias(f"{k}_x") for k in (*COMPARED, "outside")])
    differ = (F.col("c_x") != F.col("c")) & _size_fits(percent, "n_x", "n") & _may_share_enough(percent)
    new = x.select("*", F.explode("outside_x").alias("value")).drop("outside_x").join(
        known.select("group", *COMPARED, F.explode("outside").alias("value")), ["group", "value"]).where(differ)

    size_bin = lambda n: F.floor(F.log2(n) * SIZE_BINS)
    least = F.greatest(F.col("n_x") * percent / 100, F.lit(1.0))
    most = F.col("inside_x") * (100 + percent) / percent - F.col("n_x")
    deep = x.where(most >= least).select(
        "*", F.explode(F.sequence(size_bin(least) - 1, size_bin(most) + 1)).alias("bin")).drop("outside_x").join(
        known.where(100 * F.col("inside") >= percent * F.col("n")).select("group", *COMPARED, size_bin(F.col("n")).alias("bin")),
        ["group", "bin"]).where(differ & (
            (100 + percent) * F.least("inside", "inside_x") >= percent * (F.col("n") + F.col("n_x"))))
    smaller = F.col("id_x") < F.col("id")
    side = lambda here, there, name: F.when(smaller, F.col(here)).otherwise(F.col(there)).alias(name)
    columns = [side("id_x", "id", "a"), side("n_x", "n", "n_a"), side("id", "id_x", "b"), side("n", "n_x", "n_b")]
    return new.select(*columns).unionByName(deep.select(*columns)).distinct()


def _alike(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sketches agree well enough, and in how many bytes (``same``)."""
    side = lambda name: sketches.select(F.col("id").alias(name), F.col("sketch").alias(f"s_{name}"))

    def agreeing(batches):
        for batch in batches:
            x, y = (_matrix(batch.column(batch.schema.get_field_index(name))) for name in ("s_a", "s_b"))
            same = (x == y).sum(axis=1)
            table = batch.select(["a", "n_a", "b", "n_b"]).append_column("same", pa.array(same.astype(np.int64)))
            yield table.filter(pa.array(100 * same >= (percent - MARGIN) * x.shape[1]))

    return pairs.join(side("b"), "b").join(side("a"), "a").mapInArrow(
        agreeing, "a long, n_a long, b long, n_b long, same long")


def _matrix(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype=np.uint8).reshape(len(rows), -1 if rows else 1)


def _sets(column: pa.Array, shingle_words: int) -> list[np.ndarray]:
    """The distinct values of each text."""
    out = []
    for _, _, data, offsets in wordhash.chunks(column):
        members, sizes = wordhash.distinct(*wordhash.shingles(wordhash.Words(data, offsets), shingle_words))
        out.extend(np.split(members, np.cumsum(sizes)[:-1]))
    return out


def _verified(pairs: DataFrame, texts: DataFrame, percent: int, shingle_words: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    side = lambda name: texts.select(F.col("id").alias(name), F.col("text").alias(f"text_{name}"))

    def compare(batches):
        for batch in batches:
            a, text_a, text_b = (batch.column(batch.schema.get_field_index(c)) for c in ("a", "text_a", "text_b"))
            if not len(a):
                continue
            ids = a.to_numpy()
            new = np.ones(len(ids), dtype=bool)
            new[1:] = ids[1:] != ids[:-1]
            of_a, of_b, run = _sets(text_a.take(pa.array(np.flatnonzero(new))), shingle_words), _sets(text_b, shingle_words), np.cumsum(new) - 1
            shared = np.array([len(np.intersect1d(of_a[k], y, assume_unique=True)) for k, y in zip(run, of_b)])
            total = np.array([len(of_a[k]) + len(y) for k, y in zip(run, of_b)])
            linked = 100 * shared >= percent * (total - shared)
            yield batch.select(["a", "b"]).filter(pa.array(linked))

    return pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a").mapInArrow(compare, "a long, b long")
