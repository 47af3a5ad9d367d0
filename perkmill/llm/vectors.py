"""Embedding near-dedup by sorted projection passes.

In every pass the vectors are put in the order of a concatenation of random hashes (signs of
random projections), and each is compared with its next WINDOW neighbours. Verified pairs of
all passes are united to components. The number of passes follows from the number of vectors,
so that of evenly spread vectors a pair at the threshold is missed with a probability of about
MISS at any size.

Dense topics are split less by a sign. So every pass measures how many signs must agree for two
vectors to meet: one more than a vector shares with those WINDOW places before and after it. A
vector whose passes leave a chance of more than CROWDED to miss a pair at the threshold is
crowded. Pairs of two crowded vectors of one label are searched exactly: in blocks of neighbours,
leaving out only pairs of blocks that are further apart than their radii allow. Where a whole
topic is dense and no blocks are apart, that takes the square of its crowded vectors.

Windows find components, not all links of a dense group. The number of links of each vector is
counted afterwards, exactly, among all vectors of its component: blocks of vectors are
multiplied with each other, and only counts leave a task.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perkmill.llm.components import connected_components
from perkmill.llm.tables import Scratch, read_table, small_batches

LEAST_COSINE = 0.98
WINDOW = 32
BITS = 48
MISS = 1e-7
CROWDED = 1e-5
AGREE = 1 - math.acos(LEAST_COSINE) / math.pi
BLOCK = 1024
EXACT_BLOCK = 2048
ROWS_PER_TASK = 50_000


def passes_for(n: int) -> int:
    """Passes so that a pair at the threshold meets in a window with probability 1 - MISS.

    The two are neighbours once the first log2(n / WINDOW) signs agree, each of which does with
    probability 1 - angle / pi.
    """
    depth = max(1.0, math.log2(max(n, 1) / WINDOW) + 1)
    agree = AGREE ** depth
    return max(4, math.ceil(math.log(MISS) / math.log(1 - agree)))


def deep_enough(passes: int) -> int:
    """Signs that may be needed in every pass so that a pair is missed with CROWDED at most."""
    return int(math.log(1 - CROWDED ** (1 / passes)) / math.log(AGREE))


def _projected(passes: int):
    def run(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            ids, labels, dims = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 2))
            vectors = batch.column(3)
            for dim in np.unique(dims):
                mine = np.flatnonzero(dims == dim)
                x = np.array(vectors.take(pa.array(mine)).flatten()).reshape(len(mine), dim)
                x = x.astype(np.float64)
                if dim not in planes:
                    planes[dim] = np.random.default_rng(int(dim) + 1).standard_normal((dim, passes * BITS))
                signs = (x @ planes[dim] > 0).reshape(len(mine), passes, BITS)
                code = (signs.astype(np.int64) << np.arange(BITS - 1, -1, -1)).sum(axis=2)
                for p in range(passes):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(mine), p, np.int32)), pa.array(labels[mine]), pa.array(dims[mine]), pa.array(code[:, p]),
                         pa.array(ids[mine]), vectors.take(pa.array(mine))], ["pass", "label", "dim", "code", "id", "embedding"])
    return run


_LINK_SCHEMA = "a long, b long, edge int, side int, pass int, label long, dim int, id long, embedding array<float>"


def _links_of(keys: list, ids: np.ndarray, rows: list[np.ndarray], new_from: int, parent: dict) -> list[tuple[int, int]]:
    """Links between rows at most WINDOW apart, the later one at ``new_from`` or after.

    Rows of one key are alike in pass, label and dimension. Pairs that links of this task
    already connect are not given again.
    """
    def root(i):
        while parent.setdefault(i, i) != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    found = []
    start = 0
    while start < len(keys):
        end = start
        while end < len(keys) and keys[end] == keys[start]:
            end += 1
        if end > max(new_from, start + 1):
            x = np.array(rows[start:end], dtype=np.float64)
            x /= np.sqrt((x * x).sum(axis=1))[:, None]
            for lag in range(1, min(WINDOW, end - start - 1) + 1):
                low = max(new_from - start, lag)
                if low < end - start:
                    cosine = np.einsum("ij,ij->i", x[low - lag:end - start - lag], x[low:end - start])
                    for k in np.flatnonzero(cosine >= LEAST_COSINE):
                        a, b = int(ids[start + low + k - lag]), int(ids[start + low + k])
                        if root(a) != root(b):
                            parent[root(a)] = root(b)
                            found.append((a, b))
        start = end
    return found


class _Depths:
    """Signs that a vector and its partner must share to be in one window, along sorted rows."""

    def __init__(self, first: bool, last: bool):
        # Nothing stands before the first partition and after the last: rows of no key do.
        self.nothing = np.full((WINDOW, 5), -1, dtype=np.int64)
        self.rows = self.nothing[:WINDOW if first else 0]
        self.done = len(self.rows)
        self.last = last

    @staticmethod
    def _shared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Leading signs two rows share; -1 for rows of different keys."""
        bits = BITS - np.frexp((x[:, 3] ^ y[:, 3]).astype(np.float64))[1]
        return np.where((x[:, :3] == y[:, :3]).all(axis=1), bits, -1)

    def add(self, rows: np.ndarray, last: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(id, depth) of rows (pass, label, dim, code, id) whose neighbours have come.

        Rows less than WINDOW from an end of the partition have unknown neighbours: BITS + 1.
        """
        closing = last and self.last
        self.rows = np.concatenate([self.rows, rows, self.nothing[:WINDOW if closing else 0]])
        n, first = len(self.rows), self.done
        end = n if last and not closing else max(n - WINDOW, first)
        at = np.arange(first, end)
        depth = np.full(len(at), BITS, dtype=np.int64)
        known = (at >= WINDOW) & (at + WINDOW < n)
        here = self.rows[at[known]]
        depth[known] = np.maximum(self._shared(here, self.rows[at[known] - WINDOW]), self._shared(here, self.rows[at[known] + WINDOW]))
        ids = self.rows[at, 4]
        drop = max(end - WINDOW, 0)
        self.rows, self.done = self.rows[drop:], end - drop
        return ids, depth + 1


def _within(deep: int, tasks: int):
    """Links inside a sorted partition, its first and last WINDOW rows for the seams, and depths over ``deep``."""
    def run(batches):
        return _searched(batches, deep, tasks)
    return run


def _searched(batches, deep: int, tasks: int):
    from pyspark import TaskContext
    edge = TaskContext.get().partitionId()
    parent: dict[int, int] = {}
    keys, ids, rows, head = [], np.zeros(0, np.int64), [], []
    depths = _Depths(edge == 0, edge == tasks - 1)

    def over(ids, depth):
        wide = depth > deep
        k = int(wide.sum())
        none, word = pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32())
        return pa.RecordBatch.from_arrays(
            [none, none, pa.array(np.full(k, -2, np.int32)), pa.array(depth[wide].astype(np.int32)), word, none, word,
             pa.array(ids[wide]), pa.nulls(k, pa.list_(pa.float32()))],
            ["a", "b", "edge", "side", "pass", "label", "dim", "id", "embedding"])

    def seam(items, side, at):
        cols = list(zip(*items))
        n = len(items)
        none = pa.nulls(n, pa.int64())
        return pa.RecordBatch.from_arrays(
            [none, none, pa.array([at] * n, pa.int32()), pa.array([side] * n, pa.int32()), pa.array([k[0] for k in cols[0]], pa.int32()),
             pa.array([k[1] for k in cols[0]], pa.int64()), pa.array([k[2] for k in cols[0]], pa.int32()),
             pa.array(cols[1], pa.int64()), pa.array(list(cols[2]), pa.list_(pa.float32()))],
            ["a", "b", "edge", "side", "pass", "label", "dim", "id", "embedding"])

    for batch in batches:
        if not batch.num_rows:
            continue
        more = list(zip(*(batch.column(k).to_pylist() for k in (0, 1, 2))))
        new_ids = batch.column(4).to_numpy(zero_copy_only=False)
        new_rows = [np.asarray(v, dtype=np.float32) for v in batch.column(5).to_pylist()]
        if len(head) < WINDOW:
            head += list(zip(more, new_ids.tolist(), new_rows))[:WINDOW - len(head)]
        numbers = np.array([*zip(*more), batch.column(3).to_numpy(zero_copy_only=False), new_ids], dtype=np.int64).T
        yield over(*depths.add(numbers))
        kept = len(keys)
        keys, ids, rows = keys + more, np.concatenate([ids, new_ids]), rows + new_rows
        found = _links_of(keys, ids, rows, kept, parent)
        if found:
            a, b = (pa.array(list(c), pa.int64()) for c in zip(*found))
            empty = [pa.nulls(len(found), t) for t in (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays([a, b, *empty], ["a", "b", "edge", "side", "pass", "label", "dim", "id", "embedding"])
        keys, ids, rows = keys[-WINDOW:], ids[-WINDOW:], rows[-WINDOW:]
    yield over(*depths.add(np.zeros((0, 5), dtype=np.int64), last=True))
    if head:
        yield seam(head, 1, edge - 1)
        yield seam(list(zip(keys, ids.tolist(), rows)), 0, edge)


def _across(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links over the seam between two partitions (tail of one, head of the next)."""
    tail, head = pdf[pdf.side == 0], pdf[pdf.side == 1]
    both = pd.concat([tail, head])
    keys = list(zip(both["pass"], both.label, both.dim))
    found = _links_of(keys, both.id.to_numpy(), [np.asarray(v) for v in both.embedding], len(tail), {})
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _blocked(batches):
    """Sorted rows (label, dim, code, id, embedding) in blocks of neighbours with centre and radius."""
    from pyspark import TaskContext
    task, made, held = TaskContext.get().partitionId(), 0, []

    def block(rows):
        x = np.array([np.asarray(r[4], dtype=np.float32) for r in rows])
        unit = x.astype(np.float64)
        unit /= np.sqrt((unit * unit).sum(axis=1))[:, None]
        centre = unit.sum(axis=0)
        long = np.sqrt((centre * centre).sum())
        centre = centre / long if long > 1e-9 else unit[0]
        radius = float(np.arccos(np.clip(unit @ centre, -1, 1)).max())
        return pa.RecordBatch.from_arrays(
            [pa.array([(task << 32) + made]), pa.array([rows[0][0]], pa.int64()), pa.array([rows[0][1]], pa.int32()),
             pa.array([centre.tolist()], pa.list_(pa.float64())), pa.array([radius]),
             pa.array([[r[3] for r in rows]], pa.list_(pa.int64())), pa.array([x.tobytes()], pa.binary())],
            ["block", "label", "dim", "centre", "radius", "ids", "rows"])

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and (row[:2] != held[0][:2] or len(held) == EXACT_BLOCK
                         or (len(held) >= EXACT_BLOCK // 8 and row[2] >> (BITS - 16) != held[-1][2] >> (BITS - 16))):
                yield block(held)
                made, held = made + 1, []
            held.append(row)
    if held:
        yield block(held)


def _exact(batches):
    """For pairs of blocks (dim, ids_x, rows_x, ids_y, rows_y): every linked vector with one it is connected to."""
    for batch in batches:
        for k in range(batch.num_rows):
            dim = batch.column(0)[k].as_py()
            ids, units = [], []
            for side in (1, 3):
                ids.append(batch.column(side)[k].values.to_numpy())
                x = np.frombuffer(batch.column(side + 1)[k].as_py(), dtype=np.float32).reshape(-1, dim).astype(np.float64)
                units.append(x / np.sqrt((x * x).sum(axis=1))[:, None])
            near = units[0] @ units[1].T >= LEAST_COSINE
            rows, columns = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
            near = near[np.ix_(rows, columns)]
            of_x, of_y = ids[0][rows], ids[1][columns]
            root_x, root_y, none = of_x.copy(), of_y.copy(), np.iinfo(np.int64).max
            while len(rows):
                new_x = np.minimum(root_x, np.where(near, root_y[None, :], none).min(axis=1))
                new_y = np.minimum(root_y, np.where(near, new_x[:, None], none).min(axis=0))
                if (new_x == root_x).all() and (new_y == root_y).all():
                    break
                root_x, root_y = new_x, new_y
            a, b = np.concatenate([root_x, root_y]), np.concatenate([of_x, of_y])
            yield pa.RecordBatch.from_arrays([pa.array(a[a != b]), pa.array(b[a != b])], ["a", "b"])


def _crowded_links(crowded: DataFrame, scratch: Scratch) -> DataFrame:
    """Links that connect all vectors of ``crowded`` (id, label, dim, embedding) as their exact pairs do."""
    spark = crowded.sparkSession
    n = crowded.count()
    if not n:
        return spark.createDataFrame([], "a long, b long")
    coded = crowded.select("id", "label", "dim", "embedding").mapInArrow(
        _projected(1), "pass int, label long, dim int, code long, id long, embedding array<float>")
    order = ["label", "dim", "code", "id"]
    blocks = scratch.store(coded.select(*order, "embedding").repartitionByRange(n // ROWS_PER_TASK + 1, *order).sortWithinPartitions(
        *order).mapInArrow(_blocked, "block long, label long, dim int, centre array<double>, radius double, ids array<long>, rows binary"))
    side = lambda name, *more: blocks.select(
        *[F.col(c).alias(f"{c}_{name}") for c in ("block", *more)], "label", "dim")
    bounds = ("centre", "radius")
    cosine = F.aggregate(F.zip_with("centre_x", "centre_y", lambda p, q: p * q), F.lit(0.0), lambda p, q: p + q)
    angle = F.acos(F.greatest(F.least(cosine, F.lit(1.0)), F.lit(-1.0)))
    reach = F.col("radius_x") + F.col("radius_y") + math.acos(LEAST_COSINE) + 1e-6
    pairs = scratch.store(side("x", *bounds).join(side("y", *bounds), ["label", "dim"]).where(
        (F.col("block_x") <= F.col("block_y")) & ((F.col("block_x") == F.col("block_y")) | (angle <= reach))).select("block_x", "block_y"))
    tasks = max(1, min(pairs.count() // 8 + 1, 20_000))
    whole = lambda name: blocks.select(*[F.col(c).alias(f"{c}_{name}") for c in ("block", "ids", "rows")])
    dims = blocks.select(F.col("block").alias("block_x"), "dim")
    both = pairs.join(dims, "block_x").join(whole("x"), "block_x").repartition(tasks, "block_x", "block_y").join(whole("y"), "block_y")
    return both.select("dim", "ids_x", "rows_x", "ids_y", "rows_y").mapInArrow(_exact, "a long, b long")


def _counted(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links of each vector of block i with block j (both ways), as counts weighted by copies."""
    i, j = pdf.i.iloc[0], pdf.j.iloc[0]
    left, right = pdf[pdf.block == i], pdf[pdf.block == j]
    unit = []
    for part in (left, right):
        x = np.array([np.asarray(v, dtype=np.float64) for v in part.embedding]) if len(part) else np.zeros((0, 1))
        unit.append(x / np.sqrt((x * x).sum(axis=1))[:, None])
    if not len(left) or not len(right):
        return pd.DataFrame({"id": [], "links": []}).astype("int64")
    near = (unit[0] @ unit[1].T) >= LEAST_COSINE
    if i == j:
        np.fill_diagonal(near, False)
        return pd.DataFrame({"id": left.id, "links": near @ right.copies.to_numpy()})
    return pd.concat([pd.DataFrame({"id": left.id, "links": near @ right.copies.to_numpy()}),
                      pd.DataFrame({"id": right.id, "links": near.T @ left.copies.to_numpy()})])


def link_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding, label).

    Compared are vectors of one label and dimension. Those without a label or id, NULL, empty
    or zero vectors, and vectors with NULL or non-finite parts link with nothing. Equal vectors
    of one label are one class: they link with each other and are searched once.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2048")
    scratch = Scratch(spark, "vectors")
    e = F.col("embedding")
    bad = F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = (F.col("label").isNotNull() & F.col("vec_id").isNotNull() & e.isNotNull() & (F.size(e) > 0) & ~bad
              & F.exists(e, lambda v: v != 0))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        e.cast("array<float>").alias("embedding"), F.coalesce(usable, F.lit(False)).alias("usable"))
    key = [F.xxhash64("label", "embedding").alias("key_a"), F.hash("embedding", "label").alias("key_b")]
    keyed = rows.select("*", *key)
    good = keyed.where("usable")
    classes = scratch.store(good.groupBy("key_a", "key_b").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies")))
    chosen = scratch.store(
        good.join(classes, ["key_a", "key_b"]).where("vec_id = id")
        .select("id", "label", F.size("embedding").alias("dim"), "embedding", "copies").dropDuplicates(["id"]))

    n = chosen.count()
    passes = passes_for(n)
    tasks = max(1, min(n * passes // ROWS_PER_TASK + 1, 20_000))
    ordered = chosen.select("id", "label", "dim", "embedding").mapInArrow(
        _projected(passes), "pass int, label long, dim int, code long, id long, embedding array<float>")
    ordered = ordered.repartitionByRange(int(tasks), "pass", "label", "dim", "code", "id").sortWithinPartitions(
        "pass", "label", "dim", "code", "id")
    deep = deep_enough(passes)
    found = scratch.store(ordered.mapInArrow(_within(deep, int(tasks)), _LINK_SCHEMA))
    seams = found.where("edge >= 0").groupBy("edge").applyInPandas(_across, "a long, b long")
    # Passes that gave no depth needed at most ``deep`` signs.
    missed = F.sum(F.when(F.col("side") <= BITS, F.log1p(-F.pow(F.lit(AGREE), F.col("side")))).otherwise(0.0))
    missed = missed + (passes - F.count(F.lit(1))) * math.log1p(-AGREE ** deep)
    crowded = scratch.store(chosen.join(
        found.where("edge = -2").groupBy("id").agg(missed.alias("missed")).where(F.col("missed") > math.log(CROWDED)).select("id"),
        "id").select("id", "label", "dim", "embedding"))
    exact = _crowded_links(crowded, scratch)
    links = scratch.store(found.where("a is not null").select("a", "b").unionByName(seams).unionByName(exact).distinct())
    components = scratch.store(connected_components(links, scratch))

    sizes = components.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    placed = components.join(sizes, "component").join(chosen.select("id", "embedding", "copies"), "id").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    other = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = other.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    counts = pairs.select("component", "i", "j", "block", "id", "embedding", "copies").groupBy("component", "i", "j").applyInPandas(
        _counted, "id long, links long").groupBy("id").agg(F.sum("links").alias("links"))
    classed = scratch.store(
        classes.join(components, "id", "left").join(counts, "id", "left")
        .select("key_a", "key_b", F.coalesce("component", "id").alias("component"),
                (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    out = keyed.select("vec_id", "usable", "key_a", "key_b").join(classed, ["key_a", "key_b"], "left")
    component = F.when(F.col("usable"), F.col("component")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id", F.when(F.col("usable"), F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(read_table(spark, sf_dir, "embeddings"))


OP3_SQL = """
WITH RECURSIVE e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM e UNION SELECT reach.a, links.y FROM reach JOIN links ON links.x = reach.b)
SELECT e.vec_id, coalesce(k.n, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM e LEFT JOIN (SELECT x, count(*) AS n FROM links GROUP BY x) k ON k.x = e.vec_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = e.vec_id
"""
