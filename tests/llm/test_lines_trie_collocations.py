"""Line dedup, the conversation trie and collocations against plain Python and on odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from perkmill.llm import collocations, lines, trie

DOCS = "doc_id long, text string, lang string, key string, n_dropped string, positions string"
TURNS = "conv_id long, turn long, role string, text string, path string, ids string"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture
def documents(spark):
    def build(rows):
        return spark.createDataFrame([(i, t, lang, "x", "y", "z") for i, t, lang in rows], DOCS)
    return build


# -- lines ----------------------------------------------------------------------------

def kept_lines(rows, min_chars, min_docs):
    holders = defaultdict(set)
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(UPPER)
    for i, text, _ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars and i is not None:
                holders[key(line)].add(i)
    frequent = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for i, text, _ in rows:
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if key(x) not in frequent or frequent[key(x)] == i]
        out.append((i, "\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return sorted(out, key=str)


def test_lines_against_plain_python(documents):
    rng = random.Random(4)
    pool = ["Short", "", "  ", "Ünï çödé line number one", "\x0bLine \tTWO is here\r", "line \ttwo is here", "ÜNÏ çödé line number one",
            "a third line, longer", "only a few have this one"]
    rows = [(rng.choice([None, *range(12)]), "\n".join(rng.choices(pool, k=rng.randrange(9))), "en") for _ in range(60)]
    rows += [(90 + i, "only a few have this one", "en") for i in range(2)] + [(7, None, None), (8, "\n", "en"), (7, None, None)]
    found = lines.drop_repeated_lines(documents(rows), min_chars=8, min_docs=4)
    assert found.columns == ["doc_id", "text", "lang", "key", "positions", "n_lines", "n_dropped"]
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found.collect()), key=str)
    assert got == kept_lines(rows, 8, 4)
    assert sum(r[3] for r in got) > 20


def test_lines_code_points_and_last_holder(documents):
    line = "é" * 40
    rows = [(i, f"{line}\n{i}", "en") for i in range(5)] + [(None, line, "en")] + [(i, "é" * 39, "en") for i in range(10, 16)]
    got = {r.doc_id: r.text for r in lines.drop_repeated_lines(documents(rows)).collect()}
    assert got[4] == f"{line}\n4" and got[0] == "0" and got[None] == "" and got[10] == "é" * 39


def test_lines_long_text_and_empty_table(documents, spark):
    shared = "the very same line in each of these documents"
    rows = [(i, "\n".join([shared, f"own {i}"] * 20_000), "en") for i in range(5)]
    got = {r.doc_id: r for r in lines.drop_repeated_lines(documents(rows)).collect()}
    assert got[4].n_dropped == 0 and got[0].n_dropped == 20_000 and got[0].text == "\n".join(["own 0"] * 20_000)
    assert lines.drop_repeated_lines(spark.createDataFrame([], DOCS)).collect() == []


# -- trie -----------------------------------------------------------------------------

def nodes_of(paths):
    """Every node of ``paths`` {conv_id: [(hash, n_words)]} by plain dictionaries."""
    members, children = defaultdict(set), defaultdict(set)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].add(c)
            if d:
                children[tuple(path[:d - 1])].add(tuple(path[:d]))
    leaves, saved = Counter(), Counter()
    for node in members:
        own = (len(members[node]) - 1) * (node[-1][1] if node else 0)
        for d in range(len(node) + 1):
            saved[node[:d]] += own
            leaves[node[:d]] += not children[node]
    out = []
    for node, of in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in of if len(paths[c]) == len(node)))
        out.append((min(of), len(node), min(members[node[:-1]]) if node else None, len(of), len(children[node]), leaves[node],
                    saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found_nodes(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def as_turns(spark, paths):
    rows = [(c, [(bytearray(hashlib.md5(t.encode()).digest()), n) for t, n in path]) for c, path in paths.items()]
    return spark.createDataFrame(rows, "conv_id long, turns array<struct<hash:binary,n_words:long>>")


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_trie_against_plain_python(spark, shards):
    rng = random.Random(shards)
    turns = [(f"t{k}", k) for k in range(4)]
    paths = {rng.randrange(-50, 20_000): rng.choices(turns, k=rng.choice([0, 1, 2, 3, 5, 8])) for _ in range(400)}
    paths.update({30_000 + i: [turns[0]] * 5 for i in range(300)})  # one path with a large share of all
    paths.update({40_000 + i: [turns[1]] * (60 + i % 3) for i in range(9)})  # longer than splitters are
    assert found_nodes(trie.prefix_trie(as_turns(spark, paths), shards)) == nodes_of(paths)


def test_trie_hands_on_finished_nodes(spark, monkeypatch):
    rng = random.Random(1)
    monkeypatch.setattr(trie, "_ROWS", 7)
    paths = {i: [(f"t{rng.randrange(3)}", 2) for _ in range(rng.randrange(7))] for i in range(200)}
    rows = sorted((b"".join(hashlib.md5(t.encode()).digest() for t, _ in path), c, [n for _, n in path]) for c, path in paths.items())
    shard = trie._Shard(trie.skeleton_of([rows[60][0], rows[120][0]]))
    batches = 0
    for path, c, n_words in rows:
        shard.leave(path)
        if len(shard.conv) >= 7 and shard.settled():
            shard.finished()
            batches += 1
        shard.add(path, n_words, str(c), 1, c)
    assert batches > 3
    assert found_nodes(trie.prefix_trie(as_turns(spark, paths), 5)) == nodes_of(paths)


def test_trie_rebuilds_conversations_and_takes_odd_rows(spark):
    rows = [(c, t, r, x, "p", "i") for c, t, r, x in [
        (20, None, None, "null turn comes first"), (20, 1, "user", None), (20, 1, "user", None), (20, 0, "user", "one two"),
        (21, 0, "user", "one two"), (21, 1, None, "  "), (40, 0, "b", "tie"), (40, 0, "a", "tie"), (None, 0, "user", "nobody"),
        (61, 0, "user", "no first conversation"), (-3, 0, "user", "x"), (-20, 0, "user", "y"), (45, 5, "user", "long " * 50_000)]]
    turns = spark.createDataFrame(rows, TURNS)
    plain = defaultdict(list)
    for c, t, r, x, _, _ in sorted((x for x in rows if x[0] is not None), key=lambda x: (
            x[0], x[1] is not None, x[1] or 0, x[2] or "", hashlib.md5((x[3] or "").encode()).hexdigest())):
        plain[c].append((f"{len(r or '')}:{r or ''}{x or ''}", len(re.findall(r"[^\x20\x09-\x0D]+", x or ""))))
    rebuilt = {}
    for c, own in plain.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        rebuilt[c] = plain.get(base, [])[:h] + own[h:]
    assert found_nodes(trie.prefix_trie(trie.branched(trie.turns_of(turns)), 4)) == nodes_of(rebuilt)
    assert trie.prefix_trie(trie.branched(trie.turns_of(spark.createDataFrame([], TURNS))), 4).collect() == []


# -- collocations ---------------------------------------------------------------------

def plain_collocations(rows, threshold, top):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for size in range(1, 6):
                f[lang].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        frequent = {p: a for p, a in counts.items() if len(p) > 1 and a >= threshold}
        left = []
        for p, a in frequent.items():
            if any(len(q) > len(p) and b >= a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in frequent.items()):
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            left.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(left)[:top], 1):  # noqa: E741
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"slack": 1}, {"most_known": 0}])
def test_collocations_against_plain_python(documents, options):
    rng = random.Random(9)
    vocabulary = ["the", "The", "of", "ölig", "Ölig", "a", "b c", "new", "york", "city", "x"]
    glue = [" ", "  ", "\t", ", ", ".", "\n", " "]
    rows = [(i, "".join(w + rng.choice(glue) for w in rng.choices(vocabulary, k=rng.randrange(40))), rng.choice(["en", "de", None, "und"]))
            for i in range(300)]
    rows += [(None, "in new york city hall. a a a a a a", "en")] * 30 + [(1, None, "en"), (2, "", None), (3, "?!", "fr"), (4, "w " * 30_000, "en")]
    found = collocations.collocations(documents(rows), threshold=8, top=25, **options)
    assert sorted(tuple(r) for r in found.collect()) == plain_collocations(rows, 8, 25)


def test_summaries_keep_what_is_frequent():
    rng = np.random.default_rng(2)
    often = rng.integers(0, 1 << 63, 40, dtype=np.uint64) * np.uint64(2)
    stream = np.concatenate([np.repeat(often, 60), rng.integers(0, 1 << 63, 30_000, dtype=np.uint64) * np.uint64(2)])
    rng.shuffle(stream)
    masses = np.bincount((stream >> np.uint64(60)).astype(int), minlength=16)
    parts = [collocations.Summary(masses // 50 + 1) for _ in range(3)]
    for i, some in enumerate(np.array_split(stream, 60)):
        parts[i % 3].merge(*collocations._counted(some))
    whole = collocations.Summary(masses // 50 + 1)
    for part in parts:
        whole.taken += part.taken
        whole.merge(part.hashes, part.counts)
    assert set(often) <= set(whole.hashes) and whole.taken.max() > 0 and whole.taken.max() < 50
    assert len(whole.hashes) <= (masses // 50 + 1).sum()


@pytest.mark.parametrize("most", [1 << 19, 3])
def test_a_task_counts_a_run_once(monkeypatch, most):
    class Known:
        value = None

    monkeypatch.setattr(collocations, "_MOST_TALLIED", most)
    batch = lambda *texts: pa.RecordBatch.from_arrays(
        [pa.array(["en", "de"][:len(texts)]), pa.array(texts, pa.string())], ["lang", "text"])
    batches = [batch("New York city", "new york"), batch("a new\tYork", None), batch("city of new york. new york", "x")]
    packed = [r for found in collocations._count_exactly(Known, Known, Known, 64)(iter(batches)) for r in found.to_pylist()]
    rows = [r for p in packed for r in pa.ipc.open_stream(p["runs"]).read_all().to_pylist()]
    counts = Counter()
    for r in rows:
        counts[r["lang"], r["size"], r["phrase"]] += r["n"]
    assert counts["en", 2, "new york"] == 4 and counts["de", 2, "new york"] == 1 and counts["en", 4, "city of new york"] == 1
    assert counts["en", 0, ""] == 12 and counts["de", 0, ""] == 3 and counts["en", 1, "city"] == 2
    assert most < len(counts) or len(rows) == len(counts) and len(packed) <= 65
    packed.sort(key=lambda r: r["part"])
    ordered = pa.RecordBatch.from_pylist(packed, pa.schema([("part", pa.int32()), ("runs", pa.binary())]))
    found = [r for batch in collocations._added_up(2)(iter([ordered])) for r in batch.to_pylist()]
    assert sorted((r["lang"], r["size"], r["phrase"], r["f"]) for r in found) == sorted(
        (*key, n) for key, n in counts.items() if n >= 2 or not key[1])


def test_collocations_scores_beyond_64_bits(spark):
    big = 4 * 10 ** 12
    row = spark.range(1).select(F.lit(big).alias("a"), F.lit(big).alias("n"), F.lit(big).alias("l"), F.lit(3).cast("long").alias("r"))
    exact = "cast({} as decimal(38,0))"
    assert row.select(F.expr(f"(1000 * {exact.format('a')} * n) div ({exact.format('l')} * r)")).first()[0] == 1000 * big * big // (big * 3)


def test_collocations_of_nothing(spark):
    assert collocations.collocations(spark.createDataFrame([], DOCS)).collect() == []
