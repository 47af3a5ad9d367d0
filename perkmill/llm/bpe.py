"""Byte-level BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

The leaves of the tree are the pairs of neighbouring tokens of one piece of text; every inner
node holds the smallest rank below it. The root gives the lowest rank, the way down (left
child first) its leftmost place. A merge changes three leaves and their ancestors. Pieces of
up to ``SHORT`` bytes go through their trees side by side, as rows of one array; longer ones
have a tree each.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perkmill.llm.tables import read_table

SHORT = 64
NONE = np.uint32(0xFFFFFFFF)
# A task remembers the tokens of about this many pieces, and of none longer than SHORT.
REMEMBERED = 400_000
CHUNK_CHARS = 500_000
_SLICE = 1 << 14
# Unicode's white space, without the four ASCII separators that some libraries add.
_SPACE = r"\t\n\x0b\x0c\r \x85\xa0  -     　"
PIECES = (r" ?\p{L}+|'s|'t|'re|'ve|'m|'ll|'d| ?\p{N}+| ?[^" + _SPACE + r"\p{L}\p{N}]+|["
          + _SPACE + r"]+(?![^" + _SPACE + r"])|[" + _SPACE + r"]+")

# The same for texts whose characters are all below U+0100.
_LETTER, _NUMBER, _WHITE = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", r"\t\n\x0b\x0c\r \x85\xa0"
LATIN_PIECES = (f" ?[{_LETTER}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{_NUMBER}]+| ?[^{_WHITE}{_LETTER}{_NUMBER}]+"
                f"|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Visible characters of Latin-1 stand for themselves, all others for 256, 257 and so on.
    """
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class Codec:
    """Encoder and decoder of one byte-level BPE vocabulary (text of its JSON file)."""

    def __init__(self, vocabulary: str):
        spec = json.loads(vocabulary)
        ids, letters = spec["model"]["vocab"], byte_letters()
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.base = max([*ids.values(), *self.special.values()]) + 1
        self.byte_ids = np.array([ids[x] for x in letters], dtype=np.int32)
        keys = np.array([ids[a] * self.base + ids[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.uint32)
        self.merged = np.array([ids[a + b] for a, b in merges], dtype=np.int32)
        self.rank_of = {int(k): r for r, k in enumerate(keys)}
        byte_of = {x: b for b, x in enumerate(letters)}
        self.bytes_of: list[bytes] = [b""] * self.base
        for token, i in ids.items():
            self.bytes_of[i] = bytes(byte_of[x] for x in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.digits = [str(i) for i in range(self.base)]
        self.pieces, self.latin_pieces = regex.compile(PIECES), re.compile(LATIN_PIECES)
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.known: dict[str, tuple[str, bytes]] = {}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left.astype(np.int64) * self.base + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where((self.keys[at] == wanted) & (left >= 0) & (right >= 0), self.ranks[at], NONE)

    def cut(self, text: str) -> list[str]:
        """Pieces that are encoded on their own; special tokens are pieces."""
        try:
            text.encode("latin-1")
            find = self.latin_pieces.findall
        except UnicodeEncodeError:
            find = self.pieces.findall
        if self.split is None or not any(s in text for s in self.special):
            return find(text)
        out = []
        for k, part in enumerate(self.split.split(text)):
            out.extend([part] if k % 2 else find(part))
        return out

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(pieces)
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        for k in np.flatnonzero(lengths > SHORT):
            out[k] = self._long(pieces[k])
        data = np.frombuffer(b"".join(pieces) + bytes(SHORT), dtype=np.uint8)
        starts = np.cumsum(lengths) - lengths
        width, least = 2, 0
        while width <= SHORT:
            members = np.flatnonzero((lengths > least) & (lengths <= width))
            for start in range(0, len(members), _SLICE):
                part = members[start:start + _SLICE]
                table = data[starts[part] + np.arange(width)[:, None]]
                for k, found in zip(part.tolist(), self._side_by_side(table, lengths[part])):
                    out[k] = found
            width, least = 2 * width, width
        return out

    def _side_by_side(self, data: np.ndarray, lengths: np.ndarray) -> list[list[int]]:
        # Places 1 to width hold tokens, 0 and width + 1 stand for "no neighbour"; the leaf of
        # place p is node width + p - 1. Node (or place) k of piece i is at k * n + i.
        width, n = data.shape
        tokens = np.full((width + 2, n), -1, dtype=np.int32)
        tokens[1:-1] = np.where(np.arange(width)[:, None] < lengths, self.byte_ids[data], -1)
        tree = np.full((2 * width, n), NONE, dtype=np.uint32)
        tree[width:] = self.rank(tokens[1:-1], tokens[2:])
        for node in range(width - 1, 0, -1):
            np.minimum(tree[2 * node], tree[2 * node + 1], out=tree[node])
        places = np.arange(width + 2, dtype=np.int32)
        after, before = (np.repeat(places + step, n) for step in (1, -1))
        rows = np.flatnonzero(tree[1] != NONE)
        flat, tree = tokens.reshape(-1), tree.reshape(-1)
        while len(rows):
            root = tree.take(n + rows)
            node = np.ones(len(rows), dtype=np.int64)
            for _ in range(width.bit_length() - 1):
                node *= 2
                node += tree.take(node * n + rows) != root
            here = node - (width - 1)
            at = here * n + rows
            gone = after.take(at).astype(np.int64)
            at_gone = gone * n + rows
            follow = after.take(at_gone)
            left = before.take(at).astype(np.int64)
            token = self.merged.take(root)
            flat[at], flat[at_gone] = token, -1
            after[at] = follow
            at_follow = follow.astype(np.int64) * n + rows
            before[at_follow] = here
            ranks = self.rank(np.concatenate([token, flat.take(left * n + rows)]), np.concatenate([flat.take(at_follow), token]))
            # Three leaves change, then their ancestors; a missing left neighbour repeats the dead leaf.
            k = len(rows)
            leaf = np.concatenate([gone, here, np.where(left > 0, left, gone)]) + (width - 1)
            rows3 = np.concatenate([rows, rows, rows])
            tree[leaf * n + rows3] = np.concatenate([np.full(k, NONE), ranks[:k], np.where(left > 0, ranks[k:], NONE)])
            for _ in range(width.bit_length() - 1):
                leaf >>= 1
                child = leaf * (2 * n) + rows3
                tree[leaf * n + rows3] = np.minimum(tree.take(child), tree.take(child + n))
            rows = rows[tree.take(n + rows) != NONE]
        by_piece = tokens[1:-1].T
        live = by_piece >= 0
        found, ends = by_piece[live].tolist(), np.cumsum(live.sum(axis=1)).tolist()
        return [found[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    def _long(self, piece: bytes) -> list[int]:
        tokens = [int(self.byte_ids[b]) for b in piece]
        n = len(tokens)
        width = 1 << (n - 1).bit_length()
        none, get, base = int(NONE), self.rank_of.get, self.base
        tree = [none] * (2 * width)
        for i in range(n - 1):
            tree[width + i] = get(tokens[i] * base + tokens[i + 1], none)
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(leaf: int, value: int) -> None:
            node = leaf + width
            tree[node] = value
            node >>= 1
            while node:
                tree[node] = min(tree[2 * node], tree[2 * node + 1])
                node >>= 1

        while tree[1] != none:
            rank, node = tree[1], 1
            while node < width:
                node *= 2
                node += tree[node] != rank
            here = node - width
            gone = after[here]
            follow, left = after[gone], before[here]
            tokens[here], tokens[gone] = int(self.merged[rank]), -1
            after[here] = follow
            put(gone, none)
            if follow < n:
                before[follow] = here
            put(here, get(tokens[here] * base + tokens[follow], none) if follow < n else none)
            if left >= 0:
                put(left, get(tokens[left] * base + tokens[here], none))
        return [t for t in tokens if t >= 0]

    def encode(self, text: str) -> list[int]:
        pieces = self.cut(text)
        found = self.encode_pieces([b"" if p in self.special else p.encode() for p in pieces])
        return [i for p, ids in zip(pieces, found) for i in ([self.special[p]] if p in self.special else ids)]

    def decode(self, ids) -> str:
        """The text of ``ids``; bytes that are no UTF-8 become U+FFFD. Unknown ids give nothing."""
        return b"".join(self.bytes_of[i] for i in ids if 0 <= i < self.base).decode("utf-8", "replace")

    def coded(self, texts: list[str]) -> list[tuple[str, bytes]]:
        """(ids in decimal joined by commas, bytes that they decode to) of every text."""
        cuts = [self.cut(t) for t in texts]
        found = [list(map(self.known.get, pieces)) for pieces in cuts]
        new = list({p for pieces, entries in zip(cuts, found) for p, e in zip(pieces, entries) if e is None})
        plain = [p for p in new if p not in self.special]
        ids_of = {**{p: [self.special[p]] for p in new if p in self.special},
                  **dict(zip(plain, self.encode_pieces([p.encode() for p in plain])))}
        digits, of = self.digits, self.bytes_of
        fresh = {p: (",".join([digits[i] for i in ids]), b"".join([of[i] for i in ids])) for p, ids in ids_of.items()}
        out = []
        for pieces, entries in zip(cuts, found):
            entries = [e or fresh[p] for p, e in zip(pieces, entries)]
            out.append((",".join([e[0] for e in entries]), b"".join([e[1] for e in entries])))
        if len(self.known) < REMEMBERED:
            self.known.update((p, e) for p, e in fresh.items() if len(p) <= SHORT)
        return out


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


ARROW_ROWS = "1024"


def tokenized(docs: DataFrame, vocabulary: str | None = None, with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, (ids,) decoded-text digests of every row of ``docs`` (doc_id, text, ...).

    ids_text holds the ids in decimal, joined by commas. A NULL text reads as an empty one and
    has no tokens. ``vocabulary`` is the path of a tokenizer's JSON file, read on the driver.
    """
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(file.read())

    def run(batches):
        codec = Codec(shared.value)
        gc.disable()  # nothing here makes cycles, and collections would walk all that is remembered
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            start = 0
            while start < len(texts):
                end, size = start, 0
                while end < len(texts) and (end == start or size + len(texts[end]) <= CHUNK_CHARS):
                    size += len(texts[end])
                    end += 1
                rows = codec.coded(texts[start:end])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start),
                     pa.array([ids.count(",") + 1 if ids else 0 for ids, _ in rows], pa.int64()),
                     pa.array([ids if with_ids else None for ids, _ in rows], pa.string()),
                     pa.array([hashlib.sha256(ids.encode()).hexdigest() for ids, _ in rows], pa.string()),
                     pa.array([hashlib.sha256(d.decode("utf-8", "replace").encode()).hexdigest() for _, d in rows], pa.string())],
                    ["doc_id", "n_tokens", "ids_text", "ids_sha256", "decoded_sha256"])
                start = end

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_text string, ids_sha256 string, decoded_sha256 string")
    return found if with_ids else found.drop("ids_text")


def encode(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the tokens themselves (ids, array of int)."""
    rows = tokenized(docs, vocabulary)
    ids = F.when(F.col("ids_text") == "", F.array().cast("array<int>")).otherwise(F.split("ids_text", ",").cast("array<int>"))
    return rows.select("doc_id", "n_tokens", ids.alias("ids"))


def decode(rows: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""
    spark = rows.sparkSession
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(file.read())

    def run(batches):
        codec = Codec(shared.value)
        for batch in batches:
            texts = [None if ids is None else codec.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenized(read_table(spark, sf_dir, "documents"), with_ids=False)
