"""Words, shingles and sets of whole texts as 64-bit hashes, for Arrow batches inside tasks.

Everything here is vectorised over the bytes of many texts at once. A byte table says which
bytes belong to words and what they are read as; bytes of 0x80 and more are parts of letters,
so UTF-8 needs no decoding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Texts are worked on in pieces of about this many bytes; one text is never cut.
CHUNK_BYTES = 1 << 21
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[str, np.ndarray] = {}


def byte_table(separators: bytes, marks: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """(what each byte is read as, its kind); A-Z are read as a-z.

    Kind 0 separates words, kinds 1 and 2 (``marks``) make them up; a word ends where the
    kind changes.
    """
    read_as = np.arange(256, dtype=np.uint8)
    read_as[65:91] += 32
    kind = np.ones(256, dtype=np.uint8)
    kind[list(marks)] = 2
    kind[list(separators)] = 0
    return read_as, kind


# Words are what white space (space, tab to carriage return) leaves.
BETWEEN_SPACES = byte_table(bytes([0x20, *range(0x09, 0x0E)]))
_ASCII_MARKS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())
# Runs of letters and digits, and runs of punctuation, are words of two kinds.
WORDS_AND_MARKS = byte_table(bytes([*range(0x21), 0x7F]), _ASCII_MARKS)
# Runs of letters; everything else separates.
LETTERS = byte_table(bytes(b for b in range(128) if not chr(b).isalpha()))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def multipliers(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit constants that follow from ``seed``."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed)) | np.uint64(1)


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + 1)
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


class Words:
    """The words of some texts: ``hashes`` and ``text`` (index of the text) in reading order."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table=BETWEEN_SPACES):
        read_as, kinds = table
        kind = kinds[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        change = edge.copy()
        change[1:-1] |= kind[1:] != kind[:-1]
        opens, closes = (kind > 0) & change[:-1], (kind > 0) & change[1:]
        self.starts = np.flatnonzero(opens)
        self.ends = np.flatnonzero(closes) + 1
        up, down = _power_table(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((read_as[data].astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
        self.prefix = (sums, down)
        self.hashes = mix((sums[self.ends] - sums[self.starts]) * down[self.starts])
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.text = np.repeat(np.arange(len(offsets) - 1), self.counts)

    def prefix_hashes(self, size: int) -> np.ndarray:
        """Hash of the first ``size`` bytes of every word (of all of a shorter one)."""
        sums, down = self.prefix
        return mix((sums[np.minimum(self.starts + size, self.ends)] - sums[self.starts]) * down[self.starts])


def word_hash(word: str) -> int:
    """The hash :class:`Words` gives to ``word``, which must be in lower case."""
    data = np.frombuffer(word.encode(), dtype=np.uint8)
    return int(Words(data, np.array([0, len(data)])).hashes[0])


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every run of ``size`` words, number of runs of each text).

    A text of fewer words, but not none, is one run as a whole.
    """
    weights = multipliers(size, 5)
    h, n = words.hashes, len(words.hashes)
    full = np.maximum(words.counts - size + 1, 0)
    short = (words.counts > 0) & (full == 0)
    counts = np.where(short, 1, full)
    runs = max(n - size + 1, 0)
    if runs:
        sums = h[:runs] * weights[0]
        for k in range(1, size):
            sums = sums + h[k:k + runs] * weights[k]
        whole = mix(sums)[words.text[:runs] == words.text[size - 1:]]
    else:
        whole = np.zeros(0, dtype=np.uint64)
    if not short.any():
        return whole, counts
    out = np.empty(int(counts.sum()), dtype=np.uint64)
    place = np.concatenate([[0], np.cumsum(counts)])[:-1]
    is_short = np.zeros(len(out), dtype=bool)
    is_short[place[short]] = True
    out[~is_short] = whole
    for t in np.flatnonzero(short):
        part = h[words.first[t]:words.first[t + 1]]
        out[place[t]] = mix(np.array([(part * weights[:len(part)]).sum() + np.uint64(len(part))]))[0]
    return out, counts


def distinct(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values of each text in ascending order without repeats, how many there are)."""
    values = values.copy()
    ends = np.cumsum(counts)
    for a, b in zip(ends - counts, ends):
        values[a:b].sort()
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = values[1:] != values[:-1]
    keep[(ends - counts)[counts > 0]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return values[keep], kept[ends] - kept[ends - counts]


def per_text(ufunc: np.ufunc, values: np.ndarray, counts: np.ndarray, empty=0) -> np.ndarray:
    """``ufunc`` reduced over each text's values; ``empty`` where there are none."""
    out = np.full(len(counts), empty, dtype=values.dtype)
    some = counts > 0
    if some.any():
        out[some] = ufunc.reduceat(values, (np.cumsum(counts) - counts)[some])
    return out


def chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Pieces of a string column as (first row, end row, bytes, offsets); NULL reads as empty."""
    texts = pa.chunked_array([texts]).combine_chunks() if not isinstance(texts, pa.ChunkedArray) else texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return
    _, places, content = texts.buffers()
    offsets = np.frombuffer(places, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(content, dtype=np.uint8) if content is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, side="right")) - 1
        end = min(max(end, row + 1), len(texts))
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def list_column(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A list of 64-bit integers per row."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))
