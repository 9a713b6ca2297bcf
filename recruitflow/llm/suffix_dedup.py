"""Operator 8, suffix-array dedup: distributed prefix doubling over sampled suffixes.

A byte goes if a string of ``length`` bytes that covers it also starts
anywhere else in the corpus; matches never cross texts.

Names stand for ranks: each round sorts the names of the corpus by key
range on Spark, but a prefix's name is a hash of its bytes, not composed
from the ranks of its halves.  Sorting (position, rank) pairs of *all*
positions would move more than ten times the text in each round, so the suffixes that are ranked are a
content-defined sample: positions whose ``gram`` hashes below a limit
(about one in 25).  A string belongs to the first sampled position at or
after its start, at distance d; equal strings have it at equal d.  Ranks
are names (64-bit hashes of the prefix so far, equal names for equal
prefixes); each round sorts them over the corpus and drops what is
unique.

* Strings with d in one block of distances share a middle part.  A round
  ranks these parts; a unique part drops its whole block.
* The next round ranks the blocks' strings in full: from the first
  string's start to the last one's end.  A repeated block is done: all
  its strings occur twice.
* What is left is cut into twelve blocks of a twelfth of the distances,
  so the ranked prefix grows towards ``length`` (57, 189 and 200 bytes for
  the default), until unique or as long as the threshold.

A block that is done stays as a witness only while an undecided block
has the same middle part.  Strings without a sampled position in reach
are ranked whole in the last round.  Accepting ranks have 96 bits.

Defined results: a null or empty text has 0 bytes; texts shorter than
``length`` lose nothing; overlapping occurrences inside one text count;
repeated rows are texts of their own and remove each other; extra
columns are carried, names that the result adds are replaced; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Generator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _BYTE, _KEEP, covered, mix64, text_bytes
from .repeats import ASKED, REPEATED, in_rounds

LENGTH = 200
#: A chunk's texts: its hashes take about 40 times as much memory.
CHUNK_BYTES = 2 << 20
_U = np.uint64
_BASES = (0x9E3779B97F4A7C55, 0xC2B2AE3D27D4EB4D)
#: Positions hashed in one numpy step, and factors of the words of a sampled gram.
_RUN = 1 << 15
_SCALE = mix64(np.arange(1, 65, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)


def block_sizes(length: int, gram: int) -> list[int]:
    """Distances per block, each a twelfth of the last, down to one."""
    sizes = [1]
    while sizes[-1] * 12 + gram <= length:
        sizes.append(sizes[-1] * 12)
    return sizes[::-1]


_SCALES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _scale(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2**64, at least ``n`` of each."""
    if which not in _SCALES or len(_SCALES[which][0]) < n:
        both = []
        for base in (_BASES[which], pow(_BASES[which], -1, 1 << 64)):
            p = np.full(n, base, dtype=_U)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _SCALES[which] = both[0], both[1]
    return _SCALES[which]


class Prefixes:
    """Names of any byte range of a chunk; a base's sums are made when first asked for."""

    def __init__(self, data: np.ndarray) -> None:
        self.data = data
        self.made: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _sums(self, which: int) -> tuple[np.ndarray, np.ndarray]:
        if which not in self.made:
            n = len(self.data)
            up, down = _scale(which, max(n + 1, 3 << 20))
            sums = np.zeros(n + 1, dtype=_U)
            np.multiply(_BYTE[self.data], up[:n], out=sums[1:])
            np.cumsum(sums, out=sums)
            self.made[which] = sums, down
        return self.made[which]

    def name(self, a: np.ndarray, b: np.ndarray, tag: np.ndarray | int = 0, which: int = 0) -> np.ndarray:
        sums, back = self._sums(which)
        raw = (sums[b] - sums[a]) * back[a]
        return mix64(raw + (b - a).astype(_U) * _U(0x9FB21C651E98DF25) + np.asarray(tag).astype(_U) * _U(0xD6E8FEB86659FD93))


def _short(names: np.ndarray) -> np.ndarray:
    return (names >> _U(32)).astype(np.uint32)


def sampled(data: np.ndarray, offs: np.ndarray, gram: int, one_in: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose ``gram`` bytes, inside one text, hash below a limit, and their texts.

    The hash only deals positions, no names come of it: eight bytes at a
    time are scaled and added, and the sum is mixed once.
    """
    n = len(data) - gram + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    places = [*range(0, gram - 8, 8), max(0, gram - 8)]
    limit = _U(((1 << 64) - 1) // one_in)
    at = []
    for lo in range(0, n, _RUN):
        hi = min(lo + _RUN, n)
        h = np.full(hi - lo, _BASES[1], dtype=_U)
        for k, place in enumerate(places):
            word = words[lo + place:hi + place]
            h += (word if gram >= 8 else word & _KEEP[gram]) * _SCALE[k % len(_SCALE)]
        h ^= h >> _U(32)
        h *= _U(0x94D049BB133111EB)
        h ^= h >> _U(29)
        h *= _U(0xBF58476D1CE4E5B9)
        at.append(np.flatnonzero(h < limit) + lo)
    found = np.concatenate(at)
    text = np.searchsorted(offs, found, "right") - 1
    own = found + gram <= offs[1:][text]
    return found[own], text[own]


def left_out(offs: np.ndarray, length: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Starts of strings of ``length`` bytes in one text that lie in none of the ranges ``lo..hi`` (apart, each in one text)."""
    long = np.diff(offs) >= length
    begin, to = np.sort(np.append(offs[:-1][long], hi + 1)), np.sort(np.append(lo, offs[1:][long] - length + 1))
    k = to - begin
    return np.repeat(begin - np.cumsum(k) + k, k) + np.arange(int(k.sum()))


def rounds_of(length: int) -> int:
    return 2 * (len(block_sizes(length, max(1, length // 8))) - 1) + 1


def repeated_strings(data: np.ndarray, offs: np.ndarray, length: int = LENGTH) -> Generator:
    """Coroutine over one chunk; returns the starts of all strings of ``length`` bytes that are repeated."""
    gram = max(1, length // 8)
    sizes = block_sizes(length, gram)
    span = sizes[0]
    at, text = sampled(data, offs, gram, max(1, span // 5))
    names = Prefixes(data)
    begin, end = offs[:-1][text], offs[1:][text]
    before = np.append(-1, at[:-1]) if len(at) else at
    lo = np.maximum(np.maximum(np.maximum(before + 1, begin), at - span + 1), 0)
    hi = np.minimum(at, end - length)
    ok = hi >= lo
    s, e0, e1 = at[ok], (at - hi)[ok], (at - lo)[ok]
    reached = lo[ok], hi[ok]
    d0 = np.zeros(len(s), np.int64)
    open_ = np.ones(len(s), bool)
    found: list[np.ndarray] = []

    def starts(pick: np.ndarray) -> np.ndarray:
        k = (e1 - e0 + 1)[pick]
        first = (s - e1)[pick]
        return np.repeat(first - np.cumsum(k) + k, k) + np.arange(int(k.sum()))

    for level, size in enumerate(sizes[:-1]):
        got = yield names.name(s - d0, s - d0 - size + 1 + length, d0 + level * span), None, open_
        keep = ((got & REPEATED) > 0) & (open_ | ((got & ASKED) > 0))
        s, d0, e0, e1, open_ = s[keep], d0[keep], e0[keep], e1[keep], open_[keep]
        tag = ((d0 + level * span) * span + e0) * span + e1
        a, b = s - e1, s - e0 + length
        got = yield names.name(a, b, tag), _short(names.name(a, b, tag, 1)), None
        done = open_ & ((got & REPEATED) > 0)
        found.append(starts(done))
        open_ = open_ & ~done
        step = sizes[level + 1]
        parts = []
        for k in range(size // step):
            c = d0 + k * step
            p0, p1 = np.maximum(e0, c), np.minimum(e1, c + step - 1)
            ok = p0 <= p1
            parts.append((s[ok], c[ok], p0[ok], p1[ok], open_[ok]))
        s, d0, e0, e1, open_ = (np.concatenate(x) for x in zip(*parts, strict=True))
    rest = left_out(offs, length, *reached)  # strings without a sampled position in reach
    one = np.concatenate([s - e0, rest])
    ask = np.concatenate([open_, np.ones(len(rest), bool)])
    got = yield names.name(one, one + length), _short(names.name(one, one + length, 0, 1)), ask
    found.append(one[ask & ((got & REPEATED) > 0)])
    return np.concatenate(found)


def remove_strings(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans and kept (the remaining bytes)."""
    src = docs.drop("n_bytes", "n_removed", "n_spans", "kept")
    names = src.columns
    zero = F.lit(0).cast("long")
    schema = src.withColumns({"n_bytes": zero, "n_removed": zero, "n_spans": zero, "kept": F.lit(b"")}).schema

    def step(table: pa.Table) -> Generator:
        data, offs = text_bytes(table.column(text))
        gone = covered(len(data), (yield from repeated_strings(data, offs, length)), length)
        first = gone.copy()
        first[1:] &= ~gone[:-1]
        heads = offs[:-1][offs[:-1] < offs[1:]]
        first[heads] = gone[heads]
        spans, removed = np.append(0, np.cumsum(first))[offs], np.append(0, np.cumsum(gone))[offs]
        new = offs - removed
        kept = pa.Array.from_buffers(pa.large_binary(), len(offs) - 1, [
            None, pa.py_buffer(new.astype(np.int64).tobytes()), pa.py_buffer(data[~gone].tobytes())])
        return pa.table([*(table.column(c) for c in names), pa.array(np.diff(offs)), pa.array(np.diff(removed)),
                         pa.array(np.diff(spans)), kept.cast(pa.binary())],
                        names=[*names, "n_bytes", "n_removed", "n_spans", "kept"])

    return in_rounds(src, step, rounds_of(length), schema, keys_per_byte=0.05, text=text, chunk_bytes=CHUNK_BYTES)
