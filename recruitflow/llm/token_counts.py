"""Operator 9, token counts by finite-state tokenizer compilation.

The byte-level BPE tokenizer is compiled from its vocabulary file into
two deterministic machines; the tokenizer library takes no part.

* The *splitter* reads character classes (letter, number, space, other
  white space, the rest) and marks where a pre-token starts.  It is
  local: after two characters its state no longer depends on what came
  before, so all positions of a chunk are decided at once in numpy.
* The *counter* reads the bytes of a pre-token.  Its state holds the
  longest suffix read that some token begins with and, for each place in
  that suffix, the last token of the encoding that ends there and the
  number of tokens up to there.  A byte ends exactly one token that no
  merge joins with the last token before it, so the next state and the
  change in the number of tokens, which the transition emits, depend on
  state and byte alone.  Transitions are compiled from the merge table
  when they first occur; at ``MOST_STATES`` states the table is started
  anew, so memory is bounded.  The sums of whole pre-tokens that a worker
  has read are kept by their bytes, at most ``MOST_PATHS``.

A chunk of text acts on the machine as a ``StateMap``: characters before
its first forced start (their pre-token began earlier), tokens emitted
between, characters after its last forced start (their pre-token is
still open).  Maps compose associatively.  A text of more than ``CHUNK``
bytes is cut into chunks that are dealt to all tasks; each becomes a map,
and the maps of a text are composed in a tree of ``FAN`` maps a node.  A
string of Spark has less than 2^31 bytes, so two levels are enough, and
no task holds more than ``FAN`` maps of a text.  A text without white
space is one open piece: its maps hold it whole, and it meets in one task.

Defined results: a null or empty text has 0 bytes and 0 tokens; a special
string of the vocabulary inside a text is one token and parts its
neighbours, as the library does by default; repeated rows each get their
count (equal long rows are counted once and repeated); extra columns are
ignored.  A vocabulary file of another kind raises ``ValueError``.  One
pass without a shuffle, but for the chunks of long texts.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import astuple, dataclass
from functools import reduce
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _KEEP, pieces, text_bytes

#: Bytes of a text from which on it is cut; characters of a chunk.
CHUNK = 1 << 20
#: Maps that one node of the tree composes.
FAN = 64
#: Pre-tokens whose sums a worker keeps, the longest of them (bytes), and states of the counter it keeps.
MOST_PATHS = 500_000
LONGEST_PATH = 256
MOST_STATES = 200_000

LETTER, NUMBER, SPACE, WHITE, OTHER = range(5)
#: The suffixes that the splitter takes together with the apostrophe before them.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def _class_table() -> np.ndarray:
    """Class of every code point, from the Unicode properties the splitting pattern names."""
    import regex

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", WHITE)):
        for m in regex.finditer(pattern, every):
            cps = np.frombuffer(m[0].encode("utf-32-le"), np.uint32)
            table[cps] = kind
    table[0x20] = SPACE
    return table


def starts_of(cps: np.ndarray, cls: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The splitter: which characters start a pre-token.  ``first`` marks the first character of each text."""
    n = len(cps)
    blank = (cls == SPACE) | (cls == WHITE)
    before = np.empty_like(cls)
    before[1:] = cls[:-1]
    before[0] = OTHER
    blank_before = np.zeros(n, dtype=bool)
    blank_before[1:] = blank[:-1]
    blank_before[first] = False
    word_after = np.zeros(n, dtype=bool)  # a character that is no white space follows in the same text
    word_after[:-1] = ~blank[1:] & ~first[1:]
    start = np.where(blank, ~blank_before | word_after,
                     np.where(blank_before, before == WHITE, cls != before))
    start |= first
    quote = np.flatnonzero((cps == 0x27) & start)
    quote = quote[quote + 1 < n]
    quote = quote[~first[quote + 1]]
    for suffix in CONTRACTIONS:
        k = len(suffix)
        at = quote[quote + k < n]
        ok = np.ones(len(at), dtype=bool)
        for j, ch in enumerate(suffix, 1):
            ok &= (cps[at + j] == ord(ch)) & ~first[at + j]
        at = at[ok]
        for j in range(1, k + 1):
            start[at + j] = False
        after = at + k + 1
        start[after[after < n]] = True
    return start


@dataclass
class StateMap:
    """What a chunk does to the machine: open head, tokens of closed pre-tokens, open tail.

    ``synced`` is false if the chunk holds no forced start; it is then all head.
    """

    head: str
    tokens: int
    tail: str
    synced: bool


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: itself if printable, else the next beyond 255."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Transducer:
    """The compiled tokenizer of one vocabulary file.

    Tokens are numbered by birth: bytes first (0 to 255), then the merges
    in their order.  A token is merged away by a later number than its
    own, so numbers serve as times.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        if (model["type"] != "BPE" or spec["normalizer"] or model.get("dropout") or model.get("ignore_merges")
                or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix")
                or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex")):
            raise ValueError(f"not a plain byte-level BPE vocabulary: {path}")
        added = spec["added_tokens"]
        if any(x["single_word"] or x["lstrip"] or x["rstrip"] for x in added):
            raise ValueError(f"special strings that take their surroundings: {path}")
        special = sorted((x["content"].encode() for x in added), key=len, reverse=True)
        self.special = re.compile(b"|".join(map(re.escape, special)) or b"(?!)")
        self.longest_special = max(map(len, special), default=0)
        self.table = _class_table()
        self._read_merges(model["merges"])
        self.paths: dict[int | bytes, int] = {}
        self._forget()

    def _read_merges(self, merges: list) -> None:
        letters = _byte_letters()
        self.tokens = {bytes([b]): b for b in range(256)}
        self.pairs: dict[tuple[int, int], int] = {}
        self.parts: list[tuple[int, int] | None] = [None] * 256
        for merge in merges:
            a, b = (bytes(letters[c] for c in x) for x in (merge.split(" ") if isinstance(merge, str) else merge))
            if a not in self.tokens or b not in self.tokens or a + b in self.tokens:
                raise ValueError(f"merge without its parts, or made twice: {merge}")
            pair = self.tokens[a], self.tokens[b]
            self.pairs[pair] = self.tokens[a + b] = len(self.parts)
            self.parts.append(pair)
        self.edges: dict[tuple[int, int], list[float]] = {}
        whole = {t: k for t, k in self.tokens.items() if k < 256 or self._joined(*self.parts[k]) == k}
        self.tokens = whole  # without those that their own bytes do not encode to
        self.begins = {t[:k] for t in whole for k in range(len(t))}

    def _edge(self, token: int, side: int) -> list[float]:
        """The tokens that hold the outermost byte of ``token`` on a side, as merges grow them; then never."""
        got = self.edges.get((token, side))
        if got is None:
            got, at = [float("inf"), token], token
            while self.parts[at]:
                at = self.parts[at][side]
                got.append(at)
            got = self.edges[token, side] = got[::-1]
        return got

    def _joined(self, a: int, b: int) -> int | None:
        """The first merge across the seam when the bytes of ``a`` and ``b`` are encoded together, if any.

        Both edges grow in the order of time; a pair that stands at the
        seam is merged unless one of it is merged away before.  Of equal
        merges the one further left goes first.
        """
        left, right, j, k = self._edge(a, 1), self._edge(b, 0), 0, 0
        while True:
            m = self.pairs.get((left[j], right[k]))
            if m is not None and m < left[j + 1] and m <= right[k + 1]:
                return m
            if left[j + 1] <= right[k + 1]:
                j += 1
                if j + 1 == len(left):
                    return None
            else:
                k += 1

    def _forget(self) -> None:
        self.states: list[tuple] = [(b"", (-1,), (0,))]
        self.numbers: dict[tuple, int] = {self.states[0]: 0}
        self.arcs: dict[int, tuple[int, int]] = {}

    def _arc(self, state: int, byte: int) -> tuple[int, int]:
        """Compile the transition of ``state`` on ``byte``: next state, tokens emitted."""
        suffix, lasts, sums = self.states[state]
        suffix += bytes([byte])
        for k, last in enumerate(lasts):
            token = self.tokens.get(suffix[k:])
            if token is not None and (last < 0 or self._joined(last, token) is None):
                break
        more = sums[k] + 1
        lasts, sums = (*lasts, token), (*sums, more)
        keep = next(k for k in range(len(suffix) + 1) if suffix[k:] in self.begins)
        to = suffix[keep:], lasts[keep:], tuple(n - more for n in sums[keep:])
        if len(self.states) >= MOST_STATES:
            self._forget()
            self.numbers.setdefault(to, 1)
            self.states.append(to)
            return 1, more
        if to not in self.numbers:
            self.numbers[to] = len(self.states)
            self.states.append(to)
        self.arcs[state << 8 | byte] = arc = self.numbers[to], more
        return arc

    def emit(self, word: bytes) -> int:
        """Tokens that the counter emits on the bytes of one pre-token."""
        state = n = 0
        for byte in word:
            state, more = self.arcs.get(state << 8 | byte) or self._arc(state, byte)
            n += more
        return n

    def _sum(self, key: int | bytes, word: bytes) -> int:
        got = self.paths.get(key)
        if got is None:
            got = self.emit(word)
            if len(word) <= LONGEST_PATH:
                if len(self.paths) >= MOST_PATHS:
                    self.paths = {}
                self.paths[key] = got
        return got

    def emitted(self, data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Tokens that each pre-token (byte span) emits.  Up to seven bytes and their number are one exact key."""
        raw, size = data.tobytes(), hi - lo
        out = np.empty(len(lo), dtype=np.int64)
        few = np.flatnonzero(size <= 7)
        blocks = np.ndarray(len(data) + 1, "<u8", raw + bytes(8), strides=(1,))
        own = (blocks[lo[few]] & _KEEP[size[few]]) | size[few].astype(np.uint64) << np.uint64(56)
        keys, where, back = np.unique(own, return_index=True, return_inverse=True)
        a, b = lo[few[where]].tolist(), hi[few[where]].tolist()
        out[few] = np.array([self._sum(k, raw[i:j]) for k, i, j in zip(keys.tolist(), a, b, strict=True)], dtype=np.int64)[back]
        many = np.flatnonzero(size > 7)
        words = [raw[i:j] for i, j in zip(lo[many].tolist(), hi[many].tolist(), strict=True)]
        out[many] = [self._sum(w, w) for w in words]
        return out

    def count_all(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Token counts of whole texts without special strings."""
        out = np.zeros(len(offs) - 1, dtype=np.int64)
        if not len(data):
            return out
        cps = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        width = 1 + (cps >= 0x80).astype(np.int64) + (cps >= 0x800) + (cps >= 0x10000)
        at = np.cumsum(width) - width  # byte of each character
        first = np.zeros(len(cps), dtype=bool)
        first[np.searchsorted(at, offs[:-1][offs[:-1] < offs[1:]])] = True
        lo = at[starts_of(cps, self.table[cps], first)]
        hi = np.append(lo[1:], len(data))
        sums = np.append(0, np.cumsum(self.emitted(data, lo, hi)))
        edge = np.searchsorted(lo, offs)
        return sums[edge[1:]] - sums[edge[:-1]]

    def mapped(self, chunk: str) -> StateMap:
        """The map of a chunk that may hold special strings: each emits one token and closes what was open."""
        plain = [self.state_map(x.decode()) for x in self.special.split(chunk.encode())]
        return reduce(lambda a, b: self.compose(self.compose(a, StateMap("", 1, "", True)), b), plain)

    def state_map(self, chunk: str) -> StateMap:
        """The map of plain text.  Forced starts: white space right after a character that is none."""
        cls = self.table[np.frombuffer(chunk.encode("utf-32-le"), np.uint32)]
        blank = (cls == SPACE) | (cls == WHITE)
        forced = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
        if not len(forced):
            return StateMap(chunk, 0, "", False)
        a, b = int(forced[0]), int(forced[-1])
        return StateMap(chunk[:a], self.closed(chunk[a:b]), chunk[b:], True)

    def closed(self, text: str) -> int:
        raw = np.frombuffer(text.encode(), np.uint8)
        return int(self.count_all(raw, np.array([0, len(raw)]))[0])

    def compose(self, left: StateMap, right: StateMap) -> StateMap:
        """The map of two adjacent chunks (associative).

        What lies between the two chunks' forced starts is an open piece
        of its own; it may hold a forced start at the seam.
        """
        if not left.synced and not right.synced:
            return self.state_map(left.head + right.head)
        if not left.synced:
            seam = self.state_map(left.head + right.head)
            closed = self.closed(seam.tail) if seam.synced else 0
            return StateMap(seam.head, seam.tokens + closed + right.tokens, right.tail, True)
        if not right.synced:
            seam = self.state_map(left.tail + right.head)
            if not seam.synced:
                return StateMap(left.head, left.tokens, left.tail + right.head, True)
            return StateMap(left.head, left.tokens + self.closed(seam.head) + seam.tokens, seam.tail, True)
        return StateMap(left.head, left.tokens + self.closed(left.tail + right.head) + right.tokens, right.tail, True)

    def ended(self, m: StateMap) -> int:
        """Tokens of the whole text whose map is ``m``."""
        return self.closed(m.head) + m.tokens + self.closed(m.tail)

    def chunks(self, text: str, size: int) -> Iterator[str]:
        """Chunks of about ``size`` characters, never cut inside a special string."""
        cuts = np.arange(size, len(text), size)
        raw = text.encode()
        if self.special.search(raw):
            ends = [m.span() for m in self.special.finditer(raw)]
            lo, hi = np.array(ends, dtype=np.int64).T
            if len(raw) > len(text):  # bytes to characters
                begins = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
                lo, hi = begins[lo] - 1, begins[hi - 1]
            k = np.searchsorted(lo, cuts, "left") - 1
            inside = (k >= 0) & (cuts < hi[k])
            cuts = np.unique(np.where(inside, hi[k], cuts))
        at = [0, *cuts.tolist(), len(text)]
        yield from (text[i:j] for i, j in zip(at, at[1:], strict=False) if i < j)

    def count(self, texts: pa.Array) -> np.ndarray:
        """Token counts of whole texts."""
        data, offs = text_bytes(texts)
        raw = data.tobytes()
        if not self.special.search(raw):
            return self.count_all(data, offs)
        plain = [self.special.split(raw[i:j]) for i, j in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
        n = np.array([len(x) for x in plain])
        flat = [x for xs in plain for x in xs]
        got = self.count_all(np.frombuffer(b"".join(flat), np.uint8), np.append(0, np.cumsum([len(x) for x in flat])))
        return np.add.reduceat(got, np.cumsum(n) - n) + n - 1


_READY: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """The worker's compiled machine for a vocabulary file."""
    if path not in _READY:
        _READY[path] = Transducer(path)
    return _READY[path]


_MAP = "head string, tokens long, tail string, synced boolean"


def state_maps(src: DataFrame, path: str, chunk: int = CHUNK) -> DataFrame:
    """One row per chunk of each text of (``__key``, ``__text``): its place and its map.

    Texts are cut where they are read; their chunks are dealt to tasks by
    the digest of the text and their place.  Equal rows share their maps,
    ``__copies`` says how many they are.
    """
    kind = src.schema["__key"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "__text"):
            for key, text in zip(part.column("__key"), part.column("__text").to_pylist(), strict=True):
                raw = text.encode()
                name, size = sha256(raw).digest(), len(raw)
                for k, x in enumerate(transducer(path).chunks(text, chunk)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key.as_py()], key.type), pa.array([name]), pa.array([size]), pa.array([k]), pa.array([x])],
                        ["__key", "__name", "n_bytes", "place", "chunk"])

    def to_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = [astuple(transducer(path).mapped(x)) for x in batch.column("chunk").to_pylist()]
            cols = [pa.array(x) for x in zip(*maps, strict=True)] if maps else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("__key", "__name", "n_bytes", "place")),
                 *(pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.string(), pa.bool_()), strict=True))],
                ["__key", "__name", "n_bytes", "place", "head", "tokens", "tail", "synced"])

    ids = f"__key {kind}, __name binary, n_bytes long, place long"
    dealt = src.mapInArrow(cut, f"{ids}, chunk string").repartition("__name", "place")
    maps = dealt.mapInArrow(to_maps, f"{ids}, {_MAP}")
    return maps.groupBy("__key", "__name", "n_bytes", "place").agg(
        F.first(F.struct("head", "tokens", "tail", "synced")).alias("map"), F.count("*").alias("__copies")).select(
        "__key", "__name", "n_bytes", "__copies", "place", "map.*")


def composed(maps: DataFrame, path: str) -> DataFrame:
    """Token counts of the texts whose maps are given, composed in a tree of two levels."""

    def node(group: pd.DataFrame) -> pd.DataFrame:
        rows = group.sort_values("place")
        own = [StateMap(*x) for x in rows[["head", "tokens", "tail", "synced"]].itertuples(index=False)]
        out = rows.iloc[:1].copy()
        out["place"] //= FAN
        out[["head", "tokens", "tail", "synced"]] = [astuple(reduce(transducer(path).compose, own))]
        return out

    def end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = zip(*(batch.column(c).to_pylist() for c in ("head", "tokens", "tail", "synced")), strict=True)
            n = pa.array([transducer(path).ended(StateMap(*x)) for x in maps], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("__key"), batch.column("n_bytes"), n, batch.column("__copies")],
                                             ["__key", "n_bytes", "n_tokens", "__copies"])

    for _ in range(2):
        maps = maps.groupBy("__key", "__name", F.floor(F.col("place") / FAN)).applyInPandas(node, maps.schema)
    kind = maps.schema["__key"].dataType.simpleString()
    got = maps.mapInArrow(end, f"__key {kind}, n_bytes long, n_tokens long, __copies long")
    return got.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(
        "__key", "n_bytes", "n_tokens")


def count_tokens(docs: DataFrame, path: str, limit: int = 512, key: str = "doc_id", text: str = "text",
                 chunk: int = CHUNK) -> DataFrame:
    """``key``, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every text."""
    src = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    kind = src.schema["__key"].dataType.simpleString()
    long = F.coalesce(F.octet_length("__text"), F.lit(0)) > chunk

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "__text"):
            offs = text_bytes(part.column("__text"))[1]
            n = transducer(path).count(part.column("__text"))
            yield pa.RecordBatch.from_arrays([part.column("__key"), pa.array(np.diff(offs)), pa.array(n)],
                                             ["__key", "n_bytes", "n_tokens"])

    short = src.where(~long).mapInArrow(run, f"__key {kind}, n_bytes long, n_tokens long")
    return short.unionByName(composed(state_maps(src.where(long), path, chunk), path)).select(
        F.col("__key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
