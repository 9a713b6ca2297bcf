"""Which keys of a corpus occur twice or more: rounds of questions over hashed chunks of documents.

A *step* is a generator over one chunk of texts: it yields keys, gets
back for each key whether it is repeated in the whole corpus, and may
ask again; what it returns in the end is the chunk's result.

One round: every chunk makes its keys unique (a key that a chunk holds a
thousand times is sent once, marked), and sends them by key range to
slots; a slot sorts the keys of all chunks and answers with two bits a
key.  So a key held by a third of all texts costs its slot one entry a
chunk, and no task ever holds a group of texts.  Rows are dealt
to chunks by their number in a written copy.  Chunks are rebuilt from the
same shuffle in each round; nothing is collected.  Sizes of chunks
and slots are fixed, their numbers follow the input.
"""

from __future__ import annotations

from collections.abc import Callable, Generator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: A chunk's texts and a slot's keys, in bytes.
CHUNK_BYTES = 4 << 20
SLOT_BYTES = 8 << 20

REPEATED, ASKED = 1, 2

#: Keys of a round: first halves, second halves (or None), asking marks (or None).
Keys = tuple[np.ndarray, np.ndarray | None, np.ndarray | None]
Step = Callable[[pa.Table], Generator[Keys, np.ndarray, pa.Table]]

_FLAGS = "chunk long, round int, slot int, flags binary"
#: A question (keys and marks of one chunk for one slot), or an answer on its way back to its chunk (slot: none).
_KEYS = ("to long, chunk long, slot int, keys binary, more binary, twice binary, asked binary, "
         "round int, flags binary")
_KEY_TYPES = (pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 4, pa.int32(), pa.binary())
_FLAG_TYPES = (pa.int64(), pa.int32(), pa.int32(), pa.binary())


def _table(rows: list[tuple], schema: str, kinds: tuple) -> pa.Table:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
    return pa.table([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                    names=[x.split()[0] for x in schema.split(", ")])


def _packed(flags: np.ndarray) -> bytes:
    return np.packbits(np.stack([flags & REPEATED, flags >> 1])).tobytes()


def _unpacked(data: bytes, n: int) -> np.ndarray:
    one, two = np.unpackbits(np.frombuffer(data, np.uint8), count=2 * n).reshape(2, n)
    return one | two << 1


def _unique(keys: Keys) -> tuple[np.ndarray, np.ndarray | None, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, which of them occur twice, which are asked, and each key's place among them."""
    h1, h2, ask = keys
    if not len(h1):
        none = np.zeros(0, bool)
        return h1, h2, none, none, np.zeros(0, np.int64)
    order = np.argsort(h1, kind="stable") if h2 is None else np.lexsort((h2, h1))
    a = h1[order]
    new = np.ones(len(a), bool)
    new[1:] = a[1:] != a[:-1]
    if h2 is not None:
        b = h2[order]
        new[1:] |= b[1:] != b[:-1]
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(a)))
    place = np.empty(len(a), np.int64)
    place[order] = np.cumsum(new) - 1
    asked = np.ones(len(first), bool) if ask is None else np.logical_or.reduceat(ask[order], first)
    return a[first], None if h2 is None else b[first], size > 1, asked, place


def _cuts(h1: np.ndarray, slots: int) -> np.ndarray:
    """Where each slot's keys begin among ordered keys (slots are equal ranges of the key space)."""
    edges = [(k << 64) // slots for k in range(1, slots)]
    return np.concatenate([[0], np.searchsorted(h1, np.array(edges, dtype=np.uint64)), [len(h1)]]).astype(np.int64)


def _bits(x: np.ndarray) -> bytes:
    return np.packbits(x).tobytes()


def _replay(step: Step, texts: pa.Table, flags: pa.Table | None, rounds: int, slots: int):
    """Run the step through the rounds answered so far: its next keys, or its result."""
    answers: dict[int, dict[int, bytes]] = {}
    if flags is not None:
        for r, s, f in zip(*(flags.column(c).to_pylist() for c in ("round", "slot", "flags")), strict=True):
            answers.setdefault(r, {})[s] = f
    run = step(texts)
    try:
        keys = next(run)
        for r in range(rounds):
            h1, _, _, _, place = _unique(keys)
            got = np.zeros(len(h1), np.uint8)
            if r in answers:
                cuts = _cuts(h1, slots)
                for s, f in answers[r].items():
                    got[cuts[s]:cuts[s + 1]] = _unpacked(f, cuts[s + 1] - cuts[s])
            keys = run.send(got[place])
    except StopIteration as end:
        return None, end.value
    return keys, None


def _ask(step: Step, rounds: int, slots: int):
    """Questions of one chunk; the answers it has so far travel on with them."""

    def rows(key: tuple, texts: pa.Table, flags: pa.Table | None = None) -> pa.Table:
        chunk = key[0].as_py()
        keys, _ = _replay(step, texts, flags, rounds, slots)
        out: list[tuple] = []
        if flags is not None:
            out = [(-1 - chunk, chunk, s, None, None, None, None, r, f) for r, s, f in zip(
                *(flags.column(c).to_pylist() for c in ("round", "slot", "flags")), strict=True)]
        if keys is not None and len(keys[0]):
            h1, h2, twice, asked, _ = _unique(keys)
            cuts = _cuts(h1, slots)
            for s in np.flatnonzero(np.diff(cuts)):
                a, b = cuts[s], cuts[s + 1]
                out.append((int(s), chunk, int(s), h1[a:b].tobytes(),
                            None if h2 is None else h2[a:b].astype(np.uint32).tobytes(),
                            _bits(twice[a:b]), _bits(asked[a:b]), None, None))
        return _table(out, _KEYS, _KEY_TYPES)

    return rows


def _answer(number: int):
    """Answers of one slot: bit 1 if a key is repeated, bit 2 if a chunk asks for it."""

    def run(table: pa.Table) -> pa.Table:
        if table["to"][0].as_py() < 0:  # earlier answers
            return table.select([x.split()[0] for x in _FLAGS.split(", ")])
        held = table.to_pydict()
        h1 = np.frombuffer(b"".join(held["keys"]), np.uint64)
        lens = np.array([len(k) // 8 for k in held["keys"]])
        h2 = None if held["more"][0] is None else np.frombuffer(b"".join(held["more"]), np.uint32)

        def plane(name: str) -> np.ndarray:
            return np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n)
                                   for x, n in zip(held[name], lens, strict=True)])

        order = np.argsort(h1, kind="stable") if h2 is None else np.lexsort((h2, h1))
        a = h1[order]
        new = np.ones(len(a), bool)
        new[1:] = a[1:] != a[:-1]
        if h2 is not None:
            b = h2[order]
            new[1:] |= b[1:] != b[:-1]
        first = np.flatnonzero(new)
        count = np.add.reduceat(plane("twice")[order].astype(np.int64) + 1, first)
        asked = np.maximum.reduceat(plane("asked")[order], first)
        value = (np.where(count > 1, REPEATED, 0) | np.where(asked > 0, ASKED, 0)).astype(np.uint8)
        flags = np.empty(len(a), np.uint8)
        flags[order] = value[np.cumsum(new) - 1]
        out, at = [], 0
        for chunk, slot, n in zip(held["chunk"], held["slot"], lens, strict=True):
            part = flags[at:at + n]
            at += n
            if (part & REPEATED).any():
                out.append((chunk, number, slot, _packed(part)))
        return _table(out, _FLAGS, _FLAG_TYPES)

    return run


def _alone(rows):
    return lambda key, texts: rows(key, texts)


def _answered(rows):
    return lambda key, texts, flags: rows(key, texts, flags)


def in_rounds(docs: DataFrame, step: Step, rounds: int, schema, keys_per_byte: float, text: str = "text",
              chunk_bytes: int = CHUNK_BYTES, slot_bytes: int = SLOT_BYTES) -> DataFrame:
    """Run ``step`` on chunks of ``docs`` through ``rounds`` rounds; rows of its results, with ``schema``."""
    total = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    chunks = max(1, -(-total // chunk_bytes))
    slots = max(1, int(total * keys_per_byte * 8) // slot_bytes, min(chunks, 32))
    # rows are numbered in a written copy, so that equal rows are spread and every round sees the same chunks
    rows = written(docs.withColumn("__row", F.monotonically_increasing_id()), "repeats-rows")
    held = rows.withColumn("__chunk", F.pmod(F.xxhash64("__row"), F.lit(chunks))).drop("__row")
    flags = None
    for number in range(rounds):
        texts = held.groupBy("__chunk")
        rows = _ask(step, number, slots)
        # a chain: each round takes the last one's answers and passes them on with its own
        if flags is None:
            keys = texts.applyInArrow(_alone(rows), _KEYS)
        else:
            keys = texts.cogroup(flags.groupBy("chunk")).applyInArrow(_answered(rows), _KEYS)
        flags = keys.groupBy("to").applyInArrow(_answer(number), _FLAGS)
    return held.groupBy("__chunk").cogroup(flags.groupBy("chunk")).applyInArrow(
        lambda table, f: _replay(step, table, f, rounds, slots)[1], schema)
