"""Operator 7, packing: mixture-controlled, deficit round-robin over source queues.

1. Every text is tokenized (by distinct words, which the tokenizer's
   rules make independent of each other) and closed by an end id; the
   ids are written once with each document's place in its task's source
   queues.  A source's queue is its tasks' queues one after another.
2. All windows are numbered before any is filled.  Token j of source s
   is due at cell floor((j * T + o_s) / T_s) of T cells (o_s: a phase
   below T, so that small sources are not due together); a group of
   ``GROUP`` consecutive windows takes the next ``GROUP * WINDOW`` tokens
   by (cell, source).  A group's bound, a cell and a source, is found by
   bisection from its number alone, in the task that needs it.  So the
   deficits at the start of any group are known: they carry over from
   group to group without one waiting for another, and no list of groups
   exists anywhere.
3. Documents are cut where their range crosses groups, and shuffled by
   group.  All groups hold the same number of tokens, whatever the skew
   of sources or lengths.
4. Inside a group each window is filled by deficit round-robin: every
   source earns its share of the window, pays with tokens, and keeps the
   rest; what rounding leaves goes to the largest deficits, one turn
   each.  Only the last window of all may be short.

Target proportions are the sources' shares of all tokens, so that all
queues end together and every id is packed once.

Defined results: a null or empty text is the end id alone; a null source
is a queue of its own; repeated rows are packed once each; a null key is
carried; an empty table gives no pieces; extra columns are ignored.  One
row per source passes through the driver; a group holds
``GROUP * WINDOW`` tokens, however many sources there are.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _LOWER, pieces, span_hashes, text_bytes, word_spans, written

WINDOW = 4096
GROUP = 64
END_ID = 2
#: Words whose ids a worker keeps.
MOST_WORDS = 1_000_000


_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
#: ASCII marks without the apostrophe, which may start a suffix.
_MARK = np.zeros(256, bool)
_MARK[0x21:0x30] = _MARK[0x3A:0x41] = _MARK[0x5B:0x61] = _MARK[0x7B:0x7F] = True
_MARK[0x27] = False


def atoms(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts and ends of the pieces that are tokenized alone, and offsets of each text's pieces.

    Words, cut between an ASCII letter and an ASCII mark other than the
    apostrophe (the rules part the two anyway) and in lower case (as the
    rules make them), so that few distinct pieces remain.  Where a
    special string may be present words stay as they are.
    """
    lo, hi, at = word_spans(data, offs)
    if b"<|" in data.tobytes() or not len(data):
        return data, lo, hi, at
    letter, mark = _LETTER[data], _MARK[data]
    cut = np.flatnonzero((letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])) + 1
    cut = cut[~np.isin(cut, lo, assume_unique=True)] if len(cut) else cut  # texts may touch
    lo = np.concatenate([lo, cut])
    hi = np.concatenate([hi, cut])
    lo.sort()
    hi.sort()
    return _LOWER[data], lo, hi, np.searchsorted(lo, offs)


class WordTokenizer:
    """Ids of whole texts from the ids of their distinct words (white space parts words for good)."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.kind = np.uint16 if self.library.get_vocab_size() <= 1 << 16 else np.uint32
        self.known: dict[int, bytes] = {}

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids (each text's followed by ``end_id``) and the offsets of the texts."""
        data, offs = text_bytes(texts)
        data, lo, hi, at = atoms(data, offs)
        keys, where, back = np.unique(span_hashes(data, lo, hi), return_index=True, return_inverse=True)
        got = [self.known.get(k) for k in keys.tolist()]
        new = [i for i, g in enumerate(got) if g is None]
        if new:
            if len(self.known) + len(new) > MOST_WORDS:
                self.known = {}
            words = [data[lo[w]:hi[w]].tobytes().decode() for w in where[new]]
            for i, e in zip(new, self.library.encode_batch_fast(words, add_special_tokens=False), strict=True):
                got[i] = self.known[int(keys[i])] = np.array(e.ids, self.kind).tobytes()
        size = np.dtype(self.kind).itemsize
        flat = np.frombuffer(b"".join(got), self.kind)
        lens = np.fromiter(map(len, got), np.int64, len(got)) // size
        first = np.cumsum(lens) - lens
        n = lens[back]
        sums = np.append(0, np.cumsum(n))
        ends = sums[at[1:]] + np.arange(1, len(offs))  # one end id per text
        out = np.empty(int(sums[-1]) + len(offs) - 1, self.kind)
        out[ends - 1] = end_id
        text_of = np.repeat(np.arange(len(offs) - 1), np.diff(at))
        pos = np.repeat(sums[:-1] + text_of - np.cumsum(n) + n, n) + np.arange(int(sums[-1])) if len(n) else np.zeros(0, np.int64)
        out[pos] = flat[np.repeat(first[back] - sums[:-1], n) + np.arange(int(sums[-1]))]
        return out, np.append(0, ends)


_READY: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _READY:
        _READY[path] = WordTokenizer(path)
    return _READY[path]


def tokenized(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", source: str = "source",
              end_id: int = END_ID) -> DataFrame:
    """Ids of every document, with its place in its task's queue of its source."""
    src = docs.select(F.col(key).alias("key"), F.col(source).cast("string").alias("source"), F.col(text).alias("text"))
    kind = src.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, task, queue = tokenizer(path), TaskContext.get().partitionId(), {}
        for part in pieces(batches, "text"):
            ids, offs = own.encode(part.column("text"), end_id)
            n = np.diff(offs)
            at = np.empty(len(n), np.int64)
            for i, s in enumerate(part.column("source").to_pylist()):
                at[i] = queue.get(s, 0)
                queue[s] = at[i] + n[i]
            size = ids.itemsize
            col = pa.Array.from_buffers(pa.large_binary(), len(n), [
                None, pa.py_buffer((offs * size).astype(np.int64).tobytes()), pa.py_buffer(ids.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), part.column("source"), pa.array(np.full(len(n), task, np.int64)), pa.array(at),
                 pa.array(n), pa.array(np.full(len(n), size, np.int32)), col.cast(pa.binary())],
                ["key", "source", "task", "at", "n", "width", "ids"])

    return src.mapInArrow(run, f"key {kind}, source string, task long, at long, n long, width int, ids binary")


class Plan:
    """Where every group of windows begins in every source queue; each bound is found from its number alone."""

    #: Bounds a task keeps.
    MOST_BOUNDS = 4_096

    def __init__(self, totals: list[int], window: int = WINDOW, group: int = GROUP) -> None:
        self.totals = totals
        self.total = sum(totals)
        self.window = window
        self.group = group
        self.tokens = group * window
        #: Phases: multiples of the golden ratio
        self.phase = [((i * 0x9E3779B97F4A7C15 & (1 << 64) - 1) * self.total) >> 64 for i in range(len(totals))]
        # products of a total and a number of cells up to that of the sources have to fit
        self.kind = np.int64 if max(totals, default=0) * (len(totals) + 2) < 1 << 62 else object
        self.known: dict[int, tuple[int, int]] = {}

    def _before(self, cell: int) -> tuple[int, np.ndarray]:
        """Whole tokens due before ``cell``, over all sources, and what each source has beyond them (times T)."""
        parts = [divmod(n * cell - o, self.total) for n, o in zip(self.totals, self.phase, strict=True)]
        return sum(q for q, _ in parts), np.array([r for _, r in parts], self.kind)

    def bound(self, k: int) -> tuple[int, int]:
        """The (cell, source) at which group ``k`` begins."""
        if k not in self.known:
            if len(self.known) >= self.MOST_BOUNDS:
                self.known.clear()
            self.known[k] = self._bound(k * self.tokens)
        return self.known[k]

    def _bound(self, done: int) -> tuple[int, int]:
        if not 0 < done < self.total:
            return min(max(done, 0), self.total), 0
        n = np.array(self.totals, self.kind)
        whole, rest = self._before(done)
        # the tokens due before a cell differ from its number by less than the number of sources
        lo, hi = max(-len(n), -done), min(len(n), self.total - done)
        while hi - lo > 1:
            mid = (lo + hi) // 2
            if whole + int((-(-(rest + n * mid) // self.total)).sum()) <= done:
                lo = mid
            else:
                hi = mid
        due = -(-(rest + n * lo) // self.total)
        more = done - whole - int(due.sum())  # of the cell's own tokens, at most one a source
        own = np.flatnonzero(-(-(rest + n * (lo + 1)) // self.total) > due)
        return done + lo, int(own[more - 1]) + 1 if more else 0

    def due(self, s: int, cell: int) -> int:
        """Tokens of source ``s`` due before ``cell``."""
        return -((self.phase[s] - self.totals[s] * cell) // self.total)

    def served(self, s: int, k: int) -> int:
        """Tokens of source ``s`` in the groups before ``k``."""
        cell, end = self.bound(k)
        return self.due(s, cell + (s < end))

    def group_of(self, s: int, at: int) -> int:
        """The group that takes the token at ``at`` of source ``s``'s queue."""
        cell = (at * self.total + self.phase[s]) // self.totals[s]
        k = cell // self.tokens  # its group, or one beside it (or further, if groups are smaller than the sources)
        while (cell, s) < self.bound(k):
            k -= 1
        while self.bound(k + 1) <= (cell, s):
            k += 1
        return k

    def fill(self, k: int, left: list[int]) -> Iterator[list[tuple[int, int]]]:
        """For each window of group ``k``: the sources and how many tokens each gives."""
        done = min(k * self.tokens, self.total)
        debt = [done * t / self.total - self.served(s, k) if t else 0.0 for s, t in enumerate(self.totals)]
        left = list(left)
        rest = sum(left)
        here = [s for s, n in enumerate(left) if n]  # the others give nothing
        while rest:
            size = min(self.window, rest)
            give = [0] * len(left)
            for s in here:
                debt[s] += size * self.totals[s] / self.total
                give[s] = min(left[s], max(0, int(debt[s])))
            short = size - sum(give)
            while short < 0:  # deficits above one window: the smallest remainders wait
                s = max((s for s in here if give[s]), key=lambda s: give[s] - debt[s])
                give[s] -= 1
                short += 1
            turn = sorted(here, key=lambda s: give[s] - debt[s])
            while short:
                for s in turn:
                    more = min(left[s] - give[s], max(1, short // len(turn)), short)
                    give[s] += more
                    short -= more
            for s in here:
                debt[s] -= give[s]
                left[s] -= give[s]
            rest -= size
            yield [(s, give[s]) for s in here if give[s]]
            here = [s for s in here if left[s]]


def pack(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", source: str = "source",
         end_id: int = END_ID, window: int = WINDOW, group: int = GROUP, with_ids: bool = True) -> DataFrame:
    """Pieces of all documents: key, start, length, ids_crc32, doc_tokens, sequence_id, offset (and the ids)."""
    spark = docs.sparkSession
    ready = written(tokenized(docs, path, key, text, source, end_id), "pack-ids")
    queues = ready.groupBy("source", "task").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("source").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = written(queues.withColumn("base", F.coalesce(F.sum("n").over(order), F.lit(0))), "pack-queues")
    rows = sorted(((r[0], r[1]) for r in base.groupBy("source").agg(F.sum("n")).collect()),
                  key=lambda r: (r[0] is None, r[0] or ""))
    plan = Plan([n for _, n in rows], window, group)
    number = {s: i for i, (s, _) in enumerate(rows)}
    kind = ready.schema["key"].dataType.simpleString()

    placed = ready.join(base.select(F.col("source").alias("s"), F.col("task").alias("t"), "base"),
                        F.col("source").eqNullSafe(F.col("s")) & (F.col("task") == F.col("t")))
    placed = placed.select("key", "source", (F.col("base") + F.col("at")).alias("at"), "n", "width", "ids")
    cut_schema = f"key {kind}, grp long, src int, at long, start long, n long, width int, ids binary"
    cut_names = [x.split()[0] for x in cut_schema.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            which: list[int] = []
            ids = batch.column("ids")
            for i, (s, at, n, w) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("source", "at", "n", "width")),
                                                  strict=True)):
                src, a = number[s], 0
                raw = ids[i].as_buffer()
                while a < n:
                    k = plan.group_of(src, at + a)
                    b = min(n, plan.served(src, k + 1) - at)
                    out.append((k, src, at + a, a, n, w, raw.slice(a * w, (b - a) * w).to_pybytes()))
                    which.append(i)
                    a = b
            if out:
                cols = list(zip(*out, strict=True))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(pa.array(which)), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))],
                    cut_names)

    out_schema = (f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                  "sequence_id long, offset long" + (", ids array<int>" if with_ids else ""))
    out_names = [x.split()[0].strip("`") for x in out_schema.split(", ")]
    key_type: list = []

    def windows(k: int, rows: list[tuple]) -> list[tuple]:
        """Pieces of one group; ``rows``: (key, src, at, start, n, ids) ordered by source and place."""
        queue: dict[int, list] = {}
        for r in rows:
            queue.setdefault(r[1], []).append(r)
        left = [sum(len(r[5]) for r in queue.get(s, ())) for s in range(len(plan.totals))]
        head = dict.fromkeys(queue, (0, 0))  # row, ids taken of it
        out = []
        for w, gives in enumerate(plan.fill(k, left)):
            place = 0
            for s, want in gives:
                i, used = head[s]
                while want:
                    row = queue[s][i]
                    take = min(want, len(row[5]) - used)
                    part = row[5][used:used + take].astype("<u4")
                    out.append((row[0], row[3] + used, take, zlib.crc32(part.tobytes()), row[4],
                                k * plan.group + w, place, *([part.astype(np.int32)] if with_ids else [])))
                    place += take
                    want -= take
                    used += take
                    if used == len(row[5]):
                        i, used = i + 1, 0
                head[s] = (i, used)
        return out

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []

        def flush() -> pa.RecordBatch:
            cols = list(zip(*windows(now, rows), strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], key_type[0]), *(pa.array(c, pa.int64()) for c in cols[1:7]),
                 *([pa.array(cols[7], pa.list_(pa.int32()))] if with_ids else [])], out_names)

        for batch in batches:
            key_type[:] = [batch.column("key").type]
            kept = (batch.column(c).to_pylist() for c in ("grp", "key", "src", "at", "start", "n", "width", "ids"))
            for g, k, s, at, start, n, w, ids in zip(*kept, strict=True):
                if g != now:
                    if rows:
                        yield flush()
                    now, rows = g, []
                rows.append((k, s, at, start, n, np.frombuffer(ids, np.dtype(f"<u{w}"))))
        if rows:
            yield flush()

    dealt = placed.mapInArrow(cut, cut_schema).repartition("grp").sortWithinPartitions("grp", "src", "at")
    return dealt.mapInArrow(fill, out_schema)
