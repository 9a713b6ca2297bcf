"""Operator 11, benchmark decontamination: suffix arrays of the training shards, searched by every test suffix.

The benchmark is the stated query set: its items become rows of word
hashes (a long item several, overlapping by a window less one word),
dealt to blocks of about ``BLOCK_WORDS`` words.  One block at a time is
broadcast; one pass over the documents serves it.

A pass cuts the documents into shards (slices of Arrow batches).  Words
become their numbers in the block's vocabulary.  A suffix that can match
begins with as many words of the vocabulary as the block's shortest
window has; the others are left out.  The suffix array of the rest is
made by prefix doubling (only tied suffixes are sorted again, until none
is tied or the longest run of vocabulary words is ranked in full).

Every test suffix is then searched by bisection, all suffixes of the
block at once, with the usual shortcut that a comparison begins at the
words both ends of the interval are known to share.  For windows the
search gives the interval of all their occurrences; for whole suffixes
the longest verbatim match in the shard and where it is.

Contract of windows: ``length`` consecutive words of an item; an item of
fewer words, but not none, is one window.  A document word inside any
occurrence of a window is hit; a document with a hit word is
contaminated and ``clean`` removes it.

Defined results: a null or empty text has no words and is never hit; an
item without words has no windows; items that repeat an id are one item;
an item whose id is null hits words and counts as no item; windows and
matches never cross texts; repeated rows each get their own result; extra
columns are carried, names that the result adds are replaced; an empty
table of documents gives no rows, an empty benchmark no hits.  A text is
searched whole in one task, in memory of about 30 times its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import covered, letter_words, own_windows, pieces, text_bytes, window_hashes, written

LENGTH = 10
#: Words of the benchmark in one broadcast block, and of one row of it.
BLOCK_WORDS, SEGMENT = 1 << 19, 4096
#: Bytes of text in one shard.
SHARD_BYTES = 16 << 20
ADDED = ("n_words", "n_hit", "n_items", "items", "hits", "contaminated")


@dataclass(frozen=True)
class Block:
    """Part of the benchmark: words as numbers in its vocabulary (from 1), rows, windows and suffixes."""

    vocabulary: np.ndarray
    numbers: np.ndarray
    row_of: np.ndarray
    #: Distinct windows: start, length, and their items (``items[item_at[g]:item_at[g + 1]]``).
    start: np.ndarray
    size: np.ndarray
    item_at: np.ndarray
    items: np.ndarray
    names: list[str | None]
    #: Item of each row (place in ``names``).
    item_of: np.ndarray
    #: Word offset of each row in its item; words left to the row's end from each word on.
    first: np.ndarray
    left: np.ndarray

    @property
    def shortest(self) -> int:
        return int(self.size.min()) if len(self.size) else 1


def segments(benchmark: DataFrame, item: str = "item_id", text: str = "text", length: int = LENGTH,
             segment: int = SEGMENT) -> DataFrame:
    """Rows (item, first, words, n) of word hashes; a long item is cut into rows that overlap by length - 1 words."""
    src = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text"):
            words, at = letter_words(*text_bytes(part.column("text")))
            names, rows = part.column("item").to_pylist(), []
            for k, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
                for s in range(a, max(b - length + 1, min(a + 1, b)), segment):
                    e = min(s + segment + length - 1, b)
                    rows.append((names[k], int(s - a), words[s:e].tobytes(), int(e - s)))
            if rows:
                cols = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.binary(), pa.int64()), strict=True)],
                    ["item", "first", "words", "n"])

    return src.mapInArrow(run, "item string, first long, words binary, n long")


def block_of(rows: list, length: int = LENGTH) -> Block:
    """One block from (item, first, words, n) rows; ``rows`` are bounded by the caller."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1], bytes(r[2])))
    words = np.frombuffer(b"".join(bytes(r[2]) for r in rows), np.uint64)
    n = np.array([r[3] for r in rows], np.int64)
    at = np.append(0, np.cumsum(n))
    row_of = np.repeat(np.arange(len(rows)), n)
    vocabulary, numbers = np.unique(words, return_inverse=True)
    names = sorted({r[0] for r in rows if r[0] is not None}) + [None]
    place = {x: k for k, x in enumerate(names)}
    item_of = np.array([place[r[0]] for r in rows], np.int64)
    keys, starts, sizes = [], [], []
    for size in range(1, length + 1):  # whole short rows, and all windows of the others
        hashed = window_hashes(words, size, salt=11)
        mine = own_windows(at, size, len(hashed)) & (True if size == length else n[row_of[:len(hashed)]] == size)
        pick = np.flatnonzero(mine)
        keys.append(hashed[pick])
        starts.append(pick)
        sizes.append(np.full(len(pick), size, np.int64))
    keys, starts, sizes = np.concatenate(keys), np.concatenate(starts), np.concatenate(sizes)
    _, once, group = np.unique(keys, return_index=True, return_inverse=True)
    pair = np.unique(group * len(names) + item_of[row_of[starts]]) if len(starts) else np.zeros(0, np.int64)
    return Block(vocabulary, numbers.astype(np.int64) + 1, row_of, starts[once], sizes[once],
                 np.searchsorted(pair, np.arange(len(once) + 1) * len(names)), pair % len(names), names, item_of,
                 np.array([r[1] for r in rows], np.int64), at[1:][row_of] - np.arange(len(words)))


def numbered(words: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Numbers (from 1) of the words in the vocabulary, 0 for others."""
    out = np.zeros(len(words), np.int64)
    bits = max(16, int(len(vocabulary)).bit_length() + 4)
    mask = np.uint64((1 << bits) - 1)
    table = np.zeros(1 << bits, bool)
    table[(vocabulary & mask).astype(np.int64)] = True
    pick = np.flatnonzero(table[(words & mask).astype(np.int64)])
    if len(pick):
        k = np.minimum(np.searchsorted(vocabulary, words[pick]), len(vocabulary) - 1)
        same = vocabulary[k] == words[pick]
        out[pick[same]] = k[same] + 1
    return out


def runs_of(numbers: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Words of the vocabulary from each word on, up to the next other word or the text's end."""
    n = len(numbers)
    stop = np.zeros(n + 1, bool)
    stop[:n] = numbers == 0
    stop[at] = True
    stops = np.flatnonzero(stop)
    return np.where(numbers > 0, stops[np.searchsorted(stops, np.arange(n), "right")] - np.arange(n), 0)


def suffix_array(numbers: np.ndarray, run: np.ndarray, least: int) -> np.ndarray:
    """Starts of all suffixes of at least ``least`` words in the order of their words (equal ones by position).

    ``run``: words of each suffix.  Prefix doubling: a suffix's rank is the
    first place of those that share its prefix so far, so a round sorts
    only tied suffixes, by the rank of what follows.
    """
    place = np.flatnonzero(run > 0)
    rank = np.zeros(len(numbers) + 1, np.int64)
    ids = numbers[place]
    order = np.argsort(ids, kind="stable")
    first = np.flatnonzero(np.append(True, ids[order][1:] != ids[order][:-1])) if len(ids) else ids
    size = np.diff(np.append(first, len(ids)))
    rank[place[order]] = np.repeat(first, size) + 1
    tied = place[order][np.repeat(size > 1, size)]
    k, longest = 1, int(run.max(initial=0))
    while len(tied) and k < longest:
        more = run[tied] > k
        after = np.where(more, rank[np.where(more, tied + k, 0)], 0)
        held = rank[tied]
        order = np.lexsort((after, held))
        tied, held, after = tied[order], held[order], after[order]
        new_group = np.append(True, held[1:] != held[:-1])
        new = new_group | np.append(True, after[1:] != after[:-1])
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(tied)))
        group = np.flatnonzero(new_group)
        offset = begin - group[np.cumsum(new_group)[begin] - 1]
        rank[tied] = held + np.repeat(offset, size)
        tied = tied[np.repeat(size > 1, size)]
        k *= 2
    keep = place[run[place] >= least]
    return keep[np.lexsort((keep, rank[keep]))]


def bisect(train: np.ndarray, run: np.ndarray, array: np.ndarray, test: np.ndarray, start: np.ndarray, limit: np.ndarray,
           after: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where test strings stand in a suffix array, and the words they share with the suffixes before and at that place.

    String i is ``test[start[i]:start[i] + limit[i]]``.  ``after``: behind
    all suffixes that begin with it, else before them.
    """
    lo, hi = np.zeros(len(start), np.int64), np.full(len(start), len(array), np.int64)
    with_lo, with_hi = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
    todo = np.flatnonzero(lo < hi)
    while len(todo):
        mid = (lo[todo] + hi[todo]) // 2
        p, s, most = array[mid], start[todo], np.minimum(limit[todo], run[array[mid]])
        same = np.minimum(with_lo[todo], with_hi[todo])
        go = np.arange(len(todo))
        while len(go := go[same[go] < most[go]]):
            go = go[train[p[go] + same[go]] == test[s[go] + same[go]]]
            same[go] += 1
        whole, over = same == limit[todo], same == run[p]  # the string, or the suffix, is at its end
        inner = ~whole & ~over
        less = np.where(whole, after, over)
        less[inner] = train[(p + same)[inner]] < test[(s + same)[inner]]
        lo[todo] = np.where(less, mid + 1, lo[todo])
        with_lo[todo] = np.where(less, same, with_lo[todo])
        hi[todo] = np.where(less, hi[todo], mid)
        with_hi[todo] = np.where(less, with_hi[todo], same)
        todo = todo[lo[todo] < hi[todo]]
    return lo, with_lo, with_hi


class Shard:
    """The suffix array of some texts, for one block."""

    def __init__(self, texts: pa.Array, block: Block) -> None:
        words, self.at = letter_words(*text_bytes(texts))
        self.numbers = numbered(words, block.vocabulary)
        self.run = runs_of(self.numbers, self.at)
        self.array = suffix_array(self.numbers, np.where(self._reach(block.shortest), self.run, 0), block.shortest)
        self.block = block

    def _reach(self, least: int) -> np.ndarray:
        """Words in runs of at least ``least`` words of the vocabulary."""
        return covered(len(self.run), np.flatnonzero(self.run >= least), self.run[self.run >= least])

    def occurrences(self) -> tuple[np.ndarray, np.ndarray]:
        """Word and window number of every occurrence of a window, ordered by word."""
        b = self.block
        low, _, _ = bisect(self.numbers, self.run, self.array, b.numbers, b.start, b.size)
        high, _, _ = bisect(self.numbers, self.run, self.array, b.numbers, b.start, b.size, after=True)
        n = high - low
        at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        word, window = self.array[at], np.repeat(np.arange(len(n)), n)
        order = np.argsort(word, kind="stable")
        return word[order], window[order]

    def longest(self) -> tuple[np.ndarray, np.ndarray]:
        """Of every test suffix: words of its longest match here, and the word where it begins (-1: none)."""
        b = self.block
        start = np.arange(len(b.numbers))
        at, before, behind = bisect(self.numbers, self.run, self.array, b.numbers, start, b.left)
        if not len(self.array):
            return np.zeros(len(start), np.int64), np.full(len(start), -1)
        where = np.where(before > behind, self.array[np.maximum(at - 1, 0)], self.array[np.minimum(at, len(self.array) - 1)])
        size = np.maximum(before, behind)
        return size, np.where(size > 0, where, -1)


def _blocks(benchmark: DataFrame, item: str, text: str, length: int) -> Iterator[Block]:
    """The benchmark, a bounded block at a time."""
    rows = written(segments(benchmark, item, text, length, SEGMENT).withColumn("row", F.monotonically_increasing_id()), "benchmark")
    total = rows.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_WORDS))
    for k in range(blocks):
        mine = rows.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == k)
        yield block_of([tuple(r) for r in mine.select("item", "first", "words", "n").collect()], length)


def _searched(docs: DataFrame, block: Block, text: str, carry: list[str]) -> DataFrame:
    """``carry`` columns, n_words, hits and items of every document for one block."""
    shared = docs.sparkSession.sparkContext.broadcast(block)
    schema = docs.select(*[F.col(f"`{c}`") for c in carry]).withColumns({
        "n_words": F.lit(0).cast("long"), "hits": F.lit(None).cast("array<struct<lo:long,hi:long>>"),
        "items": F.lit(None).cast("array<string>")}).schema
    own = docs.select(*[F.col(f"`{c}`") for c in carry], F.col(text).alias("__text"))
    span = pa.struct([("lo", pa.int64()), ("hi", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for part in pieces(batches, "__text", SHARD_BYTES):
            shard = Shard(part.column("__text"), held)
            word, window = shard.occurrences()
            hit = covered(len(shard.numbers), word, held.size[window])
            first = hit.copy()  # maximal runs of hit words inside one text
            first[1:] &= ~hit[:-1]
            heads = shard.at[:-1][shard.at[:-1] < shard.at[1:]]
            first[heads] = hit[heads]
            last = np.append(hit[1:] & ~first[1:], False)
            lo, hi = np.flatnonzero(first), np.flatnonzero(hit & ~last) + 1
            spans, found, known = [[] for _ in range(part.num_rows)], [[] for _ in range(part.num_rows)], {}
            text_of = np.searchsorted(shard.at, lo, "right") - 1
            for t, a, b in zip(text_of.tolist(), lo.tolist(), hi.tolist(), strict=True):
                spans[t].append({"lo": a - int(shard.at[t]), "hi": b - int(shard.at[t])})
            text_of = np.searchsorted(shard.at, word, "right") - 1
            cut = np.flatnonzero(np.append(True, text_of[1:] != text_of[:-1])) if len(word) else word
            for a, b in zip(cut, np.append(cut[1:], len(word))[:len(cut)], strict=True):
                mine = np.unique(window[a:b])
                if (key := mine.tobytes()) not in known:  # copies share their windows
                    items = np.unique(np.concatenate([held.items[held.item_at[g]:held.item_at[g + 1]] for g in mine]))
                    known[key] = [held.names[i] for i in items if held.names[i] is not None]
                found[int(text_of[a])] = known[key]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in carry), pa.array(np.diff(shard.at).astype(np.int64)),
                 pa.array(spans, pa.list_(span)), pa.array(found, pa.list_(pa.string()))], [*carry, "n_words", "hits", "items"])

    return own.mapInArrow(run, schema)


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
                  length: int = LENGTH) -> DataFrame:
    """``docs`` without its text, with n_words, hits (ranges of hit words), n_hit, items (sorted), n_items, contaminated."""
    carry = [c for c in docs.columns if c != text and c not in ADDED]
    passes, last = [], None
    for block in _blocks(benchmark, item, item_text, length):
        if last is None:
            last = block
            continue
        if not passes:  # more than one block: documents are numbered, so that the passes meet again
            docs = written(docs.withColumn("__row", F.monotonically_increasing_id()), "decontamination-rows")
            passes.append(written(_searched(docs, last, text, [*carry, "__row"]), "decontamination-pass"))
        passes.append(written(_searched(docs, block, text, ["__row"]).where(F.size("hits") > 0), "decontamination-pass"))
    if not passes:
        out = _searched(docs, last, text, carry)
    else:
        hits = passes[0].where(F.size("hits") > 0).select("__row", "hits", "items")
        for p in passes[1:]:
            hits = hits.unionByName(p.select("__row", "hits", "items"))
        merged = hits.groupBy("__row").agg(F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"),
                                           F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
        none = lambda c, t: F.coalesce(F.col(c), F.array().cast(t)).alias(c)
        out = passes[0].drop("hits", "items").join(merged, "__row", "left").select(
            *[F.col(f"`{c}`") for c in carry], "n_words", none("hits", "array<struct<lo:long,hi:long>>"), none("items", "array<string>"))
    zero = F.lit(0).cast("long")
    counted = F.aggregate("hits", F.struct(zero.alias("n"), zero.alias("end")), lambda acc, x: F.struct(
        (acc["n"] + F.greatest(x["hi"] - F.greatest(x["lo"], acc["end"]), zero)).alias("n"),
        F.greatest(acc["end"], x["hi"]).alias("end")))["n"]
    return out.select(*[F.col(f"`{c}`") for c in carry], "n_words", counted.alias("n_hit"), "hits",
                      F.array_sort("items").alias("items"), F.size("items").cast("long").alias("n_items"),
                      (F.size("hits") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
          length: int = LENGTH) -> DataFrame:
    """``docs`` without the contaminated rows."""
    rows = written(docs.withColumn("__doc", F.monotonically_increasing_id()), "decontamination-docs")
    bad = contamination(rows.select("__doc", F.col(text).alias("text")), benchmark, "text", item, item_text, length)
    return rows.join(bad.where("contaminated").select("__doc"), "__doc", "left_anti").drop("__doc")


def longest_matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                    item_text: str = "text", length: int = LENGTH) -> DataFrame:
    """Longest verbatim match in ``docs`` of each test suffix that matches ``length`` words or more, or a whole shorter item.

    item, item_word, n_words, key and doc_word (of equally long matches
    one of a shard, the least key of the shards').  A suffix ends with its
    row of ``segments`` (``SEGMENT`` words or more).
    """
    own = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    found = None
    for block in _blocks(benchmark, item, item_text, length):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            held = shared.value
            whole = np.bincount(held.row_of, minlength=len(held.first))
            for part in pieces(batches, "text", SHARD_BYTES):
                shard = Shard(part.column("text"), held)
                size, where = shard.longest()
                pick = np.flatnonzero((size >= length) | (size > 0) & (size == whole[held.row_of]))
                text_of = np.searchsorted(shard.at, where[pick], "right") - 1
                row = held.row_of[pick]
                start = np.searchsorted(held.row_of, row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([held.names[i] for i in held.item_of[row]], pa.string()),
                     pa.array(held.first[row] + pick - start), pa.array(size[pick]),
                     part.column("key").take(pa.array(text_of)), pa.array(where[pick] - shard.at[text_of])],
                    ["item", "item_word", "n_words", "key", "doc_word"])

        part = own.mapInArrow(run, "item string, item_word long, n_words long, key long, doc_word long")
        found = part if found is None else found.unionByName(part)
    best = F.min(F.struct((-F.col("n_words")).alias("n"), "key", "doc_word")).alias("m")
    return found.groupBy("item", "item_word").agg(best).select(
        "item", "item_word", (-F.col("m.n")).alias("n_words"), F.col("m.key").alias(key), F.col("m.doc_word").alias("doc_word"))
