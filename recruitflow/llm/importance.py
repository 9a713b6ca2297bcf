"""Operator 12, target-distribution importance resampling with an Aho-Corasick dictionary.

Documents are drawn with the Gumbel top-k trick by how much likelier
their hashed n-grams are in a target corpus than in the documents.

Texts are translated byte by byte: A-Z become lower case, bytes between
words become spaces.  Each task makes a dictionary of the distinct words of its
first slice of texts, the ``DICTIONARY`` commonest, every one bounded by
a space on both sides and carrying its CRC-32 and its length as payload.
The automaton's scan then emits one payload a word, in order; a word that
is not in the dictionary gets the same payload from its bytes, so results
do not depend on which words are.  Payloads of adjacent words compose into
the payload of their run: the CRC of a joined string is the first one's
CRC, moved over the bytes that follow (a linear map of 32 bits, a table
product for each set bit of the length), xor the second one's.  So
n-grams are never built as strings.

One pass over each corpus writes every text's buckets (4 bytes a
feature) and word count; counts are summed from there, at most one row a
bucket a task; the driver holds ``BUCKETS`` gains, nothing else.  Scores
are sums of gains.  The draw sorts narrow rows by range (score, id and a
row number, so that equal rows split too) and numbers them by partition
offsets: no task holds more than its range.

Defined results: a null or empty text has no words, no features and
weight 0; a text of fewer words than an n-gram has no n-grams of that
size; a null id draws as the empty string does; rows that repeat an id
are ranked apart, in any order of their own; extra columns are ignored;
an empty table gives no rows; an empty target has T = 0.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import NOT_LETTERS, pieces, text_bytes, word_spans, written

#: Words of the longest feature, buckets, words a drawn document has at least, and percent drawn.
LONGEST, BUCKETS, LEAST_WORDS, PERCENT, SEED = 1, 10_000, 20, 10, 2024
#: Words of a task's dictionary (a small one stays in the processor's cache), and bytes of text in one step.
DICTIONARY, SLICE_BYTES = 8192, 4 << 20

_TABLE = np.arange(256, dtype=np.uint8)
_TABLE[0x41:0x5B] += 0x20
_TABLE = np.where(NOT_LETTERS[_TABLE], 0x20, _TABLE).astype(np.uint8).tobytes()
_SPACE = np.arange(256) == 0x20
_POLY = 0xEDB88320


def _shift_tables(bits: int = 31) -> list[np.ndarray]:
    """Columns of the linear maps that move a CRC-32 over 1, 2, 4, ... zero bytes."""

    def times(m: np.ndarray, v: np.ndarray) -> np.ndarray:
        out = np.zeros(len(v), np.uint32)
        for k in range(32):
            out ^= np.where(v >> np.uint32(k) & np.uint32(1), m[k], np.uint32(0))
        return out

    bit = np.array([_POLY, *(1 << k for k in range(31))], np.uint32)  # over one zero bit
    for _ in range(3):
        bit = times(bit, bit)
    tables = [bit]
    for _ in range(bits - 1):
        tables.append(times(tables[-1], tables[-1]))
    return tables


_SHIFT = _shift_tables()


def composed(crc: np.ndarray, then: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of joined strings from the CRC of the first, and the CRC and length of the second."""
    out = crc.copy()
    for k, table in enumerate(_SHIFT):
        pick = np.flatnonzero(size >> k & 1)
        if not len(pick) and not (size >> k).any():
            break
        moved, v = np.zeros(len(pick), np.uint32), out[pick]
        for b in range(32):
            moved ^= np.where(v >> np.uint32(b) & np.uint32(1), table[b], np.uint32(0))
        out[pick] = moved
    return out ^ then


def dictionary(raw: bytes, most: int = DICTIONARY) -> ahocorasick.Automaton:
    """Automaton of a translated text's ``most`` commonest words, a space on both sides; payload: length << 32 | CRC."""
    out = ahocorasick.Automaton()
    for word, _ in Counter(raw.split(b" ")).most_common(most + 1):
        if word:
            out.add_word(f" {word.decode('latin-1')} ", len(word) << 32 | zlib.crc32(word))
    if len(out):
        out.make_automaton()
    return out


def translated(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """The texts' bytes, lower-cased, with spaces between words, and their offsets."""
    data, offs = text_bytes(texts)
    return data.tobytes().translate(_TABLE), offs


def payloads(raw: bytes, offs: np.ndarray, known: ahocorasick.Automaton) -> tuple[np.ndarray, np.ndarray]:
    """Payloads of all words of translated texts in order, and the offsets of each text's words."""
    starts, ends, at = word_spans(np.frombuffer(raw, np.uint8), offs, _SPACE)
    out = np.full(len(starts), -1, np.int64)
    if len(known):
        for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
            # one character a byte, so that places in the string are places in the text
            found = known.iter(f" {raw[a:b].decode('latin-1')} ")
            got = np.fromiter(chain.from_iterable(found), np.int64).reshape(-1, 2)
            out[np.searchsorted(ends, got[:, 0] + (a - 1))] = got[:, 1]
    rest = np.flatnonzero(out < 0)
    out[rest] = [b - a << 32 | zlib.crc32(raw[a:b]) for a, b in zip(starts[rest].tolist(), ends[rest].tolist(), strict=True)]
    return out, at


def buckets_of(held: np.ndarray, at: np.ndarray, longest: int = LONGEST,
               buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features from payloads, ordered by text, offsets of each text's features, and words of each text."""
    words = np.diff(at)
    text_of = np.repeat(np.arange(len(words)), words)
    crc, size = (held & 0xFFFFFFFF).astype(np.uint32), held >> 32
    keys, rows = [crc], [text_of]
    joined = crc
    space = np.full(len(crc), zlib.crc32(b" "), np.uint32)
    spaced = composed(space, crc, size) if longest > 1 else crc  # a word with a space before it
    for n in range(2, longest + 1):
        joined = composed(joined[:-1], spaced[n - 1:], size[n - 1:] + 1) if len(joined) else joined
        keys.append(joined)
        rows.append(np.where(text_of[:len(joined)] == text_of[n - 1:], text_of[:len(joined)], -1) if len(joined) else text_of[:0])
    keys, rows = np.concatenate(keys), np.concatenate(rows)
    keys, rows = keys[rows >= 0], rows[rows >= 0]
    if longest > 1:
        order = np.argsort(rows, kind="stable")
        keys, rows = keys[order], rows[order]
    return (keys % np.uint32(buckets)).astype(np.int32), np.searchsorted(rows, np.arange(len(words) + 1)), words


def features(docs: DataFrame, key: str, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """id, n_words, n_features and buckets (32-bit numbers, little-endian) of every row."""
    src = docs.select(F.col(key).cast("string").alias("id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ahocorasick.Automaton()
        for part in pieces(batches, "text", SLICE_BYTES):
            raw, offs = translated(part.column("text"))
            if not known and raw:
                known = dictionary(raw)
            held, at, words = buckets_of(*payloads(raw, offs, known), longest, buckets)
            col = pa.Array.from_buffers(pa.large_binary(), part.num_rows, [
                None, pa.py_buffer((4 * at).astype(np.int64).tobytes()), pa.py_buffer(held.astype("<i4").tobytes())])
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(words.astype(np.int64)), pa.array(np.diff(at).astype(np.int64)), col.cast(pa.binary())],
                ["id", "n_words", "n_features", "buckets"])

    return src.mapInArrow(run, "id string, n_words long, n_features long, buckets binary")


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Features of each bucket: summed in each task, then by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(text_bytes(batch.column("buckets"))[0].view("<i4"), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    out = [0] * buckets
    for r in rows.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n  # at most one row a bucket
    return out


def gains(own: list[int], target: list[int]) -> list[int]:
    """floor(1000 * ln of the smoothed ratio) of each bucket."""
    n, s_all, t_all = len(own), sum(own), sum(target)
    return [math.floor(1000 * math.log(float((t + 1) * (s_all + n)) / float((s + 1) * (t_all + n))))
            for s, t in zip(own, target, strict=True)]


def scored(rows: DataFrame, gain: list[int], seed: int = SEED) -> DataFrame:
    """id, n_words, n_features, weight and score of ``features`` rows."""
    shared = rows.sparkSession.sparkContext.broadcast(np.array(gain, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            data, offs = text_bytes(batch.column("buckets"))
            sums = np.append(0, np.cumsum(table[data.view("<i4")]))[offs // 4]
            n = np.diff(offs // 4)
            weight = np.diff(sums) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "n_words", "n_features")), pa.array(weight)],
                                             ["id", "n_words", "n_features", "weight"])

    out = rows.mapInArrow(run, "id string, n_words long, n_features long, weight long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce("id", F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return out.withColumn("score", F.col("weight") + noise)


def resampled(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
              longest: int = LONGEST, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT,
              seed: int = SEED) -> DataFrame:
    """key, n_features, weight, score and rank (null: not drawn) of every row."""
    own = written(features(docs, key, text, longest, buckets), "importance-features")
    wanted = written(features(target.withColumn("__none", F.lit(None).cast("string")), "__none", target_text, longest, buckets),
                     "importance-target")
    gain = gains(bucket_counts(own, buckets), bucket_counts(wanted, buckets))
    rows = written(scored(own, gain, seed).withColumns({
        "able": F.col("n_words") >= least_words, "row": F.monotonically_increasing_id()}), "importance-scores")
    draw = rows.where("able").count() * percent // 100
    id_ = F.col("id").cast(docs.schema[key].dataType)
    rows = rows.select(id_.alias("id"), "n_features", "weight", "score", "able", "row")
    order = [F.desc("able"), F.desc("score"), F.col("id").asc_nulls_last(), F.col("row")]
    ranged = written(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                     .withColumn("place", F.monotonically_increasing_id()).drop("row"), "importance-ranged")
    part, within = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    sizes, before = {}, 0
    for r in ranged.groupBy(part.alias("part")).count().orderBy("part").collect():  # one row a partition
        sizes[r["part"]] = before
        before += r["count"]
    offsets = ranged.sparkSession.createDataFrame(list(sizes.items()), T.StructType([
        T.StructField("part", T.LongType()), T.StructField("before", T.LongType())]))
    rank = F.col("before") + within + 1
    return (ranged.withColumn("part", part).join(F.broadcast(offsets), "part", "left")
            .select(F.col("id").alias(key), "n_features", "weight", "score",
                    F.when(F.col("able") & (rank <= draw), rank).alias("rank")))
