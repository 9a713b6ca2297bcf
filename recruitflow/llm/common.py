"""Helpers the operators share: shared scratch tables and word hashing on Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from typing import ClassVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Words are maximal runs of characters outside this class (fixed by the data contract).
SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD_CLASS = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"

_U = np.uint64
#: Blocks of a long span, and windows, hashed in one numpy step.
_STEP = 1 << 20
_RUN = 1 << 16


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A folder that driver and executors share: the cluster's checkpoint folder.

    Only where the session names none (tests, one machine) a temporary
    folder is set for it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = "file://" + tempfile.mkdtemp(prefix="recruitflow-llm-")
        spark.sparkContext.setCheckpointDir(base)
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


class Scope:
    """Tables that ``written`` makes while the scope is open (``with``); ``close`` deletes them.

    For callers that write an operator's result themselves: what the
    operator wrote on its way goes when the result is there.
    """

    _open: ClassVar[list["Scope"]] = []

    def __init__(self) -> None:
        self.tables: list[tuple[SparkSession, str]] = []

    def __enter__(self) -> "Scope":
        Scope._open.append(self)
        return self

    def __exit__(self, *_) -> None:
        Scope._open.remove(self)

    def close(self, still: DataFrame | None = None) -> None:
        """Delete the tables, unless ``still`` has yet to read one of them."""
        files = still.inputFiles() if still is not None and self.tables else []
        if any(path.rsplit("/", 1)[-1] in f for f in files for _, path in self.tables):
            return
        while self.tables:
            _delete(*self.tables.pop())


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back (cuts lineage, survives lost executors)."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    if Scope._open:
        Scope._open[-1].tables.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that no later step reads."""
    for t in tables:
        _delete(t.sparkSession, t._written_to)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix64(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_BASE = 0xD6E8FEB86659FD93
#: Blocks of eight bytes that all spans of a batch hash together, their places, and masks of 0 to 8 bytes.
_BLOCKS = 32
_PLACE = mix64(np.arange(1, _BLOCKS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=_U)
_ALL = (1 << 64) - 1
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows (null: empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_string(col.type) or pa.types.is_binary(col.type):
        col = col.cast(pa.large_binary())
    col = pc.fill_null(col, b"" if pa.types.is_large_binary(col.type) else "")
    n = len(col)
    if not n or col.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + n + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8)[offs[0]:offs[-1]]
    return data, offs - offs[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``most`` bytes of text each; a longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at, offs = 0, text_bytes(batch.column(column))[1]
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offs, offs[at] + most, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def word_spans(data: np.ndarray, offs: np.ndarray, apart: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of all words, and offsets of each text's words.  ``apart``: bytes between words."""
    inside = ~apart[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    full = offs[:-1][offs[:-1] < offs[1:]]  # a word never crosses texts
    first[full] = inside[full]
    ends = offs[1:][offs[:-1] < offs[1:]] - 1
    last[ends] = inside[ends]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offs)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: every block of eight bytes is mixed with its place, so no pattern cancels out."""
    size = ends - starts
    out = size.astype(_U) * _U(_BASE)
    if not len(starts):
        return out
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    blocks = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    pick, at, left = slice(None), starts, size
    for k in range(_BLOCKS):
        out[pick] += mix64((blocks[at] & _KEEP[np.minimum(left, 8)]) ^ _PLACE[k])
        more = np.flatnonzero(left > 8)
        pick = more if k == 0 else pick[more]
        at, left = at[more] + 8, left[more] - 8
        if not len(at):
            return mix64(out)
    for i, lo, n in zip(pick, at, left, strict=True):  # the rest of spans beyond _BLOCKS blocks
        for s in range(0, int(n), 8 * _STEP):
            part = blocks[lo + s:lo + min(s + 8 * _STEP, int(n)):8].copy()
            if s + 8 * _STEP >= n:
                part[-1] &= _KEEP[(int(n) - 1) % 8 + 1]
            place = mix64((np.arange(len(part), dtype=_U) + _U(s // 8 + _BLOCKS + 1)) * _U(0x9E3779B97F4A7C15))
            out[i:i + 1] += mix64(part ^ place).sum(dtype=_U)
    return mix64(out)


def word_hashes(data: np.ndarray, offs: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and the offsets of each text's words."""
    starts, ends, at = word_spans(data, offs)
    return span_hashes(_LOWER[data] if lower else data, starts, ends), at


def _paired(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hash of two runs, one after the other."""
    t = (x ^ (x >> _U(32))) * _U(0xBF58476D1CE4E5B9) + y
    t = (t ^ (t >> _U(29))) * _U(0x94D049BB133111EB)
    return t ^ (t >> _U(32))


#: Bytes between words of letters, digits and all that is not ASCII, after lower-casing A-Z.
NOT_LETTERS = np.zeros(256, dtype=bool)
NOT_LETTERS[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True


def letter_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of letters, digits and non-ASCII, and the offsets of each text's words."""
    low = _LOWER[data]
    starts, ends, at = word_spans(low, offs, NOT_LETTERS)
    return span_hashes(low, starts, ends), at


def window_hashes(items: np.ndarray, length: int, salt: int = 1) -> np.ndarray:
    """Hash of every run of ``length`` items, composed from runs half as long; a run may cross texts, the caller drops those."""
    n = len(items) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=_U)
    out = np.empty(n, dtype=_U)
    first, last = _U(salt * 0xD6E8FEB86659FD93 & _ALL), _U(length * 0x9FB21C651E98DF25 & _ALL)
    for at in range(0, n, _RUN):
        to = min(at + _RUN, n)
        h, k = items[at:to + length - 1] ^ first, 1
        while 2 * k <= length:
            h, k = _paired(h[:-k], h[k:]), 2 * k
        if k < length:  # the last two runs overlap
            h = _paired(h[:k - length], h[length - k:])
        out[at:to] = mix64(h + last)
    return out


def own_windows(at: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of ``n`` window starts keep their window of ``length`` items inside one text."""
    lo, hi = np.minimum(at[:-1], n), np.minimum(np.maximum(at[1:] - length + 1, at[:-1]), n)
    edge = np.bincount(lo, minlength=n + 1) - np.bincount(hi, minlength=n + 1)
    return np.cumsum(edge[:n]) > 0


def covered(n: int, starts: np.ndarray, length: int | np.ndarray) -> np.ndarray:
    """Which of ``n`` items lie in a window of ``length`` that begins at one of ``starts``."""
    edge = np.bincount(starts, minlength=n + 1)[:n + 1] - np.bincount(np.minimum(starts + length, n), minlength=n + 1)
    return np.cumsum(edge[:n]) > 0
