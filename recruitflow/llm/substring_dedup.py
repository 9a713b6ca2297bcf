"""Operator 6, substring dedup with difference-cover anchors.

A word goes if a window of ``length`` consecutive words that covers it
also starts anywhere else in the corpus (windows are judged on the input).

A difference cover D modulo v holds, for every shift, two members that
far apart.  So for any two equal windows there is an offset below v at
which both texts have a position in D modulo v: hashing runs of
``length - v + 1`` words at those positions only (5 of 21) misses no
equal pair.  Round one finds the anchors that occur twice; round two
extends them: every window that holds such an anchor is compared in full
(96 bits of hash over 64-bit word hashes).

Defined results: a null or empty text has no words and nothing removed;
texts shorter than a window keep all words; windows inside one text count
as well as windows of other texts, overlapping ones too; repeated rows
are texts of their own and remove each other; extra columns are carried,
names that the result adds are replaced; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Generator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import covered, own_windows, span_hashes, text_bytes, window_hashes, word_spans
from .repeats import REPEATED, in_rounds

LENGTH = 35
#: Perfect difference sets modulo their period.
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}


def cover_for(length: int) -> tuple[int, tuple[int, ...]]:
    """The largest period that leaves anchors of at least a third of the window."""
    fit = [v for v in COVERS if length - v + 1 >= max(1, length // 3)]
    return (max(fit), COVERS[max(fit)]) if fit else (1, (0,))


def repeated_words(data: np.ndarray, offs: np.ndarray, length: int = LENGTH) -> Generator:
    """Coroutine: anchors, then windows; returns word spans, text offsets and the mask of words to remove."""
    period, cover = cover_for(length)
    short = length - period + 1
    lo, hi, at = word_spans(data, offs)
    words = span_hashes(data, lo, hi)
    anchor = window_hashes(words, short)
    text_of = np.repeat(np.arange(len(at) - 1), np.diff(at))
    inside = np.zeros(period, bool)
    inside[list(cover)] = True
    place = np.arange(len(words)) - at[:-1][text_of] if len(words) else np.zeros(0, np.int64)
    pick = np.flatnonzero(inside[place[:len(anchor)] % period] & own_windows(at, short, len(anchor)))
    got = yield anchor[pick], None, None
    hit = pick[(got & REPEATED) > 0]
    full = window_hashes(words, length)
    # a window that holds an anchor begins at most period - 1 words before it
    least = np.maximum(hit - (period - 1), 0)
    near = covered(len(words), least, hit + 1 - least)[:len(full)]
    pick = np.flatnonzero(near & own_windows(at, length, len(full)))
    more = (window_hashes(words, length, salt=3) >> np.uint64(32)).astype(np.uint32) if len(pick) else np.zeros(len(full), np.uint32)
    got = yield full[pick], more[pick], None
    return lo, hi, at, covered(len(words), pick[(got & REPEATED) > 0], length)


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with n_words, n_removed and kept_text (the text without the removed words)."""
    src = docs.drop("n_words", "n_removed", "kept_text")
    names = src.columns
    schema = src.withColumns({"n_words": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long"),
                              "kept_text": F.lit("")}).schema

    def step(table: pa.Table) -> Generator:
        data, offs = text_bytes(table.column(text))
        lo, hi, at, gone = yield from repeated_words(data, offs, length)
        # a removed word goes with the white space up to the next word
        end = np.minimum(np.append(lo[1:], len(data)), np.repeat(offs[1:], np.diff(at))) if len(lo) else lo
        drop = np.zeros(len(data) + 1, np.int8)
        drop[lo[gone]] += 1
        drop[end[gone]] -= 1
        stay = np.cumsum(drop[:-1], dtype=np.int32) == 0
        kept = data[stay]
        new = np.append(0, np.cumsum(stay))[offs]
        total = np.append(0, np.cumsum(gone))[at]
        col = pa.Array.from_buffers(pa.large_string(), len(offs) - 1, [
            None, pa.py_buffer(new.astype(np.int64).tobytes()), pa.py_buffer(kept.tobytes())])
        return pa.table([*(table.column(c) for c in names), pa.array(np.diff(at).astype(np.int64)),
                         pa.array(np.diff(total).astype(np.int64)), col.cast(pa.string())],
                        names=[*names, "n_words", "n_removed", "kept_text"])

    return in_rounds(src, step, 2, schema, keys_per_byte=0.06, text=text)
