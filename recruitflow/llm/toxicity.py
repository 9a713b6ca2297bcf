"""Operator 5, toxicity: a factorization machine over hashed terms.

Score = sigmoid(b + sum w_f + sum_{f<g} <v_f, v_g>) over the terms of a
text: the factors v let a pair of terms (an insult and the mention of a
group) weigh more or less than the two weights added.

Terms are the distinct lower-case letter runs of the whole text and
their beginnings of four to six bytes, hashed into ``BUCKETS``.  The
model is fitted on a bounded sample of labelled rows (``SAMPLE`` rows
expected, chosen by a hash of the key, never from the held-out fold):
the ``FEATURES`` buckets that tell the classes apart best are kept, and
their weights and factors are learned with minibatches.  Scoring is one
pass over all rows with the model in the task closure (a few hundred KB,
bounded by the parameters); no text is shuffled, because the sampled
keys are few enough to be broadcast by construction.

Defined results: null and empty texts score by the bias alone; without
labelled rows of both classes every score is the smoothed share of label
1; a key with several labels counts as toxic if one says so; a null key
is never sampled and not held out; repeated rows each get a score; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import _LOWER, pieces, span_hashes, text_bytes, word_spans

BUCKETS = 1 << 18
#: Expected number of labelled rows the model is fitted on (all, if fewer).
SAMPLE = 16_384
FEATURES = 2_048
FACTORS = 8
EPOCHS = 24
BATCH = 512
PREFIXES = (4, 5, 6)
FOLDS = 5

_APART = np.ones(256, dtype=bool)  # bytes that separate terms: all but letters and non-ASCII
_APART[0x41:0x5B] = _APART[0x61:0x7B] = _APART[0x80:] = False


def held_out(key: Column) -> Column:
    """The fold whose labels are never learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bucket) pairs of a piece, ordered by row."""
    data, offs = text_bytes(texts)
    low = _LOWER[data]
    lo, hi, at = word_spans(low, offs, _APART)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(at)).astype(np.int64)
    keys = [row * BUCKETS + (span_hashes(low, lo, hi) % np.uint64(BUCKETS)).astype(np.int64)]
    for k in PREFIXES:
        m = hi - lo > k
        h = span_hashes(low, lo[m], lo[m] + k) + np.uint64(k)
        keys.append(row[m] * BUCKETS + (h % np.uint64(BUCKETS)).astype(np.int64))
    keys = np.unique(np.concatenate(keys))
    return keys // BUCKETS, keys % BUCKETS


@dataclass
class Model:
    """Bias, and weight and factors of each kept bucket; ``slot`` maps buckets to them (-1: none)."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    slot: np.ndarray

    def scores(self, texts: pa.Array) -> np.ndarray:
        row, bucket = terms(texts)
        f = self.slot[bucket].astype(np.int64)
        row, f = row[f >= 0], f[f >= 0]
        n = len(texts)
        z = self.bias + np.bincount(row, self.weights[f], n)
        for v in self.factors.T:
            s = np.bincount(row, v[f], n)
            z += 0.5 * (s * s - np.bincount(row, v[f] ** 2, n))
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _select(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Buckets whose presence differs most between the classes (z of two shares)."""
    df = [np.bincount(np.concatenate([r for r, t in zip(rows, y, strict=True) if t == k]), minlength=BUCKETS)
          for k in (0, 1)]
    n = np.array([(y == 0).sum(), (y == 1).sum()], dtype=float)
    share = (df[0] + df[1] + 1) / (n.sum() + 2)
    z = (df[1] / n[1] - df[0] / n[0]) / np.sqrt(share * (1 - share) * (1 / n[0] + 1 / n[1]))
    z[df[0] + df[1] < 3] = 0
    best = np.argsort(-np.abs(z), kind="stable")[:FEATURES]
    return np.sort(best[z[best] != 0])


def fit(rows: list[np.ndarray], y: np.ndarray, seed: int = 7) -> Model:
    """Fit on rows of distinct buckets and their labels; the order of the rows must be fixed by the caller."""
    n, pos = len(rows), int(y.sum())
    prior = (pos + 0.5) / (n + 1) if n else 0.01
    slot = np.full(BUCKETS, -1, dtype=np.int16)
    if not 0 < pos < n:
        p = min(max(prior, 1e-6), 1 - 1e-6)
        return Model(float(np.log(p / (1 - p))), np.zeros(1), np.zeros((1, FACTORS)), slot)
    kept = _select(rows, y)
    slot[kept] = np.arange(len(kept))
    m = max(1, len(kept))
    flat = [s[s >= 0] for s in (slot[r] for r in rows)]
    rng = np.random.default_rng(seed)
    theta = np.concatenate([[np.log(prior / (1 - prior))], np.zeros(m), rng.normal(0, 0.01, m * FACTORS)])
    g1, g2, step = np.zeros_like(theta), np.zeros_like(theta), 0
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            pick = order[at:at + BATCH]
            x = np.zeros((len(pick), m))
            for i, r in enumerate(pick):
                x[i, flat[r]] = 1
            w, v = theta[1:m + 1], theta[m + 1:].reshape(m, FACTORS)
            xv = x @ v
            z = theta[0] + x @ w + 0.5 * ((xv ** 2).sum(1) - (x @ (v ** 2)).sum(1))
            d = (1 / (1 + np.exp(-np.clip(z, -35, 35))) - y[pick]) / len(pick)
            gw = x.T @ d
            gv = x.T @ (d[:, None] * xv) - v * gw[:, None]
            grad = np.concatenate([[d.sum()], gw, gv.ravel()]) + 1e-5 * theta
            step += 1
            g1 = 0.9 * g1 + 0.1 * grad
            g2 = 0.999 * g2 + 0.001 * grad ** 2
            theta = theta - 0.02 * (g1 / (1 - 0.9 ** step)) / (np.sqrt(g2 / (1 - 0.999 ** step)) + 1e-8)
    return Model(float(theta[0]), theta[1:m + 1], theta[m + 1:].reshape(m, FACTORS), slot)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fit on about ``sample`` labelled keys outside the held-out fold, one text each (that with the least hash)."""
    own = (labels.select(F.col(key).alias("__key"), F.col(label).cast("int").alias("__y"))
           .where(F.col("__key").isNotNull() & F.col("__y").isNotNull() & ~held_out(F.col("__key")))
           .groupBy("__key").agg(F.max("__y").alias("__y")))
    total = own.count()
    share = min(1.0, sample / max(total, 1))
    # a hash threshold, not a limit: the expected size is the bound whatever the number of labels
    few = own.where(F.pmod(F.xxhash64("__key", F.lit(11)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    src = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")).join(F.broadcast(few), "__key")
    # one text a label: repeated rows of a key are one row of the sample
    src = src.groupBy("__key", "__y").agg(F.min_by("__text", F.xxhash64("__text")).alias("__text"))

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "__text"):
            row, bucket = terms(part.column("__text"))
            cuts = np.searchsorted(row, np.arange(part.num_rows + 1))
            got = [bucket[a:b].astype(np.int32).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("__key").cast(pa.string()), part.column("__y"), pa.array(got, pa.binary())],
                ["k", "y", "f"])

    got = src.select("__key", "__text", "__y").mapInArrow(featurise, "k string, y int, f binary").toArrow()
    rows = sorted(zip(got["k"].to_pylist(), got["f"].to_pylist(), got["y"].to_pylist(), strict=True))
    return fit([np.frombuffer(f, np.int32) for _, f, _ in rows], np.array([float(y > 0) for _, _, y in rows]))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; clashing names are replaced."""
    src = docs.drop("score", "predicted").withColumn("__text", F.col(text))
    schema = src.drop("__text").withColumn("score", F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "__text"):
            out = [part.column(c) for c in part.schema.names if c != "__text"]
            yield pa.RecordBatch.from_arrays([*out, pa.array(model.scores(part.column("__text")))], schema.names)

    return src.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def score_keys(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, fold, score and decision of every row; the text stays in the task that read it."""
    src = docs.select(F.col(key), F.col(text).alias("__text"))
    schema = src.select(key).withColumn("score", F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "__text"):
            yield pa.RecordBatch.from_arrays(
                [part.column(key), pa.array(model.scores(part.column("__text")))], [key, "score"])

    out = src.mapInArrow(run, schema)
    return out.select(key, held_out(F.col(key)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
