"""Operator 4, approximate nearest neighbours by a permutation index.

A vector is represented by its ``DEPTH`` nearest of ``PIVOTS`` pivots, in
order.  Close vectors see the pivots in nearly the same order, so rows
are ranked by the footrule distance between their permutation and the
query's (sum over the query's pivots of the difference in position; a
pivot outside a row's prefix counts as position ``DEPTH``), and the best
of each block, as many different vectors as ``SHARE`` of its rows, are
reranked by the exact inner product.

Largest inner product becomes nearest neighbour by one added coordinate
that gives all vectors the length of the longest.

* Pivots are the only fitted part: up to ``PIVOTS`` distinct vectors
  among the ``SAMPLE`` rows with the least hash of their id.
* Every row is indexed; the index (id, vector, permutation) is a table.
* Rows are dealt by hash into blocks of about ``BLOCK`` rows, queries
  into groups of at most ``QUERIES``; a task turns a block's permutations
  into pivot inverted files (position lists by pivot) and scans, for each
  query of a group, the lists of the query's pivots.  It returns at most
  ``k`` rows a query, so no list of candidates leaves a task.
* Spark keeps the best ``k`` of each query's blocks.

A common vector cannot crowd a block: equal vectors are one entry of its
lists, and only the result has their rows, the least ids first, as its
ties are ordered.  Equal footrules are ordered by least id.

A score that overflows is infinite, as in double precision; one that adds
infinities of both signs counts as the least.

Defined results: vectors that are null, empty, zero, of another length
than most, or hold null or non-finite components take no part, nor do
rows without an id; a query's own id is never its neighbour; a repeated
query id is asked once (its least vector); repeated rows can each be
neighbours; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

PIVOTS = 256
DEPTH = 128
SAMPLE = 4_096
SHARE = 8  # a block of n rows has n / SHARE different vectors reranked
LEAST = 512  # but at least so many
BLOCK = 8_192
QUERIES = 2_048


def _longest(v: Column, scale: Column) -> Column:
    """Square sum of ``v / scale``."""
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + (x / scale) * (x / scale))


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v, big) of the vectors that take part; ``big`` is the largest magnitude of a component."""
    v = F.col("v")
    own = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    own = own.where(F.col("id").isNotNull() & v.isNotNull() & ~odd).withColumn(
        "big", F.aggregate(v, F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x))))
    own = own.where(F.col("big") > 0)
    size = own.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return own.where(F.size("v") == (size["n"] if size else -1))


class Pivots:
    """The fitted part of the index.

    Distances are taken after division by the largest component of the
    table (of a query: by its own), so that no square over- or underflows;
    neither changes the order of a query's inner products.
    """

    def __init__(self, vectors: np.ndarray, scale: float, longest2: float, depth: int = DEPTH) -> None:
        self.scale, self.longest2 = scale, longest2
        self.depth = min(depth, len(vectors))
        self.points = self.lifted(vectors)

    def lifted(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        x = x / (np.abs(x).max(axis=1, keepdims=True) if query else self.scale)
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.longest2 - (x * x).sum(1), 0))
        return np.column_stack([x, more])

    def permutations(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        near = np.argsort(-(self.lifted(x, query) @ self.points.T), axis=1, kind="stable")
        return near[:, :self.depth].astype(np.uint16)


def _matrix(col: pa.Array) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1)


def fit(vectors: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE, depth: int = DEPTH) -> Pivots | None:
    """Pivots from the rows with the least hash of their id."""
    scale = vectors.agg(F.max("big")).first()[0]
    if scale is None:
        return None
    longest2 = vectors.agg(F.max(_longest(F.col("v"), F.lit(scale)))).first()[0]
    few = vectors.orderBy(F.xxhash64("id"), "id", "v").limit(sample).select("v").toArrow()["v"]
    x = _matrix(few)
    _, first = np.unique(x, axis=0, return_index=True)
    return Pivots(x[np.sort(first)[:pivots]], scale, longest2, depth)


def build(vectors: DataFrame, pivots: Pivots) -> DataFrame:
    """The index: every row's id, vector and permutation."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                perm = pivots.permutations(_matrix(batch.column("v")))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("v"), pa.array([p.tobytes() for p in perm], pa.binary())], ["id", "v", "perm"])

    return written(vectors.select("id", "v").mapInArrow(run, "id long, v array<double>, perm binary"), "ann-index")


def _different(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows ordered by their vector, then as they are; where each different vector begins there, and its size."""
    held = np.ascontiguousarray(x + 0.0)  # -0.0 is 0.0
    _, which = np.unique(held.view(np.dtype((np.void, held.itemsize * held.shape[1]))).ravel(), return_inverse=True)
    order = np.argsort(which, kind="stable")
    size = np.bincount(which)
    first = np.cumsum(size) - size
    by_row = np.argsort(order[first])  # the vector whose first row comes first is the first
    first, size = first[by_row], size[by_row]
    return order, first, size


def search(index: DataFrame, queries: DataFrame, pivots: Pivots, k: int = 20, block: int = BLOCK,
           group: int = QUERIES, share: int = SHARE, least: int = LEAST) -> DataFrame:
    """query_id, rank, vec_id and score of the best ``k`` found for each query (id, v)."""
    n, asked = index.count(), queries.count()
    blocks, groups = max(1, -(-n // block)), max(1, -(-asked // group))
    rows = (index.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(blocks)))
            .withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))
    own = (queries.select("id", "v").withColumn("g", F.pmod(F.xxhash64("id", F.lit(5)), F.lit(groups)).cast("int"))
           .withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>"))))
    depth = pivots.depth

    def scan(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if left.num_rows and right.num_rows:
            ids = left["id"].to_numpy()
            order = np.argsort(ids, kind="stable")
            ids, x = ids[order], _matrix(left["v"])[order]
            perm = np.frombuffer(b"".join(left["perm"].to_pylist()), np.uint16).reshape(len(ids), depth)[order]
            # equal vectors are one entry; rows has the rows of an entry in order of id
            rows, first, size = _different(x)
            entry = np.empty(len(ids), np.int64)
            entry[rows[np.repeat(first - np.cumsum(size) + size, size) + np.arange(len(ids))]] = np.repeat(np.arange(len(first)), size)
            x, perm = x[rows[first]], perm[rows[first]]
            # pivot inverted files: the position of each pivot in every entry's permutation
            posts = np.full((len(pivots.points), len(first)), depth, np.int16)
            posts[perm, np.arange(len(first))[:, None]] = np.arange(depth, dtype=np.int16)
            q, q_ids = _matrix(right["v"]), right["id"].to_numpy()
            take = min(len(first), max(least, -(-len(ids) // share)))
            foot, diff = np.empty(len(first), np.int16), np.empty(len(first), np.int16)
            for i, near in enumerate(pivots.permutations(q, query=True)):
                foot[:] = 0
                for position, p in enumerate(near):
                    np.subtract(posts[p], position, out=diff)
                    np.abs(diff, out=diff)
                    foot += diff
                own = slice(*np.searchsorted(ids, [q_ids[i], q_ids[i] + 1]))
                free = size - np.bincount(entry[own], minlength=len(size))  # rows that are not the query's
                best = np.flatnonzero(free)
                if take < len(best):  # ties by id: entries are ordered by their least
                    key = foot[best].astype(np.int64) * len(first) + best
                    best = best[np.argpartition(key, take - 1)[:take]]
                with np.errstate(over="ignore", invalid="ignore"):
                    score = (x[best] * q[i]).sum(axis=1)  # the same in every block, so that ties are ties
                score[np.isnan(score)] = -np.inf
                by_score = np.argsort(-score, kind="stable")
                enough = np.searchsorted(np.cumsum(free[best[by_score]]), k)
                if enough < len(best):
                    held = score >= score[by_score[enough]]
                    best, score = best[held], score[held]
                n = np.minimum(size[best], k + own.stop - own.start)
                row = rows[np.repeat(first[best] - np.cumsum(n) + n, n) + np.arange(n.sum())]
                score = np.repeat(score, n)
                other = ids[row] != q_ids[i]
                row, score = row[other], score[other]
                top = np.lexsort((ids[row], -score))[:k]
                out.append((np.full(len(top), q_ids[i]), ids[row[top]], score[top]))
        cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()), strict=True)],
                        names=["query_id", "vec_id", "score"])

    found = rows.groupBy("b", "g").cogroup(own.groupBy("b", "g")).applyInArrow(
        scan, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def neighbours(rows: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 20,
               **how) -> DataFrame:
    """Index all ``rows`` and search for those whose ``key`` satisfies ``is_query`` (a condition on ``id``)."""
    vectors = written(usable(rows, key, vector), "ann-vectors")
    pivots = fit(vectors)
    if pivots is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = build(vectors, pivots)
    queries = index.where(is_query).groupBy("id").agg(F.min("v").alias("v"))
    return search(index, queries, pivots, k, **how)
