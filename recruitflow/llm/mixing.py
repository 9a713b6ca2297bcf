"""Operator 3, mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Sizes (words) are summed per source; targets share a multiple of all
   words by weight, never above ``CAP`` times a source's own words.
2. Each source's documents are dealt by hash into blocks of about
   ``BLOCK_WORDS`` words (at most ``MOST_BLOCKS`` blocks in all), and the
   blocks are permuted by a keyed hash.  A source's exact word quota is
   met by whole passes over its blocks and then a prefix of the
   permuted blocks; the last block drawn gives only some documents, and
   the last of those only its first words.
3. A binary tree over the output shards splits the draws: each node deals
   its draws to its two halves by a multivariate hypergeometric sample
   seeded by the node, so every task walks only the part of the tree
   above its own shards.  Leaves own disjoint ranges of each source's
   draws.
4. Documents join the draws of their block; a shard is shuffled by
   ordering it by a hash.

One row per source and, per source, the number of draws pass through the
driver.  Window partitions are blocks or lists of blocks, both bounded
by parameters.  A hot source is split over its own blocks; of rows equal
in key, text and source, each is dealt by its number among them.

Defined results: a null or empty text has size 0, belongs to its source
and is taken with 0 words; a null source is a source of its own, ordered
last; repeated rows are documents of their own; an empty table gives an
empty mix; extra columns are carried unless named like the columns this
module adds (those are replaced).  Reruns agree: every choice is a hash
of key and text or seeded by the tree node.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS, drop, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
BLOCK_WORDS = 1 << 16
MOST_BLOCKS = 1 << 18
SHARD_WORDS = 1 << 22
SEED = 20_24
#: Rows of the documents while they are mixed.
ROW = "mix_row_number"
#: Names of the columns that this module adds.
ADDED = ("size", "source_size", "target", "taken", "draws", "repeat", "shard", "words", "place")


def n_words(text: str = "text"):
    return F.size(F.filter(F.split(F.coalesce(F.col(text), F.lit("")), SPACE_CLASS), lambda w: w != "")).cast("long")


def fill(sizes: list[int], weights: list[int], total: float, cap: float = CAP) -> list[float]:
    """Shares of ``total`` by weight; what is above ``cap`` times a size is shared anew until none is."""
    out = [0.0] * len(sizes)
    open_, left = set(range(len(sizes))), float(total)
    while open_:
        w = sum(weights[i] for i in open_)
        over = [i for i in sorted(open_) if left * weights[i] / w > cap * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / w
            break
        for i in over:
            out[i] = float(cap * sizes[i])
        open_ -= set(over)
        left -= sum(out[i] for i in over)
    return out


def split(counts: np.ndarray, shards: int, lo: int, hi: int, seed: int = SEED) -> Iterator[tuple[int, int, int, int]]:
    """Leaves of the splitting tree for shards ``lo`` to ``hi``: (shard, source, first draw, number of draws)."""

    def walk(a: int, b: int, start: np.ndarray, have: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        if b <= lo or a >= hi or not have.any():
            return
        if b - a == 1:
            for s in np.flatnonzero(have):
                yield a, int(s), int(start[s]), int(have[s])
            return
        mid = (a + b) // 2
        total = int(have.sum())
        rng = np.random.default_rng([seed, a, b])
        left = rng.multivariate_hypergeometric(have, total * (mid - a) // (b - a), method="marginals")
        yield from walk(a, mid, start, left)
        yield from walk(mid, b, start + left, have - left)

    yield from walk(0, shards, np.zeros(len(counts), dtype=np.int64), counts.astype(np.int64))


def _apart(sized: DataFrame) -> DataFrame:
    """Rows with equal hash and source get hashes of their own, by their number among them (the first keeps its).

    Numbers are counted inside the task that read the rows, from what the
    tasks before it hold, so that no group of equal rows meets in one
    task, and the hashes given do not depend on how rows lie in files.
    """
    own = sized.withColumn("__g", F.xxhash64("__h", "__source"))
    earlier = Window.partitionBy("__g").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    later = (own.groupBy("__g", "__p").agg(F.count("*").alias("__c"))
             .withColumn("__o", F.sum("__c").over(earlier)).where(F.col("__o").isNotNull()).select("__g", "__p", "__o"))
    inside = F.row_number().over(Window.partitionBy("__g", "__p").orderBy("__i")) - 1
    number = F.col("__k") + F.coalesce("__o", F.lit(0))
    return own.withColumn("__k", inside).join(later, ["__g", "__p"], "left").withColumn(
        "__h", F.when(number == 0, F.col("__h")).otherwise(F.xxhash64("__h", number))).drop("__g", "__p", "__i", "__k", "__o")


def allocations(docs: DataFrame, source: str = "source", text: str = "text", key: str = "doc_id",
                carry: list[str] | None = None, share: float = SHARE, block_words: int = BLOCK_WORDS,
                shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per document: the carried columns, size, source_size, target, taken and its draws.

    ``draws`` is an array of (repeat, shard, words); documents not taken have an empty one.
    """
    spark = docs.sparkSession
    carry = [c for c in (carry if carry is not None else docs.columns) if c not in ADDED and not c.startswith("__")]
    read = written(docs.select(
        *carry, F.col(source).alias("__source"), n_words(text).alias("size"),
        F.xxhash64(F.lit(SEED), F.col(key), F.col(text)).alias("__h"),
        F.spark_partition_id().alias("__p"), F.monotonically_increasing_id().alias("__i")), "mix-read")
    sized = written(_apart(read), "mix-sized")
    drop(read)

    rows = [(r[0], r[1] or 0) for r in sized.groupBy("__source").agg(F.sum("size")).collect()]
    rows.sort(key=lambda r: (r[0] is None, r[0] or ""))  # code points order as UTF-8 bytes do
    sizes = [r[1] for r in rows]
    total = sum(sizes)
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(rows))]
    targets = fill(sizes, weights, share * total)
    quotas = [min(round(t), CAP * n) for t, n in zip(targets, sizes, strict=True)]
    block = max(block_words, total // MOST_BLOCKS, 1)
    table = spark.createDataFrame(
        [(r[0], i, sizes[i], float(targets[i]), max(1, math.ceil(sizes[i] / block)),
          quotas[i] // sizes[i] if sizes[i] else 1, quotas[i] % sizes[i] if sizes[i] else 0)
         for i, r in enumerate(rows)],
        "__source string, __sid int, source_size long, target double, __blocks long, __full long, __rest long")
    # Spark broadcasts the source table where its size allows; beyond that the join splits skewed sources
    named = sized.join(table, sized["__source"].eqNullSafe(table["__source"])).drop("__source")
    named = named.withColumn("__block", F.pmod(F.col("__h"), F.col("__blocks")))

    blocks = named.groupBy("__sid", "__block").agg(
        F.sum("size").alias("words"), F.first("__full").alias("full"), F.first("__rest").alias("rest"))
    order = Window.partitionBy("__sid").orderBy(F.xxhash64(F.lit(SEED + 1), "__sid", "__block"), "__block")
    placed = (blocks
              .withColumn("rank", F.row_number().over(order) - 1)
              .withColumn("of", F.count("*").over(Window.partitionBy("__sid")))
              .withColumn("before", F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)))
              .fillna(0, ["before"]))
    drawn = written(
        placed.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full"))).alias("repeat"))
        .withColumn("take", F.when(F.col("repeat") < F.col("full"), F.col("words"))
                    .otherwise(F.least("words", F.col("rest") - F.col("before"))))
        .where((F.col("repeat") < F.col("full")) | (F.col("before") < F.col("rest")))
        .select("__sid", "__block", "repeat", "take", "words",
                (F.col("repeat") * F.col("of") + F.col("rank")).alias("draw")), "mix-draws")

    have = dict(drawn.groupBy("__sid").count().collect())
    counts = np.array([have.get(i, 0) for i in range(len(rows))], dtype=np.int64)
    shards = max(1, min(math.ceil(sum(quotas) / shard_words), int(counts.sum())))

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy()
            if len(own):
                got = [x for x in split(counts, shards, int(own[0]), int(own[-1]) + 1)]
                cols = np.array(got, dtype=np.int64).reshape(-1, 4).T
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["shard", "sid", "start", "n"])

    deals = spark.range(shards).mapInArrow(leaves, "shard long, sid long, start long, n long")
    deals = deals.select("shard", F.col("sid").cast("int").alias("__sid"),
                         F.explode(F.expr("sequence(start, start + n - 1)")).alias("draw"))
    per_block = drawn.join(deals, ["__sid", "draw"]).groupBy("__sid", "__block").agg(
        F.sort_array(F.collect_list(F.struct("repeat", "shard", "take", "words"))).alias("__draws"),
        (F.max(F.col("take") < F.col("words"))).alias("__part"))

    joined = named.join(written(per_block, "mix-deals"), ["__sid", "__block"], "left")
    inside = Window.partitionBy("__sid", "__block").orderBy("__h", key).rowsBetween(Window.unboundedPreceding, -1)
    part = F.coalesce(F.col("__part"), F.lit(False))
    before = (joined.where(~part).withColumn("__before", F.lit(0).cast("long"))
              .unionByName(joined.where(part).withColumn("__before", F.coalesce(F.sum("size").over(inside), F.lit(0)))))
    draws = F.transform(F.coalesce(F.col("__draws"), F.array()), lambda d: F.struct(
        d["repeat"].alias("repeat"), d["shard"].alias("shard"),
        F.least(F.col("size"), F.greatest(d["take"] - F.col("__before"), F.lit(0))).alias("words")))
    # a document without words is taken with its block; one that the cut leaves no word of is not
    draws = F.filter(draws, lambda d: (d["words"] > 0) | (F.col("size") == 0))
    return before.withColumn("draws", draws).select(
        *carry, "size", "source_size", "target",
        F.aggregate("draws", F.lit(0).cast("long"), lambda n, d: n + d["words"]).alias("taken"), "draws", "__h")


def _first_words(text: pd.Series, n: pd.Series) -> pd.Series:
    def cut(t: str, k: int) -> str:
        at, spaces, inside = 0, frozenset(" \t\n\x0b\f\r"), False
        for i, c in enumerate(t):
            if c in spaces:
                if inside and at == k:
                    return t[:i]
                inside = False
            elif not inside:
                inside, at = True, at + 1
        return t

    return pd.Series([cut(t, k) if t is not None else t for t, k in zip(text, n, strict=True)])


def mix(docs: DataFrame, text: str = "text", **how) -> DataFrame:
    """The mixed documents: one row per draw, with shard, repeat, words and place (order inside the shard).

    Drawn on row numbers; the documents' own columns join the draws once.
    A document drawn in part carries only its first words.
    """
    numbered = written(docs.drop(*ADDED).withColumn(ROW, F.monotonically_increasing_id()), "mix-rows")
    got = allocations(numbered, text=text, carry=[ROW, how.get("key", "doc_id")], **how)
    draws = got.select(ROW, "size", "__h", F.explode("draws").alias("__d")).select(
        ROW, "__d.repeat", "__d.shard", "__d.words", (F.col("__d.words") < F.col("size")).alias("__cut"),
        F.xxhash64(F.lit(SEED + 2), F.col("__d.shard"), F.col("__d.repeat"), "__h").alias("place"))
    rows = draws.join(numbered, ROW)
    # only texts that are cut travel to Python
    cut = F.pandas_udf(_first_words, "string")(F.when(F.col("__cut"), F.col(text)), F.col("words"))
    return rows.withColumn(text, F.when(F.col("__cut"), cut).otherwise(F.col(text))).select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in ADDED], "repeat", "shard", "words", "place")


def in_order(mixed: DataFrame) -> DataFrame:
    """Each shard in one partition, in its shuffled order (a shard is bounded by ``SHARD_WORDS``)."""
    return mixed.repartition("shard").sortWithinPartitions("shard", "place", "repeat")
