"""Operator 10, MinHash near-dedup: one-permutation hashing, optimal densification, star edges.

1. One pass gives every text its set size, a 128-bit hash of its whole
   set of word shingles, and a signature: each shingle hash falls into
   one of ``BINS`` bins and the least of a bin is kept; an empty bin
   takes the value of another bin, tried in an order that a universal
   hash of (bin, attempt) gives (optimal densification).  ``ROWS`` bins
   make a band.  With 42 bands of 6 rows a pair at the threshold of 0.8
   shares no band with probability (1 - 0.8^6)^42, about 3e-6.
2. Texts with equal sets are one class; everything below is on classes,
   so a large group of copies costs one entry.
3. Each bucket of classes with an equal band is a star around its least
   class.  A class meets one centre: of the centres of its buckets that
   with most buckets in common.  So the first round tests at most one
   pair a class.
4. Pairs are tested on full sets.  Centres travel to their members; a
   star of many members is salted.
5. Links make components (contraction, so rounds are logarithmic).  A
   bucket that lies in one component is closed.  In an open one, each
   member outside its centre's component is compared by sketch with the
   members of other components and names its best partner not tested
   yet; the best of its partners in all buckets is tested.  Members
   already joined are skipped, so a round adds at most one tree of links
   and never lists a bucket's pairs.  When best partners seldom link any
   more, every pair that the sketches still cannot rule out, between two
   components, is tested once.  So no link between two classes that share
   a bucket is lost because others were better.
6. A bucket's members are dealt to blocks of ``BLOCK``; only members
   outside the centre's component go to every block, streaming past the
   block's own.

Links, labels and components stay in tables on the shared folder, each
dropped when the next has replaced it.

Defined results: a null text or one without words has an empty set, is
linked with nothing and kept; a text with fewer words than a shingle has
its whole word sequence as the one element; equal sets are one
component; rows that repeat a doc_id are all kept if the id is its
component's least; a null doc_id is never a component's name while
another member has an id; extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, mix64, own_windows, pieces, text_bytes, window_hashes, word_hashes, written

SHINGLE = 4
THRESHOLD = 80
BINS, ROWS = 252, 6
#: Bins of the sketch that screens pairs (two bits each), and the least similarity it may estimate.  At the threshold
#: the estimate deviates by at most 0.016, so this loses about as few pairs as the bands do.
SKETCH, LIKELY = 1024, 0.73
#: Members of a star that are tested in one task, and members of a bucket that are compared in one.
STAR, BLOCK = 256, 4096
#: Rounds of best partners go on while more than one pair in so many links.
LEAST_YIELD = 4
_U = np.uint64
_NO_ID = (1 << 63) - 1


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, ordered by text and hash, and the texts' offsets."""
    words, at = word_hashes(*text_bytes(texts), lower=True)
    n = np.diff(at)
    runs = window_hashes(words, size)
    own = own_windows(at, size, len(runs))
    text = np.repeat(np.arange(len(n)), n)
    ids, hashes = [text[:len(runs)][own]], [runs[own]]
    for k in range(1, size):  # texts of fewer words: the whole sequence
        few = np.flatnonzero(n == k)
        ids.append(few)
        hashes.append(window_hashes(words, k, salt=2 + k)[at[few]] if len(few) else np.zeros(0, _U))
    ids, hashes = np.concatenate(ids), np.concatenate(hashes)
    order = np.lexsort((hashes, ids))
    ids, hashes = ids[order], hashes[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (hashes[1:] != hashes[:-1])
    ids, hashes = ids[new], hashes[new]
    return hashes, np.searchsorted(ids, np.arange(len(n) + 1))


def set_keys(hashes: np.ndarray, at: np.ndarray) -> list[bytes]:
    """128-bit hash of each set."""
    both = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        sums = np.append(_U(0), np.cumsum(mix64(hashes ^ _U(salt)), dtype=_U))
        both.append(mix64(sums[at[1:]] - sums[at[:-1]] + np.diff(at).astype(_U)))
    flat = np.stack(both, axis=1).tobytes()
    return [flat[i:i + 16] for i in range(0, len(flat), 16)]


def signatures(hashes: np.ndarray, at: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Densified one-permutation signatures, a row per set (all ones for an empty set)."""
    out = np.full((len(at) - 1, bins), ~_U(0))
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    bin_ = ((hashes >> _U(32)) * _U(bins) >> _U(32)).astype(np.int64)  # ordered like the hashes
    first = np.ones(len(hashes), bool)
    first[1:] = (text[1:] != text[:-1]) | (bin_[1:] != bin_[:-1])
    out[text[first], bin_[first]] = hashes[first]
    filled = np.zeros(out.shape, bool)
    filled[text[first], bin_[first]] = True
    todo = np.flatnonzero(~filled.all(axis=1) & (np.diff(at) > 0))
    sig, own = out[todo], filled[todo]
    missing = ~own
    attempt = 0
    while len(todo):
        attempt += 1
        donor = (mix64(np.arange(bins, dtype=_U) + _U(attempt * 65_537)) % _U(bins)).astype(np.int64)
        take = missing & own[:, donor]
        sig[take] = sig[:, donor][take]
        missing &= ~take
        left = missing.any(axis=1)
        if not left.all():
            out[todo[~left]] = sig[~left]
            todo, sig, own, missing = todo[left], sig[left], own[left], missing[left]
    return out


def bands(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """Band keys of signatures; the band's number is part of its key."""
    n, bins = sig.shape
    parts = sig.reshape(n, bins // rows, rows)
    key = np.broadcast_to(np.arange(1, bins // rows + 1, dtype=_U) * _U(0x9E3779B97F4A7C15), (n, bins // rows)).copy()
    for r in range(rows):
        key = mix64(key ^ parts[:, :, r])
    return key


def sketches(hashes: np.ndarray, at: np.ndarray, bins: int = SKETCH) -> list[bytes]:
    """Two bits of the least hash in each of ``bins`` bins, 1 to 3, or 0 where a bin is empty."""
    out = np.zeros((len(at) - 1, bins), np.uint8)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    bin_ = ((hashes >> _U(32)) * _U(bins) >> _U(32)).astype(np.int64)
    first = np.ones(len(hashes), bool)
    first[1:] = (text[1:] != text[:-1]) | (bin_[1:] != bin_[:-1])
    out[text[first], bin_[first]] = (mix64(hashes[first]) % _U(3)).astype(np.uint8) + 1
    four = out.reshape(len(out), -1, 4)
    flat = (four[:, :, 0] | four[:, :, 1] << 2 | four[:, :, 2] << 4 | four[:, :, 3] << 6).tobytes()
    return [flat[i:i + bins // 4] for i in range(0, len(flat), bins // 4)]


_ODD = _U(0x5555555555555555)


def estimates(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Similarity of one packed sketch to others: equal bins, less the third of the unequal ones that agree by chance."""
    filled_one, filled = (one | one >> _U(1)) & _ODD, (others | others >> _U(1)) & _ODD
    unlike = one ^ others
    both = filled & filled_one
    count = lambda x: np.bitwise_count(x).sum(axis=1, dtype=np.int64)
    return (1.5 * count(both & ~(unlike | unlike >> _U(1))) - 0.5 * count(both)) / np.maximum(count(filled | filled_one), 1)


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """id, the numbers a row's text is found by (row, body), and text."""
    own = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return own.withColumn("body", F.xxhash64("text")).withColumn("row", F.coalesce("id", "body"))


def signed(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """id, row, body, n (set size), set key, band keys and sketch of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text", 2 << 20):
            hashes, at = shingle_sets(part.column("text"), size)
            b = bands(signatures(hashes, at)).view(np.int64)
            rows = pa.ListArray.from_arrays(pa.array(np.arange(0, b.size + 1, b.shape[1], dtype=np.int32)), pa.array(b.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("id", "row", "body")), pa.array(np.diff(at).astype(np.int64)),
                 pa.array(set_keys(hashes, at), pa.binary()), rows, pa.array(sketches(hashes, at), pa.binary())],
                ["id", "row", "body", "n", "key", "bands", "sketch"])

    return _rows(docs, key, text).mapInArrow(
        run, "id long, row long, body long, n long, key binary, bands array<long>, sketch binary")


def confirmed(pairs: DataFrame, texts: DataFrame, size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """a, b and linked (the full sets reach the threshold) of pairs (a, b) of classes; ``texts``: cid, text."""
    many = pairs.groupBy("a").count()
    dealt = pairs.join(many, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), 1 + F.floor(F.col("count") / STAR)).alias("salt"))
    wanted = (dealt.select("a", "salt", F.lit(1).alias("role"), F.col("b").alias("cid"))
              .unionByName(dealt.select("a", "salt", F.lit(0).alias("role"), F.col("a").alias("cid")).distinct()))
    rows = wanted.join(texts, "cid").repartition("a", "salt").sortWithinPartitions("a", "salt", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for part in pieces(batches, "text", 1 << 20):
            hashes, at = shingle_sets(part.column("text"), size)
            out = []
            for i, (a, role, cid) in enumerate(zip(*(part.column(c).to_pylist() for c in ("a", "role", "cid")), strict=True)):
                got = hashes[at[i]:at[i + 1]]
                if role == 0:  # the centre comes first
                    own = got.copy()
                    continue
                both = np.searchsorted(own, got)
                both[both == len(own)] = 0
                common = int((own[both] == got).sum())
                out.append((a, cid, 100 * common >= threshold * (len(own) + len(got) - common)))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.bool_()), strict=True)],
                    ["a", "b", "linked"])

    return rows.select("a", "role", "cid", "text").mapInArrow(run, "a long, b long, linked boolean")


def _jumped(hooks: DataFrame) -> DataFrame:
    """(cid, root, moved) with the roots of the roots, twice."""
    up = hooks.select(F.col("cid").alias("root"), F.col("root").alias("next"))
    further = hooks.select(F.col("cid").alias("next"), F.col("root").alias("last"))
    return hooks.join(up, "root").join(further, "next").select(
        "cid", F.col("last").alias("root"), (F.col("last") != F.col("root")).alias("moved"))


def hooked(edges: DataFrame) -> DataFrame:
    """(cid, root) of all ends of ``edges`` (a, b): each hooks to its least neighbour."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.groupBy(F.col("a").alias("cid")).agg(F.min("b").alias("low")).select("cid", F.least("cid", "low").alias("root"))


def components(links: DataFrame) -> DataFrame:
    """cid and label (least member) of all ends of ``links`` (a, b), by contraction.

    Each round every end hooks to its least neighbour, hooks are followed
    to their roots by pointer doubling, and the links between roots are
    the next round's.  At least half of the ends with links left go in
    each round.
    """
    edges = written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "near-edges")
    labels = None
    while True:
        hooks = written(_jumped(written(hooked(edges), "near-hooks")), "near-hooks")
        while not hooks.where("moved").isEmpty():
            new = written(_jumped(hooks), "near-hooks")
            drop(hooks)
            hooks = new
        roots = hooks.select("cid", "root")
        if labels is None:
            new = written(roots.select("cid", F.col("root").alias("label")), "near-labels")
        else:
            new = written(labels.join(roots.withColumnRenamed("cid", "label"), "label", "left").select(
                "cid", F.coalesce("root", "label").alias("label")), "near-labels")
            drop(labels)
        labels = new
        ends = (edges.join(roots.select(F.col("cid").alias("a"), F.col("root").alias("x")), "a")
                .join(roots.select(F.col("cid").alias("b"), F.col("root").alias("y")), "b"))
        new = written(ends.where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "near-edges")
        drop(edges, hooks)
        edges = new
        if edges.isEmpty():
            drop(edges)
            return labels


def partners(rows: DataFrame, most: int | None, threshold: int = THRESHOLD) -> DataFrame:
    """Pairs (cid, partner, score): the best ``most`` (None: all) of each asking member among its block of a bucket.

    ``rows``: bucket, block, asks, open, cid, label, n, sketch, tested and
    bands.  Where bands are not null, a pair is named in the first bucket
    that it shares only, and by one of two open members.  Members
    that do not ask are held, at most a block of them; asking ones stream
    past.  A partner has another label, a size that can reach the
    threshold, an estimate of at least ``LIKELY``, and is not in tested.
    """
    dealt = (rows.repartition("bucket", "block").sortWithinPartitions("bucket", "block", "asks")
             .select("bucket", "block", "asks", "open", "cid", "label", "n", "sketch", "tested", "bands"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None
        for batch in batches:
            bucket, block, cid, label, n = (batch.column(c).to_numpy() for c in ("bucket", "block", "cid", "label", "n"))
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            tested = batch.column("tested")
            if not len(bucket):
                continue
            sketch = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), _U).reshape(len(cid), -1)
            once = batch.column("bands").null_count == 0
            every = batch.column("bands").flatten().to_numpy().reshape(len(cid), -1) if once else np.zeros((len(cid), 0), np.int64)
            open_ = batch.column("open").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (block[1:] != block[:-1]), [True]]))
            out = []
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                if (bucket[x], block[x]) != now:
                    now, held = (bucket[x], block[x]), None
                take = x + int((~asks[x:y]).sum())
                if take > x:
                    part = cid[x:take], label[x:take], n[x:take], sketch[x:take], every[x:take], open_[x:take]
                    held = part if held is None else tuple(np.concatenate(z) for z in zip(held, part, strict=True))
                if held is None:  # no member of the bucket is dealt to this block
                    continue
                for m in range(take, y):
                    pick = np.flatnonzero((held[1] != label[m]) & (100 * np.minimum(held[2], n[m]) >= threshold * np.maximum(held[2], n[m])))
                    if len(pick) and tested[m].is_valid:
                        pick = pick[~np.isin(held[0][pick], tested[m].values.to_numpy())]
                    like = estimates(sketch[m], held[3][pick])
                    pick, like = pick[like >= LIKELY], like[like >= LIKELY]
                    if once and len(pick):
                        first = every[m][np.argmax(held[4][pick] == every[m], axis=1)] == bucket[x]
                        first &= ~(held[5][pick] & (held[0][pick] < cid[m]))
                        pick, like = pick[first], like[first]
                    best = np.lexsort((held[0][pick], -like))[:most]
                    out += [(int(cid[m]), int(held[0][pick[i]]), float(like[i])) for i in best]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["cid", "partner", "score"])

    return dealt.mapInArrow(run, "cid long, partner long, score double")


def _asking(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Rows (bucket, block, asks, cid, label) of the buckets that hold two components or more."""
    named = members.withColumn("label", F.col("cid")) if labels is None else members.join(labels, "cid", "left").select(
        "bucket", "cid", F.coalesce("label", "cid").alias("label"))
    named = written(named, "near-named")
    open_ = named.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min_by("label", "cid").alias("head"),
                                        F.count("*").alias("size")).where("low < high").select("bucket", "head", "size")
    blocks = F.floor((F.col("size") + BLOCK - 1) / BLOCK)
    return (named.join(open_, "bucket").withColumn("blocks", blocks)
            .withColumn("asks", F.explode(F.when(F.col("label") == F.col("head"), F.array(F.lit(False)))
                                          .otherwise(F.array(F.lit(False), F.lit(True)))))
            .withColumn("block", F.explode(F.when(F.col("asks"), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
                                           .otherwise(F.array(F.pmod(F.xxhash64("cid"), F.col("blocks"))))))
            .select("bucket", "block", "asks", (F.col("label") != F.col("head")).alias("open"), "cid", "label"))


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE,
                 threshold: int = THRESHOLD) -> DataFrame:
    """key, n_shingles, component_id and kept (is the component's least id) of every row."""
    sig = written(signed(docs, key, text, size), "near-signed")
    # a row without an id is found again by its text's hash
    least = F.min(F.struct(F.coalesce("id", F.lit(_NO_ID)).alias("rep"), "row", "body")).alias("m")
    classes = written(sig.where("n > 0").groupBy("key").agg(
        least, F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
        .select("key", "m.*", "n", "bands", "sketch").withColumn("cid", F.monotonically_increasing_id()), "near-classes")
    entries = classes.select("cid", F.explode("bands").alias("bucket"))
    heads = entries.groupBy("bucket").agg(F.min("cid").alias("head"), F.max("cid").alias("last")).where("head < last").select("bucket", "head")
    stars = written(entries.join(heads, "bucket"), "near-stars")
    members = stars.select("bucket", "cid")

    nodes = stars.select("cid").distinct().join(classes.select("cid", "row", "body"), "cid")
    # rows that repeat an id and a text are one before they travel
    bodies = _rows(docs, key, text).groupBy("row", "body").agg(F.first("text").alias("text"))
    texts = written(bodies.join(nodes, ["row", "body"]).select("cid", "text"), "near-texts")

    # round one: each class and the centre it shares most buckets with
    votes = stars.where("cid != head").groupBy("cid", "head").count()
    pairs = written(votes.groupBy("cid").agg(F.max_by("head", F.struct("count", -F.col("head"))).alias("a")).select(
        "a", F.col("cid").alias("b")), "near-pairs")
    tested, labels, most = None, None, 1
    while True:
        got = written(confirmed(pairs, texts, size, threshold), "near-tested")
        tested = got if tested is None else tested.unionByName(got)
        counts = got.agg(F.count_if("linked").alias("links"), F.count("*").alias("pairs")).first()
        if most is None:
            if counts.links:
                labels = components(tested.where("linked"))
            break
        if LEAST_YIELD * counts.links < counts.pairs:  # best partners seldom link any more: test what is left
            most = None
        if counts.links:
            labels = components(tested.where("linked"))
        ends = (tested.select(F.col("a").alias("cid"), F.col("b").alias("other"))
                .unionByName(tested.select(F.col("b").alias("cid"), F.col("a").alias("other")))
                .groupBy("cid").agg(F.collect_set("other").alias("tested")))
        own = classes.select("cid", "n", "sketch", "bands" if most is None else F.lit(None).cast("array<long>").alias("bands"))
        asking = written(_asking(members, labels).join(own, "cid").join(ends, "cid", "left"), "near-asking")
        best = partners(asking, most, threshold)
        if most is not None:
            best = best.groupBy("cid").agg(F.max_by("partner", F.struct("score", "partner")).alias("partner"))
        # a pair that both name is tested once; the centre is a member that asked
        pairs = (best.groupBy(F.least("cid", "partner").alias("x"), F.greatest("cid", "partner").alias("y")).agg(F.min("cid").alias("a"))
                 .select("a", (F.col("x") + F.col("y") - F.col("a")).alias("b")))
        pairs = written(pairs, "near-pairs")
        if pairs.isEmpty():
            break
        members = written(asking.where("NOT asks").select("bucket", "cid"), "near-members")
        drop(asking)

    if labels is None:
        labels = classes.select("cid", F.col("cid").alias("label")).limit(0)
    named = classes.select("cid", "key", "rep").join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    least_id = named.groupBy("label").agg(F.min("rep").alias("component"))
    named = named.join(least_id, "label").select("key", "component")
    out = sig.select("id", "n", "key").join(named, "key", "left")
    component = F.when(F.col("n") == 0, F.col("id")).when(F.col("component") < _NO_ID, F.col("component"))
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col(key) == F.col("component_id"), F.col("component_id").isNull()))
