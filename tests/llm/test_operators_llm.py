"""Each operator against a brute-force version, on the odd cases and on an empty table."""
import hashlib
import random
import re
import sys
import zlib
from bisect import bisect_right
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql.functions import spark_partition_id
from tokenizers import Tokenizer

from recruitflow.llm import (
    minhash,
    mixing,
    packing,
    permutation_index,
    quality_rules,
    repeats,
    substring_dedup,
    suffix_dedup,
    token_counts,
    toxicity,
    warc,
)
from recruitflow.llm.common import new_folder

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return WORD.findall(t or "")


# ------------------------------------------------------------------ 1
def test_quality_rules(documents, empty):
    rows = quality_rules.apply_rules(documents).collect()
    assert len(rows) == documents.count() and quality_rules.apply_rules(empty).count() == 0
    for r in rows:
        w = words(r.text)
        runs = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
        c = Counter(runs)
        hit = {p for i, x in enumerate(runs) if c[x] > 1 for p in range(i, i + 8)}
        lines = [x for x in (r.text or "").split("\n") if words(x)]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(map(len, w)), len(hit))
        assert r.n_symbols == sum(ch in "#*$%&|<>" for ch in r.text or "")
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.base_failed == (len(w) < 20 or 100 * len(hit) > 30 * len(w))
        assert not (r.base_failed and r.kept)
    plan = quality_rules.apply_rules(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


# ------------------------------------------------------------------ 2
def test_warc_round_trip(spark):
    rows = [(1, "http://a/x y\r\n", "<p>one</p>", 5), (2, None, "<p>one</p>", 5), (3, "u", None, 5), (4, "u", "", 5),
            (2, None, "<p>one</p>", 5), (None, "n", "<p>one</p>", 5), (None, "n", "solo", 5), (None, "n", "solo", 5),
            (9, "big", "é" * 200_000, 5), (10, "b2", "z" * 50, 5), (1 << 60, "far", "far", 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, refers int")
    folder = new_folder(spark, "t")
    manifest = warc.write_archive(pages, folder, roll_bytes=300, shard_bytes=1_000)
    assert manifest.count() > 2 and warc.commit(manifest, folder) == manifest.count()  # may be repeated
    got = warc.read_archive(spark, folder).collect()
    assert len(got) == len(rows)
    best = {}
    for i, _, h, _ in rows:
        best[h or ""] = max(best.get(h or "", -1), -1 if i is None else i)
    responses = Counter()
    for r in got:
        text = {(x[0], (x[2] or "").encode().__len__(), warc.base32_sha1((x[2] or "").encode())): x[2] or "" for x in rows}[
            (r.page_id, r.payload_bytes, r.payload_digest)]
        if r.record_type == "response":
            responses[text] += 1
            assert r.payload.decode() == text and r.refers_to is None
            assert (-1 if r.page_id is None else r.page_id) == best[text]
        else:
            assert r.payload is None and (-1 if r.refers_to is None else r.refers_to) == best[text]
    assert responses == Counter(best.keys())
    other = new_folder(spark, "t")
    again = warc.write_archive(pages.repartition(7), other, roll_bytes=300, shard_bytes=1_000)
    key = lambda m: sorted((r.file, r.records, r.sha1) for r in m.collect())
    assert key(manifest) == key(again)  # deterministic bytes
    bare = new_folder(spark, "t")
    warc.write_archive(pages.limit(0), bare)
    assert warc.read_archive(spark, bare).count() == 0


def test_warc_shards_from_running_sums(spark):
    rng = random.Random(2)
    rows = [(rng.choice([i, 7, -1 << 63]), rng.randrange(1, 900)) for i in range(0, 6_000, 3)] + [(10_001, 64)]
    sums = Counter()
    for i, n in rows:
        sums[i] += n
    want, at = {}, 0
    for i in sorted(sums):
        want[i] = at // 1_000, max(1, (at + sums[i]) // 1_000 - at // 1_000)
        at += sums[i]
    sizes = spark.createDataFrame(rows, "id long, bytes long")
    got = warc.shard_starts(sizes.repartition(7), 1_000)
    assert got == warc.shard_starts(sizes.coalesce(1), 1_000)  # however the rows lie
    first = [g[0] for g in got]
    for i, (shard, parts) in want.items():
        g = got[bisect_right(first, i) - 1]
        assert g[1] == shard and (parts == 1 or g == (i, shard, parts))
    assert max(g[2] for g in got) > 100 and len(got) <= 2 * (at // 1_000 + 1)


def test_warc_splits_a_hot_page_id(spark):
    rows = [(5, "u", f"{i:05d}" * 40) for i in range(200)] + [(None, "n", f"{i:04d}" * 40) for i in range(200)] + [(6, "u", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = new_folder(spark, "t")
    files = warc.write_archive(pages, folder, shard_bytes=8_000).collect()
    by_shard = Counter()
    for f in files:
        by_shard[f.shard] += f.records
    assert len(by_shard) > 20 and max(by_shard.values()) < 60  # 401 records
    got = warc.read_archive(spark, folder).collect()
    assert sorted((r.page_id or -1, r.payload.decode()) for r in got) == sorted((r[0] or -1, r[2]) for r in rows)


# ------------------------------------------------------------------ 3
def test_fill_and_split():
    assert mixing.fill([100, 100, 100], [5, 2, 1], 450) == [200.0, 2 * 250 / 3, 250 / 3]
    assert sum(mixing.fill([5, 0, 7], [5, 2, 1], 18)) == 18 and mixing.fill([], [], 0) == []
    counts = np.array([40, 3, 0, 17])
    leaves = list(mixing.split(counts, 7, 0, 7))
    for s, n in enumerate(counts):  # disjoint ranges that cover every draw
        got = sorted((a, k) for _, src, a, k in leaves if src == s)
        assert [p for a, k in got for p in range(a, a + k)] == list(range(n))
    size = Counter()
    for shard, _, _, k in leaves:
        size[shard] += k
    assert max(size.values()) - min(size.values()) <= 3
    part = [x for lo in range(7) for x in mixing.split(counts, 7, lo, lo + 1)]
    assert sorted(part) == sorted(leaves)


def test_mixing(documents, empty):
    how = {"block_words": 50, "shard_words": 5_000}
    rows = mixing.allocations(documents, **how).collect()
    assert len(rows) == documents.count() and mixing.allocations(empty).count() == 0
    by = {}
    for r in rows:
        assert r.size == len(words(r.text)) and r.taken <= 2 * r.size
        by.setdefault(r.source, []).append(r)
    total = sum(r.size for r in rows)
    assert abs(sum(v[0].target for v in by.values()) - 1.5 * total) < 1e-6
    for v in by.values():
        assert v[0].source_size == sum(r.size for r in v) and abs(sum(r.taken for r in v) - v[0].target) <= 1
    again = sorted((str(r.doc_id), r.taken) for r in mixing.allocations(documents.repartition(3), **how).collect())
    assert again == sorted((str(r.doc_id), r.taken) for r in rows)
    mixed = mixing.in_order(mixing.mix(documents, **how)).collect()
    assert all(len(words(r.text)) == r.words for r in mixed)
    assert sum(r.words for r in mixed) == sum(r.taken for r in rows)


def test_mixing_deals_equal_rows_apart(spark):
    """A third of the rows are one row: each has a block of its own draw, however the rows lie."""
    docs = spark.createDataFrame([(i, f"w{i} a b c", "s", i) for i in range(600)] + [(7_000, "w x y z", "s", 0)] * 300,
                                 "doc_id long, text string, source string, other int")
    hashed = lambda df: mixing._apart(df.select(
        "doc_id", mixing.F.col("source").alias("__source"), mixing.F.xxhash64("doc_id", "text").alias("__h"),
        mixing.F.spark_partition_id().alias("__p"), mixing.F.monotonically_increasing_id().alias("__i")))
    one, other = (sorted(map(tuple, hashed(docs.repartition(n)).select("doc_id", "__h").collect())) for n in (2, 7))
    assert one == other and len({h for _, h in one}) == len(one) == 900
    blocks = Counter(h % 30 for _, h in one)
    assert max(blocks.values()) <= 2 * len(one) / 30
    how = {"block_words": 40, "share": 0.5}
    taken = sorted((r.doc_id, r.taken) for r in mixing.allocations(docs, **how).collect())
    assert taken == sorted((r.doc_id, r.taken) for r in mixing.allocations(docs.repartition(5), **how).collect())
    assert abs(sum(t for _, t in taken) - 0.5 * 4 * 900) <= 1
    of_the_copy = [t for k, t in taken if k == 7_000]
    assert 0.25 < sum(of_the_copy) / (4 * len(of_the_copy)) < 0.75  # drawn like all others, not as one block


# ------------------------------------------------------------------ 4
def test_permutation_index(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3_000, 24)).astype("float32") * rng.uniform(0.5, 2, (3_000, 1)).astype("float32")
    x[100:160] = x[40]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(20, rows[20][1]), (None, rows[1][1]), (5_000, None), (5_020, []), (5_040, [0.0] * 24), (5_060, [float("nan")] * 24),
             (5_080, [None] + [1.0] * 23), (5_100, [float("inf")] + [1.0] * 23), (5_120, [1.0] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = permutation_index.neighbours(df, permutation_index.F.col("id") % 20 == 0, block=1_000).collect()
    ids = np.append(np.arange(3_000), 20)
    every = np.vstack([x, x[20]]).astype(float)
    found, recall = {}, []
    for r in got:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(found) == list(range(0, 3_000, 20))
    for q, v in found.items():
        s = every @ x[q].astype(float)
        s[ids == q] = -np.inf
        best = ids[np.lexsort((ids, -s))[:20]]
        v.sort()
        assert [r[0] for r in v] == list(range(1, 21)) and v == sorted(v, key=lambda r: (-r[2], r[1]))
        assert all(abs(r[2] - x[q].astype(float) @ x[r[1]].astype(float)) < 1e-9 for r in v)
        recall.append(len(set(best) & {r[1] for r in v}) / 20)
    assert np.mean(recall) >= 0.9
    assert [r[1] for r in found[40]][:20] == list(range(100, 120))[:20] or found[40][0][2] > x[40] @ x[40]
    assert permutation_index.neighbours(df.limit(0), permutation_index.F.col("id") % 20 == 0).count() == 0


def test_permutation_index_with_a_common_vector(spark):
    """A third of the rows are one vector that most queries rank early; it takes one place of a block's rerank."""
    rng = np.random.default_rng(3)
    centre = rng.normal(size=24)
    centre /= np.linalg.norm(centre)
    x = 2 * centre + 0.35 * rng.normal(size=(6_000, 24))
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype("float32")
    x[::3] = 0.6 * centre  # in the middle of all, and of a small inner product with any
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = {}
    for r in permutation_index.neighbours(df, permutation_index.F.col("id") % 25 == 0, block=3_000).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    every, ids, recall = x.astype(float), np.arange(6_000), []
    assert sorted(found) == list(range(0, 6_000, 25))
    for q, v in found.items():
        s = (every * every[q]).sum(axis=1)
        s[q] = -np.inf
        assert [r for r, _ in sorted(v)] == list(range(1, 21))
        recall.append(len(set(np.lexsort((ids, -s))[:20].tolist()) & {i for _, i in v}) / 20)
    assert np.mean(recall) >= 0.9, np.mean(recall)


def test_permutation_index_copies_are_ordered_by_id(spark):
    """Copies over many blocks, with an id that is repeated: the least other ids, each row once."""
    rows = [(i, [1.0, 2.0, 0.0]) for i in range(400)] + [(7, [1.0, 2.0, -0.0])] * 30 + [(1_000 + i, [float(i), 0.1, 0.0]) for i in range(1, 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = permutation_index.neighbours(df, permutation_index.F.col("id").isin(3, 7), block=50).orderBy("query_id", "rank").collect()
    by = {q: [r.vec_id for r in got if r.query_id == q] for q in (3, 7)}
    assert by == {3: [0, 1, 2, 4, 5, 6] + [7] * 14, 7: [0, 1, 2, 3, 4, 5, 6, *range(8, 21)]}


@pytest.mark.parametrize("size", [1e160, 1e-170])
def test_permutation_index_keeps_vectors_of_any_magnitude(spark, size):
    """Components whose squares over- or underflow, beside ordinary ones."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 6))
    x[::3] *= size
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = permutation_index.neighbours(df, permutation_index.F.col("id") % 20 == 0, k=5).collect()
    assert {r.query_id for r in got} == {0, 20, 40} and len(got) == 15
    for q in (0, 20, 40):
        with np.errstate(over="ignore", invalid="ignore"):
            score = (x * x[q]).sum(axis=1)
        score[np.isnan(score)] = -np.inf
        want = [i for i in np.lexsort((np.arange(60), -score)) if i != q][:5]
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [i for _, i, _ in own] == want and [s for _, _, s in own] == [score[i] for i in want]


# ------------------------------------------------------------------ 5
def test_toxicity_learns_pairs(spark, documents, empty):
    rng = random.Random(3)
    plain = [f"word{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(3_000):
        w = rng.sample(plain, 30)
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        w += ["fool"] * insult + ["people"] * group
        rng.shuffle(w)
        rows.append((i, " ".join(w)))
        labels.append((i, int(insult and group)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, lab)
    got = {r.doc_id: r for r in toxicity.score_keys(docs, model).collect()}
    held = [i for i in got if got[i].held_out]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    assert np.mean([got[i].predicted == labels[i][1] for i in held]) > 0.97
    rows = toxicity.score(documents, model).collect()
    assert len(rows) == documents.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    bare = toxicity.train(docs, lab.limit(0))
    assert all(r.predicted == 0 for r in toxicity.score_keys(documents, bare).collect())
    assert toxicity.score_keys(empty, model).count() == 0


def test_toxicity_takes_one_text_a_label(spark, monkeypatch):
    """A document repeated 3,000 times is one row of the sample; the model is that of the distinct rows."""
    seen = []
    fit = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda rows, y: seen.append(len(rows)) or fit(rows, y))
    docs = spark.createDataFrame([(i, "fool people " * (i % 2) + f"word{i} text") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    first = toxicity.train(docs, labels)
    again = toxicity.train(docs.unionByName(docs.where("doc_id < 20").crossJoin(spark.range(150)).drop("id")), labels)
    assert seen[0] == seen[1] <= 40
    assert (first.scores(pa.array(["fool people"])) == again.scores(pa.array(["fool people"]))).all()


# ------------------------------------------------------------------ 6
def brute_words(texts, n):
    c = Counter(tuple(w[i:i + n]) for w in texts for i in range(len(w) - n + 1))
    out = []
    for w in texts:
        gone = {p for i in range(len(w) - n + 1) if c[tuple(w[i:i + n])] > 1 for p in range(i, i + n)}
        out.append([x for i, x in enumerate(w) if i not in gone])
    return out


@pytest.mark.parametrize("length", [35, 4, 1])
def test_substring_dedup(documents, empty, length):
    rows = documents.collect()
    want = Counter((r.doc_id, len(words(r.text)), " ".join(k)) for r, k in zip(
        rows, brute_words([words(r.text) for r in rows], length), strict=True))
    got = substring_dedup.remove_repeats(documents, length=length).collect()
    assert Counter((r.doc_id, r.n_words, " ".join(words(r.kept_text))) for r in got) == want
    assert all(r.n_removed == r.n_words - len(words(r.kept_text)) for r in got)
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_equal_rows_are_spread_over_chunks(spark):
    """A repeated row is not one chunk's load."""
    docs = spark.createDataFrame([(1, "a text that is always the same")] * 4_000, "doc_id long, text string").repartition(4)

    def step(table):
        yield np.zeros(0, np.uint64), None, None
        return pa.table([pa.array([table.num_rows], pa.int64())], names=["n"])

    got = [r.n for r in repeats.in_rounds(docs, step, 1, "n long", 0.05, chunk_bytes=4_000).collect()]
    assert sum(got) == 4_000 and max(got) < 400


def test_covers_hold_every_shift():
    for v, d in substring_dedup.COVERS.items():
        assert {(a - b) % v for a in d for b in d} == set(range(v))


# ------------------------------------------------------------------ 7
def test_packing(documents, empty):
    t = Tokenizer.from_file(WORD_BPE)
    rows = documents.collect()
    want = Counter((r.doc_id, tuple(t.encode(r.text or "", add_special_tokens=False).ids + [2])) for r in rows)
    got = packing.pack(documents, WORD_BPE, window=256, group=4).collect()
    # pieces of equal ids (repeated rows) are put together by their places
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append(r)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length
    sizes = []
    for k in sorted(seqs):
        at = 0
        for r in sorted(seqs[k], key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        sizes.append(at)
    assert sorted(seqs) == list(range(len(seqs))) and set(sizes[:-1]) == {256}
    assert sum(sizes) == sum(len(k[1]) * n for k, n in want.items())
    single = {k for k, n in Counter(r.doc_id for r in rows).items() if n == 1 and k is not None}
    for k in single:
        parts = sorted((r for r in got if r.doc_id == k), key=lambda r: r.start)
        assert ((k, tuple(sum((r.ids for r in parts), []))) in want) and all(r.doc_tokens == sum(p.length for p in parts) for r in parts)
    assert packing.pack(empty, WORD_BPE).count() == 0


def test_word_tokenizer_equals_library():
    rng = random.Random(5)
    own, t = packing.WordTokenizer(WORD_BPE), Tokenizer.from_file(WORD_BPE)
    chars = ["a", "Ab", "Σ", "s", "'s", "'", "!", ",", "(", " ", "\n", "1", "é", "é", "ß", "中", "\x0b", " ", "İ", "—", "́"]
    texts = ["".join(rng.choice(chars) for _ in range(rng.randint(0, 30))) for _ in range(3_000)] + [None, ""]
    for extra in ([], ["x<|endoftext|>Y <|ENDOFTEXT|>"]):
        ids, at = own.encode(pa.array(texts + extra, pa.string()), 2)
        for i, x in enumerate(texts + extra):
            assert ids[at[i]:at[i + 1]].tolist() == t.encode(x or "", add_special_tokens=False).ids + [2], x


@pytest.mark.parametrize("totals", [[1000, 1, 7, 992], [5], [3] * 40, [10_000, 10_000, 1]])
def test_plan_serves_every_token_once(totals):
    p = packing.Plan(totals, window=64, group=2)
    groups = -(-p.total // p.tokens)
    for k in range(groups):
        left = [p.served(s, k + 1) - p.served(s, k) for s in range(len(totals))]
        assert min(left) >= 0 and sum(left) == min(p.tokens, p.total - k * p.tokens)
        gives = list(p.fill(k, left))
        assert [sum(g for s, g in w if s == x) for x in range(len(totals)) for w in [sum(gives, [])]] == left
        assert all(sum(g for _, g in w) == 64 for w in gives[:-1])
    assert [p.served(s, groups) for s in range(len(totals))] == totals


def test_groups_do_not_grow_with_the_sources():
    rng = random.Random(4)
    totals = [rng.choice([1, 2, 40, 700]) for _ in range(2_000)] + [300_000]
    p = packing.Plan(totals, window=4_096, group=4)
    assert p.tokens == 4 * 4_096  # the sources squared are 4 million
    groups = -(-p.total // p.tokens)
    served = [[p.served(s, k) for s in range(len(totals))] for k in range(groups + 1)]
    for k in range(groups):
        left = [b - a for a, b in zip(served[k], served[k + 1], strict=True)]
        assert min(left) >= 0 and sum(left) == min(p.tokens, p.total - k * p.tokens)
        windows = list(p.fill(k, left))
        assert all(sum(g for _, g in w) == 4_096 for w in windows[:-1])
        assert sum(g for w in windows for _, g in w) == sum(left)
        slack = [abs(k * p.tokens * t / p.total - a) for t, a in zip(totals, served[k], strict=True)]
        assert max(slack[:-1]) < 2 and slack[-1] < 100  # a share is kept to a token or two
    assert served[-1] == totals
    for s in (0, 1, 2, 3, 2_000):
        for at in range(0, totals[s], max(1, totals[s] // 50)):
            k = p.group_of(s, at)
            assert served[k][s] <= at < served[k + 1][s]


def test_plan_of_any_size_holds_no_groups():
    import pickle

    small, large = packing.Plan([10_000] * 20), packing.Plan([10**13] * 19 + [7])
    assert len(pickle.dumps(large)) < 2 * len(pickle.dumps(small))
    groups = -(-large.total // large.tokens)
    for k in (0, 1, groups // 3, groups - 1):
        give = [large.served(s, k + 1) - large.served(s, k) for s in range(20)]
        assert min(give) >= 0 and sum(give) == min(large.tokens, large.total - k * large.tokens)
    for at in (0, 10**12 + 7, 10**13 - 1):
        k = large.group_of(3, at)
        assert large.served(3, k) <= at < large.served(3, k + 1)
    assert len(large.known) < 20


# ------------------------------------------------------------------ 8
@pytest.mark.parametrize("length", [200, 16, 1])
def test_suffix_dedup(documents, empty, length):
    small = documents.where("doc_id is null or doc_id <> 14")
    rows = [(r.doc_id, (r.text or "").encode()) for r in small.collect()]
    c = Counter(t[i:i + length] for _, t in rows for i in range(len(t) - length + 1))
    want = Counter()
    for k, t in rows:
        gone = np.zeros(len(t) + 2, bool)
        for i in range(len(t) - length + 1):
            if c[t[i:i + length]] > 1:
                gone[i + 1:i + 1 + length] = True
        kept = bytes(b for b, g in zip(t, gone[1:], strict=False) if not g)
        want[k, len(t), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()] += 1
    got = suffix_dedup.remove_strings(small, length=length).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got) == want
    assert suffix_dedup.remove_strings(empty).count() == 0


# ------------------------------------------------------------------ 9
def test_token_counts(documents, empty):
    t = Tokenizer.from_file(BYTE_BPE)
    got = token_counts.count_tokens(documents, BYTE_BPE).collect()
    want = Counter((r.doc_id, len((r.text or "").encode()), len(t.encode(r.text or "", add_special_tokens=False).ids))
                   for r in documents.collect())
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in got) and token_counts.count_tokens(empty, BYTE_BPE).count() == 0


def test_state_maps_compose(monkeypatch):
    """Maps of any chunks, composed in any order of nesting, count as the library does; the machine runs without it."""
    rng, library = random.Random(8), Tokenizer.from_file(BYTE_BPE)
    monkeypatch.setitem(sys.modules, "tokenizers", None)
    own = token_counts.Transducer(BYTE_BPE)
    chars = ["a", "b", "s", "t", "'", "'", " ", " ", "\n", "1", "!", "é", "中", "\x1c", "\x85", "²", "👍", "re", "ll", "<|endoftext|>"]
    for _ in range(1_500):
        text = "".join(rng.choice(chars) for _ in range(rng.randint(1, 40)))
        for chunk in (1, 3, 8):
            parts = list(own.chunks(text, chunk))
            assert "".join(parts) == text
            maps = [own.mapped(x) for x in parts]
            while len(maps) > 1:
                k = rng.randrange(len(maps) - 1)
                maps[k:k + 2] = [own.compose(*maps[k:k + 2])]
            assert own.ended(maps[0]) == len(library.encode(text, add_special_tokens=False).ids), (text, chunk)


def test_counter_equals_library(monkeypatch):
    rng, library = random.Random(3), Tokenizer.from_file(BYTE_BPE)
    chars = ["a", "aa", "the", "ing", "é", "中", "\x00", "0", "00", "-", "--", "=", "er", "xyz", "Q", "o", "on", " ", "  "]
    texts = ["".join(rng.choice(chars) for _ in range(rng.randint(0, 12))) for _ in range(5_000)]
    texts += ["a" * n for n in range(1, 80)] + ["-" * n for n in range(1, 300, 7)] + ["é中" * 900, "x<|endoftext|><|endoftext|>", None]
    want = [len(library.encode(x or "", add_special_tokens=False).ids) for x in texts]
    assert token_counts.Transducer(BYTE_BPE).count(pa.array(texts)).tolist() == want
    monkeypatch.setattr(token_counts, "MOST_STATES", 50)
    monkeypatch.setattr(token_counts, "MOST_PATHS", 20)
    assert token_counts.Transducer(BYTE_BPE).count(pa.array(texts)).tolist() == want


def test_long_texts_are_counted_in_many_tasks(spark, documents):
    t = Tokenizer.from_file(BYTE_BPE)
    want = Counter((r.doc_id, len((r.text or "").encode()), len(t.encode(r.text or "", add_special_tokens=False).ids))
                   for r in documents.collect())
    got = token_counts.count_tokens(documents, BYTE_BPE, chunk=300).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    text = " ".join(f"u{i}" for i in range(30_000))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        one = spark.createDataFrame([(1, text)], "__key long, __text string")
        tasks = token_counts.state_maps(one, BYTE_BPE, 2_000).select(spark_partition_id().alias("task"), "place").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(tasks) == -(-len(text) // 2_000) and len({r.task for r in tasks}) > 3


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        token_counts.Transducer(WORD_BPE)


# ------------------------------------------------------------------ 10
def brute_components(rows):
    low = {chr(c): chr(c + 32) for c in range(65, 91)}
    sets = []
    for r in rows:
        w = words((r.text or "").translate(str.maketrans(low)))
        sets.append(frozenset(tuple(w[i:i + 4]) for i in range(len(w) - 3)) if len(w) > 3 else frozenset([tuple(w)] if w else []))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j].doc_id for j in range(len(rows)) if group[j] == group[i] and rows[j].doc_id is not None]
        c = r.doc_id if not sets[i] else min(ids, default=None)
        out.append((r.doc_id, len(sets[i]), c, c is None or r.doc_id == c))
    return Counter(out)


def test_near_classes(spark, documents, empty):
    got = minhash.near_classes(documents).collect()
    assert Counter(map(tuple, got)) == brute_components(documents.collect())
    assert minhash.near_classes(empty).count() == 0


def test_near_classes_of_chained_copies(spark):
    """Copies that resemble their neighbours but not each other: links that no first star sees."""
    rng = random.Random(2)
    rows, at = [], [f"k{rng.random()}" for _ in range(120)]
    for i in range(60):
        rows.append((i, " ".join(at)))
        for _ in range(2):
            at[rng.randrange(120)] = f"k{rng.random()}"
    for i in range(60, 100):  # a common passage, nothing else in common
        rows.append((i, " ".join([f"p{k}" for k in range(60)] + [f"k{rng.random()}" for _ in range(60)])))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, minhash.near_classes(df).collect())) == brute_components(df.collect())


def test_densified_signatures_estimate_similarity():
    rng = np.random.default_rng(4)
    for n in (5, 60, 3_000):
        x = rng.integers(0, 1 << 63, n * 10, dtype=np.uint64)
        a, b = np.unique(x[:9 * n]), np.unique(x[n:])
        sig = minhash.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        assert abs((sig[0] == sig[1]).mean() - 0.8) < 0.12
