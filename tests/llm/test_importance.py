"""Operator 12 against brute force, with features of up to three words."""
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from recruitflow.llm import importance as im

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, longest):
    w = WORD.findall((text or "").translate(LOWER))
    return w, [" ".join(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, longest, buckets, least, percent, seed):
    b = lambda g: zlib.crc32(g.encode()) % buckets
    own = Counter(b(g) for _, t in docs for g in grams(t, longest)[1])
    want = Counter(b(g) for t in target for g in grams(t, longest)[1])
    s_all, t_all = sum(own.values()), sum(want.values())
    gain = [math.floor(1000 * math.log((want[k] + 1) * (s_all + buckets) / ((own[k] + 1) * (t_all + buckets)))) for k in range(buckets)]
    out = []
    for key, t in docs:
        w, f = grams(t, longest)
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b(g)] for g in f) // len(f) if f else 0
        out.append((key, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w) >= least))
    able = sorted((x for x in out if x[4]), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    rank = Counter()
    for k, x in enumerate(able[:len(able) * percent // 100]):
        rank[x[:4]] = k + 1
    return out, [x[:4] for x in able[:len(able) * percent // 100]]


@pytest.mark.parametrize(("longest", "buckets", "words"), [(1, 10_000, 8192), (3, 101, 3), (2, 977, 0)])
def test_resampling_equals_brute_force(spark, documents, monkeypatch, longest, buckets, words):
    monkeypatch.setattr(im, "DICTIONARY", words)
    monkeypatch.setattr(im.dictionary, "__defaults__", (words,))
    docs = [(r.doc_id, r.text) for r in documents.collect()] + [(1000 + k, f"w{k} w{k % 7} Straße " * 9 + "中文 " * k) for k in range(80)]
    target = [None, "", "w1 w2 w3 straße", "中文 " * 40, "w5 w5 w5"]
    table = spark.createDataFrame([(k, t, 1) for k, t in docs], "doc_id long, text string, rank int").repartition(3)
    got = im.resampled(table, spark.createDataFrame([(t,) for t in target], "text string"), longest=longest, buckets=buckets,
                       least_words=20, percent=30).collect()
    want, drawn = brute(docs, target, longest, buckets, 20, 30, im.SEED)
    assert sorted(map(repr, ((r.doc_id, r.n_features, r.weight, r.score) for r in got))) == sorted(repr(x[:4]) for x in want)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.doc_id, r.n_features, r.weight, r.score) for r in ranked] == drawn


def test_empty_tables(spark, documents, empty):
    bench = spark.createDataFrame([], "text string")
    assert im.resampled(empty, bench).count() == 0
    assert im.resampled(documents, bench).count() == documents.count()


def test_crcs_compose():
    rnd = np.random.default_rng(2)
    parts = [rnd.bytes(int(n)) for n in rnd.integers(0, 5000, 60)]
    a, b = parts[:30], parts[30:]
    crc = lambda xs: np.array([zlib.crc32(x) for x in xs], np.uint32)
    assert (im.composed(crc(a), crc(b), np.array([len(x) for x in b])) == crc([x + y for x, y in zip(a, b, strict=True)])).all()
