"""Operator 11 against brute force: windows, items, longest matches, several blocks, odd tables."""
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recruitflow.llm import decontamination as dc
from recruitflow.llm.common import letter_words, text_bytes

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def brute(text, items, length=10):
    w, hit, found = words(text), set(), set()
    for name, item in items:
        v = words(item)
        n = min(len(v), length)
        for i in range(len(v) - n + 1 if n else 0):
            for j in range(len(w) - n + 1):
                if w[j:j + n] == v[i:i + n]:
                    hit.update(range(j, j + n))
                    found.add(name)
    return len(w), len(hit), sorted(str(x) for x in found if x is not None)


def corpus():
    rnd = random.Random(11)
    v = [f"w{k}" for k in range(40)]
    items = [(k, " ".join(rnd.choices(v, k=rnd.randint(11, 40)))) for k in range(12)]
    items += [(100, "one two"), (101, None), (102, " .,; "), (7, "straße naïve 中文"), (None, " ".join(v[:12])), (103, items[0][1]),
              (104, "aa " * 30), (105, "x")]
    docs = [None, "", " - ", "X!", "Aa aa  aa", "aa " * 25, "ONE, two; one", items[0][1], items[1][1].upper().replace(" ", " - "),
            "Straße NAÏVE", "straße Naïve 中文 naïve", " ".join(v[:12]), " ".join(v[:9]), "long " * 3000 + items[2][1] + " end" * 3000]
    for _ in range(60):
        a = rnd.choice(items[:12])[1].split()
        i = rnd.randrange(len(a))
        docs.append(" ".join(rnd.choices(v, k=rnd.randint(0, 30)) + a[i:i + rnd.randint(5, 25)] + rnd.choices(v, k=3)))
    return [(k, t) for k, t in enumerate(docs)] + [(3, "X!"), (None, items[3][1])], items


@pytest.mark.parametrize("block", [1 << 19, 60])
def test_contamination_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(dc, "BLOCK_WORDS", block)
    monkeypatch.setattr(dc, "SEGMENT", 16 if block == 60 else 4096)
    rows, items = corpus()
    docs = spark.createDataFrame([(k, t, "a", 5) for k, t in rows], "doc_id long, text string, items string, n_hit int").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = dc.contamination(docs, bench).collect()
    assert sorted(map(repr, (r.doc_id for r in got))) == sorted(repr(k) for k, _ in rows)
    want = sorted(repr((k, *brute(t, items))) for k, t in rows)
    assert sorted(repr((r.doc_id, r.n_words, r.n_hit, list(r["items"]))) for r in got) == want
    assert all(r.n_items == len(r["items"]) and r.contaminated == (r.n_hit > 0) for r in got)
    left = dc.clean(docs, bench)
    assert left.columns == docs.columns
    assert sorted(repr(r.doc_id) for r in left.collect()) == sorted(repr(k) for k, t in rows if not brute(t, items)[1])


def test_empty_tables(spark, documents, empty):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert dc.contamination(empty, bench).count() == 0
    got = dc.contamination(documents, bench.limit(0)).agg(F.sum("n_hit"), F.count("*")).first()
    assert tuple(got) == (0, documents.count())
    assert dc.longest_matches(documents, bench.limit(0)).count() == 0


def test_longest_matches(spark):
    rnd = random.Random(3)
    v = [f"w{k}" for k in range(5)]
    item = rnd.choices(v, k=60)
    docs = [rnd.choices(v, k=5) + item[i:i + n] + rnd.choices(v, k=4) for i, n in ((0, 14), (5, 30), (40, 20), (8, 9))]
    got = dc.longest_matches(spark.createDataFrame([(k, " ".join(d)) for k, d in enumerate(docs)], "doc_id long, text string"),
                             spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()

    def longest(i):
        return max((next((n for n in range(60) if i + n >= 60 or j + n >= len(d) or item[i + n] != d[j + n]), 60))
                   for d in docs for j in range(len(d)))

    want = {i: longest(i) for i in range(60) if longest(i) >= 10}
    assert {r.item_word: r.n_words for r in got} == want
    for r in got:
        assert docs[r.doc_id][r.doc_word:r.doc_word + r.n_words] == item[r.item_word:r.item_word + r.n_words]


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array_is_sorted(seed):
    rnd = random.Random(seed)
    texts = [" ".join(rnd.choices("ab" if seed % 2 else "abcxy", k=rnd.randint(0, 60))) for _ in range(20)] + ["a " * 300, "a " * 200]
    hashed, at = letter_words(*text_bytes(pa.array(texts)))
    vocabulary = np.unique(letter_words(*text_bytes(pa.array(["a b c"])))[0])
    numbers = dc.numbered(hashed, vocabulary)
    run = dc.runs_of(numbers, at)
    got = dc.suffix_array(numbers, run, 2).tolist()
    want = sorted(np.flatnonzero(run >= 2).tolist(), key=lambda p: (numbers[p:p + run[p]].tolist(), p))
    assert got == want
