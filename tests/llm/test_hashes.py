"""Words that a polynomial modulo 2^64 cannot tell apart: every operator that hashes words tells them apart."""
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from recruitflow.llm import decontamination, importance, minhash, packing, substring_dedup, token_counts
from recruitflow.llm.common import span_hashes, text_bytes, window_hashes, word_spans

SWAP = str.maketrans("ab", "ba")


def pattern(n):
    """The Thue-Morse word of ``n`` letters, and its complement."""
    t = "a"
    while len(t) < n:
        t += t.translate(SWAP)
    return t[:n], t[:n].translate(SWAP)


@pytest.mark.parametrize("n", [1, 7, 8, 9, 255, 256, 257, 264, 1024, 2048, 4096, 9 << 20])
def test_spans(n):
    a, b = pattern(n)
    for texts in ([a, b, a], [a + "x", a + "y", a + "x"], ["x" + a, "y" + a, "x" + a], [a, a + "a", a]):
        data, offs = text_bytes(pa.array(texts))
        lo, hi, _ = word_spans(data, offs)
        h = span_hashes(data, lo, hi)
        assert h[0] == h[2] != h[1]


@pytest.mark.parametrize("length", [1, 2, 3, 10, 35, 64, 200, 1024, 5000])
def test_windows(length):
    rng = np.random.default_rng(1)
    items = rng.integers(0, 3, 70_000).astype(np.uint64)
    items[50_000:50_000 + length] = items[100:100 + length]
    got = window_hashes(items, length)
    assert len(got) == len(items) - length + 1 and got[100] == got[50_000]
    pick = rng.integers(0, len(got), 300)
    runs = [items[p:p + length].tobytes() for p in pick]
    assert len(set(zip(runs, got[pick].tolist(), strict=True))) == len(set(runs)) == len(set(got[pick].tolist()))
    a, b = (np.frombuffer(x.encode(), np.uint8).astype(np.uint64) for x in pattern(4096))
    both = window_hashes(np.concatenate([a, b]), 4096)
    assert both[0] != both[-1]


@pytest.mark.parametrize("n", [1024, 4096])
def test_operators_tell_them_apart(spark, n):
    a, b = pattern(n)
    docs = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    byte_bpe, word_bpe = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(byte_bpe)
    assert {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs.coalesce(1), byte_bpe).collect()} == {
        k: len(library.encode(t, add_special_tokens=False).ids) for k, t in ((1, a), (2, b))}
    library = Tokenizer.from_file(word_bpe)
    got = {1: [], 2: []}
    for r in sorted(packing.pack(docs.withColumn("source", docs.doc_id.cast("string")).coalesce(1), word_bpe).collect(), key=lambda r: r.start):
        got[r.doc_id] += r.ids
    assert got == {k: [*library.encode(t, add_special_tokens=False).ids, 2] for k, t in ((1, a), (2, b))}
    assert all(r.kept for r in minhash.near_classes(docs).collect())
    run = " ".join(f"w{k}" for k in range(34))
    windows = spark.createDataFrame([(1, f"{run} {a}"), (2, f"{run} {b}")], "doc_id long, text string")
    assert all(r.n_removed == 0 for r in substring_dedup.remove_repeats(windows).collect())
    bench = spark.createDataFrame([(1, a)], "item_id long, text string")
    assert {r.doc_id: r.n_hit for r in decontamination.contamination(docs, bench).collect()} == {1: 1, 2: 0}
    assert len({r.buckets for r in importance.features(docs, "doc_id", buckets=1 << 30).collect()}) == 2
