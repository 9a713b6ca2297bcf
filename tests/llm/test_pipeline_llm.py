"""The pipeline's stages on a small corpus: each one's decisions take effect, columns stay those of documents."""
import random
import re
from collections import Counter

import corpus_pipeline as cp
import public_tokenizers
from tokenizers import Tokenizer

from recruitflow.llm import mixing, toxicity
from recruitflow.llm.common import written

from .test_operators_llm import brute_words, words


def corpus(spark, folder):
    rng = random.Random(9)
    vocab = [f"v{i}" for i in range(3_000)]
    passage = " ".join(rng.sample(vocab, 60))
    rows, labels = [], []
    for i in range(240):
        w = rng.choices(vocab, k=120)
        bad = i % 6 == 0
        text = " ".join(w[:60] + ["vermin", "scum"] * bad + w[60:])
        if i % 10 == 3:
            text += " " + passage
        if i % 10 == 5:
            text = rows[-1][1] + " end"  # a near copy of the document before
            bad = (i - 1) % 6 == 0
        rows.append((i, text, "en", f"s{i % 4}", len(text), "extra"))
        labels.append((i, 1, int(bad)))
    rows += [(900, None, None, None, None, None), (901, "", "en", "s1", 0, "extra")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size string")
    df.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return {i for i, _, t in labels if t}


def test_stages(spark, tmp_path):
    toxic = corpus(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in cp.STAGES:
        docs = written(stage(spark, docs, str(tmp_path)), "t")
        seen[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns
    ids = {n: {r.doc_id for r in v} for n, v in seen.items()}
    assert not ids["toxicity"] & toxic and len(ids["toxicity"]) >= 242 - len(toxic) - 3
    assert len(seen["near_dedup"]) == len(ids["near_dedup"])
    copies = {i for i in ids["toxicity"] if i % 10 == 5 and i - 1 in ids["toxicity"]}
    assert not copies & ids["near_dedup"] and ids["near_dedup"] == ids["toxicity"] - copies
    assert ids["substring_dedup"] == ids["near_dedup"]
    runs = Counter()
    for r in seen["substring_dedup"]:
        w = re.findall(r"\S+", r.text or "")
        runs.update(tuple(w[i:i + 35]) for i in range(len(w) - 34))
        assert r.n_chars == len(r.text or "")
    assert max(runs.values()) == 1
    total = sum(len(re.findall(r"\S+", r.text or "")) for r in seen["substring_dedup"])
    assert abs(sum(len(re.findall(r"\S+", r.text or "")) for r in seen["mixing"]) - 1.5 * total) <= 5
    assert sum(r.length for r in seen["packing"]) == sum({
        (r.sequence_id, r.offset): r.length for r in seen["packing"]}.values())
    out = cp.run(spark, str(tmp_path))
    assert out.count() == len(seen["packing"])


def test_empty_corpus(spark, tmp_path):
    corpus(spark, str(tmp_path / "full"))
    docs = spark.read.parquet(f"{tmp_path}/full/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, str(tmp_path / "full"))
        assert docs.count() == 0


def test_near_copies_by_five_words(spark, tmp_path):
    """One changed word of 40 is 0.756 on 5-word shingles (0.805 on 4) and stays; one of 200 goes."""
    short, long = [f"a{i}" for i in range(40)], [f"b{i}" for i in range(200)]
    texts = [short, [*short[:20], "other", *short[21:]], long, [*long[:90], "other", *long[91:]]]
    rows = [(i, " ".join(w), "en", "s", 0) for i, w in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    assert sorted(r.doc_id for r in cp.distinct(spark, docs, str(tmp_path)).collect()) == [0, 1, 2]


def near_firsts(rows, size=5):
    """Rows that stay: the first of each component of near copies, in the order of the rows."""
    low = {chr(c): chr(c + 32) for c in range(65, 91)}
    sets = []
    for r in rows:
        w = words((r.text or "").translate(str.maketrans(low)))
        sets.append(frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size
                    else frozenset([tuple(w)] if w else []))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((group[i], group[j]))
                group = [a if g == b else g for g in group]
    return [r for i, r in enumerate(rows) if group[i] == i]


def pack_tokens(rows):
    """How often each document has each token at each place, by the library; equal documents count."""
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = Counter()
    for r in rows:
        ids = t.encode(r.text or "", add_special_tokens=False).ids + [2]
        out.update((r.doc_id, len(ids), i, x) for i, x in enumerate(ids))
    return out


def piece_tokens(rows):
    return Counter((r.doc_id, r.doc_tokens, r.start + i, x) for r in rows for i, x in enumerate(r.ids))


def test_stages_against_brute_force(spark, tmp_path):
    corpus(spark, str(tmp_path))
    before = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in cp.STAGES:
        after = written(stage(spark, before, str(tmp_path)), "t")
        rows, got = before.collect(), after.collect()
        if name == "toxicity":  # the model's own answer for each id, and every column as it was
            model = toxicity.train(before, spark.read.parquet(f"{tmp_path}/labels.parquet"))
            bad = {r.doc_id for r in toxicity.score_keys(before, model).collect() if r.predicted}
            assert bad and Counter(got) == Counter(r for r in rows if r.doc_id not in bad)
        elif name == "near_dedup":
            kept = near_firsts(rows)
            assert len(kept) < len(rows) and Counter(got) == Counter(kept)
        elif name == "substring_dedup":
            left = brute_words([words(r.text) for r in rows], 35)
            rest = lambda r: (r.doc_id, r.lang, r.source, r.size)
            assert Counter((*rest(r), " ".join(words(r.text))) for r in got) == Counter(
                (*rest(r), " ".join(w)) for r, w in zip(rows, left, strict=True))
            as_was = Counter(r for r, w in zip(rows, left, strict=True) if r.text and w == words(r.text))
            assert as_was and not as_was - Counter(got)
        elif name == "mixing":  # whole documents, and first words of one taken in part
            held, _ = cp._tucked(before)
            taken = {r.doc_id: r.taken for r in mixing.allocations(held, carry=["doc_id"]).collect()}
            of, sizes, want = {r.doc_id: r for r in rows}, Counter(), Counter()
            for r in rows:
                sizes[r.source] += len(words(r.text))
                w, n = words(r.text), taken[r.doc_id]
                for k in ([len(w)] * (n // len(w)) + [n % len(w)] * (n % len(w) > 0) if w else []):
                    want[r.doc_id, r.lang, r.source, r.size, " ".join(w[:k])] += 1
            assert Counter((r.doc_id, r.lang, r.source, r.size, " ".join(words(r.text))) for r in got if words(r.text)) == want
            assert all(r.doc_id in of and r.n_chars == len(r.text or "") for r in got)
            by = Counter()
            for r in got:
                by[r.source] += len(words(r.text))
            assert abs(sum(by.values()) - 1.5 * sum(sizes.values())) <= len(sizes)
            assert all(by[s] <= 2 * sizes[s] for s in sizes)
        else:
            assert piece_tokens(got) == pack_tokens(rows)
        before = after
    assert piece_tokens(cp.run(spark, str(tmp_path)).collect()) == pack_tokens(rows)
