import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, shard string, kept string, score int"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents with nulls, empty and long texts, repeats, ties and columns named like those the operators add."""
    base = [f"w{i * 7919 % 997}" for i in range(400)]
    a = " ".join(base[:200])
    texts = {
        1: a, 2: a, 3: a.upper(), 4: a + " tail of its own", 5: " ".join(base[150:320]),
        6: None, 7: "", 8: " \n\t ", 9: "one", 10: "one", 11: "one two three", 12: "Straße naïve 中文 👍 x́ don't we'll",
        13: "loser " * 30, 14: " ".join(f"u{i}" for i in range(30_000)), 15: "x" * 5_000, 16: "ab" * 300,
        17: "<|endoftext|> in a text", 18: "line one\nline one\nline two words\n\n" * 6, 19: "  lead and trail  ",
    }
    rows = [(k, t, None if k % 5 == 0 else "en", None if k % 7 == 0 else f"s{k % 3}", None if t is None else len(t), k, "x", None, 1)
            for k, t in texts.items()]
    rows += [rows[3], (None, a, "en", "s0", 1, 1, "x", None, 1), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
