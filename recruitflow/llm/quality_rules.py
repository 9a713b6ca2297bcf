"""Operator 1, quality rules [native]: a threshold table compiled into one Spark projection.

``measure`` computes all counts of a text with built-in functions only;
``verdict`` folds a table of ``Rule`` rows (count, bound, ratio in
hundredths of another count) into one boolean expression.  No shuffle,
no user function: one pass over the rows, whatever their number.

Defined results: a null text counts as empty (no words, rejected by the
base rule); extra columns pass through ``apply_rules`` unchanged.
Windows of eight words are compared by a 64-bit hash of the word hashes
inside one text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, SPACES

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30

#: Common function words of the corpus languages.
STOP_WORDS = (
    "the of and a in to is it that for as was with be by on not he his but at are this have from or had "
    "le la les de des un une et est que dans en du il qui pour sur au par avec "
    "der die das und ist ein eine zu den von mit dem auf für im nicht des sich als auch "
    "el los las y un una por con del se lo su para es al como más o"
).split()

#: As they stand in running text: lower case, or with a capital at the start of a sentence.
STOP_FORMS = sorted({*STOP_WORDS, *(w[0].upper() + w[1:] for w in STOP_WORDS)})


@dataclass(frozen=True)
class Rule:
    """``value`` must lie in [``low``, ``high``] hundredths of ``per``; an open end is None."""

    value: str
    per: str
    low: int | None = None
    high: int | None = None


#: The threshold table.  All comparisons are in whole numbers.
RULES = (
    Rule("word_chars", "n_words", 150, 2000),
    Rule("n_symbols", "n_words", None, 15),
    Rule("n_upper", "word_chars", None, 40),
    Rule("n_marks", "n_words", None, 20),
    Rule("n_dup_lines", "n_lines", None, 35),
    Rule("n_stop_words", "n_words", 2, None),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is evaluated once per row (a lambda variable is never inlined)."""
    return F.transform(F.array(value), body)[0]


def _only(text: Column, chars: str) -> Column:
    """``text`` without every character outside the class ``chars``."""
    return F.regexp_replace(text, f"[^{chars}]+", "")


def _repeat_words(words: Column, window: int) -> Column:
    """Words covered by windows that occur twice or more in the text."""

    def covered(marks: Column) -> Column:
        # marks: (hash, start) sorted; keep starts whose hash equals a neighbour's
        n = F.size(marks)
        hit = F.filter(
            F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.when(
                ((k > 0) & (F.get(marks, k - 1)["h"] == F.get(marks, k)["h"]))
                | ((k < n - 1) & (F.get(marks, k + 1)["h"] == F.get(marks, k)["h"])),
                F.get(marks, k)["i"])),
            lambda i: i.isNotNull())
        return let(F.sort_array(hit), lambda p: F.aggregate(
            p, F.struct(F.lit(0).alias("n"), F.lit(-(1 << 30)).alias("to")),
            lambda acc, i: F.struct(
                (acc["n"] + i + F.lit(window) - F.greatest(acc["to"], i)).alias("n"),
                (i + F.lit(window)).alias("to")),
            lambda acc: acc["n"]))

    def windows(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(hashes) - window),
                           lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(window)]))

    def repeats(runs: Column) -> Column:
        marks = F.sort_array(F.transform(runs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(runs)) == F.size(runs), F.lit(0)).otherwise(let(marks, covered))

    return F.when(F.size(words) < window + 1, F.lit(0)).otherwise(
        let(F.transform(words, lambda w: F.xxhash64(w)), lambda hashes: let(windows(hashes), repeats)))


def _by_words(words: Column) -> Column:
    return F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        _repeat_words(words, WINDOW).cast("long").alias("n_repeat_words"),
        F.size(F.filter(words, lambda w: w.isin(STOP_FORMS))).cast("long").alias("n_stop_words"),
    )


def _by_lines(lines: Column) -> Column:
    return F.struct(F.size(lines).cast("long").alias("n_lines"),
                    (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))


def measure(text: Column) -> Column:
    """Struct of all counts of one text."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, SPACE_CLASS), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    return F.struct(
        let(_only(text, f"{SYMBOLS}A-Z!?"), lambda few: F.struct(
            F.length(_only(few, SYMBOLS)).cast("long").alias("n_symbols"),
            F.length(_only(few, "A-Z")).cast("long").alias("n_upper"),
            F.length(_only(few, "!?")).cast("long").alias("n_marks"))).alias("c"),
        let(words, _by_words).alias("w"),
        let(lines, _by_lines).alias("l"),
    )


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """The threshold table as one boolean expression."""
    out = F.lit(True)
    for r in rules:
        if r.low is not None:
            out = out & (F.col(r.value) * 100 >= F.lit(r.low) * F.col(r.per))
        if r.high is not None:
            out = out & (F.col(r.value) * 100 <= F.lit(r.high) * F.col(r.per))
    return out


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
OWN = (*COUNTS, "n_upper", "n_marks", "n_stop_words", "n_lines", "base_failed", "kept")


def apply_rules(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with all counts, ``base_failed`` and ``kept``; clashing names of ``docs`` are replaced."""
    m = docs.withColumn("__m", measure(F.col(text)))
    own = m.select(
        *[c for c in m.columns if c not in OWN and c != "__m"],
        "__m.c.*", "__m.w.*", "__m.l.*")
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    return own.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & verdict(rules))
