"""Operator 13: the stream against an enumeration of all edits, and damage, ties, nulls and spooled files on Spark."""
import hashlib
import itertools
import random
import re
import zlib

import pytest

from recruitflow.llm import conversation_repair as cr

SPACE = r"[\x20\x09-\x0D]"


def faults(rows):
    seen, out = set(), []
    for r, t in rows:
        m = re.sub(SPACE, "", t)
        out.append("b" if not m else "d" if (r, t) in seen else "t" if m[-1] not in ".!?" else "")
        seen.add((r, t))
    return out


def cheapest(rows, most):
    """Least (cost, audit) and its text over all edits with up to ``most`` inserts in a row."""
    fs = faults(rows)
    inserts = [c for n in range(most + 1) for c in itertools.product(("user", "assistant"), repeat=n)]
    best = (1 << 60, "", "")

    def go(i, cost, audit, out):
        nonlocal best
        if cost > best[0]:
            return
        for c in inserts:
            k, a, p = cost + 2 * len(c), audit + "I" * len(c), out + [(x, "") for x in c]
            if i == len(rows):
                if re.fullmatch("(s?(ua)+)?", "".join(x[0][:1] or " " for x in p)):
                    best = min(best, (k, a, "\n".join(f"{x}:{y}" for x, y in p)))
                continue
            (r, t), f = rows[i], fs[i]
            go(i + 1, k + 3, a + "D", p)
            if f not in ("b", "d"):
                go(i + 1, k + (f == "t"), a + "K", p + [(r, t)])
                for n in ("user", "assistant"):
                    go(i + 1, k + 2 + (f == "t"), a + "R", p + [(n, t)])

    go(0, 0, "", [])
    return best


def streamed(rows):
    c = cr.Conversation()
    for k, (r, t) in enumerate(rows):
        c.add(k, r, t)
    return c.result()


def test_cheapest_edits():
    rnd = random.Random(5)
    for n in range(150):
        rows = [(rnd.choice(["user", "assistant", "system", "tool", "", " "]), rnd.choice(["Hi.", "no", "x?", " ", "yes!\n"]))
                for _ in range(rnd.randint(0, 4 if n < 20 else 3))]
        gaps, blank, duplicate, truncated, illegal, cost, audit, digest = streamed(rows)
        want, f = cheapest(rows, 2), faults(rows)
        assert (cost, audit, digest) == (*want[:2], hashlib.sha256(want[2].encode()).hexdigest()), rows
        assert (gaps, blank, duplicate, truncated) == (0, f.count("b"), f.count("d"), f.count("t"))
        pairs = zip(rows, rows[1:], strict=False)
        assert illegal == sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") or not a[0] or not b[0] for a, b in pairs)


def test_long_conversations_spool(monkeypatch):
    rnd = random.Random(1)
    rows = [(rnd.choice(["user", "assistant", "system"]), rnd.choice([f"{k}.", f"{k}", "", "again!"])) for k in range(3000)]
    want = streamed(rows)
    monkeypatch.setattr(cr, "SPOOL", 100)
    monkeypatch.setattr(cr, "DIGESTS", 7)
    seen = cr.Seen
    monkeypatch.setattr(cr, "Seen", lambda: seen(7))
    assert streamed(rows) == want
    assert len(want[6]) >= 3000 and want[2] > 500


def damage(rows):
    out = []
    for c, t, r, x in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
        out += [(c, t, "user" if k == 4 else r, x)] * {0: 0, 3: 2}.get(k, 1)
    return out


@pytest.mark.parametrize("batch", ["10000", "3"])
def test_on_spark(spark, batch):
    rnd = random.Random(2)
    rows = [(c if c else None, rnd.choice([None, *range(6)]), rnd.choice(["user", "assistant", "system", "tool", "", None]),
             rnd.choice(["a.", "b", "c?\n", "", " ", None, "D!", "é…", "x" * 3000 + "."])) for c in range(60) for _ in range(rnd.randint(1, 7))]
    rows += rows[:5]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        table = spark.createDataFrame([(*r, 1, "y") for r in rows], "conv_id long, turn long, role string, text string, cost int, here string")
        got = {r.conv_id: tuple(r)[1:] for r in cr.repaired(cr.damaged(table)).collect()}
        assert len(got) == len({r[0] for r in rows})
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    by = {c: [] for c in got}
    for r in damage(rows):
        by[r[0]].append(r[1:])
    for c, mine in by.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        want = streamed([r[1:] for r in mine])
        turns = {r[0] for r in mine if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        assert got[c] == (gaps, *want[1:]), (c, mine)


def test_rows_that_are_all_dropped(spark):
    c = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    table = spark.createDataFrame([(c, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    got = cr.repaired(cr.damaged(table)).collect()
    assert [tuple(r) for r in got] == [(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert cr.repaired(cr.damaged(table.limit(0))).count() == 0
