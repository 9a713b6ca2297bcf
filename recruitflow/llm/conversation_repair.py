"""Operator 13, conversation structure repair by secondary-sorted streaming.

Rows are dealt by conversation and sorted by turn inside each task; one
conversation after the other then streams through ``mapInPandas``, over
the bounds of Arrow batches.  For each row the stream holds

* the dynamic programme's state: the least cost of each of four places in
  the pattern ``(s?(ua)+)?`` (start, after the system row, after a user
  row, after an assistant row), carried from row to row;
* back pointers: four bits (the places it is taken from) for each of
  Insert, Delete, Keep and Rerole that reaches a least cost, three bytes
  a row with the row's role;
* the row itself, for the repaired text.

Pointers and rows go to spooled files: in memory up to ``SPOOL`` bytes,
then in the task's temporary folder, gone with the conversation.  So a
conversation with a third of all rows needs no more memory than a short
one, but for 16 bytes a row that tell repeated rows apart; these too are
sorted out to files from ``DIGESTS`` on.

At a conversation's end a sweep back over the pointers marks the places
that lie on a cheapest path, and a walk forward takes the least letter
(D, I, K, R) among them: each letter leaves a place in one way only, so
this is the ASCII-least string of all cheapest ones.

One conversation is one task's work, whatever its length: the hash of the
repaired text is one sequence.

Faults, the first counts: blank, duplicate (role and text seen earlier in
the conversation), truncated (last character that is not white space is
none of ``.!?``).  Costs: Keep 0, Rerole to user or assistant 2, Delete 3
(the only way for blank and duplicate rows), Insert of an empty user or
assistant row 2, and 1 more for a truncated row that stays.

Defined results: null roles and texts are one space; a null turn sorts
first and counts for no gap; rows of equal turn are taken by role, then
text; a null conversation id is a conversation; a conversation without
rows after damage has zeros, an empty audit and the empty string's hash;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of rows, and of pointers, that a conversation holds in memory; digests that it holds before they are sorted out.
SPOOL, DIGESTS = 8 << 20, 1 << 20
WHITE = " \t\n\x0b\f\r"
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: Where an inserted or reroled row leads, and its role.
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
ROLE = ("user", "user", "assistant", "user")
#: Where a kept row leads, by its role's initial and place.
KEEP = {"s": {START: AFTER_S}, "u": {START: AFTER_U, AFTER_S: AFTER_U, AFTER_A: AFTER_U}, "a": {AFTER_U: AFTER_A}, "": {}}
INITIALS = "sua"
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
OK, TRUNCATED, GONE = range(3)
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
NEVER = 16
_FAR = 1 << 60
RESULT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


class Seen:
    """Digests seen in one conversation: a set, beyond ``DIGESTS`` sorted out to files of which there are at most 8."""

    def __init__(self, most: int = DIGESTS) -> None:
        self.most, self.new, self.runs = most, set(), []

    def add(self, digest: bytes) -> bool:
        """Whether the digest is there already; it is from now on."""
        if digest in self.new or any(self._in(run, digest) for run in self.runs):
            return True
        self.new.add(digest)
        if len(self.new) >= self.most:
            self._spill()
        return False

    @staticmethod
    def _in(run: np.memmap, digest: bytes) -> bool:
        x = np.array(digest, "S16")
        k = int(np.searchsorted(run, x))
        return k < len(run) and run[k] == x

    def _spill(self) -> None:
        held = [np.array(list(self.new), "S16")]
        if len(self.runs) == 8:
            held += self.runs
            self.runs = []
        with tempfile.TemporaryFile() as f:
            f.write(np.sort(np.concatenate(held)).tobytes())
            f.flush()
            self.runs.append(np.memmap(f, "S16", "r"))
        self.new = set()


def inserted(cost: list[int]) -> tuple[list[int], int]:
    """Least costs after inserts between two rows; the inserts that reach them (four bits, by the place before), and the
    places that are as cheap without (four bits)."""
    out, mask = cost[:], 0
    out[AFTER_U] = min(cost[AFTER_U], *(cost[k] + INSERT_COST for k in (START, AFTER_S, AFTER_A)))
    out[AFTER_A] = min(cost[AFTER_A], out[AFTER_U] + INSERT_COST)
    for k in range(4):
        if out[k] < _FAR and out[k] + INSERT_COST == out[NEXT[k]]:
            mask |= 1 << k
        mask |= (out[k] == cost[k]) << 4 + k
    return out, mask


@lru_cache(maxsize=1 << 16)
def stepped(cost: tuple[int, ...], initial: str, fault: int) -> tuple[list[int], int]:
    """Least costs after one row, and which of Delete, Keep, Rerole reach them: four bits each, by the place before."""
    out = [c + DELETE_COST for c in cost]
    ways = [(0, k, k, DELETE_COST) for k in range(4)]
    if fault != GONE:
        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        ways += [(1, k, to, extra) for k, to in KEEP[initial].items()]
        ways += [(2, k, NEXT[k], REROLE_COST + extra) for k in range(4)]
        for _, k, to, price in ways:
            out[to] = min(out[to], cost[k] + price)
    mask = 0
    for letter, k, to, price in ways:
        if cost[k] < _FAR and cost[k] + price == out[to]:
            mask |= 1 << 4 * letter + k
    return [min(c, _FAR) for c in out], mask


class Conversation:
    """State of the conversation that streams through."""

    def __init__(self) -> None:
        self.cost = [0, _FAR, _FAR, _FAR]
        self.pointers = tempfile.SpooledTemporaryFile(max_size=SPOOL)
        self.rows = tempfile.SpooledTemporaryFile(max_size=SPOOL)
        self.seen = Seen()
        self.n = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.most = self.last_turn = self.last = None

    def add(self, turn: int | None, role: str, text: str) -> None:
        initial = role[:1]
        if self.last is not None and (self.last, initial) not in LEGAL:
            self.illegal += 1
        self.last = initial
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.turns += self.last_turn != turn
            self.most = self.last_turn = turn
        raw = f"{role}:{text}".encode("utf-8", "surrogatepass")
        head = len(role.encode("utf-8", "surrogatepass"))
        end = text.rstrip(WHITE)[-1:]
        again = self.seen.add(hashlib.blake2b(raw, digest_size=16, salt=head.to_bytes(8, "little")).digest())
        if not end:
            self.blank, fault = self.blank + 1, GONE
        elif again:
            self.duplicate, fault = self.duplicate + 1, GONE
        elif end not in ".!?":
            self.truncated, fault = self.truncated + 1, TRUNCATED
        else:
            fault = OK
        kind = initial if initial and initial in INITIALS else ""
        after, before = inserted(self.cost)
        least = min(after)
        # any place leads on at most NEVER dearer than any other, so one that much behind is on no cheapest path
        cost, mask = stepped(tuple(c - least if c <= least + NEVER else _FAR for c in after), kind, fault)
        self.cost = [c + least if c < _FAR else _FAR for c in cost]
        kept_role = INITIALS.find(kind) + 1 if kind else 0
        self.pointers.write(bytes((mask & 255, mask >> 8 | before << 4 & 255, kept_role | before & 240)))
        self.rows.write(head.to_bytes(8, "little") + len(raw).to_bytes(8, "little") + raw)
        self.n += 1

    def result(self) -> tuple:
        """gaps, faults, cost, audit and hash of the repaired text."""
        after, closing = inserted(self.cost)
        cost = min(after[START], after[AFTER_A])
        good = sum(1 << k for k in (START, AFTER_A) if after[k] == cost)
        good, ways = self._with_inserts(good, closing)
        # sweep back: the places on a cheapest path before each row's inserts, one byte a row
        marks = tempfile.SpooledTemporaryFile(max_size=SPOOL)
        for low, high, kind in self._backwards():
            to, mask, before = good, 0, high >> 4 | kind & 240
            for letter, k, reached in self._ways(kind & 15):
                if (low | high << 8) >> 4 * letter + k & 1 and to >> reached & 1:
                    mask |= 1 << 4 * letter + k
            good, used = self._with_inserts((mask | mask >> 4 | mask >> 8) & 15, before)
            marks.write(bytes((mask & 255, mask >> 8 | used << 4, kind & 15)))
        audit, digest = [], hashlib.sha256()
        place, first = START, True

        def put(raw: bytes) -> None:
            nonlocal first
            digest.update(raw if first else b"\n" + raw)
            first = False

        self.rows.seek(0)
        for low, high, kind in self._backwards(marks):
            head = int.from_bytes(self.rows.read(8), "little")
            raw = self.rows.read(int.from_bytes(self.rows.read(8), "little"))
            mask = low | high << 8
            while True:  # inserts before the row go on until another letter is less
                letter = next(x for x in (0, 3, 1, 2) if mask >> 4 * x + place & 1)
                audit.append("DKRI"[letter])
                if letter != 3:
                    break
                put(f"{ROLE[place]}:".encode())
                place = NEXT[place]
            if letter == 1:
                put(raw)
                place = KEEP[INITIALS[kind - 1]][place]
            elif letter == 2:
                put(ROLE[place].encode() + raw[head:])
                place = NEXT[place]
        while ways >> place & 1:  # inserts after the last row
            audit.append("I")
            put(f"{ROLE[place]}:".encode())
            place = NEXT[place]
        for f in (marks, self.rows, self.pointers):
            f.close()
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, "".join(audit), digest.hexdigest())

    @staticmethod
    def _with_inserts(good: int, inserts: int) -> tuple[int, int]:
        """Places on cheapest paths before inserts, and the inserts on them, from the places after (``inserts``: see ``inserted``)."""
        used = 0
        for _ in range(2):  # at most two in a row
            for k in range(4):
                if inserts >> k & 1 and good >> NEXT[k] & 1:
                    good |= 1 << k
                    used |= 1 << k
        return good & inserts >> 4, used

    @staticmethod
    def _ways(kind: int) -> list[tuple[int, int, int]]:
        return [*((0, k, k) for k in range(4)), *((1, k, to) for k, to in KEEP[INITIALS[kind - 1] if kind else ""].items()),
                *((2, k, NEXT[k]) for k in range(4))]

    def _backwards(self, file=None) -> Iterator[tuple[int, int, int]]:
        """The file's three-byte entries from its end."""
        file, step = file or self.pointers, 3 << 16
        at = 3 * self.n
        while at:
            lo = max(0, at - step)
            file.seek(lo)
            part = file.read(at - lo)
            for k in range(len(part) - 3, -1, -3):
                yield part[k], part[k + 1], part[k + 2]
            at = lo


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """conv, turn, role, text and here of the damaged rows; a dropped row stays without text, here false, for its conversation's name."""
    kind = F.crc32(F.concat(_text(conv), F.lit(":"), _text(turn)).cast("binary")) % 20
    src = conversations.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), _text(role).alias("role"),
                               _text(text).alias("text"), kind.alias("kind"))
    body = (F.when(F.col("kind") <= 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    who = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(True), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return src.select("conv", "turn", who.alias("role"), body.alias("text"), (F.col("kind") != 0).alias("here"), copies).drop("col")


def repaired(rows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row per conversation of ``rows`` (conv, turn, role, text, here)."""
    dealt = rows.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "text")
    kind = dict(rows.dtypes)["conv"]
    names = ["conv", *(x.split()[0] for x in RESULT.split(", "))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held, out = None, None, []
        for batch in batches:
            for c, t, r, x, here in zip(
                    batch["conv"], batch["turn"], batch["role"], batch["text"], batch["here"], strict=True):
                if held is None or c != now:
                    if held is not None:
                        out.append((now, *held.result()))
                    now, held = c, Conversation()
                if here:
                    held.add(None if t is None else int(t), r, x)
            if len(out) >= 1000:
                yield pd.DataFrame(out, columns=names)
                out = []
        if held is not None:
            out.append((now, *held.result()))
        yield pd.DataFrame(out, columns=names)

    # numbers travel as strings: pandas has no whole numbers with nulls
    got = (dealt.select(F.col("conv").cast("string"), F.col("turn").cast("string"), "role", "text", "here")
           .mapInPandas(run, f"conv string, {RESULT}"))
    return got.select(F.col("conv").cast(kind).alias(conv), *names[1:])
