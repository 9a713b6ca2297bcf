"""op8's preparation of a chunk: names, sampled positions, strings out of their reach."""

import numpy as np
import pytest

from recruitflow.llm import suffix_dedup


def test_a_pass_makes_only_the_sums_its_keys_need():
    """Each of the six passes over a chunk prepares it anew: the first one needs one base's sums."""
    data = np.frombuffer(np.random.default_rng(3).bytes(5_000), np.uint8)
    names = suffix_dedup.Prefixes(data)
    a, b = np.array([0, 700, 4_900]), np.array([57, 900, 5_000])
    first = names.name(a, b)
    assert list(names.made) == [0]
    assert len(set(first) | set(names.name(a, b, 0, 1))) == 6 and sorted(names.made) == [0, 1]
    again = suffix_dedup.Prefixes(np.concatenate([data[:3], data]))
    assert list(again.name(a + 3, b + 3)) == list(first)


@pytest.mark.parametrize("gram", [1, 5, 8, 9, 25, 40])
def test_sampled_positions_follow_the_bytes(gram):
    rng = np.random.default_rng(gram)
    one = rng.integers(0, 256, 70_000, dtype=np.uint8)
    texts = [one, np.zeros(0, np.uint8), one[:gram], one[:max(0, gram - 1)], one[100:40_000], one]
    offs = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
    at, text = suffix_dedup.sampled(np.concatenate(texts), offs, gram, 28)
    assert all(offs[k] <= p and p + gram <= offs[k + 1] for p, k in zip(at, text, strict=True))
    mine = [at[text == k] - offs[k] for k in range(len(texts))]
    assert list(mine[0]) == list(mine[5]) and 0.01 < len(mine[0]) / len(one) < 0.08
    inner = mine[0][(mine[0] >= 100) & (mine[0] + gram <= 40_000)] - 100
    assert list(inner) == list(mine[4]) and not len(mine[1]) and not len(mine[3])


def test_starts_left_out_of_all_ranges():
    rng = np.random.default_rng(5)
    for _ in range(50):
        offs = np.concatenate([[0], np.cumsum(rng.choice([0, 3, 9, 10, 11, 60], 6))])
        starts = [p for k in range(6) for p in range(offs[k], offs[k + 1] - 9)]
        lo, hi, inside = [], [], set()
        for k in range(6):
            p, last = offs[k], offs[k + 1] - 10
            while p <= last:
                p, to = p + int(rng.integers(0, 9)), 0
                to = min(p + int(rng.integers(0, 9)), last)
                if p <= to:
                    lo.append(p)
                    hi.append(to)
                    inside |= set(range(p, to + 1))
                p = max(p, to) + 1
        got = suffix_dedup.left_out(offs, 10, np.array(lo, np.int64), np.array(hi, np.int64))
        assert list(got) == [p for p in starts if p not in inside]
