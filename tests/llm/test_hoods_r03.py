import random

import numpy as np
import pytest

from arriero.llm import blocks, jaccard_join
from tests.llm.helpers import frame, tuples, words
from tests.llm.test_jaccard_join import COLUMNS, edited, expected
from tests.llm.test_open_pairs import batch


def test_a_task_writes_less_than_a_row_for_each_set():
    crowd, same = tuple(range(1, 61)), bytes(jaccard_join.BITS // 8)
    rows = batch([crowd] * 40, 100, 10, dict.fromkeys(crowd, 40), dict.fromkeys(crowd, same))
    for most in (1000, jaccard_join.HELD_PAIRS):
        run = jaccard_join._open_pairs(80, most_held=most, reduced=blocks.spanning)
        got = [tuple(r.values()) for b in run(iter([rows])) for r in b.to_pylist()]
        assert got == [(i, 1) for i in range(2, 61)]  # 1,770 pairs before


def test_spanning_connects_what_the_pairs_connect():
    rng = np.random.default_rng(4)
    for n in (0, 1, 5, 40, 300):
        i, j = rng.integers(0, 200, n) * 7, rng.integers(0, 200, n) * 7
        label = blocks.joined(np.arange(1400), i, j)
        u, v = blocks.spanning(i, j)
        assert len(set(u.tolist())) == len(u) and (u > v).all()
        assert (blocks.joined(np.arange(1400), u, v) == label).all()


@pytest.mark.parametrize("hood_rows", [4, 300])
def test_crowds_in_small_hoods_equal_brute_force(spark, hood_rows):
    """Families at the threshold, so that many near pairs are no links, and an id with texts of two families."""
    rng = random.Random(31)
    rows = []
    for g in range(3):
        base = words(rng, 120).split()
        rows += [(100 * g + i, edited(rng, base, 3), "en", "a") for i in range(30)]
    rows += [(7, rows[40][1], "en", "a"), (150, rows[35][1], "en", "a"), (900, rows[70][1] + " end", "en", "a")]
    got = jaccard_join.join(frame(spark, rows).repartition(5), meet_rounds=1, hood_rows=hood_rows)
    assert tuples(got, *COLUMNS) == expected(rows)
