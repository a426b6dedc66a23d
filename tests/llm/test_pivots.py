import math
import random

import pytest
from pyspark.sql import functions as F

from arriero.llm import pivots
from tests.llm.helpers import tuples

ROWS = "vec_id long, embedding array<float>, label int, score long, rank int, block long"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 5, 6, 7) for i, v in rows], ROWS)


def brute(rows, k=5):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.setdefault(i, []).append([math.floor(256 * x) for x in v])
    out = []
    for q in good:
        if q % 50 == 0:
            best = sorted([(-max(sum(a * b for a, b in zip(good[q][0], v)) for v in vs), i) for i, vs in good.items() if i != q])[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out, key=str)


def vectors(n=400, width=8, seed=1):
    import numpy as np
    rng = random.Random(seed)
    hot = [rng.gauss(0, 1) for _ in range(width)]
    rows = []
    for i in range(n):
        v = [h + rng.gauss(0, .05) for h in hot] if i % 3 == 0 else [rng.gauss(0, 1) for _ in range(width)]
        rows.append((i, [float(np.float32(x)) for x in v]))
    return rows


@pytest.mark.parametrize("blocks", [(pivots.BLOCK_ROWS, pivots.QUERY_ROWS), (7, 3)])
def test_equals_brute_force(spark, blocks):
    """A third of all vectors lies around one point; equal vectors tie."""
    rows = vectors() + [(1000 + i, [1.0] * 8) for i in range(12)] + [(2000, [0.0] * 8), (2001, [1e3] * 8)]
    got = pivots.top_k(table(spark, rows).repartition(5), F.col("vec_id") % 50 == 0, block_rows=blocks[0], query_rows=blocks[1])
    assert tuples(got) == brute(rows)


def test_odd_vectors_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [1.0]), (6, []), (None, [1.0, 1.0]), (7, [-1.0, -1.0]), (50, [0.001, -0.001])]
    assert tuples(pivots.top_k(table(spark, rows), F.col("vec_id") % 50 == 0)) == brute(rows)


def test_empty_one_and_no_query(spark):
    query = F.col("vec_id") % 50 == 0
    assert pivots.top_k(table(spark, []), query).collect() == []
    assert pivots.top_k(table(spark, [(0, [1.0])]), query).collect() == []
    assert pivots.top_k(table(spark, [(1, [1.0]), (2, [1.0])]), query).collect() == []
    assert pivots.top_k(table(spark, [(0, None), (50, [None])]), query).collect() == []


def test_repeated_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [2.0, 0.0]), (4, [1.5, 0.0])]
    assert tuples(pivots.top_k(table(spark, rows), F.col("vec_id") % 50 == 0)) == [(0, 1, 3, 131072), (0, 2, 4, 98304)]


@pytest.mark.parametrize("blocks", [(pivots.BLOCK_ROWS, pivots.QUERY_ROWS), (3, 2)])
def test_an_id_repeated_more_often_than_k_takes_one_place(spark, blocks):
    """Six rows of id 3, of different scores, are among the best of every query."""
    rows = vectors(60) + [(3, [5.0 + i / 10] * 8) for i in range(6)] + [(1000, [4.0] * 8)] * 7
    got = pivots.top_k(table(spark, rows).repartition(3), F.col("vec_id") % 50 == 0, block_rows=blocks[0], query_rows=blocks[1])
    assert tuples(got) == brute(rows)
    few = [(0, [1.0, 0.0])] + [(3, [2.0, 0.0])] * 6 + [(i, [1.0, i / 100]) for i in range(4, 8)]
    assert len(pivots.top_k(table(spark, few), F.col("vec_id") % 50 == 0).collect()) == 5


def test_bounds_hold():
    import numpy as np
    rng = np.random.default_rng(2)
    for _ in range(50):
        x, v, c = rng.normal(size=(3, 6)) * 100, rng.normal(size=6) * 100, rng.normal(size=6) * 100
        far = np.sqrt(((v - c) ** 2).sum())
        assert (pivots._bounds(x, c, far - 1, far + 1, np.sqrt((v ** 2).sum())) >= x @ v).all()


def test_large_components_are_exact(spark):
    """Scores beyond 2^53, which doubles round, keep their order and their last digit."""
    rows = vectors(120) + [(150, [4e6] + [0.5] * 7), (151, [4e6] + [0.50390625] * 7), (152, [4e6, 1.0]), (153, [-4e6]), (200, [0.0, 1e13])]
    got = pivots.top_k(table(spark, rows).repartition(3), F.col("vec_id") % 50 == 0, block_rows=7, query_rows=3)
    want = brute([(r.vec_id, r.embedding) for r in table(spark, rows).collect()])
    assert tuples(got) == want and sum(abs(r[3]) > 2 ** 53 for r in want) > 6 and any(r[2] == 200 for r in want)


def test_scores_beyond_a_long_raise(spark):
    rows = vectors(60) + [(100, [1e15] * 8), (101, [1e15] * 8), (102, [1e300])]
    with pytest.raises(Exception, match="62 bits"):
        pivots.top_k(table(spark, rows), F.col("vec_id") % 50 == 0).collect()


def test_the_least_vector_of_a_repeated_query_id_asks(spark):
    rows = vectors(80) + [(50, [9.0] * 8), (50, [-9.0] * 8)]
    first = [r for r in rows if r[0] != 50] + sorted([r for r in rows if r[0] == 50], key=lambda r: [math.floor(256 * x) for x in r[1]])
    for parts in (1, 6):
        assert tuples(pivots.top_k(table(spark, rows).repartition(parts), F.col("vec_id") % 50 == 0)) == brute(first)
