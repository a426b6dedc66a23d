import hashlib
import math
import random

import numpy as np
import pytest

from arriero.llm import centroids
from tests.llm.helpers import tuples

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance string, uid int, cells int"


def brute(rows, k, rounds, dims=64):
    kept = [(i, [math.floor(256 * float(x)) for x in e]) for i, e in rows if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    at = [e for _, e in order[:k]]
    assign = lambda: [min((sum((x - y) ** 2 for x, y in zip(e, c)), j) for j, c in enumerate(at)) for _, e in kept]
    for _ in range(rounds):
        own = assign()
        for j in range(len(at)):
            members = [e for (_, e), (_, c) in zip(kept, own) if c == j]
            if members:
                at[j] = [sum(x) // len(members) for x in zip(*members)]
    own = assign()
    inertia = {j: sum(d for d, c in own if c == j) for j in range(len(at))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return sorted([(i, c, d, inertia[c], sum(inertia.values()), digest[c]) for (i, _), (d, c) in zip(kept, own)], key=str)


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, e, "x", "y", 7, 8) for i, e in rows], schema)


COLUMNS = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def float32(xs):
    return [float(np.float32(x)) for x in xs]


def some(rng, n, spread=0.3, middles=6):
    middle = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(middles)]
    return [(i, float32(m + rng.gauss(0, spread) for m in rng.choice(middle))) for i in range(n)]


def awkward():
    rng = random.Random(2)
    rows = some(rng, 150)
    bad = [(900, None), (901, []), (902, rows[0][1][:63]), (903, rows[0][1] + [0.0]), (904, [None] + rows[0][1][1:]), (905, [float("nan")] + rows[0][1][1:]), (906, [float("inf")] + rows[0][1][1:])]
    return rows + bad + [rows[3]] * 20 + [(None, rows[5][1]), (7, rows[8][1]), (7, rows[7][1]), (950, [0.0] * 64), (951, [-0.0] * 64)]


@pytest.mark.parametrize("k, rounds, bits", [(40, 5, centroids.BITS), (7, 3, 2), (300, 2, 4), (5, 0, 6)])
def test_rows_equal_brute_force(spark, k, rounds, bits):
    rows = awkward()
    got = centroids.cluster(table(spark, rows).repartition(4), clusters=k, rounds=rounds, bits=bits, sample_rows=50)
    assert tuples(got, *COLUMNS) == brute(rows, k, rounds)


def test_large_components_are_exact(spark):
    rng = random.Random(6)
    rows = [(i, [x * 6e5 for x in e]) for i, e in some(rng, 40, 0.001)]
    got = centroids.cluster(table(spark, rows, SCHEMA.replace("float", "double")), clusters=4, rounds=3)
    assert tuples(got, *COLUMNS) == brute(rows, 4, 3)
    with pytest.raises(Exception, match="does not fit a long"):
        centroids.cluster(table(spark, [(i, [x * 1e9 for x in e]) for i, e in rows], SCHEMA.replace("float", "double")), clusters=4, rounds=1).count()


def test_empty_table(spark):
    assert centroids.cluster(table(spark, [(1, [0.5])])).collect() == [] and centroids.cluster(table(spark, [])).columns == list(COLUMNS)


def test_cells_pack_and_bound():
    rng = np.random.default_rng(3)
    vectors = rng.integers(-500, 500, (200, 64))
    for bits in (1, 3, 6, 8):
        edges = [sorted(rng.integers(-500, 500, (1 << bits) - 1).tolist()) for _ in range(64)]
        cells = centroids.Cells(edges, -500, 499, bits)
        numbers = cells.number(vectors)
        assert (cells.unpack(cells.pack(numbers)) == numbers).all()
        at = rng.integers(-500, 500, (9, 64)).tolist()
        left = centroids.possible(numbers, cells.tables(at, True))
        distance = ((vectors[:, None, :] - np.array(at)[None]) ** 2).sum(axis=2)
        assert left[np.arange(200), distance.argmin(axis=1)].all()
        assert (centroids.nearest(vectors, at, left)[0] == distance.argmin(axis=1)).all()


def test_rounds_fetch_few_vectors():
    """With clusters apart the intervals alone decide."""
    rng = np.random.default_rng(4)
    at = rng.integers(-200, 200, (8, 64))
    own = rng.integers(0, 8, 400)
    vectors = at[own] + rng.integers(-8, 9, (400, 64))
    edges = [np.quantile(vectors[:, d], np.arange(1, 64) / 64).astype(int).tolist() for d in range(64)]
    cells = centroids.Cells(edges, int(vectors.min()), int(vectors.max()), 6)
    left = centroids.possible(cells.number(vectors), cells.tables(at.tolist(), True))
    assert (left.sum(axis=1) == 1).mean() > 0.95 and (left.argmax(axis=1)[left.sum(axis=1) == 1] == own[left.sum(axis=1) == 1]).all()
