import random
import re

import numpy as np
import pytest

from arriero.llm import near_dup
from arriero.llm.graph import components
from tests.llm.helpers import LOWER, edge_docs, edge_rows, empty_docs, frame, tuples, words


def brute(rows, percent=75):
    """Component by doc_id; rows that share an id are one node."""
    sets = []
    for i, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append((i, frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])))
    root = {i: i for i, _ in sets if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(sets)):
        for b in range(a):
            (i, x), (j, y) = sets[a], sets[b]
            if i is not None and j is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return sorted([(i, len(s), None if i is None else find(i), i is None or find(i) == i) for i, s in sets], key=str)


COLUMNS = ("doc_id", "n_shingles", "component_id", "kept")


def test_edge_rows_equal_brute_force(spark):
    assert tuples(near_dup.near_duplicates(edge_docs(spark)), *COLUMNS) == brute(edge_rows())


def test_empty_table(spark):
    assert near_dup.near_duplicates(empty_docs(spark)).select(*COLUMNS).collect() == []


@pytest.mark.parametrize("block_rows", [near_dup.BLOCK_ROWS, 5])
def test_groups_of_near_copies_equal_brute_force(spark, block_rows):
    """A base with many copies that are near it but not near each other, chains, and a third of all rows in one group."""
    rng = random.Random(8)
    rows, base = [], words(rng, 120).split()
    for i in range(60):
        copy = list(base)
        for _ in range(rng.randint(0, 5)):
            copy[rng.randrange(len(copy))] = f"new{rng.randint(0, 10 ** 6)}"
        rows.append((i, " ".join(copy), "en", "a"))
    chain = words(rng, 60).split()
    for i in range(20):
        chain = chain[1:] + [f"link{i}"]
        rows.append((100 + i, " ".join(chain), "en", "a"))
    rows += [(200 + i, words(rng, rng.randint(1, 60)), "en", "a") for i in range(80)]
    rng.shuffle(rows)
    got = near_dup.near_duplicates(frame(spark, rows).repartition(5), block_rows=block_rows)
    assert tuples(got, *COLUMNS) == brute(rows)


def test_a_row_of_another_size_does_not_part_two_candidates(spark):
    """Rows 1 and 3 share two minima and their size in every tree; rows of other sizes sort between them."""
    sign = lambda third: np.tile(np.array([5, 5, third, 0, 0], ">u4"), near_dup.TREES).tobytes()
    rows = [(1, 200, sign(1)), (2, 500, sign(2)), (4, 20, sign(3)), (3, 200, sign(4))]
    got = near_dup.candidates(spark.createDataFrame(rows, "rep long, n_shingles long, signature binary"))
    found = dict(tuples(components(got.toDF("u", "v"))))
    assert found.get(1, -1) == found.get(3, -3)


def test_a_passage_in_documents_of_many_lengths(spark):
    """Pairs of near copies of a passage that 150 longer documents hold too."""
    rng = random.Random(12)
    passage = words(rng, 150).split()
    rows = [(1000 + i, " ".join(passage + words(rng, rng.randint(60, 300)).split()), "en", "a") for i in range(150)]
    for i in range(6):
        copy = list(passage)
        copy[20 + 20 * i] = f"changed{i}"
        rows.append((i, " ".join(copy), "en", "a"))
    assert tuples(near_dup.near_duplicates(frame(spark, rows).repartition(5)), *COLUMNS) == brute(rows)


def test_linked_pairs():
    rng = np.random.default_rng(1)
    xs = [np.unique(rng.integers(0, 60, n).astype(np.uint64)) for n in rng.integers(0, 50, 40)]
    meet = lambda x, y: len(set(x) | set(y)) > 0 and 100 * len(set(x) & set(y)) >= 30 * len(set(x) | set(y))
    i, j = near_dup.linked(xs, None, 30)
    assert set(zip(i.tolist(), j.tolist())) == {(a, b) for a in range(40) for b in range(a + 1, 40) if meet(xs[a], xs[b])}
    i, j = near_dup.linked(xs[:15], xs[15:], 30)
    assert set(zip(i.tolist(), j.tolist())) == {(a, b) for a in range(15) for b in range(25) if meet(xs[a], xs[15 + b])}


def test_components_of_long_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 200)] + [(7, 7), (None, 3), (500, 400)]
    got = dict(tuples(components(spark.createDataFrame(edges, "u long, v long"))))
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 300)}, 500: 400, 400: 400}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_an_id_with_several_texts_joins_their_components(spark):
    rng = random.Random(6)
    a, b, c, d = (words(rng, 40) for _ in range(4))
    rows = [(3, a), (5, a), (5, b), (9, b), (9, c), (7, d), (8, d), (8, ""), (2, c + " end"), (11, words(rng, 30)), (11, words(rng, 30))]
    got = near_dup.near_duplicates(frame(spark, [(i, t, "en", "s") for i, t in rows]))
    assert tuples(got, *COLUMNS) == brute(rows) and {r.component_id for r in got.collect() if r.doc_id in (2, 3, 5, 9)} == {2}


def test_a_crowd_around_a_passage_is_no_neighbourhood(spark):
    """300 documents at a third of similarity to each other: hardly a candidate, though most share minima; the near copies are found."""
    rng = random.Random(21)
    passage = words(rng, 70).split()
    rows = [(i, " ".join(passage + words(rng, 70).split()), "en", "a") for i in range(300)]
    rows += [(1000 + i, rows[i][1] + " end", "en", "a") for i in range(0, 300, 50)]
    docs = frame(spark, rows).repartition(5)
    marks = near_dup.sketches(docs).withColumnRenamed("doc_id", "rep")
    few = tuples(near_dup.candidates(marks, block_rows=40))
    assert {(1000 + i, i) for i in range(0, 300, 50)} <= set(few) and len(few) < 20
    assert tuples(near_dup.near_duplicates(docs), *COLUMNS) == brute(rows)


def test_recall_at_the_threshold_beside_a_crowd(spark):
    """Pairs at similarity 0.75 to 0.8 among documents that share a passage with them: all are candidates of some block."""
    rng = random.Random(33)
    passage = words(rng, 60).split()
    rows = [(i, " ".join(passage + words(rng, 90).split()), "en", "a") for i in range(400)]
    for i in range(120):
        w = rows[i][1].split()
        for k in range(3):
            w[20 + 45 * k] = f"other{i}x{k}"
        rows.append((1000 + i, " ".join([*w, *words(rng, 3).split()]), "en", "a"))
    got = tuples(near_dup.near_duplicates(frame(spark, rows).repartition(6)), *COLUMNS)
    assert got == brute(rows) and sum(r[0] >= 1000 and r[2] < 1000 for r in got) >= 100
