import random

import numpy as np
import pyarrow as pa

from arriero.llm import jaccard_join
from tests.llm.helpers import frame, tuples, words
from tests.llm.test_jaccard_join import COLUMNS, expected


def batch(lists, n, m, places, bits):
    """Rows (block, doc) of lists, each a block, for sets of n shingles whose rows are numbered in the order of the lists."""
    rows = [(k, d, sum(d in x for x in lists[: k + 1])) for k, x in enumerate(lists) for d in x]
    block, doc, place = (np.array(x) for x in zip(*rows))
    size = len(rows)
    return pa.RecordBatch.from_pydict({"block": block, "alone": [True] * size, "piece": np.zeros(size, np.int64), "doc": doc, "n": np.full(size, n), "m": np.full(size, m, np.int32),
                                       "c": doc, "place": place.astype(np.int32), "places": [places[d] for d in doc], "bits": [bits[d] for d in doc]})


def pairs(rows, **options):
    return [tuple(r.values()) for b in jaccard_join._open_pairs(80, **options)(iter([rows])) for r in b.to_pylist()]


def test_a_pair_of_many_lists_is_named_once():
    same = bytes(jaccard_join.BITS // 8)
    rows = batch([(1, 2, 3)] * 40, 100, 10, {1: 40, 2: 40, 3: 40}, {1: same, 2: same, 3: same})
    assert sorted(pairs(rows)) == [(1, 2), (1, 3), (2, 3)]  # 40 rows for each before
    assert set(pairs(rows, most_held=2)) == {(1, 2), (1, 3), (2, 3)}


def test_sets_with_too_few_lists_in_common_are_not_named():
    same = bytes(jaccard_join.BITS // 8)
    # sets of 2,000 with 10 matches share 188 prefix shingles or more
    few, enough = batch([(1, 2)] * 187, 2000, 10, {1: 187, 2: 187}, {1: same, 2: same}), batch([(1, 2)] * 188, 2000, 10, {1: 188, 2: 188}, {1: same, 2: same})
    assert pairs(few) == [] and pairs(enough) == [(1, 2)]


def test_asked_is_what_linked_sets_share():
    rng = np.random.default_rng(8)
    often = np.exp2(rng.uniform(0, 12, jaccard_join.COUNTERS))
    level, seen = np.floor(np.log2(1 + often)).astype(np.uint8), 0
    for _ in range(400):
        x = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 600)).astype(np.uint64))
        y = np.unique(np.concatenate((rng.permutation(x)[rng.integers(0, len(x) // 8 + 1):], rng.integers(0, 1 << 63, rng.integers(0, len(x) // 8 + 1)).astype(np.uint64))))
        common = len(np.intersect1d(x, y))
        if 100 * common >= 80 * (len(x) + len(y) - common):
            (p, m), (q, k) = jaccard_join.prefix(x, often, level, 80), jaccard_join.prefix(y, often, level, 80)
            seen += 1
            assert len(np.intersect1d(p, q)) >= jaccard_join._asked(80, *map(np.array, (len(x), m, len(y), k))) >= min(m, k)
    assert seen > 100


def test_long_texts_with_common_passages_and_ids_with_several_texts(spark):
    """Long texts near the threshold that also share passages; some ids have two texts, or one text twice."""
    rng = random.Random(21)
    passage = words(rng, 150)
    rows = []
    for g in range(4):
        base = words(rng, 1500).split()
        for i in range(12):
            copy = list(base)
            for k in rng.sample(range(len(copy)), rng.randint(20, 50)):
                copy[k] = f"new{rng.randint(0, 10 ** 6)}"
            rows.append((100 * g + i, passage + " " + " ".join(copy), "en", "a"))
    rows += [(1000 + i, passage + " " + words(rng, 1300 + 10 * i), "en", "a") for i in range(10)]
    rows += [(5, rows[30][1], "en", "a"), (105, rows[17][1], "en", "a"), (900, rows[3][1] + " end", "en", "a")]
    got = jaccard_join.join(frame(spark, rows).repartition(4), meet_rounds=1)
    assert tuples(got, *COLUMNS) == expected(rows)
