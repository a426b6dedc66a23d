import random

import numpy as np
import pytest

from arriero.llm import jaccard_join
from tests.llm.helpers import edge_docs, edge_rows, empty_docs, frame, tuples, words
from tests.llm.test_near_dup import brute

COLUMNS = ("doc_id", "n_shingles", "component_id")


def expected(rows):
    return sorted([r[:3] for r in brute(rows, 80)], key=str)


def edited(rng, words_, most):
    copy = list(words_)
    for _ in range(rng.randint(0, most)):
        copy[rng.randrange(len(copy))] = f"new{rng.randint(0, 10 ** 6)}"
    return " ".join(copy)


def test_edge_rows_equal_brute_force(spark):
    rows = edge_rows() + [(300, "one text under two ids and more", "en", "a"), (301, "one text under two ids and more", "en", "a"), (301, "quite another text that two ids share here", "en", "a"),
                          (302, "quite another text that two ids share here", "en", "a"), (7, "a text that is alone under a repeated id", "en", "a")]
    assert tuples(jaccard_join.join(frame(spark, rows).repartition(3)), *COLUMNS) == expected(rows)


def test_empty_table(spark):
    assert jaccard_join.join(empty_docs(spark)).collect() == []


@pytest.mark.parametrize("rounds", [1, 2])
def test_crowds_equal_brute_force(spark, rounds):
    """Near copies of one text near the threshold, chains, passages that many texts share, and texts made of common passages."""
    rng = random.Random(9)
    base, passage = words(rng, 100).split(), words(rng, 60).split()
    blocks = [words(rng, 25) for _ in range(6)]
    rows = [(i, edited(rng, base, 4), "en", "a") for i in range(80)]
    rows += [(100 + i, " ".join(passage) + " " + words(rng, rng.randint(5, 80)), "en", "a") for i in range(80)]
    rows += [(200 + i, " ".join(rng.sample(blocks, 4)), "en", "a") for i in range(60)]
    chain = words(rng, 60).split()
    for i in range(20):
        chain = chain[1:] + [f"link{i}"]
        rows.append((300 + i, " ".join(chain), "en", "a"))
    rows += [(400 + i, words(rng, rng.randint(1, 60)), "en", "a") for i in range(80)]
    rng.shuffle(rows)
    got = jaccard_join.join(frame(spark, rows).repartition(5), meet_rounds=rounds)
    assert tuples(got, *COLUMNS) == expected(rows)


def test_prefixes_of_linked_sets_share_what_both_ask_for():
    rng = np.random.default_rng(5)
    often = np.exp2(rng.uniform(0, 12, jaccard_join.COUNTERS))
    level = np.floor(np.log2(1 + often)).astype(np.uint8)
    asked = set()
    for _ in range(300):
        x = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 300)).astype(np.uint64))
        drop = rng.integers(0, len(x) // 9 + 1)
        y = np.unique(np.concatenate((rng.permutation(x)[drop:], rng.integers(0, 1 << 63, rng.integers(0, len(x) // 9 + 1)).astype(np.uint64))))
        common = len(np.intersect1d(x, y))
        if 100 * common >= 80 * (len(x) + len(y) - common):
            (p, m), (q, k) = jaccard_join.prefix(x, often, level, 80), jaccard_join.prefix(y, often, level, 80)
            asked |= {m, k}
            assert len(np.intersect1d(p, q)) >= min(m, k)
    assert len(asked) > 2


def test_lists_over_batches():
    import pyarrow as pa

    rows = [(1, 5), (2, 7), (2, 3), (2, 9), (4, 1), (5, 2), (5, 8), (5, 6), (5, 4), (9, 1)]
    for step in (1, 2, 3, 10):
        batches = [pa.RecordBatch.from_pydict({"token": [t for t, _ in rows[k:k + step]], "doc": [d for _, d in rows[k:k + step]], "n": [1] * len(rows[k:k + step]), "m": [1] * len(rows[k:k + step])}) for k in range(0, len(rows), step)]
        got = [tuple(r.values()) for b in jaccard_join._lists(iter(batches)) for r in b.select(["token", "doc", "first"]).to_pylist()]
        assert sorted(got) == [(2, 3, 7), (2, 7, 7), (2, 9, 7), (5, 2, 2), (5, 4, 2), (5, 6, 2), (5, 8, 2)]


def test_crowds_in_small_blocks_equal_brute_force(spark):
    """Lists of 90 members just around the threshold, dealt in parts of 20 rows."""
    rng = random.Random(14)
    base = words(rng, 90).split()
    rows = [(i, edited(rng, base, 5), "en", "a") for i in range(90)] + [(200 + i, words(rng, 30), "en", "a") for i in range(10)]
    got = jaccard_join.join(frame(spark, rows).repartition(5), meet_rounds=1, block_rows=20)
    assert tuples(got, *COLUMNS) == expected(rows)


def test_bitmaps_never_part_linked_sets():
    rng = np.random.default_rng(3)
    seen = 0
    for _ in range(400):
        x = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 4000)).astype(np.uint64))
        y = np.concatenate((rng.permutation(x)[rng.integers(0, len(x) // 6 + 1):], rng.integers(0, 1 << 63, rng.integers(0, len(x) // 6 + 1)).astype(np.uint64)))
        common = len(np.intersect1d(x, y))
        bits = [np.bincount((s >> np.uint64(20)).astype(np.int64) & (jaccard_join.BITS - 1), minlength=jaccard_join.BITS) & 1 for s in (x, y)]
        if 100 * common >= 80 * (len(x) + len(y) - common):
            seen += 1
            assert (bits[0] != bits[1]).sum() <= jaccard_join._differing(80, np.array(len(x)), np.array(len(y)))
    assert seen > 50
