import random

import pytest

from arriero.llm import mixing
from tests.llm.helpers import edge_docs, empty_docs, frame, words


def fill(sizes, weights=(1, 2, 3), most=3):
    """Targets by resharing what is above the ceiling until nothing is."""
    names = sorted([s for s in sizes if s is not None], key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        share = sum(w[s] for s in names if s not in full)
        out = {s: most * sizes[s] if s in full else rest * w[s] / share for s in names} if share else {s: most * sizes[s] for s in names}
        above = {s for s in names if s not in full and out[s] > most * sizes[s]}
        if not above:
            return out
        full |= above


def held(rows, result):
    by = {}
    for r in result:
        by.setdefault(r.doc_id, []).append(r)
    sizes = {}
    for i, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len([w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", t or "")])
    want = fill(sizes)
    for r in result:
        assert r.taken <= 3 * r.size and (r.taken % r.size == 0 if r.size else r.taken == 0)
    return sizes, want


@pytest.mark.parametrize("bucket_rows", [mixing.BUCKET_ROWS, 3])
def test_targets_and_taken_words(spark, bucket_rows):
    rng = random.Random(4)
    rows = [(i, words(rng, rng.randint(1, 30)), "en", rng.choice(["a", "a", "a", "a", "b", "ü", None, "\U0001F600", "Z"])) for i in range(400)]
    rows += [(1000, words(rng, 3), "en", "tiny")]
    docs = frame(spark, rows)
    result = mixing.mix(docs, bucket_rows=bucket_rows).collect()
    sizes, want = held(rows, result)
    source = {i: s for i, _, _, s in rows}
    taken = {}
    for r in result:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 * max(1, want[s])
        taken[s] = taken.get(s, 0) + r.taken
    for s, t in taken.items():
        assert abs(t - want[s]) <= 30, (s, t, want[s])
    again = mixing.mix(docs.repartition(7), bucket_rows=bucket_rows).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, result))


def test_a_documents_expected_copies_do_not_depend_on_its_size(spark):
    docs = frame(spark, [(i, " ".join(["w"] * (1 + i % 7)), "en", "a" if i < 60 else "b") for i in range(120)])
    total = {}
    for seed in range(40):
        for r in mixing.mix(docs, seed=seed * 1000).where("doc_id < 60").collect():
            total.setdefault(r.size, []).append(r.taken / r.size)
    expected = mixing.mix(docs).where("doc_id < 60").selectExpr("max(target / source_size)").first()[0]
    for shares in total.values():
        assert abs(sum(shares) / len(shares) - expected) < .12


def test_edge_rows(spark):
    got = mixing.mix(edge_docs(spark)).collect()
    assert len(got) == edge_docs(spark).count() and all(r.taken == 0 for r in got if r.size == 0)
    assert {r.size for r in got if r.doc_id in (1, 2, 3)} == {0}
    assert mixing.mix(empty_docs(spark)).collect() == []
    blank = mixing.mix(frame(spark, [(1, "", "en", "a"), (2, None, "en", None)])).collect()
    assert [(r.taken, r.target) for r in blank] == [(0, 0.0), (0, 0.0)]
