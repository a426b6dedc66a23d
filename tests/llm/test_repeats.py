import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from arriero.llm import repeats
from tests.llm.helpers import edge_docs, edge_rows, empty_docs, frame, tuples, words


def brute(rows, length):
    data = [(i, (t or "").encode()) for i, t, *_ in rows]
    seen = Counter(b[k:k + length] for _, b in data for k in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                gone[k:k + length] = True
        starts = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(b) else 0
        out.append((i, len(b), int(gone.sum()), starts, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def passages():
    """Passages that many documents share, at their borders and inside, also within one document, and runs of one byte."""
    rng = random.Random(3)
    shared = [words(rng, 45) for _ in range(4)]
    rows = []
    for i in range(40):
        parts = [words(rng, rng.randint(1, 40))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(shared), words(rng, rng.randint(1, 30))]
        rows.append((i, " ".join(parts), "en", "a"))
    return rows + [(50, shared[0], "en", "a"), (51, shared[0][3:-3], "en", "a"), (52, shared[1] + shared[1], "en", "a"), (53, "é" * 150, "fr", "b"), (54, "x" * 199, "en", "a"), (55, "y" * 201, "en", "a")]


@pytest.mark.parametrize("shard_bytes", [repeats.SHARD_BYTES, 2000])
def test_passages_equal_brute_force(spark, shard_bytes):
    """With small shards one home is dealt over several, which then meet in the merge."""
    rows = passages()
    assert tuples(repeats.remove_repeats(frame(spark, rows), shard_bytes=shard_bytes)) == brute(rows, 200)


def test_edge_rows_equal_brute_force(spark):
    assert tuples(repeats.remove_repeats(edge_docs(spark))) == brute(edge_rows(), 200)


def test_empty_table(spark):
    assert repeats.remove_repeats(empty_docs(spark)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=300).map(lambda b: bytes(x % 4 for x in b)))
def test_suffix_array_and_common_prefixes(data):
    data += b"\xff"
    text = np.frombuffer(data, np.uint8)
    order = repeats.suffix_array(text, len(text) + 1)
    want = sorted(range(len(data)), key=lambda i: data[i:])
    assert order.tolist() == want
    shared = repeats.common_prefixes(text, order, len(text))
    for a, b in zip(want, want[1:]):
        n = 0
        while a + n < len(data) and b + n < len(data) and data[a + n] == data[b + n]:
            n += 1
        assert shared[b] == n
