import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from arriero.llm import blocks


def test_whole_blocks_over_batches_of_any_size():
    rng = np.random.default_rng(2)
    block = np.sort(rng.integers(0, 30, 200))
    table = pa.RecordBatch.from_pydict({"block": block, "row": np.arange(200)})
    for size in (1, 3, 7, 50, 200):
        for least in (1, 10, 1000):
            got = list(blocks.whole((table.slice(k, size) for k in range(0, 200, size)), least))
            assert [r for t in got for r in t.column("row").to_pylist()] == list(range(200))
            held = [set(t.column("block").to_pylist()) for t in got]
            assert sum(map(len, held)) == len(set(block.tolist()))  # no block in two tables
    assert list(blocks.whole(iter([table.slice(0, 0)]))) == []


def test_every_two_rows_of_a_dealt_group_meet_once(spark):
    rows = spark.createDataFrame([(g, i, n) for g, n in ((1, 50), (2, 3), (3, 1)) for i in range(n)], "g long, item long, n long")
    met = {}
    for r in blocks.dealt(rows, F.col("g"), F.col("n"), F.col("item"), 4, 8).collect():
        met.setdefault(r.block, []).append(r)
    pairs = [(x.g, *sorted((x.item, y.item))) for rs in met.values() for k, x in enumerate(rs) for y in rs[:k] if x.piece != y.piece or x.alone]
    assert sorted(pairs) == sorted((g, i, j) for g, n in ((1, 50), (2, 3)) for j in range(n) for i in range(j))


def test_pairs_of_small_and_slices_of_large_cover_all():
    block = np.repeat(np.arange(6), [1, 2, 5, 48, 49, 130])
    begins, sizes = blocks.spans(block)
    got = {(i, j) for a, b in blocks.pairs_of_small(begins, sizes) for i, j in zip(a.tolist(), b.tolist())}
    for a, b, end in blocks.slices_of_large(begins, sizes, 500):
        got |= {(i, j) for i in range(a, b) for j in range(i + 1, end)}
    assert got == {(i, j) for j in range(len(block)) for i in range(j) if block[i] == block[j]}


def test_labels_of_joined_rows():
    rng = np.random.default_rng(8)
    i, j = rng.integers(0, 200, 120), rng.integers(0, 200, 120)
    label = np.arange(200)
    for k in range(0, 120, 17):
        label = blocks.joined(label, i[k: k + 17], j[k: k + 17])
    root = list(range(200))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in zip(i.tolist(), j.tolist()):
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert label.tolist() == [find(x) for x in range(200)]
