"""Groups of any size as blocks of bounded rows, of which every two meet in some task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a block; two blocks meet at a time.
ROWS = 4000
#: Rows of a group whose pairs are listed at once with those of other small groups.
SMALL = 48
PAIRS = 20_000


def dealt(rows: DataFrame, group: Column, n: Column, item: Column, parts: int, block_rows: int = ROWS) -> DataFrame:
    """``rows`` sorted by ``block`` in ``parts`` partitions: a group of up to ``block_rows`` rows (``n`` of them) is one block.

    A larger one is dealt by ``item``, and each two of its parts make a block, so a row is copied n / block_rows times. ``piece`` is a
    row's part; ``alone`` marks the blocks of one part, where the pairs inside a part are to be counted.
    """
    pieces = F.ceil(n / block_rows)
    own = F.pmod(F.xxhash64(item), pieces)
    of = lambda q: F.struct(F.xxhash64(group, F.least(own, q), F.greatest(own, q)).alias("block"), (own == q).alias("alone"))
    named = rows.withColumn("piece", own).withColumn("at", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), pieces - 1), of))).select("*", "at.*").drop("at")
    return named.repartition(parts, "block").sortWithinPartitions("block")


def whole(batches: Iterator[pa.RecordBatch], least_rows: int = 2000) -> Iterator[pa.Table]:
    """Tables of whole blocks, of about ``least_rows`` rows, or of one block, from batches sorted by ``block``."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        block = batch.column("block").to_numpy()
        begin = int(np.searchsorted(block, block[-1]))  # of the batch's last block, which may go on
        if begin or (held and held[-1].column("block")[-1].as_py() != block[0]):
            if rows + begin >= least_rows or rows + batch.num_rows >= 4 * least_rows:
                if rows + begin:
                    yield pa.Table.from_batches([*held, batch.slice(0, begin)])
                held, rows, batch = [], 0, batch.slice(begin)
        held.append(batch)
        rows += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


def pairs_of_small(begins: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (i, j), i < j, of all pairs inside blocks of up to SMALL rows, at most some PAIRS at a time."""
    for s in np.unique(sizes[(sizes > 1) & (sizes <= SMALL)]).tolist():
        of = begins[sizes == s]
        i, j = np.triu_indices(s, 1)
        step = max(1, PAIRS // len(i))
        for k in range(0, len(of), step):
            some = of[k: k + step, None]
            yield (some + i).ravel(), (some + j).ravel()


def slices_of_large(begins: np.ndarray, sizes: np.ndarray, cells: int = 1 << 20) -> Iterator[tuple[int, int, int]]:
    """(first row, end row, end of the block): rows of a large block that meet all rows from the first one to the block's end."""
    for b, s in zip(begins[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
        step = max(1, cells // s)
        for a in range(b, b + s, step):
            yield a, min(a + step, b + s), b + s


def spans(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First rows and sizes of the blocks."""
    begins = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
    return begins, np.diff(np.concatenate((begins, [len(block)])))


def fixed_bytes(column: pa.ChunkedArray) -> np.ndarray:
    """A matrix of the bytes of values of equal length."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), -1)


def spanning(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer than one pair for each id that connect what the pairs (i, j) of ids connect: each id with the least one it hangs together with."""
    ids, at = np.unique(np.concatenate((i, j)), return_inverse=True)
    own = np.arange(len(ids))
    label = joined(own.copy(), at[: len(i)], at[len(i):])
    other = label != own
    return ids[other], ids[label[other]]


def joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (of each row the least row it is known to be joined with) after the rows i and j are joined."""
    apart = label[i] != label[j]
    i, j = i[apart], j[apart]
    while len(i):
        a, b = label[i], label[j]  # roots; a root hooked below two others at once is hooked again in the next turn
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            further = label[label]
            if (further == label).all():
                break
            label = further
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
    return label
