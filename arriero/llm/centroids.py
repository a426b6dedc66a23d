"""Centroid clustering over a vector-approximation file.

Each component of a vector is kept as the number of its cell, a few bits; the cells of a dimension are even between two quantiles. Per
centroid, dimension and cell a table has the least and the greatest squared difference that a component in that cell can have, so the
sums over a vector's cells are an interval of its squared distance. A centroid whose lower end exceeds another's upper end is out.
Rounds read the approximations only; full vectors are fetched for rows with more than one centroid left, and for rows that
change their cluster, whose components move from one cluster's sums to the other's. The first assignment and the last one, which
reports distances, read every vector anyway and use the same intervals.

All arithmetic is on integers, so the result depends neither on the partitions nor on the order of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arriero.sinks.tables import written

DIMENSIONS = 64
CLUSTERS = 40
ROUNDS = 5
SEED = "2"
SCALE = 256
#: Bits of a cell number.
BITS = 7
#: Rows whose quantiles end the even cells of a dimension; what lies beyond has the two outer cells. The bounds change how often full
#: vectors are fetched, never the result.
SAMPLE_ROWS, TAILS = 20_000, (0.001, 0.999)
#: Components up to this size are computed in 64 bits without overflow: 64 squares of differences stay under 2^63.
SMALL = 1 << 27
LONG = (1 << 63) - 1


def integers(column: pa.Array, dimensions: int, small: bool) -> np.ndarray:
    """Rows of scaled and floored components; Python integers where 64 bits may not do."""
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    return (flat.astype(np.int64) if small else np.array([int(x) for x in flat], dtype=object)).reshape(-1, dimensions)


class Cells:
    """Cell numbers of components; cell j of dimension d holds the integers of [edge j, edge j + 1)."""

    def __init__(self, edges: list[list[int]], low: int, high: int, bits: int):
        self.edges, self.low, self.high, self.bits = edges, low, high, bits

    def number(self, vectors: np.ndarray) -> np.ndarray:
        out = np.zeros(vectors.shape, dtype=np.uint8)
        for d, edge in enumerate(self.edges):
            out[:, d] = np.searchsorted(np.array(edge, dtype=vectors.dtype), vectors[:, d], side="right")
        return out

    def pack(self, numbers: np.ndarray) -> list[bytes]:
        bits = np.unpackbits(numbers[:, :, None], axis=2)[:, :, 8 - self.bits:]
        return [r.tobytes() for r in np.packbits(bits.reshape(len(numbers), -1), axis=1)]

    def unpack(self, packed: list[bytes]) -> np.ndarray:
        n = len(self.edges)
        bits = np.unpackbits(np.frombuffer(b"".join(packed), dtype=np.uint8).reshape(len(packed), -1), axis=1)[:, : n * self.bits]
        full = np.zeros((len(packed), n, 8), dtype=np.uint8)
        full[:, :, 8 - self.bits:] = bits.reshape(len(packed), n, self.bits)
        return np.packbits(full, axis=2)[:, :, 0]

    def tables(self, centroids: list[list[int]], small: bool) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Per dimension the least and the greatest squared difference by (cell, centroid)."""
        least, greatest = [], []
        for d, edge in enumerate(self.edges):
            kind = np.int64 if small else object
            begin = np.array([self.low, *edge], dtype=kind)[:, None]
            end = np.array([*[e - 1 for e in edge], self.high], dtype=kind)[:, None]
            at = np.array([c[d] for c in centroids], dtype=kind)[None, :]
            under, over = begin - at, at - end
            gap = np.maximum(np.maximum(under, over), 0)
            far = np.maximum(abs(under), abs(over))
            least.append(gap * gap)
            greatest.append(far * far)
        return least, greatest


def possible(numbers: np.ndarray, tables: tuple[list[np.ndarray], list[np.ndarray]]) -> np.ndarray:
    """Whether each centroid may be a row's nearest: its interval begins no higher than the lowest end of any. Ties stay in."""
    least, greatest = tables
    kind, k = least[0].dtype, least[0].shape[1]
    low, high = np.zeros((len(numbers), k), dtype=kind), np.zeros((len(numbers), k), dtype=kind)
    for d in range(numbers.shape[1]):
        low += least[d][numbers[:, d]]
        high += greatest[d][numbers[:, d]]
    return low <= high.min(axis=1, keepdims=True)


def nearest(vectors: np.ndarray, centroids: list[list[int]], left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest of the centroids left for each row, ties to the smaller number."""
    at = np.array(centroids, dtype=vectors.dtype)
    rows, cols = np.nonzero(left)
    distance = ((vectors[rows] - at[cols]) ** 2).sum(axis=1)
    first = np.searchsorted(rows, np.arange(len(vectors)))
    least = np.minimum.reduceat(distance, first) if len(rows) else distance
    hit = np.flatnonzero(distance == least[rows])
    begins = hit[np.searchsorted(rows[hit], np.arange(len(vectors)))]
    return cols[begins], distance[begins]


def _sums(k: int, dimensions: int) -> list[int]:
    return [0] * (k * (dimensions + 1))


def _move(sums: list[int], vectors: np.ndarray, cluster: np.ndarray, k: int, sign: int) -> None:
    """Adds the rows (negative sign: takes them) to the sums of their clusters; the last k numbers are the clusters' sizes."""
    dimensions = vectors.shape[1]
    for c in np.unique(cluster).tolist():
        own = vectors[cluster == c]
        for d, x in enumerate(own.sum(axis=0).tolist()):
            sums[c * dimensions + d] += sign * int(x)
        sums[k * dimensions + c] += sign * len(own)


STATE = "uid long, cells binary, cluster int, moved array<decimal(38,0)>"


def _state(uid, cells, cluster) -> pa.RecordBatch:
    n = len(uid)
    return pa.RecordBatch.from_arrays([pa.array(uid, type=pa.int64()), pa.array(cells, type=pa.binary()), pa.array(cluster, type=pa.int32()), pa.nulls(n, pa.list_(pa.decimal128(38, 0)))],
                                      names=["uid", "cells", "cluster", "moved"])


def _moved(sums: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int32()), pa.array([[Decimal(x) for x in sums]], type=pa.list_(pa.decimal128(38, 0)))],
                                      names=["uid", "cells", "cluster", "moved"])


def _first(cells: Cells, centroids: list[list[int]], small: bool):
    """Approximations and first clusters of all vectors, and each task's sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, sums = cells.tables(centroids, small), _sums(len(centroids), len(cells.edges))
        for batch in batches:
            if batch.num_rows:
                vectors = integers(batch.column("vector"), len(cells.edges), small)
                numbers = cells.number(vectors)
                cluster, _ = nearest(vectors, centroids, possible(numbers, tables))
                _move(sums, vectors, cluster, len(centroids), 1)
                yield _state(batch.column("uid"), cells.pack(numbers), cluster)
        yield _moved(sums)

    return run


def _judged(cells: Cells, centroids: list[list[int]], small: bool):
    """Clusters from the approximations alone: ``found`` is null where more than one centroid is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = cells.tables(centroids, small)
        for batch in batches:
            if batch.num_rows:
                left = possible(cells.unpack(batch.column("cells").to_pylist()), tables)
                found = pa.array(left.argmax(axis=1).astype(np.int32), mask=left.sum(axis=1) > 1)
                yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("cells"), batch.column("cluster"), found], names=["uid", "cells", "cluster", "found"])

    return run


def _fetched(cells: Cells, centroids: list[list[int]], small: bool):
    """Clusters of rows with their full vectors, and what each task moves between the sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, sums = cells.tables(centroids, small), _sums(len(centroids), len(cells.edges))
        for batch in batches:
            if batch.num_rows:
                vectors = integers(batch.column("vector"), len(cells.edges), small)
                cluster, _ = nearest(vectors, centroids, possible(cells.number(vectors), tables))
                was = batch.column("cluster").to_numpy()
                other = was != cluster
                _move(sums, vectors[other], was[other], len(centroids), -1)
                _move(sums, vectors[other], cluster[other], len(centroids), 1)
                yield _state(batch.column("uid"), batch.column("cells"), cluster)
        yield _moved(sums)

    return run


def _last(cells: Cells, centroids: list[list[int]], small: bool):
    """Clusters and exact distances of all vectors; distances only to the centroids left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = cells.tables(centroids, small)
        for batch in batches:
            if batch.num_rows:
                vectors = integers(batch.column("vector"), len(cells.edges), small)
                cluster, distance = nearest(vectors, centroids, possible(cells.number(vectors), tables))
                if not small and max(distance) > LONG:
                    raise OverflowError("a squared distance does not fit a long")  # reaches the driver as a failed task
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster, type=pa.int32()), pa.array(distance.tolist(), type=pa.int64())], names=["vec_id", "cluster", "distance"])

    return run


def _task_moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What all sums that a task reads move, by place; places without a move are left out."""
    total: dict[int, int] = {}
    for batch in batches:
        for sums in batch.column("moved").to_pylist():
            for k, x in enumerate(sums):
                if x:
                    total[k] = total.get(k, 0) + int(x)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), type=pa.int32()), pa.array([Decimal(x) for x in total.values()], type=pa.decimal128(38, 0))], names=["at", "x"])


def _add_moves(table: DataFrame, sums: list[int]) -> None:
    moves = table.where("moved is not null").select("moved").mapInArrow(_task_moves, "at int, x decimal(38,0)")
    for r in moves.groupBy("at").agg(F.sum("x").alias("x")).collect():  # k * 65 numbers
        sums[r["at"]] += int(r["x"])


def _updated(centroids: list[list[int]], sums: list[int]) -> list[list[int]]:
    k, dimensions = len(centroids), len(centroids[0])
    sizes = sums[k * dimensions:]
    return [[x // sizes[c] for x in sums[c * dimensions: (c + 1) * dimensions]] if sizes[c] else old for c, old in enumerate(centroids)]


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, seed: str = SEED, bits: int = BITS,
            sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every row of ``vectors`` (vec_id, embedding; others are ignored).

    Components are floored after scaling; rows without exactly ``dimensions`` components, or with null or non-finite ones, are left out.
    The first centroids are the rows with the smallest hashes of ``seed``:vec_id, equal ids by their components, null ids last; with
    fewer rows than ``clusters`` all are centroids. Repeated rows are rows of their own. An empty table gives an empty result. Ties
    go to the smaller number; a cluster without rows keeps its centroid. A distance or inertia beyond 63 bits raises an error.
    """
    spark = vectors.sparkSession
    value = F.col("embedding").cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), value.alias("vector")).where((F.size("vector") == dimensions) & finite)
    base = written(rows.select(F.monotonically_increasing_id().alias("uid"), "vec_id", "vector"), "vectors")
    n, least, most = base.agg(F.count("*"), F.min(F.array_min("vector")), F.max(F.array_max("vector"))).first()
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not n:
        return spark.createDataFrame([], schema)
    low, high = int(np.floor(least * SCALE)), int(np.floor(most * SCALE))
    small = max(abs(low), abs(high)) < SMALL
    begin = base.orderBy(F.sha2(F.concat(F.lit(seed + ":"), F.col("vec_id").cast("string")), 256).asc_nulls_last(), "vector").limit(clusters).select("vector").collect()
    centroids = [[int(np.floor(x * SCALE)) for x in r.vector] for r in begin]
    sample = base.where(F.pmod(F.xxhash64("uid"), F.lit(-(-n // sample_rows))) == 0)
    ends = {r["d"]: [int(np.floor(x * SCALE)) for x in r["q"]] for r in sample.select(F.posexplode("vector").alias("d", "x")).groupBy("d").agg(
        F.percentile_approx("x", list(TAILS), 10_000).alias("q")).collect()}  # two numbers a dimension
    width = (1 << bits) - 2
    edges = [[begin + (end - begin) * j // max(width, 1) for j in range(width + 1)] for begin, end in (ends.get(d, [low, high]) for d in range(dimensions))]
    cells = Cells(edges, low, high, bits)

    sums = _sums(len(centroids), dimensions)
    if rounds:
        state = written(base.select("uid", "vector").mapInArrow(_first(cells, centroids, small), STATE), "clusters")
    for turn in range(rounds):
        _add_moves(state, sums)
        centroids = _updated(centroids, sums)
        if turn == rounds - 1:
            break
        judged = written(state.where("moved is null").select("uid", "cells", "cluster").mapInArrow(_judged(cells, centroids, small), "uid long, cells binary, cluster int, found int"), "judged")
        stays = F.coalesce(F.col("found") == F.col("cluster"), F.lit(False))
        full = judged.where(~stays).select("uid", "cells", "cluster").join(base.select("uid", "vector"), "uid")
        moves = written(full.mapInArrow(_fetched(cells, centroids, small), STATE), "moves")
        state = judged.where(stays).select("uid", "cells", "cluster", F.lit(None).cast("array<decimal(38,0)>").alias("moved")).unionByName(moves)
    placed = written(base.select("vec_id", "vector").mapInArrow(_last(cells, centroids, small), "vec_id long, cluster int, distance long"), "placed")
    own = {r["cluster"]: int(r["s"]) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # one row per cluster
    if sum(own.values()) > LONG:
        raise OverflowError("the inertia does not fit a long")
    digest = lambda c: sha256(",".join(map(str, c)).encode()).hexdigest()
    facts = spark.createDataFrame([(c, s, digest(centroids[c])) for c, s in own.items()], "cluster int, cluster_inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(sum(own.values())).cast("long").alias("inertia"), "centroid_sha256")
