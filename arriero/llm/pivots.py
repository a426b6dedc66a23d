"""Exact top-k by inner product over a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance to it; sorted by that key, consecutive rows form blocks, each an
annulus around a pivot. Queries, in blocks too, first meet the annuli next to their own key, which gives each a k-th best score.
An annulus whose best conceivable score (triangle inequality on the pivot distance, and the largest norm in it) is below that
score is never visited; the others are visited in the order of their bounds, until no bound reaches the k-th best score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arriero.sinks.tables import written

#: Pivots, and the rows they are chosen from (the first by a hash of the id). Every row is indexed.
PIVOTS, SAMPLE_ROWS = 32, 2_000
#: Rows of an annulus block and of a query block, blocks that a task visits, and blocks next to a query block that seed its bounds.
BLOCK_ROWS, QUERY_ROWS, VISIT_BLOCKS, SEED_BLOCKS = 512, 256, 32, 2
_SLACK = 1e-6


def integer_vectors(rows: DataFrame, key: str, vector: str, scale: int = 256) -> DataFrame:
    """id and v, floor(scale * x) of every component; rows without an id, or with a null or non-finite component, are left out.

    From 2^52 on a double is an integer already, so it is not floored through a long, which would cut it off.
    """
    x = F.col(vector).cast("array<double>")
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).where(sound).select(
        F.col(key).cast("long").alias("id"), F.transform(x, lambda c: F.when(F.abs(c * scale) < 2.0 ** 52, F.floor(c * scale).cast("double")).otherwise(c * scale)).alias("v"))


def _padded(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def choose_pivots(vectors: DataFrame, pivots: int = PIVOTS, sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, int]:
    """(pivots, width): points far from each other, picked from a bounded sample; the width is the longest vector's."""
    width = vectors.agg(F.max(F.size("v"))).first()[0] or 0
    sample = vectors.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("v").toPandas().v
    x = _padded(sample.tolist(), width)
    if not len(x):
        return np.zeros((0, width)), width
    picked, far = [0], ((x - x[0]) ** 2).sum(1)
    while len(picked) < min(pivots, len(x)) and far.max() > 0:
        picked.append(int(np.argmax(far)))
        far = np.minimum(far, ((x - x[picked[-1]]) ** 2).sum(1))
    return x[picked], width


def _keyed(centres: np.ndarray, width: int):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            x = _padded(pdf.v.tolist(), width)
            square = (x ** 2).sum(1)
            apart = np.sqrt(np.maximum(square[:, None] + (centres ** 2).sum(1)[None, :] - 2 * x @ centres.T, 0))
            own = apart.argmin(1) if len(x) else np.zeros(0, int)
            yield pd.DataFrame({"id": pdf.id, "pivot": own.astype(np.int32), "far": apart[np.arange(len(x)), own], "norm": np.sqrt(square), "v": [r.tobytes() for r in x]})

    return run


def _packed(rows: int):
    """Consecutive rows of one pivot in sorted order become a block."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in parts:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            rest, out = None, []
            for pivot, one in pdf.groupby("pivot", sort=False):
                last = pivot == pdf["pivot"].iloc[-1]
                for a in range(0, len(one), rows):
                    part = one.iloc[a: a + rows]
                    if last and a + rows >= len(one):
                        rest = part
                    else:
                        out.append(_block(part))
            yield pd.DataFrame(out, columns=_BLOCK_COLUMNS)
        if rest is not None and len(rest):
            yield pd.DataFrame([_block(rest)], columns=_BLOCK_COLUMNS)

    return run


_BLOCK = "block long, pivot int, low double, high double, norm double, n int, ids binary, vectors binary"
_BLOCK_COLUMNS = [c.split(" ")[0] for c in _BLOCK.split(", ")]


def _block(pdf: pd.DataFrame) -> tuple:
    first, last = int(pdf.id.iloc[0]), int(pdf.id.iloc[-1])
    name = hash((int(pdf["pivot"].iloc[0]), float(pdf.far.iloc[0]), first, last, len(pdf))) & 0x7FFFFFFFFFFFFFFF
    return (name, int(pdf["pivot"].iloc[0]), float(pdf.far.min()), float(pdf.far.max()), float(pdf.norm.max()), len(pdf), pdf.id.to_numpy(np.int64).tobytes(), b"".join(pdf.v))


def blocks(vectors: DataFrame, centres: np.ndarray, width: int, rows: int) -> DataFrame:
    """The index: range-partitioned by (pivot, distance, id), so a pivot with most of the vectors is many partitions."""
    keyed = vectors.mapInPandas(_keyed(centres, width), "id long, pivot int, far double, norm double, v binary")
    parts = max(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return keyed.repartitionByRange(parts, "pivot", "far", "id").sortWithinPartitions("pivot", "far", "id").mapInPandas(_packed(rows), _BLOCK)


def _arrays(ids: bytes, vectors: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(ids, np.int64)
    return own, np.frombuffer(vectors, np.float64).reshape(len(own), width)


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -score))[:k]


def _bounds(x: np.ndarray, centre: np.ndarray, low: float, high: float, norm: float) -> np.ndarray:
    """The largest inner product each query could have with a vector in the annulus: q.v = (|q|² + |v|² - |q - v|²) / 2 and |q|·|v|."""
    own = np.sqrt((x ** 2).sum(1))
    far = np.sqrt(((x - centre) ** 2).sum(1))
    gap = np.maximum(np.maximum(low - far, far - high) - _SLACK * (1 + own + norm + np.sqrt((centre ** 2).sum())), 0)
    with np.errstate(all="ignore"):
        bound = np.minimum((own ** 2 + norm ** 2 - gap ** 2) / 2, own * norm) + _SLACK * (1 + own * norm)
    return np.where(np.isnan(bound), np.inf, bound)  # squares beyond a double exclude nothing


def _once(score: np.ndarray, ids: np.ndarray, none) -> np.ndarray:
    """The scores with ``none`` in place of all but the best of each row's repeated ids."""
    order = np.lexsort((-score, ids), axis=1)
    named = np.take_along_axis(ids, order, 1)
    row, col = np.nonzero(named[:, 1:] == named[:, :-1])
    out = score.copy()
    out[row, order[row, col + 1]] = none
    return out


def _recount(score: np.ndarray, x: np.ndarray, y: np.ndarray, asks: np.ndarray, own: np.ndarray) -> None:
    """Products that may have left 64 bits on the way, once more in whole numbers of any size; a score of 62 bits or more raises."""
    with np.errstate(all="ignore"):
        size = np.sqrt((x[asks] ** 2).sum(1))[:, None] * np.sqrt((y ** 2).sum(1))[None, :]
    for i, j in zip(*np.nonzero(~(size < 2.0 ** 62) & ~own[asks])):
        exact = sum(int(a) * int(b) for a, b in zip(x[asks[i]].tolist(), y[j].tolist()))
        if abs(exact) >= 2 ** 62:
            raise OverflowError("a score exceeds 62 bits")
        score[asks[i], j] = exact


def _visit(width: int, k: int, centres: np.ndarray):
    """One query block against some data blocks, in the order of their bounds, until none can change a query's best k ids."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for q in left.itertuples():
            qids, x = _arrays(q.q_ids, q.q_vectors, width)
            floor = np.frombuffer(q.q_floors, np.float64) if q.q_floors is not None else np.full(len(qids), -np.inf)
            most = np.sqrt((x ** 2).sum(1)).max(initial=0) * max(right.norm.max(), 0) if len(right) else 0.0  # no product or partial sum is larger
            number = np.float64 if most < 2.0 ** 52 else np.int64  # doubles are exact and faster up to here
            x_own, none = x.astype(number), -np.inf if number is np.float64 else np.int64(-(2 ** 62))
            found_ids, found = np.zeros((len(qids), 0), np.int64), np.zeros((len(qids), 0), number)
            bound = np.array([_bounds(x, centres[b.pivot], b.low, b.high, b.norm) for b in right.itertuples()]).reshape(len(right), len(qids))
            kth = floor.copy()
            for at in np.argsort(-bound.max(1), kind="stable"):
                asks = np.flatnonzero(bound[at] >= kth)
                if not len(asks):
                    continue
                ids, y = _arrays(right["ids"].iloc[at], right.vectors.iloc[at], width)
                score = np.full((len(qids), len(ids)), none, number)
                score[asks] = x_own[asks] @ y.astype(number).T
                own = ids[None, :] == qids[:, None]
                if number is np.int64:
                    _recount(score, x, y, asks, own)
                score[own] = none
                both, names = np.concatenate((found, score), 1), np.concatenate((found_ids, np.broadcast_to(ids, score.shape)), 1)
                if len(np.unique(ids)) < len(ids) or np.isin(ids, found_ids).any():
                    both = _once(both, names, none)
                best = np.lexsort((names, -both), axis=1)[:, :k]
                found, found_ids = np.take_along_axis(both, best, 1), np.take_along_axis(names, best, 1)
                if found.shape[1] == k:
                    kth = np.maximum(kth, np.where(found[:, -1] == none, -np.inf, found[:, -1].astype(float)))
            row, col = np.nonzero(found != none)
            out.append(pd.DataFrame({"q_block": q.q_block, "query_id": qids[row], "vec_id": found_ids[row, col], "score": found[row, col].astype(np.int64)}))
        return pd.concat(out) if out else pd.DataFrame({"q_block": [], "query_id": [], "vec_id": [], "score": []}).astype("int64")

    return run


_FOUND = "q_block long, query_id long, vec_id long, score long"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(rows: DataFrame, queries: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: int = 256,
          pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score: for each row where ``queries`` holds, the ``k`` other rows with the highest integer inner product.

    Exact; ties go to the smaller id; fewer than k rows give all of them. Null vectors and those with a null or non-finite component
    take no part, shorter vectors count as padded with zeros, and rows that repeat a query's id count as the query's own row. Rows
    that repeat another id count once, with their best score; where rows of one id could all ask, the least vector does. Scores are exact;
    one of 62 bits or more raises an error. An empty table or no query gives an empty result.
    """
    spark = rows.sparkSession
    vectors = written(integer_vectors(rows, key, vector, scale), "vectors")
    centres, width = choose_pivots(vectors, pivots)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not len(centres):
        return empty
    index = written(blocks(vectors, centres, width, block_rows), "index")
    asked = integer_vectors(rows.where(queries), key, vector, scale).groupBy("id").agg(F.min("v").alias("v"))
    asked = written(blocks(asked, centres, width, query_rows).select(*[F.col(c).alias("q_" + c) for c in _BLOCK_COLUMNS]), "queries")
    outline = index.select("block", "pivot", "low", "high", "norm")

    # seeds: for each query block the annuli of its own pivot next to its own distances
    middle = F.abs((F.col("low") + F.col("high")) / 2 - (F.col("q_low") + F.col("q_high")) / 2)
    seeds = asked.select("q_block", "q_pivot", "q_low", "q_high").join(outline, F.col("q_pivot") == F.col("pivot")).select("q_block", "block", middle.alias("apart"))
    seeds = seeds.withColumn("r", F.row_number().over(Window.partitionBy("q_block").orderBy("apart", "block"))).where(F.col("r") <= SEED_BLOCKS).select("q_block", "block")
    none = F.lit(None).cast("binary")
    first = written(_visited(asked.withColumn("q_floors", none), index, seeds, width, k, centres), "seeds")
    kth = _ranked(first, k).groupBy("query_id").agg(F.min("score").alias("kth"), F.count("*").alias("n")).where(F.col("n") == k)

    # bounds: every query block with every annulus outline, kept if one of its queries might find a better row there
    floors = asked.select("q_block", "q_ids").mapInPandas(_listed, "q_block long, query_id long").join(kth, "query_id", "left").groupBy("q_block").agg(
        F.map_from_entries(F.collect_list(F.struct("query_id", F.coalesce(F.col("kth").cast("double"), F.lit(float("-inf")))))).alias("kths"))
    primed = written(asked.join(floors, "q_block").mapInPandas(_primed, "q_block long, q_pivot int, q_low double, q_high double, q_norm double, q_n int, q_ids binary, q_vectors binary, q_floors binary"), "primed")
    meets = primed.select("q_block", "q_ids", "q_vectors", "q_floors", F.explode(F.sequence(F.lit(0), F.lit(len(centres) - 1))).alias("p")).join(
        outline, F.col("p") == F.col("pivot")).mapInPandas(_reached(width, centres), "q_block long, block long")
    meets = written(meets.join(seeds, ["q_block", "block"], "left_anti"), "meets")
    found = _visited(primed, index, meets, width, k, centres).union(first)
    return _ranked(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _listed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in parts:
        for r in pdf.itertuples():
            ids = np.frombuffer(r.q_ids, np.int64)
            yield pd.DataFrame({"q_block": np.full(len(ids), r.q_block), "query_id": ids})


def _primed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in parts:
        floors = [np.array([dict(kths)[i] for i in np.frombuffer(ids, np.int64).tolist()]).tobytes() for ids, kths in zip(pdf.q_ids, pdf.kths)]
        yield pdf.drop(columns="kths").assign(q_floors=floors)


def _reached(width: int, centres: np.ndarray):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            keep = []
            for r in pdf.itertuples():
                _, x = _arrays(r.q_ids, r.q_vectors, width)
                keep.append(bool((_bounds(x, centres[r.pivot], r.low, r.high, r.norm) >= np.frombuffer(r.q_floors, np.float64)).any()))
            yield pdf.loc[np.array(keep, dtype=bool), ["q_block", "block"]]

    return run


def _visited(asked: DataFrame, index: DataFrame, pairs: DataFrame, width: int, k: int, centres: np.ndarray) -> DataFrame:
    """The pairs' query blocks and data blocks meet in groups of one query block and a bounded number of data blocks."""
    count = pairs.groupBy("q_block").agg(F.ceil(F.count("*") / VISIT_BLOCKS).alias("groups"))
    dealt = pairs.join(count, "q_block").select("q_block", "block", F.pmod(F.xxhash64("block"), F.col("groups")).alias("part"))
    left = asked.join(dealt.select("q_block", "part").distinct(), "q_block").select("q_block", "part", "q_ids", "q_vectors", "q_floors")
    right = index.join(dealt, "block").select(F.col("q_block").alias("r_block"), F.col("part").alias("r_part"), "pivot", "low", "high", "norm", "ids", "vectors")
    return left.groupBy("q_block", "part").cogroup(right.groupBy("r_block", "r_part")).applyInPandas(_visit(width, k, centres), _FOUND)
