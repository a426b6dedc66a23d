"""Mixing sources to target weights by pivotal dependent rounding.

A document's expected copies are its source's target over its source's size. The whole part is taken; the fractional parts of a
source are rounded together: two sides exchange words until one of them has a whole copy or none, at random such that every
document keeps its expectation and the pair its words. In a bucket of a source the largest document meets all smaller ones as one
side, then the next one does, so what stays open is a small document. The open documents of all buckets meet pairwise in a
reduction tree, and a source's words miss its target by at most half of the last one.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arriero.sinks.tables import written

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
#: Documents rounded in one task, and open documents that meet in one node of the tree.
BUCKET_ROWS, FAN_IN = 20_000, 64
MAX_FILLS = 100


def word_count(text: Column) -> Column:
    """Runs without blank, tab to carriage return; null counts 0."""
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def ordinal(df: DataFrame, *order: Column) -> DataFrame:
    """Adds ``at``, the row's place (from 0) in the given total order: range-partitioned, with offsets per partition only."""
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    placed = written(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("id", F.monotonically_increasing_id()), "ordinal")
    placed = placed.withColumn("part", F.shiftright("id", 33)).withColumn("own", F.col("id").bitwiseAND(F.lit((1 << 33) - 1)))
    offsets = placed.groupBy("part").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return placed.join(offsets.select("part", "before"), "part").withColumn("at", F.col("own") + F.col("before")).drop("id", "part", "own", "before")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, target of every source of ``sizes`` (source, size).

    Sources by code point, null last, weigh ``weights``, repeating. All words are shared by weight; a target stops at ``most``
    times its source's size and the excess goes to the others by weight until none is above.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("at") % len(weights) + 1).cast("int"))
    table = written(ordinal(total, F.asc_nulls_last("source")).select(
        "source", "source_size", "at", weight.alias("w"), (F.col("source_size") * most).cast("double").alias("cap")), "sources")
    words = table.agg(F.sum("source_size"), F.sum("w"), F.count("*")).first()
    level, full = (words[0] / words[1] if words[2] else 0.0), -1
    for _ in range(MAX_FILLS + (words[2] or 0)):  # each turn but the last fills a source
        one = table.agg(F.count_if(F.col("w") * level > F.col("cap")), F.sum(F.when(F.col("w") * level > F.col("cap"), F.col("cap"))),
                        F.sum(F.when(F.col("w") * level <= F.col("cap"), F.col("w")))).first()
        if one[0] == full or not one[2]:
            break
        full, level = one[0], (words[0] - (one[1] or 0.0)) / one[2]
    return table.select("source", "source_size", "at", F.least(F.col("cap"), F.col("w") * level).alias("target"))


def _draws(seed: int, key: tuple, n: int) -> np.ndarray:
    return np.random.default_rng([seed, *(int(k) & 0xFFFFFFFF for k in key)]).random(n)


def _snapped(mass: np.ndarray, size: np.ndarray) -> np.ndarray:
    mass = np.where(mass < 1e-6, 0.0, mass)
    return np.where(mass > size - 1e-6, size, mass)


def _exchange(x: float, room_x: float, y: float, room_y: float, draw: float) -> float:
    """Words that x gets from y (or gives, if negative) until one side is empty or full; its mean is 0."""
    up, down = min(room_x, y), min(x, room_y)
    return (up if draw * (up + down) < down else -down) if up + down > 0 else 0.0


def _spread(seed: int, last: bool):
    """Round one bucket, whose documents all expect the same share of a copy: each, from the largest on, meets the rest as one side.

    ``open`` marks the document that is left with a part of a copy.
    """

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "doc_id"], ascending=[False, True], kind="stable", na_position="last").reset_index(drop=True)
        size, draws = pdf["size"].to_numpy(float), _draws(seed, key, len(pdf))
        mass, rest, words = pdf.mass.to_numpy(float).copy(), float(size.sum()), float(pdf.mass.sum())
        for i in range(len(pdf)):
            if size[i] == 0:
                break
            own = words * size[i] / rest
            rest, words = rest - size[i], words - own
            moved = _exchange(own, size[i] - own, words, rest - words, draws[i])
            mass[i], words = own + moved, min(max(words - moved, 0.0), rest)
        mass = _snapped(mass, size)
        return _closed(pdf, mass, size) if last else pdf.assign(mass=mass, open=(mass > 0) & (mass < size))

    return run


def _closed(pdf: pd.DataFrame, mass: np.ndarray, size: np.ndarray) -> pd.DataFrame:
    """The last open document of a source goes to the nearer side, so that the source's words come as near as they can."""
    return pdf.assign(mass=np.where(mass * 2 >= size, size, 0.0), open=False)


def _pivotal(seed: int, last: bool):
    """Round open documents of several buckets: each meets the one still open, from the largest on."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "doc_id"], ascending=[False, True], kind="stable", na_position="last").reset_index(drop=True)
        size, mass, draws = pdf["size"].to_numpy(float), pdf.mass.to_numpy(float).copy(), _draws(seed, key, len(pdf))
        held = 0
        for i in range(1, len(pdf)):
            moved = _exchange(mass[held], size[held] - mass[held], mass[i], size[i] - mass[i], draws[i])
            mass[held], mass[i] = _snapped(np.array([mass[held] + moved, mass[i] - moved]), size[[held, i]])
            if not 0 < mass[held] < size[held]:
                held = i
        return _closed(pdf, mass, size) if last else pdf.assign(mass=mass, open=(mass > 0) & (mass < size))

    return run


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES, seed: int = 20240607,
        bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, size, source_size, target and taken (words the mix takes, repeats counted) for every row of ``docs`` (doc_id, text, source).

    taken is a whole number of copies, at most ``most``. Null texts and texts without words have size 0 and give nothing; a null
    source is a source of its own. Draws follow from ``seed`` and the rows, not from partitions, so reruns agree. Repeated rows are
    rounded one by one. Other columns are ignored; an empty table gives an empty result.
    """
    sizes = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size")), "sizes")
    goals = targets(sizes, weights, most)
    goals = goals.select(F.col("source").alias("s"), "source_size", "target", F.col("at").alias("rank"))
    counts = sizes.groupBy("source").agg(F.count("*").alias("n")).select(F.col("source").alias("c"), F.ceil(F.col("n") / bucket_rows).alias("buckets"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = goals.join(counts, F.col("s").eqNullSafe(F.col("c"))).drop("c")
    rows = sizes.join(plan, sizes.source.eqNullSafe(plan.s)).withColumn("rate", rate).select(
        "doc_id", "size", "source_size", "target", "rank", F.least(F.floor("rate"), F.lit(most)).alias("base"),
        ((F.col("rate") - F.floor("rate")) * F.col("size")).alias("mass"), F.pmod(F.xxhash64("doc_id", "size"), F.col("buckets")).alias("bucket"))
    schema = "doc_id long, size long, source_size long, target double, rank long, base long, mass double, bucket long"
    deepest = counts.agg(F.max("buckets")).first()[0] or 1
    done, level = None, 0
    while True:
        last = deepest == 1
        parted = written(rows.groupBy("rank", "bucket").applyInPandas((_pivotal if level else _spread)(seed + level, last), schema + ", open boolean"), "rounded")
        settled = parted.where("not open").drop("open")
        done = settled if done is None else done.union(settled)
        if last:
            break
        rows = parted.where("open").drop("open").withColumn("bucket", F.floor(F.col("bucket") / FAN_IN))
        deepest, level = -(-deepest // FAN_IN), level + 1
    copies = F.col("base") + F.when((F.col("size") > 0) & (F.col("mass") >= F.col("size")), 1).otherwise(0)
    return done.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).cast("long").alias("taken"))
