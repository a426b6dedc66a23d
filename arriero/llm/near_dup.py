"""Near-duplicate documents by an LSH forest over MinHash signatures.

Every document's shingle set gets ``trees`` x ``levels`` minima, and as many more of which a byte each is kept as marks. A tree is
one order of all signatures; rows that share at least ``least_depth`` values at its top are neighbours, whatever rows stand between
them. Around a passage that many documents share most neighbours are far under the threshold, so neighbours become candidates only if
their sizes allow a link and their marks agree as often as those of near copies do. Rows connected by candidates form a neighbourhood;
within it every pair is decided exactly on the full sets, so a link needs no direct adjacency. A neighbourhood too large for one task
is cut into regions: per tree, rows that share a prefix, as deep as it takes for the region to fit. What stays apart from its
neighbourhood's main component is then compared, in blocks, with all of that neighbourhood.

Identical sets are one class from the start, so copies cost nothing beyond an aggregate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arriero.llm import blocks
from arriero.llm.graph import components
from arriero.llm.prefilter import with_possible_match
from arriero.llm.ragged import CHUNK_BYTES, chunks, mixed, shingle_sets
from arriero.sinks.tables import written

WIDTH = 5
TREES = 16
LEVELS = 5
LEAST_DEPTH = 2
#: How far under their usual number the equal marks of a candidate may be, in deviations: that loses some 1e-8 of the pairs at the threshold.
DEVIATIONS = 5.5
#: Rows and text bytes that are decided together.
BLOCK_ROWS = 300
BLOCK_BYTES = 2 << 20
#: Trees whose regions are decided in a neighbourhood that is too large for one block.
REGION_TREES = 3


def _sketcher(width: int, minima: int):
    rng = np.random.default_rng(7)
    factors = rng.integers(0, 1 << 63, 2 * minima, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 1 << 63, 2 * minima, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in chunks(batch.column("text")):
                sets = shingle_sets(data, offsets, width)
                sizes = np.array([len(s) for s in sets])
                full = np.flatnonzero(sizes)
                low, high = np.zeros(b - a, np.uint64), np.zeros(b - a, np.uint64)
                signature, marks = np.zeros((b - a, minima), dtype=">u4"), np.zeros((b - a, 2 * minima), np.uint8)
                if len(full):
                    flat = np.concatenate([sets[i] for i in full])
                    at = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
                    low[full] = np.add.reduceat(flat, at)
                    high[full] = np.add.reduceat(mixed(flat + np.uint64(1)), at)
                    for k in range(2 * minima):
                        least = np.minimum.reduceat(flat * factors[k] + shifts[k], at) >> np.uint64(32)
                        marks[full, k] = mixed(least) >> np.uint64(56)
                        if k < minima:
                            signature[full, k] = least
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(a, b - a), pa.array(sizes.astype(np.int64)), pa.array(low.view(np.int64)), pa.array(high.view(np.int64)),
                    pa.array(np.diff(offsets)), pa.array([r.tobytes() for r in signature], type=pa.binary()), pa.array([r.tobytes() for r in marks], type=pa.binary()),
                ], names=["doc_id", "n_shingles", "low", "high", "n_bytes", "signature", "marks"])

    return run


def sketches(docs: DataFrame, width: int = WIDTH, trees: int = TREES, levels: int = LEVELS) -> DataFrame:
    """doc_id, n_shingles, (low, high) as the set's 128-bit identity, n_bytes, the signature and the marks: one pass over the whole texts, no shuffle."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _sketcher(width, trees * levels), "doc_id long, n_shingles long, low long, high long, n_bytes long, signature binary, marks binary")


def least_marks(percent: int, marks: int) -> int:
    """Equal marks that two sets at the threshold have but for a deviation of DEVIATIONS times the usual one."""
    p = percent / 100
    return max(1, int(marks * (p - DEVIATIONS * (p * (1 - p) / marks) ** 0.5)))


def _near_in_blocks(percent: int):
    """Rows sorted by block to links (u, v): each row to the least row that pairs with enough equal marks join it to in the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks.whole(batches):
            rep, n = table.column("rep").to_numpy(), table.column("n_shingles").to_numpy()
            marks = blocks.fixed_bytes(table.column("marks"))
            by_mark = np.ascontiguousarray(marks.T)
            least = least_marks(percent, len(by_mark))
            begins, sizes = blocks.spans(table.column("block").to_numpy())
            label = np.arange(len(rep))
            for i, j in blocks.pairs_of_small(begins, sizes):
                fit = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
                i, j = i[fit], j[fit]
                near = (marks[i] == marks[j]).sum(axis=1) >= least
                label = blocks.joined(label, i[near], j[near])
            for a, b, end in blocks.slices_of_large(begins, sizes):
                equal = np.zeros((b - a, end - a), np.uint16)
                for mark in by_mark:
                    equal += mark[a:b, None] == mark[None, a:end]
                near = (equal >= least) & (100 * np.minimum(n[a:b, None], n[None, a:end]) >= percent * np.maximum(n[a:b, None], n[None, a:end]))
                i, j = np.nonzero(near)
                label = blocks.joined(label, i + a, j + a)
            other = rep != rep[label]
            yield pa.RecordBatch.from_arrays([pa.array(rep[other]), pa.array(rep[label][other])], names=["u", "v"])

    return run


def candidates(classes: DataFrame, trees: int = TREES, levels: int = LEVELS, least_depth: int = LEAST_DEPTH, percent: int = 75, block_rows: int = blocks.ROWS) -> DataFrame:
    """Distinct pairs (a, b), a > b, that connect class representatives as their neighbours in some tree do.

    ``classes``: rep, n_shingles, signature, and marks (without them the signature's bytes are the marks). Neighbours are rows that
    share ``least_depth`` minima of a tree; every two of them, of sizes that allow the threshold, are candidates if enough of their
    marks are equal. Most rows have no neighbour; only the others carry their marks along, and a large region is dealt in blocks.
    """
    parts = max(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    marked = classes if "marks" in classes.columns else classes.withColumn("marks", F.col("signature"))
    of_tree = lambda t: F.xxhash64(t, F.substring("signature", t * (4 * levels) + 1, F.lit(4 * least_depth)))
    rows = marked.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), of_tree)).alias("region"), "rep")
    regions = rows.groupBy("region").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(rows.join(regions, "region"), "neighbours")
    carried = shared.join(marked.select("rep", "n_shingles", "marks"), "rep")
    near = blocks.dealt(carried, F.col("region"), F.col("n"), F.col("rep"), parts, block_rows).select("block", "rep", "n_shingles", "marks")
    return near.mapInArrow(_near_in_blocks(percent), "u long, v long").select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).where("a != b").distinct()


def _sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for _, _, data, offsets in chunks(pa.array(texts, type=pa.large_string()), CHUNK_BYTES):
        out += shingle_sets(data, offsets, width)
    return out


def linked(xs: list[np.ndarray], ys: list[np.ndarray] | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) with 100 |x_i ∩ y_j| >= percent |x_i ∪ y_j|; without ``ys`` the pairs i < j of ``xs``.

    Intersections are products of 0/1 matrices over the shared shingles, a slice of them at a time.
    """
    own = ys is None
    sets = xs if own else [*xs, *ys]
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate(([True], flat[1:] != flat[:-1])) if len(flat) else np.zeros(0, bool)
    code = np.cumsum(new) - 1
    shared = np.bincount(code, minlength=1)[code] > 1 if len(code) else np.zeros(0, bool)
    owner, code = owner[shared], code[shared]
    cut = len(xs)
    common = np.zeros((cut, cut if own else len(ys)), dtype=np.float32)
    if len(code):
        code = np.cumsum(np.concatenate(([0], (code[1:] != code[:-1]).astype(np.int64))))
        step = 4096
        for low in range(0, int(code[-1]) + 1, step):
            a, b = np.searchsorted(code, [low, low + step])
            grid = np.zeros((len(sets), step), dtype=np.float32)
            grid[owner[a:b], code[a:b] - low] = 1
            common += grid[:cut] @ (grid[:cut] if own else grid[cut:]).T
    common = np.rint(common).astype(np.int64)
    union = sizes[:cut, None] + (sizes[:cut] if own else sizes[cut:])[None, :] - common
    hit = (100 * common >= percent * union) & (union > 0)
    return np.nonzero(np.triu(hit, 1) if own else hit)


def _decide_blocks(width: int, percent: int):
    """Links inside each block as (row, least row of its component in the block)."""

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, pdf in batch.groupby("block", sort=False):
            rep = pdf.rep.to_numpy()
            root = list(range(len(pdf)))

            def find(i):
                while root[i] != i:
                    root[i] = root[root[i]]
                    i = root[i]
                return i

            order = np.argsort(rep, kind="stable")
            rep = rep[order]
            i, j = linked(_sets(pdf.text.to_numpy()[order].tolist(), width), None, percent)
            for a, b in zip(i.tolist(), j.tolist()):
                a, b = find(a), find(b)
                root[max(a, b)] = min(a, b)
            for a in np.flatnonzero(rep[1:] == rep[:-1]).tolist():  # texts that share an id
                x, y = find(a), find(a + 1)
                root[max(x, y)] = min(x, y)
            out.append(pd.DataFrame({"u": rep, "v": rep[[find(i) for i in range(len(rep))]]}))
        return pd.concat(out) if out else pd.DataFrame({"u": [], "v": []}).astype("int64")

    return run


def _decide_two(width: int, percent: int):
    """Links between the rows left over (left) and all rows (right) of one pair of blocks."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"u": [], "v": []}).astype("int64")
        i, j = linked(_sets(left.text.tolist(), width), _sets(right.text_r.tolist(), width), percent)
        u, v = blocks.spanning(left.rep.to_numpy()[i], right.c_r.to_numpy()[j])  # no more links than rows and components
        return pd.DataFrame({"u": u, "v": v}).astype("int64")

    return run


def decided_blocks(rows: DataFrame, width: int, percent: int, block_bytes: int) -> DataFrame:
    """``_decide_blocks`` over rows (rep, text, n_bytes, block), many small blocks to a task."""
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    tasks = max(1, -(-total // block_bytes))
    return rows.select("rep", "text", "block", F.pmod(F.xxhash64("block"), F.lit(tasks)).alias("task")).groupBy("task").applyInPandas(
        _decide_blocks(width, percent), "u long, v long")


def _regions(crowd: DataFrame, tree: int, levels: int, block_rows: int) -> DataFrame:
    """A block for each row of ``crowd`` (rep, hood, n_bytes, signature): its hood's rows with one prefix of ``tree``.

    The depth adapts: a region of more than ``block_rows`` rows goes one minimum deeper, and at the last one it is dealt by rep.
    """
    cut = crowd.select("rep", "hood", *[
        F.substring("signature", tree * 4 * levels + 1, 4 * d).alias(f"r{d}") for d in range(1, levels + 1)])
    depths = sorted({1, (levels + 1) // 2, levels})
    block, crowded = F.xxhash64("hood", f"r{levels}", F.pmod(F.xxhash64("rep"), F.ceil(F.col(f"c{levels}") / block_rows))), cut
    for d in reversed(depths):
        crowded = crowded.join(cut.groupBy("hood", f"r{d}").agg(F.count("*").alias(f"c{d}")), ["hood", f"r{d}"])
        block = F.when(F.col(f"c{d}") <= block_rows, F.xxhash64("hood", f"r{d}", F.lit(d))).otherwise(block)
    return crowded.select("rep", F.xxhash64(block, F.lit(tree)).alias("block"))


def _large_hoods(crowd: DataFrame, rows: DataFrame, width: int, percent: int, levels: int, block_rows: int, block_bytes: int, trees: int) -> DataFrame:
    """Links (u, v) of neighbourhoods that no single block can hold. ``crowd``: rep, hood, signature; ``rows``: rep, hood, n_bytes, text."""
    regions = None
    for tree in range(min(trees, REGION_TREES)):
        one = _regions(crowd, tree, levels, block_rows)
        regions = one if regions is None else regions.union(one)
    parts = rows.select("rep", "n_bytes", "text").join(regions, "rep")
    links = written(decided_blocks(parts, width, percent, block_bytes), "regions")
    found = written(components(links), "regional")
    state = written(rows.select("rep", "hood", "n_bytes", "text").join(found, F.col("rep") == F.col("node"), "left").select(
        "rep", "hood", "n_bytes", "text", F.coalesce("component", "rep").alias("c")), "state")
    return found.select(F.col("node").alias("u"), F.col("component").alias("v")).union(rest_with_all(state, width, percent, block_rows))


def rest_with_all(state: DataFrame, width: int, percent: int, block_rows: int) -> DataFrame:
    """Links (u, v) that join the components in a hood: what is not of its largest one meets all of the hood, in blocks.

    ``state``: rep, hood, text and c, the component known so far; it is read several times.
    """
    sizes = state.groupBy("hood", "c").agg(F.count("*").alias("n"))
    main = sizes.groupBy("hood").agg(F.max_by("c", F.struct("n", "c")).alias("main"), F.sum("n").alias("rows"))
    dealt = lambda df, n: F.pmod(F.xxhash64("rep"), F.ceil(n / block_rows))
    named = state.join(main, "hood")
    every = named.withColumn("kr", dealt(named, F.col("rows")))
    left = state.join(main.select("hood", F.col("main").alias("m"), F.col("rows").alias("all")), "hood").where("c != m")
    lefts = left.groupBy("hood").agg(F.count("*").alias("rest"), F.first("all").alias("r"))
    left = left.join(lefts, "hood").withColumn("kl", dealt(left, F.col("rest")))
    left = left.select("rep", "text", "hood", "kl", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("all") / block_rows) - 1).cast("long"))).alias("kr"))
    right = every.join(lefts.select("hood", "rest"), "hood").select(
        F.col("rep").alias("rep_r"), F.col("text").alias("text_r"), F.col("c").alias("c_r"), F.col("hood").alias("hood_r"), F.col("kr").alias("kr_r"), F.explode(F.sequence(F.lit(0), (F.ceil(F.col("rest") / block_rows) - 1).cast("long"))).alias("kl_r"))
    return left.groupBy("hood", "kl", "kr").cogroup(right.groupBy("hood_r", "kl_r", "kr_r")).applyInPandas(_decide_two(width, percent), "u long, v long")


def near_duplicates(docs: DataFrame, percent: int = 75, width: int = WIDTH, trees: int = TREES, levels: int = LEVELS,
                    least_depth: int = LEAST_DEPTH, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and n_bytes for every row of ``docs`` (doc_id, text; other columns are ignored).

    Texts are linked if 100 |A ∩ B| >= percent |A ∪ B| on their full shingle sets (A-Z lower-cased words; fewer than ``width``
    words form one shingle). component_id is the least doc_id reachable. Different texts under one doc_id count as one node and join
    their components. Null
    and empty texts and texts without words have n_shingles 0 and link with nothing. Repeated rows stay repeated rows of one
    component; a null doc_id links with nothing and has a null component. An empty table gives an empty result.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marks = written(sketches(texts, width, trees, levels), "sketches")
    # copies: one class per identical set; its least doc_id stands for it
    classes = written(marks.where("n_shingles > 0 and doc_id is not null").groupBy("low", "high", "n_shingles").agg(
        F.min_by(F.struct("signature", "marks", "n_bytes"), "doc_id").alias("one"), F.min("doc_id").alias("rep")).select(
        "low", "high", "n_shingles", "rep", "one.signature", "one.marks", "one.n_bytes"), "classes")
    hoods = components(candidates(classes, trees, levels, least_depth, percent).select(F.col("a").alias("u"), F.col("b").alias("v")))
    members = classes.join(hoods.select(F.col("node").alias("rep"), F.col("component").alias("hood")), "rep").select("rep", "hood", "n_bytes", "signature")
    crowds = members.groupBy("hood").agg(F.count("*").alias("rows"), F.sum("n_bytes").alias("bytes"))
    placed = written(members.join(crowds, "hood").withColumn("large", (F.col("rows") > block_rows) | ((F.col("bytes") > block_bytes) & (F.col("rows") > 2))), "placed")
    maybe = with_possible_match(texts, "doc_id", placed, "rep", "maybe").where("maybe")  # most texts have no candidate and need no shuffle
    held = written(maybe.join(placed.select("rep", "hood", "n_bytes", "large"), F.col("doc_id") == F.col("rep")).select("rep", "hood", "n_bytes", "large", "text"), "held")
    small = written(decided_blocks(held.where("not large").select("rep", "text", "n_bytes", F.col("hood").alias("block")), width, percent, block_bytes), "decided")
    links = small.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    if placed.where("large").limit(1).count():
        crowd = placed.where("large").select("rep", "hood", "signature")
        links = links.union(components(_large_hoods(crowd, held.where("large"), width, percent, levels, block_rows, block_bytes, trees)))
    # a doc_id with several texts is one node: its classes become one component
    several = written(marks.where("doc_id is not null").groupBy("doc_id").agg(
        F.min(F.xxhash64("low", "high", "n_shingles")).alias("least"), F.max(F.xxhash64("low", "high", "n_shingles")).alias("most")).where("least != most").select(
        F.col("doc_id").alias("node")), "several")
    if several.limit(1).count():
        split = with_possible_match(marks, "doc_id", several, "node", "maybe").where("maybe").join(several, F.col("doc_id") == F.col("node")).where("n_shingles > 0")
        bridges = split.select("low", "high", "n_shingles", F.col("doc_id").alias("u")).join(classes, ["low", "high", "n_shingles"]).select("u", F.col("rep").alias("v"))
        links = components(links.select(F.col("node").alias("u"), F.col("component").alias("v")).union(bridges))
        of_ids = links.join(several, "node", "left_semi").select(F.col("node").alias("doc_id"), F.col("component").alias("of_id"))  # for their rows without words
        marks = marks.join(of_ids, "doc_id", "left")
    else:
        marks = marks.withColumn("of_id", F.lit(None).cast("long"))
    named = classes.join(links, classes.rep == links.node, "left").select("low", "high", "n_shingles", F.coalesce("component", "rep").alias("c"))
    return marks.drop("signature", "marks").join(named, ["low", "high", "n_shingles"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce(F.when(F.col("n_shingles") > 0, F.col("c")), "of_id", "doc_id")).alias("component_id"),
        "n_bytes").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
