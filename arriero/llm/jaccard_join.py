"""N-gram Jaccard join with adaptive multi-match prefixes.

All shingles have one global order: estimated frequency classes first, hashes within. A set of n shingles that reaches the threshold
with another shares at least t = ceil(threshold * n) with it, so if both keep their first n - t + m shingles (an m-prefix), they share
at least m of those; with different m the smaller one holds. Each document chooses its m: a longer prefix costs rows, but a
candidate has to share more of it, so documents whose prefix meets frequent shingles take a longer one.

The frequencies come from counters of fixed size over all shingles of the corpus; they choose orders and lengths, never results.

Links are decided on full sets. First each document meets, for its lists, the one member that comes first in a random order (linear
in the rows); what that links is one component. Lists whose members are one component already need nothing more. In the others every
two members of different components meet in blocks of bounded rows, as parity bitmaps of their sets: bits that differ are shingles of
one set only, so a pair with more of them than the threshold allows is no link. Nor does a pair count in lists behind which one of the
two has too few left to share enough. A task writes out no pairs, but what its pairs connect, with less than one row for each set; so sets
that pairs connect form neighbourhoods, and in each of those all sets are decided together. So no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arriero.llm import blocks, near_dup
from arriero.llm.graph import components
from arriero.llm.prefilter import with_possible_match
from arriero.llm.ragged import chunks, mixed, shingle_sets
from arriero.sinks.tables import written

WIDTH = 5
PERCENT = 80
#: Counters of the frequency estimate, and rows in which they travel.
COUNTERS, SLICES = 1 << 18, 64
#: Matches that a document may ask for, as parts of its set; one match is always possible.
MATCHES = (1 / 32, 1 / 16, 1 / 8, 1 / 4, 1 / 2)
#: What a candidate costs, in prefix rows, and the partners that any shingle is taken to have (the counters can't tell small numbers).
CANDIDATE_COST, USUAL_PARTNERS = 4, 0.5
#: Members a document meets in each round, rounds, and documents that meet one member in one group.
MEETS, MEET_ROUNDS, GROUP = 2, 2, 200
#: Bits of a set's parity bitmap, and pairs that a task holds to name each of them once.
BITS, HELD_PAIRS = 1024, 500_000


def _marks(width: int):
    """Identity of every row's set, and as last rows of a task its counters."""
    names = ["doc_id", "n_shingles", "low", "high", "slice", "counts"]
    step = COUNTERS // SLICES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for a, b, data, offsets in chunks(batch.column("text")):
                sets = shingle_sets(data, offsets, width)
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                owner = np.repeat(np.arange(b - a), sizes)
                low, high = np.zeros(b - a, np.uint64), np.zeros(b - a, np.uint64)
                np.add.at(low, owner, flat)
                np.add.at(high, owner, mixed(flat + np.uint64(1)))
                counters += np.bincount((flat >> np.uint64(46)).astype(np.int64), minlength=COUNTERS)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(sizes), pa.array(low.view(np.int64)), pa.array(high.view(np.int64)),
                                                  pa.nulls(b - a, pa.int32()), pa.nulls(b - a, pa.binary())], names=names)
        yield pa.RecordBatch.from_arrays([*[pa.nulls(SLICES, pa.int64())] * 4, pa.array(np.arange(SLICES, dtype=np.int32)),
                                          pa.array([counters[k * step: (k + 1) * step].astype("<i8").tobytes() for k in range(SLICES)])], names=names)

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the counters of each slice; one sum per slice is in memory, however many tasks counted."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, counts in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist()):
            one = np.frombuffer(counts, "<i8")
            sums[k] = sums[k] + one if k in sums else one
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), type=pa.int32()), pa.array([x.tobytes() for x in sums.values()], type=pa.binary())], names=["slice", "counts"])


def estimated(counters: np.ndarray) -> np.ndarray:
    """How often a shingle of each counter occurs beyond what chance puts there."""
    usual = np.median(counters)
    return np.maximum(counters - usual - 4 * np.sqrt(usual + 1), 0)


def prefix(shingles: np.ndarray, often: np.ndarray, level: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The prefix of a set (distinct, ascending) in the global order, and the matches m that it asks for."""
    n = len(shingles)
    least = -(-percent * n // 100)
    at = (shingles >> np.uint64(46)).astype(np.int64)
    order = np.argsort(level[at], kind="stable")
    cost = np.cumsum(often[at[order]] + USUAL_PARTNERS)
    best, m = None, 1
    for k in (1, *[int(part * n) for part in MATCHES]):
        if 1 <= k <= least:
            length = n - least + k
            price = length + CANDIDATE_COST * cost[length - 1] / k
            if best is None or price < best:
                best, m = price, k
    return shingles[order[: n - least + m]], m


def _prefixes(width: int, percent: int, often: np.ndarray):
    level = np.floor(np.log2(1 + often)).astype(np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in chunks(batch.column("text")):
                ids = batch.column("doc_id").slice(a, b - a).to_numpy()
                token, owner, size, match = [], [], [], []
                for i, s in enumerate(shingle_sets(data, offsets, width)):
                    if len(s):
                        own, m = prefix(s, often, level, percent)
                        token.append(own)
                        owner += [i] * len(own)
                        size += [len(s)] * len(own)
                        match += [m] * len(own)
                if token:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(token).view(np.int64)), pa.array(ids[owner]), pa.array(size, type=pa.int64()), pa.array(match, type=pa.int32())],
                                                     names=["token", "doc", "n", "m"])

    return run


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of (token, priority) to those of tokens with two rows or more, with the first row's document as ``first``."""
    held = None  # first row of the last token, and whether it has left already
    for batch in batches:
        if not batch.num_rows:
            continue
        token, doc, n, m = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("token", "doc", "n", "m"))
        gone = False
        if held is not None:
            token, doc, n, m = (np.concatenate(([x], y)) for x, y in zip(held[:4], (token, doc, n, m)))
            gone = held[4]
        begin = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        size = np.diff(np.concatenate((begin, [len(token)])))
        first, many = np.repeat(doc[begin], size), np.repeat(size > 1, size)
        b = begin[-1]
        held = (token[b], doc[b], n[b], m[b], bool(size[-1] > 1 or (gone and len(begin) == 1)))
        if gone:
            many[0] = False
        yield pa.RecordBatch.from_arrays([pa.array(x[many]) for x in (token, doc, n.astype(np.int64), m.astype(np.int32), first)], names=["token", "doc", "n", "m", "first"])


def _linked(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = []
            sets: list[list[np.ndarray]] = [[], []]
            for out, name in zip(sets, ("text_a", "text_b")):
                for _, _, data, offsets in chunks(batch.column(name)):
                    out += shingle_sets(data, offsets, width)
            for x, y in zip(*sets):
                both = np.concatenate((x, y))
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                hit.append(100 * common >= percent * (len(x) + len(y) - common))
            keep = pa.array(hit, type=pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], names=["u", "v"])

    return run


def _bitmaps(width: int):
    """Parity bitmaps: a bit is set if an odd number of the set's shingles falls on it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in chunks(batch.column("text")):
                sets = shingle_sets(data, offsets, width)
                bits = [np.packbits((np.bincount((s >> np.uint64(20)).astype(np.int64) & (BITS - 1), minlength=BITS) & 1).astype(np.uint8)).tobytes() for s in sets]
                yield pa.RecordBatch.from_arrays([batch.column("doc").slice(a, b - a), pa.array([len(s) for s in sets], type=pa.int64()), pa.array(bits, type=pa.binary())],
                                                 names=["doc", "n", "bits"])

    return run


def _differing(percent: int, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Shingles of one set only that two linked sets of these sizes can have; below 0 if none of these sizes link."""
    both = n_a + n_b
    most = both - 2 * -(-percent * both // (100 + percent))
    return np.where(100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b), most, -1)


def _asked(percent: int, n_a: np.ndarray, m_a: np.ndarray, n_b: np.ndarray, m_b: np.ndarray) -> np.ndarray:
    """Prefix shingles that two linked sets of these sizes share: of the one whose prefix ends first, all but the rest behind it."""
    least = lambda n: -(-percent * n // 100)
    return -(-percent * (n_a + n_b) // (100 + percent)) - np.maximum(least(n_a) - m_a, least(n_b) - m_b)


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))[: len(a)]
    return a[new], b[new]


def _open_pairs(percent: int, most_held: int = HELD_PAIRS, reduced=_distinct):
    """Rows of lists in blocks to the pairs of different components that may link, ``reduced`` as often as a task holds enough of them.

    ``place`` numbers a set's ``places`` rows in one order of all lists. Sets that share ``asked`` shingles have as many rows from the
    first shared one on, so only lists that leave both sets that many rows name the pair: the rarest ones, as the order begins with them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0
        for table in blocks.whole(batches):
            doc, n, m, c, piece, place, places = (table.column(x).to_numpy() for x in ("doc", "n", "m", "c", "piece", "place", "places"))
            alone = np.array(table.column("alone").to_pylist(), dtype=bool)
            bits = blocks.fixed_bytes(table.column("bits")).view(np.uint64)
            begins, sizes = blocks.spans(table.column("block").to_numpy())
            words, m, left = np.ascontiguousarray(bits.T), m.astype(np.int64), places.astype(np.int64) - place + 1  # rows from this one on

            def near_pairs():
                for i, j in blocks.pairs_of_small(begins, sizes):
                    fit = (c[i] != c[j]) & ((piece[i] != piece[j]) | alone[i])
                    i, j = i[fit], j[fit]
                    near = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1, dtype=np.int64) <= _differing(percent, n[i], n[j])
                    yield i[near], j[near]
                for a, b, end in blocks.slices_of_large(begins, sizes):
                    differ = np.zeros((b - a, end - a), np.uint16)
                    for word in words:
                        differ += np.bitwise_count(word[a:b, None] ^ word[None, a:end])
                    near = (differ <= _differing(percent, n[a:b, None], n[None, a:end])) & (c[a:b, None] != c[None, a:end])
                    near &= (piece[a:b, None] != piece[None, a:end]) | alone[a:b, None]
                    i, j = np.nonzero(np.triu(near))
                    yield i + a, j + a

            for i, j in near_pairs():
                enough = np.minimum(left[i], left[j]) >= _asked(percent, n[i], m[i], n[j], m[j])
                i, j = i[enough], j[enough]
                if len(i):
                    turned = c[i] > c[j]
                    held.append((doc[np.where(turned, j, i)], doc[np.where(turned, i, j)]))
                    rows += len(i)
                if rows > most_held:
                    held = [reduced(*map(np.concatenate, zip(*held)))]
                    rows = len(held[0][0])
                    if rows > most_held // 2:  # most are needed
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], names=["a", "b"])
                        held, rows = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in reduced(*map(np.concatenate, zip(*held)))], names=["a", "b"])

    return run


def decided(pairs: DataFrame, held: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (u, v) among distinct ``pairs`` (a, b), on the full sets of their texts in ``held`` (doc, text).

    A document that many others meet is dealt to groups of bounded size, each with its text once.
    """
    groups = pairs.groupBy("b").agg(F.ceil(F.count("*") / GROUP).alias("groups"))
    left = pairs.join(groups, "b").select("a", "b", F.pmod(F.xxhash64("a"), "groups").alias("part")).join(held.select(F.col("doc").alias("a"), F.col("text").alias("text_a")), "a")
    right = groups.join(held.select(F.col("doc").alias("b"), F.col("text").alias("text_b")), "b").select("b", "text_b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("part"))
    return left.join(right, ["b", "part"]).select("a", "b", "text_a", "text_b").mapInArrow(_linked(width, percent), "u long, v long")


def decided_hoods(rows: DataFrame, width: int, percent: int, hood_rows: int, hood_bytes: int = near_dup.BLOCK_BYTES) -> DataFrame:
    """Links (u, v) that connect what any links inside the hoods connect. ``rows``: rep, hood, n_bytes, text and c, the component known so far.

    Small hoods are decided whole, many to a task; in larger ones all that is not of the largest component meets all of the hood in blocks.
    """
    crowds = rows.groupBy("hood").agg(F.count("*").alias("rows"), F.sum("n_bytes").alias("bytes"))
    large = (F.col("rows") > hood_rows) | ((F.col("bytes") > hood_bytes) & (F.col("rows") > 2))
    placed = written(rows.join(crowds, "hood").select(*rows.columns, large.alias("large")), "hood_rows")
    links = near_dup.decided_blocks(placed.where("not large").select("rep", "text", "n_bytes", F.col("hood").alias("block")), width, percent, hood_bytes)
    if placed.where("large").limit(1).count():
        links = links.union(near_dup.rest_with_all(placed.where("large"), width, percent, hood_rows))
    return links


def join(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, meet_rounds: int = MEET_ROUNDS, block_rows: int = blocks.ROWS, hood_rows: int = near_dup.BLOCK_ROWS) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of ``docs`` (doc_id, text; other columns are ignored).

    Two rows link if 100 |A ∩ B| >= percent |A ∪ B| on their sets of shingles (``width`` words, A-Z lower-cased; fewer words: all as one
    shingle). component_id is the least doc_id reachable. Rows with one doc_id are one node, also with different texts. Null and empty
    texts and texts without words have n_shingles 0 and link with nothing; a null doc_id links with nothing and has a null component.
    Repeated rows stay. An empty table gives an empty result. Sets are compared as 64-bit hashes, equal sets by 128 bits.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    every = written(texts.mapInArrow(_marks(width), "doc_id long, n_shingles long, low long, high long, slice int, counts binary"), "marks")
    counters = np.zeros(COUNTERS, np.int64)
    step = COUNTERS // SLICES
    for r in every.where("slice is not null").select("slice", "counts").repartition(min(parts, SLICES), "slice").mapInArrow(_added, "slice int, counts binary").collect():  # 2 MB in all
        counters[r["slice"] * step: (r["slice"] + 1) * step] += np.frombuffer(r["counts"], "<i8")

    # equal sets: one row stands for all
    marks = every.where("slice is null").select("doc_id", "n_shingles", "low", "high")
    full = marks.where("n_shingles > 0 and doc_id is not null")
    classes = written(full.groupBy("low", "high", "n_shingles").agg(F.min("doc_id").alias("rep")), "classes")
    named = written(full.select("doc_id", "low", "high", "n_shingles").distinct().join(classes, ["low", "high", "n_shingles"]).select("doc_id", "rep").distinct(), "named")
    copies = named.groupBy("doc_id").agg(F.bool_or(F.col("doc_id") == F.col("rep")).alias("stands")).where("not stands").select(F.col("doc_id").alias("copy_id"))
    several = named.groupBy("doc_id").agg(F.min("rep").alias("one"), F.max("rep").alias("other")).where("one != other or (one = doc_id) != (other = doc_id)")
    ties = named.join(several.select("doc_id"), "doc_id").select(F.col("doc_id").alias("u"), F.col("rep").alias("v")).where("u != v")  # one id with several sets
    sifted = with_possible_match(texts.where("doc_id is not null and text is not null"), "doc_id", copies, "copy_id", "may_be_copy")
    own = sifted.where("may_be_copy").join(copies, F.col("doc_id") == F.col("copy_id"), "left_anti").unionByName(sifted.where("not may_be_copy")).select("doc_id", "text")

    rows = own.mapInArrow(_prefixes(width, percent, estimated(counters)), "token long, doc long, n long, m int")
    first = written(rows.repartition(parts, "token").sortWithinPartitions("token", F.xxhash64("doc")).mapInArrow(_lists, "token long, doc long, n long, m int, first long"), "lists")

    def held(pairs: DataFrame) -> DataFrame:
        """(doc, text) of the documents in ``pairs``; most texts have none and need no shuffle."""
        ids = written(pairs.select(F.col("a").alias("doc")).union(pairs.select("b")).distinct(), "asked")
        maybe = with_possible_match(own, "doc_id", ids.withColumnRenamed("doc", "asked_id"), "asked_id", "asked").where("asked")
        return written(maybe.join(ids, F.col("doc_id") == F.col("doc")).select("doc", "text", F.xxhash64("text").alias("h")).dropDuplicates(["doc", "h"]).drop("h"), "held")

    links = ties
    lists, state = first, None
    for turn in range(meet_rounds):
        met = lists.where("doc != first").groupBy("doc", "first").agg(F.count("*").alias("shared"), F.max("m").alias("m")).where("2 * shared >= m")
        chosen = met.withColumn("place", F.row_number().over(Window.partitionBy("doc").orderBy(F.desc("shared"), "first"))).where(F.col("place") <= MEETS)
        pairs = written(chosen.select(F.col("doc").alias("a"), F.col("first").alias("b")), "met")
        links = written(links.unionByName(decided(pairs, held(pairs), width, percent)).distinct(), "links")
        state = written(components(links), "state")
        # lists with members of different components only
        named_rows = first.join(state.withColumnRenamed("node", "doc"), "doc", "left").select("token", "doc", "n", "m", F.coalesce("component", "doc").alias("c"))
        split = named_rows.groupBy("token").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 != c1").select("token")
        open_rows = written(named_rows.join(split, "token"), "open")
        if turn < meet_rounds - 1:
            # another first member: the first one, in a new order, of the component that has the most members in the list
            most = open_rows.groupBy("token", "c").agg(F.count("*").alias("k"), F.min_by("doc", F.xxhash64("doc", F.lit(turn))).alias("d")).groupBy("token").agg(F.max_by(F.struct("c", "d"), F.struct("k", "c")).alias("w"))
            lists = open_rows.join(most, "token").where("c != w.c").select("doc", "m", F.col("w.d").alias("first"))
    lists_open = open_rows.groupBy("token").agg(F.count("*").alias("rows"), F.min("m").alias("least_m"))
    of_set = Window.partitionBy("doc", "n")
    numbered = open_rows.join(lists_open, "token").withColumn("place", F.row_number().over(of_set.orderBy("rows", "token"))).withColumn("places", F.count("*").over(of_set))
    # two sets share the matches of one of them or more, so a row with fewer rows left names no pair
    placed = written(numbered.where(F.col("places") - F.col("place") + 1 >= F.col("least_m")).drop("least_m"), "placed")
    members = written(placed.select(F.col("doc").alias("member")).distinct(), "members")
    # bitmaps where the texts are, which stay there
    texts_open = with_possible_match(own, "doc_id", members, "member", "is_member").where("is_member").select(F.col("doc_id").alias("doc"), "text")
    bits = written(texts_open.mapInArrow(_bitmaps(width), "doc long, n long, bits binary").distinct(), "bitmaps")
    meeting = blocks.dealt(placed.join(bits, ["doc", "n"]), F.col("token"), F.col("rows"), F.col("doc"), parts, block_rows)
    near = meeting.select("block", "alone", "piece", "doc", "n", "m", "c", "place", "places", "bits").mapInArrow(_open_pairs(percent, reduced=blocks.spanning), "a long, b long")
    hoods = written(components(near.select(F.col("a").alias("u"), F.col("b").alias("v"))), "hoods")
    known = hoods.join(state.select("node", F.col("component").alias("c")), "node", "left").select(F.col("node").alias("rep"), F.col("component").alias("hood"), "c")
    crowded = held(hoods.select(F.col("node").alias("a"), F.col("component").alias("b"))).join(known, F.col("doc") == F.col("rep")).select(
        "rep", "hood", F.octet_length("text").cast("long").alias("n_bytes"), "text", F.coalesce("c", "rep").alias("c"))
    found = components(written(links.unionByName(decided_hoods(crowded, width, percent, hood_rows)), "links"))
    groups = classes.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").select("low", "high", "n_shingles", F.coalesce("component", "rep").alias("c"))
    return marks.join(groups, ["low", "high", "n_shingles"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "doc_id")).alias("component_id"))
