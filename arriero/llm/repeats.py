"""Exact substring de-duplication: every byte covered by a ``length``-byte string that also starts anywhere else is removed.

1. *Anchors.* Winnowing picks, in each window of a text, the least hash of its ``length // 2``-byte strings. Equal strings of
   ``length`` bytes pick equal anchors, so only the surroundings of anchors that occur twice can hold a repeat.
2. *Shards.* An anchor's surroundings go to the shard of its home (the least document that has it), so all copies of a string meet
   in one shard. A home too large for a task is dealt over several.
3. *Suffix arrays.* Each shard sorts its suffixes by Larsson-Sadakane refinement and gets the common prefixes of neighbours by Kasai's
   rule; neighbours that share ``length`` bytes are repeats.
4. *Merging.* Shards of one home exchange the fingerprints of their distinct strings, sorted, in ranges; a binary search over the
   merged run finds strings that two shards have.
5. The spans of a document are joined and cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arriero.llm.ragged import chunks, mixed, prefix_sums, span_hash, utf8
from arriero.sinks.tables import written

LENGTH = 200
#: Text bytes of one suffix array.
SHARD_BYTES = 1 << 20
#: Stands for a null doc_id inside the operator.
NO_ID = -(1 << 63)


def _anchors(length: int):
    width = length // 2
    window = length - width + 1

    def pick(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, position in the row, hash) of all anchors of the rows."""
        n = len(data) - width + 1
        if n < window:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.arange(n)
        grams = span_hash(prefix_sums(data), at, at + width)
        low = ((grams >> np.uint64(32)) << np.uint64(32)) | at.astype(np.uint64)
        step = 1
        while 2 * step <= window:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        rest = window - step
        low = np.minimum(low[: len(low) - rest], low[rest:]) if rest else low
        row = np.searchsorted(offsets, np.arange(len(low)), side="right") - 1
        inside = np.arange(len(low)) + length <= offsets[row + 1]
        picked = (low[inside] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        picked = picked[np.concatenate(([True], picked[1:] != picked[:-1]))] if len(picked) else picked
        # a run of one repeated gram keeps every 50th anchor and its last: each window still holds one of that hash
        run = np.concatenate(([False], (np.diff(picked) == 1) & (grams[picked[1:]] == grams[picked[:-1]])))
        begun = np.maximum.accumulate(np.where(~run, np.arange(len(picked)), 0)) if len(picked) else np.zeros(0, np.int64)
        keep = (np.arange(len(picked)) - begun) % 50 == 0
        keep |= np.concatenate((~run[1:], [True])) if len(picked) else keep
        picked = picked[keep]
        row = np.searchsorted(offsets, picked, side="right") - 1
        return row, picked - offsets[row], grams[picked]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in chunks(batch.column("text")):
                row, at, gram = pick(data, offsets)
                rows = pa.array(row + a)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(rows), batch.column("th").take(rows), pa.array(at.astype(np.int32)),
                                                  pa.array(gram.view(np.int64))], names=["doc_id", "th", "at", "gram"])

    return run


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``text`` sorted by their first ``depth`` bytes or more, equal ones by position (Larsson-Sadakane).

    The text ends with a byte other than 0, which here is the separator.

    Suffixes start sorted by eight bytes. Each round doubles the sorted length, touching only groups that are still tied: a
    member's key is the rank of the suffix that far behind it.
    """
    n = len(text)
    padded = np.concatenate((text, np.zeros(8, np.uint8))).astype(np.uint64)
    first = np.zeros(n, np.uint64)
    for k in range(8):
        first = (first << np.uint64(8)) | padded[k: k + n]
    order = np.argsort(first)
    ranked = first[order]
    head = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    del padded, first, ranked
    rank = np.zeros(n + 1, np.int64)  # 0: behind the end
    group = np.maximum.accumulate(np.where(head, np.arange(n), 0)) + 1
    rank[order] = group
    rank[n] = 0
    done = 8
    tied = np.flatnonzero(~(head & np.concatenate((head[1:], [True]))))
    while len(tied) and done < depth:
        members = order[tied]
        key = (group[tied] << np.int64(32)) | rank[np.minimum(members + done, n)]
        by = np.argsort(key)
        key, members = key[by], members[by]
        order[tied] = members
        new = np.concatenate(([True], key[1:] != key[:-1]))
        group[tied] = np.maximum.accumulate(np.where(new, tied, 0)) + 1
        rank[members] = group[tied]
        tied = tied[~(new & np.concatenate((new[1:], [True])))]
        done *= 2
    if len(tied):
        members = order[tied]
        order[tied] = members[np.argsort((group[tied] << np.int64(32)) | members)]
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, enough: int) -> np.ndarray:
    """For each position the bytes it shares with its predecessor in ``order``, exact below ``enough`` and at least that otherwise.

    Kasai's rule in text order: while both positions of a pair move on over equal bytes, the common prefix shrinks by one. Only the heads of
    such chains are compared, eight bytes at a time.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    head = np.concatenate(([True], (before[1:] != before[:-1] + 1) | (before[:-1] < 0) | (text[:-1] != text[before[1:] - 1]))) | (before < 0)
    heads = np.flatnonzero(head)
    chain = np.diff(np.concatenate((heads, [n])))
    need = chain + enough
    padded = np.concatenate((text, np.zeros(16, np.uint8))).astype(np.uint64)
    word = np.zeros(n + 8, np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | padded[k: k + n + 8]
    shared = np.zeros(len(heads), np.int64)
    active = np.flatnonzero(before[heads] >= 0)
    while len(active):
        i, s = heads[active], shared[active]
        at, to = np.minimum(i + s, n), np.minimum(before[i] + s, n)
        same = word[at] == word[to]
        differ = active[~same]
        if len(differ):
            i, s = heads[differ], shared[differ]
            gap = word[np.minimum(i + s, n)] ^ word[np.minimum(before[i] + s, n)]
            shared[differ] += sum((gap < np.uint64(1 << (8 * k))).astype(np.int64) for k in range(1, 8))  # leading bytes that agree
        active = active[same]
        shared[active] += 8
        active = active[shared[active] < need[active]]
    out = np.repeat(shared, chain) - (np.arange(n) - np.repeat(heads, chain))
    return np.minimum(np.maximum(out, 0), n - np.maximum(np.arange(n), before))


def repeated(segments: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Over the segments, one after the other with a byte between: (flat text, segment starts, positions where a string that occurs
    twice begins, and for each distinct string one position and its count)."""
    text = np.frombuffer(b"\xff".join(segments) + b"\xff", dtype=np.uint8)
    sizes = np.array([len(s) for s in segments], dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    order = suffix_array(text, length)
    shared = common_prefixes(text, order, length)
    room = np.repeat(starts + sizes, sizes + 1) - np.arange(len(text)) >= length
    kept = order[room[order]]
    # a class of equal strings is contiguous in the suffix array, and none of its members reaches over its segment's end
    new = np.concatenate(([True], shared[kept[1:]] < length)) if len(kept) else np.zeros(0, bool)
    heads = np.flatnonzero(new)
    counts = np.diff(np.concatenate((heads, [len(kept)])))
    return text, starts, kept[np.repeat(counts > 1, counts)], kept[heads], counts


SPAN = "doc_id long, th long, low int, high int, family long, slice int, docs binary, keys binary, checks binary, owners binary, places binary"
_SPAN_COLUMNS = [c.split(" ")[0] for c in SPAN.split(", ")]


def _runs(at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by [p, p + length) for the positions."""
    at = np.unique(at)
    if not len(at):
        return at, at
    new = np.concatenate(([True], at[1:] > at[:-1] + length))
    return at[new], at[np.concatenate((new[1:], [True]))] + length


def _shard(length: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "th", "low"], kind="stable")
        text, starts, hits, heads, _ = repeated(pdf.bytes.tolist(), length)
        low, high = _runs(hits, length)
        seg = np.searchsorted(starts, low, side="right") - 1
        first = pdf.low.to_numpy()
        out = [pd.DataFrame({"doc_id": pdf.doc_id.to_numpy()[seg], "th": pdf.th.to_numpy()[seg], "low": (low - starts[seg] + first[seg]).astype(np.int32),
                             "high": (high - starts[seg] + first[seg]).astype(np.int32)}).assign(family=0, slice=0)]
        if len(heads) and pdf.slices.iloc[0] > 1:
            slices = int(pdf.slices.iloc[0])
            sums = prefix_sums(text)
            keys = span_hash(sums, heads, heads + length)
            half = length // 2
            checks = mixed(span_hash(sums, heads, heads + half) * np.uint64(3) + span_hash(sums, heads + half, heads + length))
            by = np.argsort(keys)
            keys, checks, heads = keys[by], checks[by], heads[by]
            seg = np.searchsorted(starts, heads, side="right") - 1
            ids = np.stack([pdf.doc_id.to_numpy(), pdf.th.to_numpy()], 1).astype(np.int64).tobytes()
            cut = np.searchsorted(keys, (np.arange(1, slices, dtype=np.float64) * (2.0 ** 64 / slices)).astype(np.uint64))
            for k, (a, b) in enumerate(zip([0, *cut], [*cut, len(keys)])):
                out.append(pd.DataFrame({"doc_id": [0], "th": [0], "low": [0], "high": [0], "family": [int(pdf.family.iloc[0])], "slice": [k], "docs": [ids], "keys": [keys[a:b].tobytes()], "checks": [checks[a:b].tobytes()],
                                         "owners": [seg[a:b].astype(np.int32).tobytes()], "places": [(heads - starts[seg] + first[seg])[a:b].astype(np.int32).tobytes()]}))
        return pd.concat([o for o in out if len(o)] or out).reindex(columns=_SPAN_COLUMNS)

    return run


def _merge(length: int):
    """Strings of one slice that two shards of a family have: every shard sent each of its distinct strings once."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [np.frombuffer(x, np.uint64) for x in pdf["keys"]]
        checks = [np.frombuffer(x, np.uint64) for x in pdf.checks]
        merged, seconds = np.concatenate(keys), np.concatenate(checks)
        by = np.lexsort((seconds, merged))
        merged, seconds = merged[by], seconds[by]
        twin = np.zeros(len(merged) + 1, bool)
        twin[1:-1] = (merged[1:] == merged[:-1]) & (seconds[1:] == seconds[:-1])
        twin = twin[:-1] | twin[1:]
        out = []
        for key, check, docs, owner, place in zip(keys, checks, pdf.docs, pdf.owners, pdf.places):
            at, end = np.searchsorted(merged, key, side="left"), np.searchsorted(merged, key, side="right")
            while ((move := (at < end - 1) & (seconds[at] != check))).any():
                at = at + move
            hit = np.flatnonzero(twin[at])
            own = np.frombuffer(docs, np.int64).reshape(-1, 2)[np.frombuffer(owner, np.int32)[hit]]
            low = np.frombuffer(place, np.int32)[hit]
            out.append(pd.DataFrame({"doc_id": own[:, 0], "th": own[:, 1], "low": low, "high": low + np.int32(length)}))
        return pd.concat(out)

    return run


def _cut(length: int):
    """The surroundings of a text's repeated anchors, one row per shard and connected stretch."""
    width = length // 2
    back, ahead = length - width, length

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc, th, text, marks in zip(pdf.doc_id, pdf.th, pdf.text, pdf.marks):
                data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else bytes(text)
                shard = np.array([m["shard"] for m in marks], np.int64)
                at = np.array([m["at"] for m in marks], np.int64)
                plan = {m["shard"]: (m["family"], m["slices"]) for m in marks}
                for one, (family, slices) in plan.items():
                    p = np.unique(at[shard == one])
                    low, high = np.maximum(p - back, 0), np.minimum(p + ahead, len(data))
                    new = np.concatenate(([True], low[1:] > high[:-1]))
                    for a, b in zip(low[new].tolist(), high[np.concatenate((new[1:], [True]))].tolist()):
                        out.append((one, family, slices, doc, th, a, data[a:b]))
            yield pd.DataFrame(out, columns=["shard", "family", "slices", "doc_id", "th", "low", "bytes"])

    return run


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, removed, spans, digests = [], [], [], []
        for text, runs in zip(batch.column("text"), batch.column("spans").to_pylist()):
            data, offsets = utf8(pa.array([text.as_py()], type=pa.large_string()))
            size = len(data)
            edge = np.zeros(size + 1, np.int32)
            if runs:
                np.add.at(edge, [r["low"] for r in runs], 1)
                np.add.at(edge, [r["high"] for r in runs], -1)
            gone = np.cumsum(edge[:-1]) > 0
            n.append(size)
            removed.append(int(gone.sum()))
            spans.append(int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if size else 0)
            digests.append(hashlib.sha256(data[~gone].tobytes()).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                                          pa.array(digests, pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeated_spans(docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """(texts, spans): every row with its key (doc_id, th), null ids as ``NO_ID``, and, where a repeat is possible, its text; and the bytes [low, high) to remove.

    Spans of one document may overlap.
    """
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn(
        "th", F.xxhash64("text"))
    anchors = written(texts.mapInArrow(_anchors(length), "doc_id long, th long, at int, gram long"), "anchors")
    twice = anchors.groupBy("gram").agg(F.count("*").alias("n"), F.min("doc_id").alias("home")).where("n > 1").select("gram", "home")
    marks = written(anchors.join(twice, "gram").select("doc_id", "th", "at", "home"), "marks")
    homes = marks.groupBy("home").agg((F.count("*") * (length // 2)).alias("bytes"))
    total = homes.agg(F.sum("bytes")).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    plan = homes.select("home", F.ceil(F.col("bytes") / shard_bytes).cast("int").alias("slices"))
    shard = F.when(F.col("slices") > 1, F.xxhash64("home", F.pmod(F.xxhash64("doc_id", "th"), F.col("slices")))).otherwise(F.pmod(F.xxhash64("home"), F.lit(shards)))
    lists = marks.join(plan, "home").select("doc_id", "th", F.struct(
        shard.alias("shard"), F.when(F.col("slices") > 1, F.col("home")).alias("family"), "slices", "at").alias("m")).groupBy("doc_id", "th").agg(F.collect_set("m").alias("marks"))
    lists = lists.select(F.col("doc_id").alias("d"), F.col("th").alias("h"), "marks")
    texts = written(texts.join(lists, (texts.doc_id == lists.d) & (texts.th == lists.h), "left").select(
        "doc_id", "th", "marks", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("digest"),
        F.when(F.col("marks").isNotNull(), F.col("text")).alias("text")), "texts")
    segments = texts.where("marks is not null").select("doc_id", "th", "text", "marks").mapInPandas(
        _cut(length), "shard long, family long, slices int, doc_id long, th long, low int, bytes binary")
    found = written(segments.groupBy("shard").applyInPandas(_shard(length), SPAN), "found")
    late = found.where("keys is not null").groupBy("family", "slice").applyInPandas(_merge(length), "doc_id long, th long, low int, high int")
    return texts, found.where("keys is null").select("doc_id", "th", "low", "high").union(late)


def remove_repeats(docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 for every row of ``docs`` (doc_id, text; other columns are ignored).

    A null text is an empty one. Repeated rows are separate documents that repeat each other; a null doc_id is kept. Texts under ``length`` bytes stay whole.
    An empty table gives an empty result. Memory per task is bounded by ``shard_bytes`` (or the longest text).
    """
    texts, spans = repeated_spans(docs, length, shard_bytes)
    runs = spans.groupBy("doc_id", "th").agg(F.collect_set(F.struct("low", "high")).alias("spans")).select(F.col("doc_id").alias("d"), F.col("th").alias("h"), "spans")
    touched = texts.where("marks is not null")
    cut = touched.join(runs, (touched.doc_id == runs.d) & (touched.th == runs.h), "left").select("doc_id", "text", "spans").mapInArrow(
        _removed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    plain = texts.where("marks is null").select("doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("digest").alias("kept_sha256"))
    return plain.union(cut).withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))
