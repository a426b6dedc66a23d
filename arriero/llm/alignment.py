"""Alignment of two tokenizers over the same texts.

A text with a blank before it is cut where a blank follows a character that is no white space. Neither tokenizer has a token across
such a place (the byte-level pre-tokenizer begins a new piece there, and no piece of the other vocabulary holds a blank behind
another character, which is checked), so what lies between two cuts is encoded by itself, and the tokens of both end at each cut.

That makes fragments of a text a monoid. A byte range is either *open* (no cut inside: its text) or an open prefix (the text up to
its first cut), closed groups, and an open suffix (the text from its last cut on). Composing two joins the suffix of the left with
the prefix of the right, cuts the joined text anew and closes what is bounded; it is associative, and the empty text is neutral. Long
texts are dealt as byte ranges over the tasks and composed by a tree reduction; only open texts travel in it, closed groups are
written as they arise. Short texts are one fragment. Words repeat, so a task remembers the groups of a word.
"""

from __future__ import annotations

import hashlib
import sys
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import chain
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arriero.sinks.tables import written

TOKENIZERS = "/opt/tokenizers"
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of a range; longer texts are dealt over tasks.
CHUNK_BYTES = 64 << 10
#: Fragments that one step of the reduction composes.
FAN_IN = 16
#: Pairs whose counts every task gets; all others are joined.
HEAD_PAIRS = 1 << 16
#: Segments a task remembers, and their characters; beyond either it begins anew.
MEMO_WORDS, MEMO_CHARS = 1 << 17, 1 << 22
#: Rows encoded together.
ROWS = 500
#: Distinct pairs a task gathers before it hands their counts on.
HELD_PAIRS = 1 << 20


def cuts(text: str) -> list[str]:
    """``text`` cut before every blank that follows a character other than white space; the parts joined are the text."""
    parts = text.split(" ")
    out, held = [], parts[0]
    for part in parts[1:]:
        if held and not held[-1].isspace():
            out.append(held)
            held = " " + part
        else:
            held = f"{held} {part}"
    out.append(held)
    return out


class Pair:
    """Both tokenizers, with the bytes of their entries; made inside a task from the files' contents."""

    def __init__(self, byte_level: bytes, pieces: bytes):
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(byte_level.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        vocab = self.a.get_vocab(with_added_tokens=True)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # the usual byte-level alphabet: these stand for themselves
        byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in names):
            raise ValueError("a piece holds a blank behind another character; texts can't be cut at blanks")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.len_a, self.len_b = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.bytes_a, self.bytes_b))
        self.blank = self.b.piece_to_id("▁")
        # an id as it stands in a group, and as the last one of its side
        self.names_a = np.array([b"%d," % i for i in range(len(self.bytes_a))] + [b"%d|" % i for i in range(len(self.bytes_a))], dtype=object)
        self.names_b = np.array([b"%d," % i for i in range(len(names))] + [b"%d;" % i for i in range(len(names))], dtype=object)
        self.pieces = len(names)

    def groups(self, segments: Sequence[str]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of segments (each begins with a blank): groups as texts, numbers of tokens of both, codes of the linked pairs one after the
        other and their numbers, and which segments both tokenizers give back byte by byte; the others count nothing.
        """
        ids_a = [e.ids for e in self.a.encode_batch_fast(list(segments), add_special_tokens=False)]
        ids_b = [x if s != " " else [self.blank] for s, x in zip(segments, self.b.encode([s[1:] for s in segments], num_threads=1))]
        want = [s.encode() for s in segments]
        agree = np.array([self._gives(self.bytes_a, a, w) and self._gives(self.bytes_b, b, w) for a, b, w in zip(ids_a, ids_b, want)], dtype=bool)
        if not agree.all():
            ids_a, ids_b = ([x if ok else [] for x, ok in zip(ids, agree)] for ids in (ids_a, ids_b))
        n_a, n_b = (np.array([len(x) for x in ids], dtype=np.int64) for ids in (ids_a, ids_b))
        a, b = (np.array(list(chain.from_iterable(ids)), dtype=np.int64) for ids in (ids_a, ids_b))
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])  # both give back the same bytes, so one scale holds for all
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        at_a, at_b = np.searchsorted(end_a, both), np.searchsorted(end_b, both)
        last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        last_a[at_a], last_b[at_b] = True, True
        group_a, group_b = np.searchsorted(at_a, np.arange(len(a))), np.searchsorted(at_b, np.arange(len(b)))  # which group a token is in
        items = np.empty(len(a) + len(b), dtype=object)  # A and B of each group in turn
        items[np.arange(len(a)) + np.concatenate(([0], at_b + 1))[group_a]] = self.names_a[a + len(self.bytes_a) * last_a]
        items[np.arange(len(b)) + (at_a + 1)[group_b]] = self.names_b[b + len(self.bytes_b) * last_b]
        parts, ends = items.tolist(), np.cumsum(n_a + n_b).tolist()
        text = [b"".join(parts[i:j])[:-1] for i, j in zip([0, *ends], ends)]
        first = np.searchsorted(at_a, np.concatenate(([0], np.cumsum(n_a))))
        return text, n_a, n_b, a[at_a] * self.pieces + b[at_b], np.diff(first), agree

    @staticmethod
    def _gives(table: list[bytes], ids: list[int], want: bytes) -> bool:
        return b"".join([table[i] for i in ids]) == want


class Groups:
    """Sums and texts of lists of segments; a segment that comes again is not encoded again."""

    def __init__(self, byte_level: bytes, pieces: bytes):
        self.pair = Pair(byte_level, pieces)
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.chars, self.text = 0, []
        self.n_a, self.n_b, self.codes, self.n_codes = (np.zeros(0, np.int64) for _ in range(4))
        self.agree = np.zeros(0, bool)

    def _learn(self, segments: list[str]) -> None:
        for k in range(0, len(segments), 8192):
            some = segments[k: k + 8192]
            self.place.update(zip(some, range(len(self.text), len(self.text) + len(some))))
            self.chars += sum(map(len, some))
            text, *rest = self.pair.groups(some)
            self.text += text
            self.n_a, self.n_b, self.codes, self.n_codes, self.agree = (np.concatenate(x) for x in zip((self.n_a, self.n_b, self.codes, self.n_codes, self.agree), rest))

    def many(self, lists: Sequence[list[str]]) -> list[tuple[bytes, int, int, int, np.ndarray, np.ndarray, bool]]:
        """For each list: groups as text, tokens of both, links, distinct codes of links with their numbers, and whether all bytes agree."""
        if len(self.place) > MEMO_WORDS or self.chars > MEMO_CHARS:
            self._forget()
        missing = Counter(s for s in chain.from_iterable(lists) if s not in self.place)
        again, once = [s for s, n in missing.items() if n > 1], [s for s, n in missing.items() if n == 1]
        self._learn(again)
        kept = len(self.text), len(self.codes), self.chars
        self._learn(once)
        out = self._many(lists)
        for s in once:  # most of these never come again
            del self.place[s]
        self.chars, self.codes = kept[2], self.codes[: kept[1]]
        self.text, self.n_a, self.n_b, self.n_codes, self.agree = (x[: kept[0]] for x in (self.text, self.n_a, self.n_b, self.n_codes, self.agree))
        return out

    def _many(self, lists: Sequence[list[str]]) -> list[tuple[bytes, int, int, int, np.ndarray, np.ndarray, bool]]:
        at = np.array([self.place[s] for s in chain.from_iterable(lists)], dtype=np.int64)
        owner = np.repeat(np.arange(len(lists)), np.array([len(x) for x in lists], dtype=np.int64))
        per_list = lambda x: np.bincount(owner, weights=x, minlength=len(lists)).astype(np.int64)
        bad = per_list(~self.agree[at]) > 0
        n_a, n_b, links = (np.where(bad, 0, per_list(x[at])) for x in (self.n_a, self.n_b, self.n_codes))
        begin, size = (np.cumsum(self.n_codes) - self.n_codes)[at], self.n_codes[at]
        place = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
        span = len(self.pair.bytes_a) * self.pair.pieces
        key, n = np.unique(np.repeat(owner, size) * span + self.codes[place], return_counts=True)
        cut = np.searchsorted(key, np.arange(len(lists) + 1) * span).tolist()
        code, out, numbers, low = key % span, [], at.tolist(), 0
        for k, one in enumerate(lists):
            high = low + len(one)
            i, j = (cut[k], cut[k + 1]) if not bad[k] else (0, 0)
            out.append((b";".join([self.text[x] for x in numbers[low:high]]) if not bad[k] else b"", int(n_a[k]), int(n_b[k]), int(links[k]), code[i:j], n[i:j], not bad[k]))
            low = high
        return out


def kept_groups(files: tuple[bytes, bytes]) -> Groups:
    """The ``Groups`` of this worker process: functions arrive anew with each task, so what they share is kept beside them."""
    kept = sys.modules.setdefault("_arriero_kept", ModuleType("_arriero_kept")).__dict__.setdefault("alignment", {})
    name = tuple(hashlib.sha256(x).digest() for x in files)
    if name not in kept:
        kept.clear()
        kept[name] = Groups(*files)
    return kept[name]


def model_files(folder: str = TOKENIZERS, byte_level: str = BYTE_LEVEL, pieces: str = PIECES) -> tuple[bytes, bytes]:
    """Contents of both vocabulary files, read once on the driver (a few MB) and sent with the tasks."""
    with open(f"{folder}/{byte_level}", "rb") as one, open(f"{folder}/{pieces}", "rb") as two:
        return one.read(), two.read()


SUMS = "n_a long, n_b long, n_links long, codes binary, counts binary, agree boolean"


def _short(files: tuple[bytes, bytes]):
    """Whole short texts: one closed fragment each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = None
        for batch in (b.slice(k, ROWS) for b in batches for k in range(0, b.num_rows, ROWS)):
            groups = groups or kept_groups(files)
            texts = batch.column("text").to_pylist()
            rows = []
            for text, n_a, n_b, links, codes, n, agree in groups.many([cuts(" " + t) if t else [] for t in texts]):
                rows.append((n_a, n_b, links, codes.astype("<u8").tobytes(), n.astype("<u4").tobytes(), agree, hashlib.sha256(text).hexdigest() if text else ""))
            columns = list(zip(*rows)) or [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id")] + [pa.array(c, type=k) for c, k in zip(columns, kinds)],
                                             names=["doc_id", "n_a", "n_b", "n_links", "codes", "counts", "agree", "groups_sha256"])

    return run


def byte_ranges(text: str, size: int) -> list[str]:
    """``text`` with a blank before it in ranges of ``size`` bytes, each border moved back to the beginning of a character."""
    data, out, low = (" " + text).encode(), [], 0
    while low < len(data):
        high = min(low + size, len(data))
        while high < len(data) and high > low + 1 and data[high] & 0xC0 == 0x80:
            high -= 1
        while high < len(data) and data[high] & 0xC0 == 0x80:  # a size below one character
            high += 1
        out.append(data[low:high].decode())
        low = high
    return out


def _ranges(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uid, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("uid", "doc_id", "text"))):
                parts = byte_ranges(text, size)
                for k in range(0, len(parts), 64):
                    some = parts[k: k + 64]
                    yield pa.RecordBatch.from_pydict({"uid": [uid] * len(some), "doc_id": [doc_id] * len(some), "low": list(range(k, k + len(some))), "part": some},
                                                     schema=pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("low", pa.int64()), ("part", pa.string())]))

    return run


#: A fragment (suffix null: open, its text in prefix), or with ``at`` a piece of closed groups and its place in the text.
FRAGMENT = f"uid long, doc_id long, low long, prefix string, suffix string, at long, groups binary, {SUMS}"
_NAMES = [x.split(" ")[0] for x in FRAGMENT.split(", ")]
_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.bool_()]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(list(zip(*rows)) or [()] * len(_KINDS), _KINDS)], names=_NAMES)


def _open(uid, doc_id, low, prefix, suffix) -> tuple:
    return (uid, doc_id, low, prefix, suffix, *[None] * 8)


def _closed(groups: Groups, uid, doc_id, at, segments: list[str]) -> tuple:
    text, n_a, n_b, links, codes, n, agree = groups.many([segments])[0]
    return uid, doc_id, None, None, None, at, text, n_a, n_b, links, codes.astype("<u8").tobytes(), n.astype("<u4").tobytes(), agree


def fragment(text: str) -> tuple[str, list[str] | None, str | None]:
    """(prefix, closed segments, suffix) of a byte range, or (text, None, None) where it has no cut.

    A range's beginning is no cut: whether a character or white space precedes it is known only when it is composed.
    """
    parts = cuts(text)
    return (text, None, None) if len(parts) == 1 else (parts[0], parts[1:-1], parts[-1])


def compose(left: tuple[str, str | None], right: tuple[str, str | None]) -> tuple[tuple[str, str | None], list[str]]:
    """Two neighbouring fragments (prefix, suffix) as one, and the segments that this closes."""
    parts = cuts((left[0] if left[1] is None else left[1]) + right[0])
    if left[1] is None and right[1] is None:
        return ((parts[0], None), []) if len(parts) == 1 else ((parts[0], parts[-1]), parts[1:-1])
    if left[1] is None:
        return (parts[0], right[1]), parts[1:]
    if right[1] is None:
        return (left[0], parts[-1]), parts[:-1]
    return (left[0], right[1]), parts


def _leaves(files: tuple[bytes, bytes]):
    """Byte ranges to fragments and their closed groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = None
        for batch in batches:
            groups = groups or kept_groups(files)
            for uid, doc_id, low, part in zip(*(batch.column(c).to_pylist() for c in ("uid", "doc_id", "low", "part"))):
                prefix, closed, suffix = fragment(part)
                out = [_open(uid, doc_id, low, prefix, suffix)]
                if closed:
                    out.append(_closed(groups, uid, doc_id, 2 * low + 1, closed))
                yield _rows(out)

    return run


def _node(files: tuple[bytes, bytes], last: bool):
    """One step of the reduction: neighbouring fragments of a text to one, and the groups that closes. The last one closes all."""

    def run(table: pa.Table) -> pa.Table:
        groups, out, have = kept_groups(files), [], None
        for row in table.sort_by("low").to_pylist():
            uid, doc_id = row["uid"], row["doc_id"]
            one = (row["prefix"], row["suffix"])
            if have is None:
                first, have = row["low"], one
                continue
            have, closed = compose(have, one)
            if closed:
                out.append(_closed(groups, uid, doc_id, 2 * row["low"], closed))
        if last:
            if have[1] is not None:
                out.append(_closed(groups, uid, doc_id, 1 << 62, [have[1]]))
            out.append(_closed(groups, uid, doc_id, -1, [have[0]]))
        else:
            out.append(_open(uid, doc_id, first, *have))
        return pa.Table.from_batches([_rows(out)])

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the pieces of each text, which come in order; one piece is in memory at a time."""
    now, held, first = None, None, True

    def ended():
        return pa.RecordBatch.from_pydict({"uid": [now], "groups_sha256": [held.hexdigest()]})

    for batch in batches:
        for uid, groups in zip(batch.column("uid").to_pylist(), batch.column("groups")):
            if uid != now:
                if held is not None:
                    yield ended()
                now, held, first = uid, hashlib.sha256(), True
            if not first:
                held.update(b";")
            held.update(groups.as_buffer())
            first = False
    if held is not None:
        yield ended()


def _long(texts: DataFrame, files: tuple[bytes, bytes], size: int, fan_in: int) -> tuple[DataFrame, DataFrame]:
    """Of long texts: (one row per text as of short ones, pieces with the codes of their links)."""
    ranges = written(texts.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text").mapInArrow(_ranges(size), "uid long, doc_id long, low long, part string"), "ranges")
    n, most = ranges.agg(F.count("*"), F.max("low")).first()
    parts = max(1, min(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n * size // (4 << 20))))
    rows = written(ranges.repartition(parts, "uid", "low").mapInArrow(_leaves(files), FRAGMENT), "fragments")
    pieces, width = rows.where("at is not null"), 1
    while width <= (most or 0) or width == 1:
        width *= fan_in
        rows = written(rows.where("at is null").groupBy("uid", F.floor(F.col("low") / width)).applyInArrow(_node(files, width > (most or 0)), FRAGMENT), "composed")
        pieces = pieces.unionByName(rows.where("at is not null"))
    whole = pieces.groupBy("uid").agg(F.first("doc_id").alias("doc_id"), F.bool_and("agree").alias("agree"), *[F.sum(c).alias(c) for c in ("n_a", "n_b", "n_links")])
    good = whole.where("agree").select("uid")
    kept = written(pieces.join(good, "uid", "left_semi"), "pieces")
    digests = kept.select("uid", "at", "groups").repartition("uid").sortWithinPartitions("uid", "at").select("uid", "groups").mapInArrow(_digests, "uid long, groups_sha256 string")
    zero = [F.when(F.col("agree"), F.col(c)).otherwise(F.lit(0)).alias(c) for c in ("n_a", "n_b", "n_links")]
    return written(whole.join(digests, "uid", "left").select("uid", "doc_id", *zero, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")), "long"), kept.select("uid", "codes", "counts")


def _ragged(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes and numbers of all rows one after the other, and each row's first place, n + 1 long."""
    codes, counts = (batch.column(c).to_pylist() for c in ("codes", "counts"))
    first = np.concatenate(([0], np.cumsum([len(x) // 8 for x in codes], dtype=np.int64))).astype(np.int64)
    return np.frombuffer(b"".join(codes), "<u8").astype(np.int64), np.frombuffer(b"".join(counts), "<u4").astype(np.int64), first


def _pair_counts(held: int):
    """(code, n) of a task's links, combined as far as ``held`` distinct codes fit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            more, times, _ = _ragged(batch)
            codes, at = np.unique(np.concatenate([codes, more]), return_inverse=True)
            n = np.bincount(at, weights=np.concatenate([n, times]).astype(np.float64), minlength=len(codes)).astype(np.int64)
            if len(codes) > held:
                yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], names=["code", "n"])
                codes, n = codes[:0], n[:0]
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], names=["code", "n"])

    return run


def _scores(codes: np.ndarray, n: np.ndarray, best: np.ndarray):
    """Sums over the links of each row whose pair is in the head (codes ascending); the others leave as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, times, first = _ragged(batch)
            at = np.minimum(np.searchsorted(codes, own), max(len(codes) - 1, 0))
            head = codes[at] == own if len(codes) else np.zeros(len(own), bool)
            row = np.repeat(np.arange(len(first) - 1), np.diff(first))
            out = []
            for value in (n, best.astype(np.int64)):
                sums = np.zeros(len(first) - 1, np.int64)
                np.add.at(sums, row[head], value[at[head]] * times[head])
                out.append(pa.array(sums))
            begins = np.concatenate(([0], np.cumsum(np.bincount(row[~head], minlength=len(first) - 1)))).astype(np.int32)
            rest = [pa.ListArray.from_arrays(pa.array(begins), pa.array(x[~head])) for x in (own, times)]
            yield pa.RecordBatch.from_arrays([batch.column("long_text"), batch.column("uid"), *out, *rest], names=["long_text", "uid", "count_sum", "n_best", "tail", "tail_times"])

    return run


def _head(pairs: DataFrame, most: int) -> int:
    """The least count with at most ``most`` pairs of it or above it, from the numbers of pairs by powers of two."""
    by_size = sorted(((r.p, r.k) for r in pairs.groupBy(F.floor(F.log2("n")).alias("p")).agg(F.count("*").alias("k")).collect()), reverse=True)  # at most 63 rows
    total, least = 0, 1 << 62
    for p, k in by_size:
        total += k
        if total > most:
            break
        least = 1 << p
    return least


def align(docs: DataFrame, folder: str = TOKENIZERS, byte_level: str = BYTE_LEVEL, pieces: str = PIECES, chunk_bytes: int = CHUNK_BYTES,
          fan_in: int = FAN_IN, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 for every row of ``docs`` (doc_id, text; others are ignored).

    Offsets where tokens of both end cut them into groups; the two last tokens of a group are linked. A pair's count is the number of
    links of the corpus that hold it; n_best are a row's links whose count is the highest of their B id (ties included), count_sum the
    sum over its links. Null and empty texts, and texts that a tokenizer does not give back byte by byte, have zeros and ''; so links
    nowhere count them. Repeated rows count as often as they occur and each gets its result; a null doc_id stays null. An empty
    table gives an empty result. A text without a blank is one segment, however long, as its tokens cannot be told from a part of it.
    """
    files = model_files(folder, byte_level, pieces)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    big = F.coalesce(F.octet_length("text") > chunk_bytes, F.lit(False))
    short = texts.where(~big).mapInArrow(_short(files), f"doc_id long, {SUMS}, groups_sha256 string")
    short = written(short.select(F.monotonically_increasing_id().alias("uid"), "*"), "short")
    long, parts = _long(texts.where(big), files, chunk_bytes, fan_in)
    links = short.where("n_links > 0").select(F.lit(False).alias("long_text"), "uid", "codes", "counts").unionByName(parts.select(F.lit(True).alias("long_text"), "uid", "codes", "counts"))
    counts = links.select("codes", "counts").mapInArrow(_pair_counts(HELD_PAIRS), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    width = Pair(*files).pieces
    pairs = written(counts.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy(F.col("code") % width))), "pairs")  # a B id has at most as many pairs as A has ids
    least = _head(pairs, head_pairs)
    head = pairs.where(F.col("n") >= least).toPandas().sort_values("code")
    scored = written(links.mapInArrow(_scores(head.code.to_numpy(np.int64), head.n.to_numpy(np.int64), head.best.to_numpy(bool)),
                                      "long_text boolean, uid long, count_sum long, n_best long, tail array<long>, tail_times array<long>"), "scored")
    rest = scored.where(F.size("tail") > 0).select("long_text", "uid", F.explode(F.arrays_zip("tail", "tail_times")).alias("t")).select("long_text", "uid", F.col("t.tail").alias("code"), F.col("t.tail_times").alias("times"))
    late = rest.join(pairs.where(F.col("n") < least), "code").select("long_text", "uid", (F.col("n") * F.col("times")).alias("count_sum"), F.when(F.col("best"), F.col("times")).otherwise(F.lit(0)).alias("n_best"))
    sums = scored.select("long_text", "uid", "count_sum", "n_best").unionByName(late).groupBy("long_text", "uid").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    rows = short.select(F.lit(False).alias("long_text"), "uid", "doc_id", "n_a", "n_b", "n_links", "groups_sha256").unionByName(
        long.select(F.lit(True).alias("long_text"), "uid", "doc_id", "n_a", "n_b", "n_links", "groups_sha256"))
    zero = F.lit(0).cast("long")
    return rows.join(sums, ["long_text", "uid"], "left").select(
        "doc_id", "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
