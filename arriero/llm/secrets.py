"""Secret scans: candidates by pattern, false positives removed by a random forest trained from labelled findings.

A candidate's features are its length and character classes, its character transitions under the corpus's own, its coverage by
the corpus's frequent words, whether it stands in a path, and the words beside it.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arriero.llm import trees
from arriero.llm.ragged import LOWER, chunks, word_spans
from arriero.sinks.tables import written

#: Documents whose words surround the labelled findings (the first by a hash of doc_id), and findings planted in each.
SAMPLE_DOCS, PER_DOC = 1_500, 4
#: Frequent short words that make the dictionary, their least count, and bytes of context on each side.
DICTIONARY, LEAST_COUNT, CONTEXT = 20_000, 5, 48
THRESHOLD = 0.5
N_FEATURES = 25

RUN = re.compile(r"(?<![A-Za-z0-9_\-+/.~])[A-Za-z0-9_\-+/.~]{12,}={0,2}")
#: Values behind = and : (blanks may stand between), an option or "Bearer": in quotes up to the same quote, else up to a blank, a closing quote or the next assignment.
_REST = r"(?:[^\s\"&;,<]|(?<=\w)\"(?=\w)|[&;,](?!\w++[=:])|<(?![/a-zA-Z]))"
_VALUES = (r"(?=([\"'])(?P<value>(?:(?!\1)\S){8,}))", r"(?=(?P<value>(?!//)[^\s\"'=:]" + _REST + r"{7}))")
_HEADS = (r"[=:]>?[ \t]{0,8}", r"--[A-Za-z][\w\-]{1,40} ", r"earer ")
QUOTED = [re.compile(head + _VALUES[0]) for head in _HEADS]
#: Where a quoted value stands behind =>, no bare one begins at the > in front of it.
BARE = [re.compile(head + _VALUES[1]) for head in (r"[=:](?!>[ \t]{0,8}([\"'])(?:(?!\1)\S){8})>?[ \t]{0,8}", *_HEADS[1:])]
REST = re.compile(_REST + "*+")
_ALNUM = re.compile(r"[^\W_]")
LEAST_LENGTH, LEAST_ASSIGNED = 12, 8

# Words that tell credentials, words that tell other identifiers, and placeholders.
CREDENTIAL = re.compile(r"(?i)(secret|token|passw(or)?d|passwd|pwd|api[_\- ]?key|apikey|access[_\- ]?key|auth|bearer|credential|private[_\- ]?key|client[_\- ]?secret)")
IDENTIFIER = re.compile(r"(?i)(commit|sha1|sha256|md5|checksum|digest|uuid|guid|isbn|issn|order|invoice|version|build|revision|ref|page|phone|tel|card|account|id)\b")
PLACEHOLDER = re.compile(r"(?i)(example|your|xxxx|0000|1234|placeholder|changeme|dummy|sample|test|<|\*\*)")
PREFIXED = re.compile(r"^(AKIA|ASIA|gh[pousr]_|sk[-_]|pk[-_]|xox[abps]-|AIza|eyJ|glpat-)")


def _code(c: str) -> int:
    """Characters as 38 classes: letters, digits, and all others as one."""
    o = ord(c)
    return o - 96 if 97 <= o <= 122 else o - 64 if 65 <= o <= 90 else o - 21 if 48 <= o <= 57 else 0


@dataclass
class Corpus:
    """Statistics of all documents: log-probabilities of character pairs and frequent words of four to six letters."""

    pairs: np.ndarray
    words: frozenset[str]


_CLASS = np.zeros(256, np.int64)
_CLASS[97:123] = np.arange(1, 27)
_CLASS[48:58] = np.arange(27, 37)


def corpus_statistics(docs: DataFrame, words: int = DICTIONARY, least: int = LEAST_COUNT) -> Corpus:
    """Count character pairs within words, and words of four to six letters, over all whole texts; the tables are of bounded size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, packed = np.zeros(37 * 37, np.int64), []
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column("text")):
                low = LOWER[data]
                kind = _CLASS[low]
                inner = np.ones(max(len(kind) - 1, 0), bool)
                inner[offsets[(offsets > 0) & (offsets < len(kind))] - 1] = False  # not across two texts
                pairs += np.bincount((kind[:-1] * 37 + kind[1:])[inner], minlength=37 * 37)
                starts, ends, _ = word_spans(data, offsets)
                size = ends - starts
                at, size = starts[(size >= 4) & (size <= 6)], size[(size >= 4) & (size <= 6)]
                code, sound = np.zeros(len(at), np.int64), np.ones(len(at), bool)
                for k in range(6):
                    byte = np.where(size > k, low[np.minimum(at + k, len(low) - 1)] if len(low) else 0, 0).astype(np.int64)
                    sound &= (size <= k) | ((byte >= 97) & (byte <= 122))
                    code = (code << 8) | byte
                packed.append(np.unique(code[sound], return_counts=True))
                if len(packed) >= 64:
                    packed = [_summed(packed)]
        key, n = _summed(packed)
        used = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((-1 - used, key))), pa.array(np.concatenate((pairs[used], n)))], names=["key", "n"])

    counted = written(docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "counts")
    table = np.ones(37 * 37)
    for r in counted.where("key < 0").collect():  # 37 x 37 at most
        table[-1 - r.key] += r.n
    table = table.reshape(37, 37)
    top = counted.where((F.col("key") >= 0) & (F.col("n") >= least)).orderBy(F.desc("n"), "key").limit(words).collect()
    return Corpus(np.log(table / table.sum(axis=1, keepdims=True)), frozenset(r.key.to_bytes(6, "big").rstrip(b"\0").decode("ascii") for r in top))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return key, np.bincount(inverse, np.concatenate([n for _, n in parts]), len(key)).astype(np.int64)


def _trimmed(text: str, a: int, b: int, ends: str = ".=-,;\"'") -> tuple[int, int]:
    while b > a and text[b - 1] in ends:
        b -= 1
    return a, b


def _assigned(text: str) -> Iterator[tuple[int, int]]:
    """Spans of assigned values. Heads inside a bare value end where it ends, so its rest is read once: many ``=`` stay linear."""
    for pattern in QUOTED:
        yield from (m.span("value") for m in pattern.finditer(text))
    for pattern in BARE:
        read, trimmed = 0, 0
        for m in pattern.finditer(text):
            a, known = m.span("value")
            if known > read:
                read = REST.match(text, known).end()
                trimmed = _trimmed(text, a, read)[1]
            yield a, max(a, trimmed)


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """Character spans that could be secrets: assigned and quoted values of 8 characters on, and long runs with a digit beside them."""
    spans, end, blank = [], 0, 0  # nothing that ends at ``blank`` has a letter or digit
    for a, b in sorted(_assigned(text)):
        if a >= end and b - a >= LEAST_ASSIGNED and b != blank:
            if _ALNUM.search(text, a, b):
                spans.append((a, b))
                end = b
            else:
                blank = b
    i, behind = 0, 0  # the first span that ends behind the run's start
    for m in RUN.finditer(text):
        a, b = _trimmed(text, *m.span())
        while i < len(spans) and spans[i][1] <= a:
            i += 1
        if b - a >= LEAST_LENGTH and any(c.isdigit() for c in text[a:b]) and (i == len(spans) or spans[i][0] >= b):
            yield from spans[behind:i]
            behind = i
            yield a, b
    yield from spans[behind:]


def features(text: str, a: int, b: int, corpus: Corpus) -> list[float]:
    value, before, after = text[a:b], text[max(0, a - CONTEXT): a], text[b: b + CONTEXT]
    n = len(value)
    digit, upper, lower = sum(c.isdigit() for c in value), sum(c.isupper() for c in value), sum(c.islower() for c in value)
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "s" for c in value]
    codes = [_code(c) for c in value]
    letters = value.lower()
    covered, i = 0, 0
    while i < n:
        size = next((k for k in (6, 5, 4) if letters[i: i + k] in corpus.words), 0)
        covered += size
        i += size or 1
    entropy = -sum(x / n * math.log2(x / n) for x in (value.count(c) for c in set(value)))
    line = before.rpartition("\n")[2]
    token = re.split(r"\s", before)[-1]
    last_words = " ".join(line.split()[-4:])
    return [
        n, digit / n, upper / n, lower / n, (n - digit - upper - lower) / n, sum(p != q for p, q in zip(kinds, kinds[1:])) / max(n - 1, 1),
        sum(corpus.pairs[p, q] for p, q in zip(codes, codes[1:])) / max(n - 1, 1), covered / n, entropy, len(set(value)) / n,
        float(bool(re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value))), float(value.isdigit()), float(bool(re.fullmatch(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", value))),
        value.count("/") / n, float("://" in token or "/" in token), float(value.count(".") > 0), float("@" in token or after[:1] == "@"),
        float(bool(re.search(r"[=:]\s*[\"']?$", before))), float(before[-1:] in ("\"", "'")), float(bool(CREDENTIAL.search(last_words))),
        float(bool(CREDENTIAL.search(after))), float(bool(IDENTIFIER.search(last_words))), float(bool(PLACEHOLDER.search(value))), float(bool(PREFIXED.match(value))),
        float(value.count("_") + value.count("-")) / n,
    ]


_SYMBOLS = "!@#$%*?^"
_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def plant(text: str, rng: np.random.Generator) -> tuple[str, int, int, int]:
    """A labelled finding in a real text: (text, start, end, 1 for a secret). Half are credentials in the ways they are written, half look-alikes."""
    random = lambda n, chars=_CHARS: "".join(chars[i] for i in rng.integers(0, len(chars), n))
    pick = lambda *xs: xs[int(rng.integers(len(xs)))]
    hexa, words = "0123456789abcdef", re.findall(r"[A-Za-z]{3,8}", text) or ["alpha", "beta"]
    long = re.findall(r"[A-Za-z]{8,16}", text) or [a + b.lower() for a, b in zip(words, words[1:]) if len(a + b) >= 8] or ["something"]
    word = lambda: pick(*words).lower()
    secret = bool(rng.integers(2))
    if secret:
        value = pick(random(40, hexa), random(int(rng.integers(20, 48))), random(32, hexa), "AKIA" + random(16, _CHARS[:26] + _CHARS[52:]), "ghp_" + random(36), "sk-" + random(40), random(43) + "=", random(64, hexa),
                     random(int(rng.integers(12, 20)), _CHARS + "_-"), random(int(rng.integers(8, 12))), random(int(rng.integers(8, 17)), _CHARS + _SYMBOLS), random(int(rng.integers(10, 17)), _CHARS[:52]),
                     f"{word().capitalize()}{word().capitalize()}{pick(*_SYMBOLS)}{int(rng.integers(1, 1000)):03d}", f"{word()}{pick(*_SYMBOLS)}{random(5)}")
        name = pick("token", "secret", "password", "api_key", "API_KEY", "client_secret", "access_key", "auth_token", "passwd", "private_key", f"{word()}_token", f"{word()}Secret")
        head, tail = pick((f'{name} = "', '"'), (f"{name}={'' if rng.integers(2) else chr(39)}", " "), (f"{name}: ", "\n"), (f'"{name}": "', '",'), ("Authorization: Bearer ", "\n"), (f"export {name.upper()}=", "\n"), (f"--{name} ", " "), (f"{name} = ", "\n"))
    else:
        kind = int(rng.integers(12))
        value, head, tail = [
            (random(40, hexa), pick("commit ", "sha1 ", "revision ", "at "), " "), (f"{random(8, hexa)}-{random(4, hexa)}-{random(4, hexa)}-{random(4, hexa)}-{random(12, hexa)}", pick("id=", "uuid: ", "request "), " "),
            (f"{word()}/{word()}/{word()}{int(rng.integers(1000))}.{pick('html', 'png', 'py')}", pick("https://example.com/", "/usr/share/", "src/"), " "), (random(16, "0123456789"), pick("card ", "order ", "account no. ", "call ", f"{word()} "), " "),
            (f"{word()}_{word()}_{word()}_{int(rng.integers(100))}", pick("def ", "see ", "file ", f"{word()} = "), "("), ("YOUR_API_KEY_" + "0" * int(rng.integers(4, 9)), pick('token = "', "api_key: "), '"'),
            ("xxxxxxxx" + "0" * 8, pick('password = "', "secret="), '"'), (f"20{int(rng.integers(10, 30))}-{int(rng.integers(1, 12)):02d}-{int(rng.integers(1, 28)):02d}T12:00:00.000Z".replace(":", "-"), f"{word()} ", " "),
            (random(64, hexa), pick("sha256:", "digest sha256:", "checksum "), "\n"), (f"{word()}.{int(rng.integers(100))}.{word()}.{word()}", f"{word()} ", "@mail.example.com "),
            (pick(*long), pick(f"{word()}: ", f"{word()}:", f"{word()} = ", f"{word()}: {pick(chr(34), chr(39))}", "password: ", "token: ", "secret: "), pick(" ", ", ", '" ')), (f"{word()}{pick('_', '.', '-')}{word()}_{word()}", pick(f"{word()} = ", f"{word()}=", f"{word()}: "), pick(" ", "(", "; ")),
        ][kind]
    spaces = [i for i, c in enumerate(text) if c == " "]
    at = pick(*spaces) + 1 if spaces else 0
    return text[:at] + head + value + tail + text[at:], at + len(head), at + len(head) + len(value), int(secret)


def planted_findings(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, per_doc: int = PER_DOC) -> DataFrame:
    """Labelled findings (text, start, end, label) in at most ``sample_docs`` documents, for use where no reviewed findings exist. Draws follow from doc_id."""
    rows = docs.where("doc_id is not null and length(text) > 0").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(F.broadcast(rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)), "doc_id")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            out = [plant(t, np.random.default_rng([17, i & 0xFFFFFFFF, k])) for i, t in zip(pdf.doc_id, pdf.text) for k in range(per_doc)]
            yield pd.DataFrame(out, columns=["text", "start", "end", "label"])

    return rows.mapInPandas(run, "text string, start int, end int, label int")


@dataclass
class Model:
    corpus: Corpus
    ensemble: trees.Ensemble

    def scores(self, rows: list[list[float]]) -> np.ndarray:
        return np.clip(self.ensemble.raw(np.array(rows, float).reshape(-1, N_FEATURES)), 0, 1)


def fit(docs: DataFrame, findings: DataFrame | None = None, max_findings: int = SAMPLE_DOCS * PER_DOC) -> Model:
    """Corpus statistics over all of ``docs`` and a forest from at most ``max_findings`` labelled findings (text, start, end, label).

    Without any finding everything scores 0.
    """
    corpus = corpus_statistics(docs)
    # written, so that no task runs a worker that plants beside one that measures
    findings = written(planted_findings(docs), "planted") if findings is None else findings.orderBy(F.xxhash64("text", "start"), "text", "start", "end").limit(max_findings)

    def measured(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield pd.DataFrame({"x": [features(t, a, b, corpus) for t, a, b in zip(pdf.text, pdf.start, pdf.end)], "label": pdf.label.astype("int32")})

    sample = findings.mapInPandas(measured, "x array<double>, label int").toPandas()
    if not len(sample):
        return Model(corpus, trees.Ensemble(0.0))
    x, y = np.array(sample.x.tolist(), float), sample.label.to_numpy(float)
    order = np.lexsort((*x.T, y))
    return Model(corpus, trees.forest(x[order], y[order]))


def scan(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, start, end (characters), score, secret and value_sha256 of every candidate in every whole text; one pass, no shuffle.

    Null and empty texts have no candidates; repeated rows give repeated findings; an empty table gives an empty result. Values
    themselves are not returned.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows, x = [], []
            for i, text in zip(pdf.doc_id, pdf.text):
                for a, b in candidates(text or ""):
                    rows.append((i, a, b, hashlib.sha256(text[a:b].encode("utf-8", "replace")).hexdigest()))
                    x.append(features(text, a, b, model.corpus))
            out = pd.DataFrame(rows, columns=["doc_id", "start", "end", "value_sha256"])
            out["score"] = model.scores(x) if x else np.zeros(0)
            yield out.assign(secret=out.score >= threshold).astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(
        run, "doc_id long, start int, end int, value_sha256 string, score double, secret boolean")


def redact(docs: DataFrame, model: Model, threshold: float = THRESHOLD, mask: str = "<secret>") -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by ``mask``; every row and all other columns stay as they are."""

    @F.pandas_udf("string")
    def clean(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            out = []
            for text in texts:
                spans = list(candidates(text)) if text else []
                if spans:
                    score = model.scores([features(text, a, b, model.corpus) for a, b in spans])
                    for (a, b), s in reversed(list(zip(spans, score))):
                        text = text[:a] + mask + text[b:] if s >= threshold else text
                out.append(text)
            yield pd.Series(out, dtype=object)

    return docs.withColumn("text", clean(F.col("text").cast("string")))
