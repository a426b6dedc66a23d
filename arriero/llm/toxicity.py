"""Toxicity of whole texts: gradient-boosted trees over dense features, calibrated by isotonic regression.

The features are densities of a lexicon, second-person words near its hits, capitals, punctuation and obfuscation. The lexicon
(whole words and word beginnings with their log-odds) starts from plain insults and is learned from labelled rows; a labelled row's own features use a lexicon
learned without its fold, so trees and calibration see what an unseen text would show.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arriero.llm import trees
from arriero.sinks.tables import written

#: Labelled rows used at most, the first by a hash of doc_id. Everything learned comes from them.
MAX_ROWS = 16_000
#: Lexicon entries at most.
MAX_LEXICON = 3_000
FOLDS = 3
#: Counts that a task holds before it hands them on.
HELD_KEYS = 50_000
THRESHOLD = 0.3
STEMS = (4, 5, 6, 7)
#: Rows in which a key must occur with label 1 to be considered, and the least log-odds of an entry, less its standard error.
LEAST_ROWS, LEAST_ODDS = 3, 0.8

# Second-person words of the four languages.
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split())

# Plain insults of the four languages, known before any label is seen, and their log-odds.
INSULTS = frozenset("""
    idiot idiots moron morons stupid dumb fool loser losers scum trash garbage pathetic worthless disgusting clown jerk creep coward liar vermin filth imbecile
    idiote crétin imbécile abruti débile ordure déchet nul minable dégoûtant pourriture raclure salaud connard
    dummkopf trottel depp abschaum müll versager erbärmlich wertlos widerlich blödmann arschloch dreckskerl
    idiota imbécil estúpido estúpida basura escoria patético inútil asqueroso payaso tonto canalla cretino""".split())
INSULT_ODDS = 2.0

_WORD = re.compile(r"\w+")
#: Tokens with a digit or symbol, each read once; the possessive parts keep a long token linear.
_MIXED = re.compile(r"(?<![\w@$*#])[^\W\d]*+[\d@$*#][\w@$*#]*+")
_LETTER, _MARK = re.compile(r"[^\W\d_]"), re.compile(r"[\d@$*#]")
_STRETCHED = re.compile(r"(.)\1\1|\b\w(?:[.\-* ]\w){3,}\b")
_UPPER, _PUNCT = bytes(range(65, 91)), bytes(b".,;:!?\"'()[]{}-*#%&$@/|")
N_FEATURES = 18


def keys_of(words) -> set[str]:
    """Whole words and, marked by a star, word beginnings."""
    out = set(words)
    for w in list(out):
        for k in STEMS:
            if len(w) > k:
                out.add(w[:k] + "*")
    return out


def obfuscated(token: str) -> bool:
    """A digit or symbol stands inside or before the letters of a word: from the token's first word with a letter on, a letter follows it."""
    first = _LETTER.search(token)
    if not first:
        return False
    start = 1 + max(token.rfind(c, 0, first.start()) for c in "@$*#")
    mark = _MARK.search(token, start)
    return bool(mark and _LETTER.search(token, mark.end()))


def odd_tokens(text: str) -> int:
    """Obfuscated tokens, and in the rest characters three times in a row and words spelt letter by letter. Linear in the text."""
    found = 0

    def taken(m: re.Match) -> str:
        nonlocal found
        hit = obfuscated(m[0])
        found += hit
        return "\0" if hit else m[0]

    rest = _MIXED.sub(taken, text)
    return found + len(_STRETCHED.findall(rest))


def _beside(at: int, places: list[int], reach: int = 5) -> bool:
    """Whether one of the ascending ``places`` is within ``reach`` of ``at``."""
    k = bisect_left(places, at - reach)
    return k < len(places) and places[k] <= at + reach


def features(text: str, lexicon: dict[str, float], roots: frozenset[str]) -> list[float]:
    lowered = text.lower()
    words = _WORD.findall(lowered)
    n = max(len(words), 1)
    weight: dict[str, float] = {}
    for w in set(words):
        if w in lexicon or w[:4] in roots:
            best = max([lexicon.get(w, 0.0), *(lexicon.get(w[:k] + "*", 0.0) for k in STEMS if len(w) > k)])
            if best:
                weight[w] = best
    at = [(i, weight[w]) for i, w in enumerate(words) if w in weight] if weight else []
    strong = [i for i, x in at if x > 1.6]
    person = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = sum(_beside(i, person) for i in strong)
    best = sorted(weight.values(), reverse=True)[:5] + [0.0] * 5
    data = text.encode("utf-8", "replace")
    size = max(len(data), 1)
    upper = size - len(data.translate(None, _UPPER))
    odd = odd_tokens(text)
    return [
        100 * sum(x for _, x in at) / n, 100 * len(at) / n, 100 * len(strong) / n, min(len(strong), 50), len([x for x in weight.values() if x > 1.6]),
        best[0], best[1], best[2], sum(best[:5]), near, 100 * near / n, 100 * len(person) / n, upper / size,
        100 * sum(w.isupper() and len(w) > 2 for w in text.split()) / n, 100 * lowered.count("!") / n,
        (size - len(data.translate(None, _PUNCT))) / size, 100 * odd / n, float(np.log1p(len(words))),
    ]


@dataclass
class Model:
    """What scoring needs: a lexicon of bounded size, the trees and the calibration."""

    lexicon: dict[str, float]
    ensemble: trees.Ensemble
    knots: tuple[np.ndarray, np.ndarray]

    def score(self, texts: list[str]) -> np.ndarray:
        roots = frozenset(k[:4] for k in self.lexicon)
        x = np.array([features(t, self.lexicon, roots) for t in texts], dtype=float).reshape(len(texts), N_FEATURES)
        return np.clip(np.interp(self.ensemble.raw(x), *self.knots), 0.0, 1.0)


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts per key, fold and label, pre-aggregated over as many texts as ``HELD_KEYS`` entries allow."""

    def rows() -> pd.DataFrame:
        return pd.DataFrame([(k, f, t, n) for (k, f, t), n in counts.items()], columns=["key", "fold", "toxic", "n"])

    counts: Counter = Counter()
    for pdf in batches:
        for text, fold, toxic in zip(pdf.text, pdf.fold, pdf.toxic):
            for key in keys_of(_WORD.findall(text.lower())):
                counts[key, fold, toxic] += 1
            if len(counts) > HELD_KEYS:
                yield rows()
                counts = Counter()
    yield rows()


def _odds(p: np.ndarray, n: np.ndarray, total_p: float, total_n: float) -> np.ndarray:
    """Log-odds of label 1 given the key, less one standard error."""
    value = np.log((p + 0.5) / (total_p + 1)) - np.log((n + 0.5) / (total_n + 1)) - np.sqrt(1 / (p + 0.5) + 1 / (n + 1.5))
    return np.where(p >= 2, value, 0.0)


def labelled(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """text, toxic and fold of at most ``max_rows`` labelled documents that may be learned from: crc32(doc_id) mod 4 is not 2.

    A document labelled twice counts as toxic if one label says so; null labels and ids are skipped.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("d"), F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1) and d is not null")
    rows = rows.where(F.crc32(F.col("d").cast("string")) % 4 != 2).groupBy("d").agg(F.max("toxic").alias("toxic"))
    rows = rows.orderBy(F.xxhash64("d"), "d").limit(max_rows)  # a bounded sample, so it may be broadcast
    return docs.select("doc_id", "text").join(F.broadcast(rows), F.col("doc_id") == F.col("d")).select(
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), "toxic", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold"))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_lexicon: int = MAX_LEXICON) -> Model:
    """Learn lexicon, trees and calibration from at most ``max_rows`` labelled rows; only their features reach the driver.

    Without rows of both labels every text gets the share of label 1 (0 without rows).
    """
    rows = written(labelled(docs, labels, max_rows), "labelled")
    totals = {(r.fold, r.toxic): r.n for r in rows.groupBy("fold", "toxic").agg(F.count("*").alias("n")).collect()}
    size = {t: sum(n for (_, x), n in totals.items() if x == t) for t in (0, 1)}
    if not size[0] or not size[1]:
        flat = float(bool(size[1]))
        return Model({}, trees.Ensemble(0.0), (np.array([0.0, 1.0]), np.array([flat, flat])))
    wide = [F.coalesce(F.sum(F.when((F.col("fold") == f) & (F.col("toxic") == t), F.col("n"))), F.lit(0)).alias(f"n{f}{t}") for f in range(FOLDS) for t in (0, 1)]
    keys = rows.mapInPandas(_counted, "key string, fold int, toxic int, n long").groupBy("key").agg(*wide)
    p, n = sum(F.col(f"n{f}1") for f in range(FOLDS)), sum(F.col(f"n{f}0") for f in range(FOLDS))
    odds = F.log((p + 0.5) / F.lit(size[1] + 1.0)) - F.log((n + 0.5) / F.lit(size[0] + 1.0)) - F.sqrt(1 / (p + 0.5) + 1 / (n + 1.5))
    found = keys.where(p >= LEAST_ROWS).withColumn("odds", odds).where(F.col("odds") > LEAST_ODDS / 2).orderBy(F.desc("odds"), "key").limit(2 * max_lexicon).toPandas()
    counts = {(f, t): found[f"n{f}{t}"].to_numpy(float) for f in range(FOLDS) for t in (0, 1)}

    def lexicon(without: int | None) -> dict[str, float]:
        folds = [f for f in range(FOLDS) if f != without]
        one = _odds(sum(counts[f, 1] for f in folds), sum(counts[f, 0] for f in folds), sum(totals.get((f, 1), 0) for f in folds), sum(totals.get((f, 0), 0) for f in folds))
        best = np.argsort(-one, kind="stable")[:max_lexicon]
        return {**dict.fromkeys(INSULTS, INSULT_ODDS), **{found.key[i]: float(one[i]) for i in best if one[i] > LEAST_ODDS}}

    parts = {f: lexicon(f) for f in range(FOLDS)}

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        roots = {f: frozenset(k[:4] for k in words) for f, words in parts.items()}
        for pdf in batches:
            yield pd.DataFrame({"x": [features(t, parts[f], roots[f]) for t, f in zip(pdf.text, pdf.fold)], "toxic": pdf.toxic, "fold": pdf.fold})

    sample = rows.mapInPandas(measured, "x array<double>, toxic int, fold int").toPandas()
    x, y, fold = np.array(sample.x.tolist(), float), sample.toxic.to_numpy(float), sample.fold.to_numpy()
    order = np.lexsort((*x.T, y, fold))  # whatever order the rows arrived in
    x, y, fold = x[order], y[order], fold[order]
    held = np.zeros(len(y))
    for f in range(FOLDS):
        if (fold == f).any() and len(set(y[fold != f])) == 2:
            held[fold == f] = trees.boosted(x[fold != f], y[fold != f]).raw(x[fold == f])
    return Model(lexicon(None), trees.boosted(x, y), trees.isotonic(held, y))


def toxicity(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if score >= threshold) of each whole text.

    A null text is scored as an empty one; repeated rows get equal scores; an empty table gives an empty result. The result's
    columns replace columns of the same names. One pass, no shuffle.
    """
    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series(model.score(texts.fillna("").tolist()), dtype=float)

    return rows.withColumn("score", score(F.col("text").cast("string"))).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
