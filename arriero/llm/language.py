"""Language of code-switched text by a linear-chain conditional random field.

Every word is a state; its emission is a sum of learned weights for prefixes, suffixes, byte n-grams and membership in the
languages' lexicons, and neighbouring states are tied by learned transitions. Forward-backward gives each word's posterior, a
document's language is the one with the largest expected share of words. Training sequences splice stretches of labelled texts, so
that the transitions see switches. Features are hashed from the bytes of many words at once; no word list of the corpus is kept.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arriero.llm.ragged import LOWER, chunks, mixed, prefix_sums, span_hash, word_spans
from arriero.sinks.tables import written

#: Labelled rows used at most, the first by a hash of doc_id, and sequences of words cut from them.
MAX_ROWS, SEQUENCES, LENGTH = 4_000, 4_000, 48
#: Slots of the hashed n-gram weights; words of a language's lexicon at most.
SLOTS, LEXICON = 1 << 14, 2_000
STEPS, RATE, DECAY = 60, 0.3, 1e-4
#: Text bytes whose emissions are computed at once, and words whose sequences are then run side by side.
EMISSION_BYTES, SIDE_BY_SIDE = 192 << 10, 600_000
_SALTS = [np.uint64(0x9E3779B97F4A7C15 + 2 * k) for k in range(8)]


def _slot(code: np.ndarray, kind: int) -> np.ndarray:
    return (mixed(code * _SALTS[kind] + np.uint64(kind)) >> np.uint64(64 - 14)).astype(np.int64)


@dataclass
class Words:
    """The words of some rows: hashed features per word, and the row each row starts at."""

    affixes: np.ndarray  # words x 6: prefixes and suffixes of one to three bytes
    grams: np.ndarray  # one slot per trigram
    gram_at: np.ndarray  # first trigram of each word, and the end
    word: np.ndarray  # identity
    first: np.ndarray  # first word of each row, and the end


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    low = LOWER[data]
    starts, ends, first = word_spans(data, offsets)
    size = ends - starts
    padded = np.concatenate((low, np.zeros(4, np.uint8))).astype(np.uint64)
    code = np.zeros((len(starts), 6), np.uint64)
    for k in range(3):
        code[:, k] = (code[:, k - 1] if k else 0) * np.uint64(257) + np.where(size > k, padded[np.minimum(starts + k, len(low))], 0) + np.uint64(1)
        code[:, 3 + k] = (code[:, 2 + k] if k else 0) * np.uint64(257) + np.where(size > k, padded[np.maximum(ends - 1 - k, 0)], 0) + np.uint64(1)
    affixes = np.stack([_slot(code[:, k], k) for k in range(6)], 1) if len(starts) else np.zeros((0, 6), np.int64)
    count = np.maximum(size - 2, 0)
    gram_at = np.concatenate(([0], np.cumsum(count)))
    at = np.repeat(starts - gram_at[:-1], count) + np.arange(gram_at[-1])
    tri = (padded[at] * np.uint64(65536)) + (padded[at + 1] * np.uint64(256)) + padded[at + 2]
    return Words(affixes, _slot(tri, 6), gram_at, span_hash(prefix_sums(low), starts, ends), first)


@dataclass
class Model:
    languages: list[str]
    affix: np.ndarray  # SLOTS x languages
    gram: np.ndarray  # SLOTS x languages
    lexicon: np.ndarray  # sorted word identities
    belongs: np.ndarray  # lexicon entries x languages
    lexical: np.ndarray  # languages
    bias: np.ndarray
    step: np.ndarray  # transitions

    def emissions(self, w: Words) -> np.ndarray:
        score = self.bias + self.affix[w.affixes].sum(axis=1)
        if len(w.grams):
            sums = np.concatenate((np.zeros((1, len(self.bias))), np.cumsum(self.gram[w.grams], axis=0)))
            score = score + (sums[w.gram_at[1:]] - sums[w.gram_at[:-1]])
        return score + self.known(w) * self.lexical

    def known(self, w: Words) -> np.ndarray:
        if not len(self.lexicon) or not len(w.word):
            return np.zeros((len(w.word), len(self.bias)))
        at = np.minimum(np.searchsorted(self.lexicon, w.word), len(self.lexicon) - 1)
        return self.belongs[at] * (self.lexicon[at] == w.word)[:, None]


def _messages(emission: np.ndarray, first: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(local weights, forward, backward) of many sequences side by side, the longest first, so that each step runs over those not yet at their end."""
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    begin, size = first[:-1][order], sizes[order]
    weight = np.exp(emission - emission.max(axis=1, keepdims=True)) if len(emission) else emission
    ahead, back, move = weight.copy(), np.ones_like(weight), np.exp(step)
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(1, longest + 1), side="right")  # rows with more than t words
    for t in range(longest):
        at = begin[: active[t]] + t
        now = ahead[at] if t == 0 else (ahead[at - 1] @ move) * weight[at]
        ahead[at] = now / now.sum(axis=1, keepdims=True)
    for t in range(longest - 2, -1, -1):
        at = begin[: active[t + 1]] + t
        now = (back[at + 1] * weight[at + 1]) @ move.T
        back[at] = now / now.sum(axis=1, keepdims=True)
    return weight, ahead, back


def posteriors(emission: np.ndarray, first: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Each word's distribution over the states, by forward-backward."""
    _, ahead, back = _messages(emission, first, step)
    both = ahead * back
    return both / both.sum(axis=1, keepdims=True) if len(both) else both


def expected_moves(weight: np.ndarray, ahead: np.ndarray, back: np.ndarray, step: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Expected counts of (state, next state) over the words ``at``, which all have a successor."""
    joint = ahead[at][:, :, None] * np.exp(step)[None] * (weight * back)[at + 1][:, None, :]
    return (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)


def has_letters(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def labelled(docs: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """text and lang of at most ``max_rows`` documents that may be learned from: crc32(doc_id) mod 4 is not 2, lang and text not null."""
    rows = docs.where("doc_id is not null and lang is not null and text is not null").where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    some = rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows).select(F.col("doc_id").alias("d"))
    return rows.join(F.broadcast(some), F.col("doc_id") == F.col("d")).select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.xxhash64("doc_id").alias("h"))


def _lexicon(rows: pd.DataFrame, languages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Frequent words and the share of each language among the texts that hold them."""
    counts = [Counter() for _ in languages]
    total = np.zeros(len(languages))
    for text, lang in zip(rows.text, rows.lang):
        k = languages.index(lang)
        total[k] += 1
        for _, _, data, offsets in chunks(pa.array([text])):
            counts[k].update(np.unique(words_of(data, offsets).word).tolist())
    chosen = sorted({w for c in counts for w, n in c.most_common(LEXICON) if n >= 3})
    share = np.array([[c[w] for c in counts] for w in chosen], float).reshape(-1, len(languages)) / np.maximum(total, 1)
    return np.array(chosen, np.uint64), share / np.maximum(share.sum(axis=1, keepdims=True), 1e-9)


def fit(docs: DataFrame, max_rows: int = MAX_ROWS, sequences: int = SEQUENCES, seed: int = 5) -> Model:
    """Learn from at most ``max_rows`` labelled rows by gradient ascent on the likelihood of the spliced sequences.

    Without any labelled row the model has no language and every text is ``und``.
    """
    rows = written(labelled(docs, max_rows), "labelled").toPandas()
    rows = rows.sort_values(["h", "text"], kind="stable").reset_index(drop=True)
    languages = sorted(set(rows.lang))
    n = len(languages)
    lexicon, belongs = _lexicon(rows, languages) if n else (np.zeros(0, np.uint64), np.zeros((0, 0)))
    model = Model(languages, np.zeros((SLOTS, n)), np.zeros((SLOTS, n)), lexicon, belongs, np.zeros(n), np.zeros(n), np.zeros((n, n)))
    if n < 2:
        return model
    rng = np.random.default_rng(seed)
    texts = [[t.split() for t in rows.text[rows.lang == one]] for one in languages]
    texts = [[t for t in own if t] or [["-"]] for own in texts]
    pieces, labels = [], []
    for _ in range(sequences):
        line, tags = [], []
        while len(line) < LENGTH:
            k = int(rng.integers(n))
            own = texts[k][int(rng.integers(len(texts[k])))]
            a, size = int(rng.integers(len(own))), int(rng.integers(4, LENGTH + 1))
            part = own[a: a + size]
            line += part
            tags += [k] * len(part)
        pieces.append(" ".join(line[:LENGTH])), labels.append(tags[:LENGTH])
    joined = pa.array(pieces)
    batches = []
    for a, b, data, offsets in chunks(joined, 256 << 10):
        w = words_of(data, offsets)
        batches.append((w, np.concatenate([np.array(t) for t in labels[a:b]])))
    batches = [(w, y) for w, y in batches if len(w.word) == len(y)]
    held = [np.zeros_like(p) for p in (model.affix, model.gram, model.lexical, model.bias, model.step)]
    for step in range(STEPS):
        w, y = batches[step % len(batches)]
        weight, ahead, back = _messages(model.emissions(w), w.first, model.step)
        error = -(ahead * back) / (ahead * back).sum(axis=1, keepdims=True)
        error[np.arange(len(y)), y] += 1
        size = len(y)
        gradient = [np.zeros_like(model.affix), np.zeros_like(model.gram), (error * model.known(w)).sum(0), error.sum(0), np.zeros((n, n))]
        per_gram = np.repeat(error, np.diff(w.gram_at), axis=0)
        for k in range(n):
            gradient[0][:, k] = np.bincount(w.affixes.reshape(-1), np.repeat(error[:, k], 6), SLOTS)
            gradient[1][:, k] = np.bincount(w.grams, per_gram[:, k], SLOTS)
        inner = np.ones(size, bool)
        inner[w.first[1:] - 1] = False
        at = np.flatnonzero(inner)
        np.add.at(gradient[4], (y[at], y[at + 1]), 1)
        gradient[4] -= expected_moves(weight, ahead, back, model.step, at)
        for p, g, h in zip((model.affix, model.gram, model.lexical, model.bias, model.step), gradient, held):
            g = g / size - DECAY * p
            h += g * g
            p += RATE * g / (np.sqrt(h) + 1e-6)
    return model


def label(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score (its expected share of words) of every whole text of ``docs`` (doc_id, text).

    ``und`` with score 0 if the text is null or has no letter. Repeated rows get equal answers; other columns are ignored; an empty
    table gives an empty result. One pass, no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            # emissions chunk by chunk; forward-backward over many rows at once, since it takes as many steps as the longest has words
            held, begun, words = [], 0, 0
            for a, b, data, offsets in chunks(texts, EMISSION_BYTES):
                w = words_of(data, offsets)
                low = LOWER[data]
                letter = np.concatenate(([0], np.cumsum((low >= 97) & (low <= 122))))
                held.append((model.emissions(w).astype(np.float32), np.diff(w.first), letter[offsets[1:]] > letter[offsets[:-1]]))
                words += len(w.word)
                if words >= SIDE_BY_SIDE or b == len(batch):
                    yield answered(held, batch.column("doc_id").slice(begun, b - begun), texts.slice(begun, b - begun))
                    held, begun, words = [], b, 0

    def answered(held: list, ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        sizes, letters = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
        first = np.concatenate(([0], np.cumsum(sizes)))
        names, scores = ["und"] * len(sizes), np.zeros(len(sizes))
        if model.languages:
            post = posteriors(np.concatenate([h[0] for h in held]), first, model.step.astype(np.float32))
            sums = np.concatenate((np.zeros((1, len(model.languages))), np.cumsum(post, axis=0, dtype=np.float64)))
            share = (sums[first[1:]] - sums[first[:-1]]) / np.maximum(sizes, 1)[:, None]
            for i in range(len(sizes)):
                if letters[i] or has_letters(texts[i].as_py()):
                    k = int(share[i].argmax())
                    names[i], scores[i] = model.languages[k], min(max(float(share[i, k]), 0.0), 1.0)
        return pa.RecordBatch.from_arrays([ids, pa.array(names, pa.string()), pa.array(scores)], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")
