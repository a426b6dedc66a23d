"""URL filters: host and path rules, and exact membership in a listed key set by a Bloom filter cascade.

Level 0 of the cascade encodes the listed keys, level 1 those other keys of the corpus that level 0 lets through, level 2 the
listed keys that level 1 lets through, and so on until nothing is wrong. Over the complete key universe of the corpus the answer
is exact, and a page needs no join: the cascade takes a few bits per listed key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arriero.sinks.tables import written

#: (verdict, host, path) of the rules in force.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Keys of one shard of the cascade, and the bytes up to which all shards travel to every task.
SHARD_KEYS, MOST_BYTES = 200_000, 16 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or url."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """Behind the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, else nulls. A rule fits its host and all subdomains, and paths that start with its own."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text, verdict = F.when(fits, F.lit(h + p)).otherwise(text), F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


def _positions(h1: np.ndarray, h2: np.ndarray, level: int, hashes: int, bits: int) -> np.ndarray:
    """Bit places (keys x hashes) of a level, by double hashing with a stride of its own."""
    a = h1.view(np.uint64) ^ np.uint64((level * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    a = (a ^ (a >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    a = a ^ (a >> np.uint64(32))
    b = (h2.view(np.uint64) + np.uint64(level)) | np.uint64(1)
    return ((a[:, None] + b[:, None] * np.arange(hashes, dtype=np.uint64)[None, :]) % np.uint64(bits)).astype(np.int64)


def build_levels(h1: np.ndarray, h2: np.ndarray, listed: np.ndarray) -> list[tuple[int, int, bytes]]:
    """(hashes, bits, filter) of each level over the universe of keys."""
    inside, outside, out = np.flatnonzero(listed), np.flatnonzero(~listed), []
    while len(inside):
        share = min(0.5, 0.7 * len(inside) / max(len(outside), 1)) if not out else 0.5
        hashes = max(1, round(-np.log2(share)))
        bits = max(64, int(np.ceil(len(inside) * hashes / np.log(2))))
        grid = np.zeros(bits, bool)
        level = len(out)
        grid[_positions(h1[inside], h2[inside], level, hashes, bits).reshape(-1)] = True
        out.append((hashes, bits, np.packbits(grid).tobytes()))
        wrong = outside[grid[_positions(h1[outside], h2[outside], level, hashes, bits)].all(axis=1)] if len(outside) else outside
        inside, outside = wrong, inside
    return out


def ask_levels(levels: list[tuple[int, int, bytes]], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Whether the keys are listed: the first level that rejects a key decides, even levels against and odd ones for it."""
    answer, open_ = np.full(len(h1), len(levels) % 2 == 1), np.arange(len(h1))
    for level, (hashes, bits, data) in enumerate(levels):
        grid = np.unpackbits(np.frombuffer(data, np.uint8), count=bits).astype(bool)
        hit = grid[_positions(h1[open_], h2[open_], level, hashes, bits)].all(axis=1)
        answer[open_[~hit]] = level % 2 == 1
        open_ = open_[hit]
    return answer


_LEVELS = "shard long, hashes array<int>, bits array<long>, filters array<binary>"


def _build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    levels = build_levels(pdf.h1.to_numpy(np.int64), pdf.h2.to_numpy(np.int64), pdf.listed.to_numpy(bool))
    return pd.DataFrame({"shard": [key[0]], "hashes": [[x[0] for x in levels]], "bits": [[x[1] for x in levels]], "filters": [[x[2] for x in levels]]})


def hashed(key: Column, shards: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(7)), F.lit(shards)).alias("shard"), F.xxhash64(key).alias("h1"), F.xxhash64(key, F.lit(1)).alias("h2")]


def cascade(universe: DataFrame, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int]:
    """(levels per shard, number of shards) for ``universe`` (key, listed): all keys of the corpus, repeats allowed. Each shard is a cascade of its own, of bounded size."""
    keys = written(universe.groupBy("key").agg(F.max("listed").alias("listed")), "keys")
    shards = max(1, -(-keys.count() // shard_keys))
    return written(keys.select(*hashed(F.col("key"), shards), "listed").groupBy("shard").applyInPandas(_build, _LEVELS), "cascade"), shards


def is_listed(rows: DataFrame, key: str, levels: DataFrame, shards: int, most_bytes: int = MOST_BYTES) -> DataFrame:
    """``rows`` with ``listed``. A cascade of at most ``most_bytes`` travels to the tasks; a larger one meets the rows by shard (AQE splits hot shards)."""
    asked = rows.select("*", *hashed(F.col(key), shards))
    size = levels.agg(F.sum(F.aggregate("filters", F.lit(0).cast("long"), lambda a, x: a + F.octet_length(x)))).first()[0] or 0
    if size <= most_bytes:
        held = {r.shard: list(zip(r.hashes, r.bits, map(bytes, r.filters))) for r in levels.collect()}

        @F.pandas_udf("boolean")
        def ask(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            for shard, h1, h2 in parts:
                out = pd.Series(False, index=shard.index)
                for one, at in shard.groupby(shard).groups.items():
                    out.loc[at] = ask_levels(held.get(one, []), h1.loc[at].to_numpy(np.int64), h2.loc[at].to_numpy(np.int64))
                yield out

        return asked.withColumn("listed", ask("shard", "h1", "h2")).drop("shard", "h1", "h2")

    @F.pandas_udf("boolean")
    def ask_with(h1: pd.Series, h2: pd.Series, hashes: pd.Series, bits: pd.Series, filters: pd.Series) -> pd.Series:
        return pd.Series([bool(ask_levels(list(zip(k, b, f)), np.array([x], np.int64), np.array([y], np.int64))[0]) if k is not None else False
                          for x, y, k, b, f in zip(h1, h2, hashes, bits, filters)], dtype=bool)

    return asked.join(levels, "shard", "left").withColumn("listed", ask_with("h1", "h2", "hashes", "bits", "filters")).drop("shard", "h1", "h2", "hashes", "bits", "filters")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, shard_keys: int = SHARD_KEYS, most_bytes: int = MOST_BYTES) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages`` (page_id, url; other columns are ignored).

    The longest rule that fits decides. A page without one is blocked if its host is listed: some page of that very host is
    blocked by a rule. Null urls and urls without ``://`` have an empty host and path. Repeated rows get equal verdicts; an empty
    table gives an empty result.
    """
    rows = pages.select("page_id", host_of(F.col("url").cast("string")).alias("host"), path_of(F.col("url").cast("string")).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = rows.select("*", rule.alias("rule"), verdict.alias("ruled"))
    levels, shards = cascade(ruled.select(F.col("host").alias("key"), F.coalesce(F.col("ruled") == "block", F.lit(False)).alias("listed")), shard_keys)
    return is_listed(ruled, "host", levels, shards, most_bytes).select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"))
