"""Benchmark decontamination by template canonicalisation, with DataFrame functions only.

Numbers, units and names in a text become typed placeholders, the rest lower-cased words. Windows of this template are hash-joined
with the benchmark's windows. A hit is decided on the aligned tokens around it: a run of enough equal template tokens, in which
the slots are filled consistently (one value of the question always becomes the same value in the text, and no two the same), is
a leak, also with other numbers or names than the question's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arriero.sinks.tables import written

#: Tokens of a window, tokens of a leak (or the whole item, if it is shorter), plain words among a window: at least three are in some
#: window of every run of 8 or more that is half plain words, and from 13 on also in one that starts at an even token.
WINDOW, RUN, PLAIN = 8, 13, 3
#: Benchmark windows up to which they are sent to every task; above, Spark joins by shuffle.
BROADCAST_ROWS = 400_000

# Units that may follow a number.
UNITS = ("mm|cm|dm|m|km|inch|inches|feet|foot|ft|yards?|miles?|mg|g|kg|tons?|tonnes?|lbs?|pounds?|oz|ounces?|ml|cl|l|liters?|litres?|gallons?|s|sec|seconds?|min|minutes?|"
         "h|hours?|days?|weeks?|months?|years?|percent|dollars?|cents?|euros?|usd|eur|gbp|degrees?|celsius|fahrenheit|kelvin|watts?|volts?|joules?|newtons?|hz|khz|mhz|gb|mb|kb|bytes?|"
         "jahre?|tage?|stunden?|minuten?|prozent|meter|heures?|jours?|ans?|mètres?|horas?|días?|años?|metros?|grados?")
_NAME, _UNIT = "\u0001", "\u0002"
_TOKEN = "[\u0001\u0002]?(?:[0-9]+(?:[.,:/][0-9]+)*|[\\p{L}\\p{M}][\\p{L}\\p{M}\\p{N}'’]*)"


def tokens(text: Column) -> Column:
    """Lower-cased words and numbers; a mark before the word tells a name (capitalised within a sentence, not all capitals) or a unit (behind a number)."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), rf"(?i)(?<=[0-9]\s)(?=(?:{UNITS})(?![\p{{L}}\p{{N}}]))", _UNIT)
    marked = F.regexp_replace(marked, r"(?=\p{Lu}\p{Ll})(?<=[\p{Ll}\p{N},;]\s)", _NAME)
    return F.regexp_extract_all(F.lower(marked), F.lit(_TOKEN), F.lit(0))


def template(tokens: Column, names: bool = True) -> Column:
    """Tokens with typed placeholders; without ``names``, names stay words."""

    def one(x: Column) -> Column:
        head = F.substring(x, 1, 1)
        name = F.lit("<name>") if names else F.substring(x, 2, 1000)
        return F.when(head == _NAME, name).when(head == _UNIT, "<unit>").when((head >= "0") & (head <= "9"), "<num>").otherwise(x)

    return F.transform(tokens, one)


def _hashes(form: Column) -> Column:
    return F.transform(form, lambda x: F.xxhash64(x))


def _windows(hashes: Column, stride: int) -> Column:
    """Hash of every window of the template's ``hashes`` whose start is a multiple of ``stride``; none for fewer tokens than a window."""
    starts = F.when(F.size(hashes) >= WINDOW, F.sequence(F.lit(0), F.size(hashes) - WINDOW, F.lit(stride)))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i + 1, WINDOW)))


def _items(benchmark: DataFrame) -> DataFrame:
    """Every item as template twice, with names as slots and as words, so that lower-cased copies match too."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), tokens(F.col("text").cast("string")).alias("words"))
    return rows.select("item_id", "words", F.explode(F.array(template(F.col("words")), template(F.col("words"), False))).alias("form")).distinct()


def _longest_run(same: Column) -> Column:
    """Length of the longest run of true values."""
    step = lambda s, ok: F.struct(F.when(ok, s["now"] + 1).otherwise(0).alias("now"), F.greatest(s["best"], F.when(ok, s["now"] + 1).otherwise(0)).alias("best"))
    return F.aggregate(same, F.struct(F.lit(0).alias("now"), F.lit(0).alias("best")), step, lambda s: s["best"])


def _run_starts(places: Column, slots: Column, exact: bool) -> Column:
    """For every aligned place the start of the run that it ends; behind its place, if it breaks the run.

    A run breaks at unequal templates and begins anew at a slot that contradicts one of the run; ``exact``: at any unequal tokens.
    """

    def step(s: Column, e: Column) -> Column:
        other = F.exists(slots, lambda c: (c["at"] >= s["low"]) & (c["at"] < e["at"]) & (c["a"] == e["a"]) & ((c["x"] == e["x"]) != (c["y"] == e["y"])))
        broken = ~e["same"] | (e["x"] != e["y"]) if exact else ~e["same"]
        low = F.when(broken, e["at"] + 1).when(e["slot"] & other, e["at"]).otherwise(s["low"])
        return F.struct(low.alias("low"), F.concat(s["starts"], F.array(low)).alias("starts"))

    return F.aggregate(places, F.struct(F.lit(0).alias("low"), F.array().cast("array<int>").alias("starts")), step, lambda s: s["starts"])


def _leaked_run(starts: Column, plain: Column, least: Column) -> Column:
    """(n, low) of the longest part of a run that has ``least`` tokens and is half plain words; ``plain``: their counts up to each place."""

    def best(low: Column, end: Column) -> Column:
        sound = lambda t: 2 * (F.get(plain, end + 1) - F.get(plain, t)) >= end + 1 - t
        tries = F.sequence(low, end + 1 - least)
        at = F.when(end + 1 - low >= least, F.when(sound(low), low).otherwise(F.array_min(F.filter(tries, sound))))
        return F.when(at.isNotNull(), F.struct((end + 1 - at).alias("n"), at.alias("low")))

    return F.array_max(F.transform(starts, best))


def leaks(docs: DataFrame, benchmark: DataFrame, run: int = RUN, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, item_id, n_words (longest aligned run), n_slots in it and same_slots (all filled as in the item) of every leak.

    ``docs``: doc_id, text; ``benchmark``: item_id, text; other columns are ignored. A leak is a run of at least ``run`` equal template
    tokens (all of a shorter item), at least half of them words, with consistent slots: a slot that contradicts an earlier one begins
    a new run, so what is consistent before or behind it counts. Items under 8 tokens are too short to tell. Null ids
    and null or empty texts leak nothing; repeated rows count once. Empty tables give an empty result.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null")
    items = written(_items(benchmark.where("item_id is not null")), "items")
    marks = items.select("item_id", "form", F.posexplode(_windows(_hashes(F.col("form")), 1)).alias("item_at", "window")).where(
        F.size(F.filter(F.slice("form", F.col("item_at") + 1, WINDOW), lambda x: ~x.startswith("<"))) >= PLAIN).select("window", "item_id", "item_at").distinct()
    marks = written(marks, "windows")
    small = marks.count() <= broadcast_rows
    shortest = items.where(F.size("form") >= WINDOW).agg(F.min(F.size("form"))).first()[0] or run
    stride = 2 if min(run, shortest) >= 13 else 1
    found = texts.select("doc_id", _hashes(template(tokens(F.col("text")))).alias("form")).select("doc_id", F.posexplode(_windows(F.col("form"), stride)).alias("at", "window"))
    hits = found.join(F.broadcast(marks) if small else marks, "window").select("doc_id", "item_id", (F.col("item_at") - F.col("at") * stride).alias("shift"))
    hits = written(hits.distinct(), "hits")

    words = texts.join(hits.select(F.col("doc_id").alias("d")).distinct(), F.col("doc_id") == F.col("d")).select("doc_id", tokens(F.col("text")).alias("doc_words"))
    words = written(words.withColumn("doc_form", template(F.col("doc_words"))), "words")
    low = F.greatest(F.lit(0), -F.col("shift"))  # first token of the document that stands beside the item
    size = F.least(F.size("doc_form") - low, F.size("form") - F.greatest(F.lit(0), F.col("shift")))
    part = lambda c, at: F.slice(c, at + 1, F.greatest(size, F.lit(0)))
    item_low = F.greatest(F.lit(0), F.col("shift"))
    both = hits.join(words, "doc_id").join(items, "item_id").select(
        "doc_id", "item_id", F.size("form").alias("n_item"), part("doc_form", low).alias("a"), part("form", item_low).alias("b"),
        part("doc_words", low).alias("x"), part("words", item_low).alias("y"))
    least = F.greatest(F.least(F.lit(run), F.col("n_item")), F.lit(WINDOW))
    both = both.withColumn("least", least).where(_longest_run(F.zip_with("a", "b", lambda p, q: p == q)) >= F.col("least"))
    places = F.transform(F.arrays_zip("a", "b", "x", "y"), lambda s, i: F.struct(
        i.alias("at"), s["a"].alias("a"), s["x"].alias("x"), s["y"].alias("y"), (s["a"] == s["b"]).alias("same"), ((s["a"] == s["b"]) & s["a"].startswith("<")).alias("slot")))
    both = both.select("doc_id", "item_id", "least", places.alias("places"))
    both = both.withColumn("slots", F.filter("places", lambda s: s["slot"])).withColumn("plain", F.aggregate(
        "places", F.array(F.lit(0)), lambda s, e: F.concat(s, F.array(F.element_at(s, -1) + F.when(e["slot"], 0).otherwise(1)))))
    runs = [_leaked_run(_run_starts(F.col("places"), F.col("slots"), exact), F.col("plain"), F.col("least")) for exact in (False, True)]
    both = both.select("doc_id", "item_id", "slots", F.explode(F.array(*runs)).alias("best")).where("best is not null")
    inside = F.filter("slots", lambda s: (s["at"] >= F.col("best.low")) & (s["at"] < F.col("best.low") + F.col("best.n")))
    kept = both.withColumn("slots", inside).select("doc_id", "item_id", F.col("best.n").alias("n_words"), F.size("slots").alias("n_slots"),
                                                   F.forall("slots", lambda s: s["x"] == s["y"]).alias("same_slots"))
    return kept.groupBy("doc_id", "item_id").agg(F.max(F.struct("n_words", "same_slots", "n_slots")).alias("m")).select(
        "doc_id", "item_id", F.col("m.n_words").alias("n_words"), F.col("m.n_slots").alias("n_slots"), F.col("m.same_slots").alias("same_slots"))
