"""A bit filter of fixed size that spares rows a shuffle: what it rejects has no partner, what it lets through is still joined.

The filter has at most ``MOST_BITS`` bits however many keys there are, so it may be broadcast; with more keys it lets more rows
through, and the result is the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits per key up to the largest filter, 1 MB in words of 32 bits.
BITS_PER_KEY, MOST_BITS = 16, 1 << 23


def with_possible_match(rows: DataFrame, value: str, keys: DataFrame, key: str, flag: str) -> DataFrame:
    """``rows`` with the boolean ``flag``: false only where the number ``value`` is not among ``keys``. Nulls never match."""
    bits = min(MOST_BITS, max(1 << 12, 1 << (keys.count() * BITS_PER_KEY).bit_length()))
    place = lambda c: F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(bits)).cast("int")
    words = keys.where(F.col(key).isNotNull()).select(place(key).alias("p")).groupBy(F.shiftright("p", 5).alias("filter_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, p & 31)")).alias("filter_bits"))  # at most bits / 32 rows
    asked = rows.withColumn("filter_place", place(value)).join(F.broadcast(words), F.shiftright("filter_place", 5) == F.col("filter_word"), "left")
    hit = F.expr("shiftright(filter_bits, filter_place & 31) & 1") == 1
    return asked.withColumn(flag, F.coalesce(F.col(value).isNotNull() & hit, F.lit(False))).drop("filter_place", "filter_word", "filter_bits")
