"""File listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def file_listing(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Path, modification time and size of every file; the month comes from a ``mes=`` folder. No content is read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
        .select("path", "modificationTime", "length")
    )
    month = F.regexp_extract("path", r"/mes=(\d{4}-\d{2})/", 1)
    return files.select(
        F.nullif(month, F.lit("")).alias("mes"),
        F.col("path").alias("ruta"),
        F.to_utc_timestamp("modificationTime", F.current_timezone()).cast("timestamp_ntz").alias("modificado"),
        F.col("length").alias("bytes"),
        F.sha2(F.concat_ws("|", F.col("length"), F.unix_millis("modificationTime")), 256).alias("huella"),
    )


def content_digests(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """``file_listing`` with ``lineas`` and ``huella`` from the content instead of size and time: a file written again with the same
    lines, in whatever order, keeps its fingerprint.

    Lines are hashed where they are read, in splits of a file, and folded by sums that combine on the map side; no file is held
    whole. The fingerprint covers the number of lines and the sums of two 64-bit hashes of each, so repeated lines count. A line
    ends at a line feed, with or without a carriage return. Empty files are not listed.
    """
    parts = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(root).select(
        F.col("_metadata.file_path").alias("_p"), F.xxhash64("value").cast("decimal(20,0)").alias("_a"), F.xxhash64("value", F.lit(1)).cast("decimal(20,0)").alias("_b"))
    folded = parts.groupBy("_p").agg(F.count(F.lit(1)).alias("lineas"), F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    listed = file_listing(spark, root, pattern).drop("huella")
    return listed.join(folded, _plain("ruta") == F.try_url_decode(F.replace(_plain("_p"), F.lit("+"), F.lit("%2B"))), "left").select(
        *listed.columns, "lineas", F.when(F.col("lineas").isNotNull(), F.sha2(F.concat_ws("|", "lineas", "_a", "_b"), 256)).alias("huella"))


def _plain(c: str) -> Column:
    """One spelling of a path: the listing and the metadata of a read differ in the slashes behind the scheme (and in escapes)."""
    return F.regexp_replace(c, "^([a-z0-9]+:)/+", "$1/")
