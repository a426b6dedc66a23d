"""Which months and files a run has to take."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arriero.functions.calendar import LOCAL_ZONE, month_of, previous_month, to_local

GRACE_DAYS = 5


def in_processing_window(df: DataFrame, run_ts_utc: Column, grace_days: int = GRACE_DAYS, month: str = "mes",
                         zone: str = LOCAL_ZONE) -> DataFrame:
    """Rows of the current local month and, in its first days, of the previous one, for late corrections.

    With a literal ``run_ts_utc`` the condition folds to constants, so on a table partitioned by month it prunes.
    """
    local = to_local(run_ts_utc, zone)
    late = F.dayofmonth(local) <= grace_days
    return df.where((F.col(month) == month_of(local)) | (late & (F.col(month) == previous_month(local))))


def partition_coverage(listing: DataFrame, months: DataFrame, date: Column, zone: str = LOCAL_ZONE) -> DataFrame:
    """Per expected month: is its file there, was it modified on or after ``date`` (local), and is everything ready.

    ``listing`` has ``mes`` and ``modificado`` (UTC wall clock); a month may have several files, the newest counts.
    """
    newest = listing.groupBy("mes").agg(F.max("modificado").alias("modificado"))
    found = months.select("mes").distinct().join(newest, "mes", "left")
    day = to_local("modificado", zone).cast("date")
    rows = found.select(
        "mes", F.col("modificado").isNotNull().alias("presente"), F.coalesce(day >= date, F.lit(False)).alias("al_dia")
    )
    ready = rows.agg(F.coalesce(F.bool_and("al_dia"), F.lit(False))).scalar()
    return rows.withColumn("listo", ready)


def changed_files(listing: DataFrame, manifest: DataFrame, months: Sequence[str] | None = None,
                  key: str = "mes", fingerprint: str = "huella") -> DataFrame:
    """Files never loaded or loaded with another fingerprint; ``months`` restricts a backfill, all in one job."""
    wanted = listing if months is None else listing.where(F.col(key).isin(*months))
    loaded = manifest.select(F.col(key).alias("_k"), F.col(fingerprint).alias("_h"))
    same = (F.col(key) == F.col("_k")) & F.col(fingerprint).eqNullSafe(F.col("_h"))
    return wanted.join(loaded, same, "left_anti")
