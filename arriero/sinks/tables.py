"""Partition replacement and catalog registration."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from arriero.session import scratch_dir
from arriero.sinks import fs


def observed(df: DataFrame, name: str, metrics: Mapping[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """Attach run metrics (at least the row count) that the job's own pass collects.

    Attach them right below a write: they are then counted in the write stage, once per partition, also when tasks rerun.
    """
    seen = Observation(name)
    columns = {"filas": F.count(F.lit(1)), **(metrics or {})}
    return df.observe(seen, *[c.alias(n) for n, c in columns.items()]), seen


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for what runs inside."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def freed_shuffles(spark: SparkSession):
    """Writes inside remove their shuffle files when they end; Spark otherwise keeps them until the driver's garbage collector comes by.

    So a job of several writes holds the shuffles of one at a time. A write is a plan of its own: nothing reads its shuffles again.
    """
    return setting(spark, CLEANUP, "true")


def balanced(df: DataFrame, key: str) -> DataFrame:
    """Few, even files per partition value: AQE merges small months and splits one that dominates."""
    return df.hint("rebalance", key)


def written(df: DataFrame, label: str, *partition: str) -> DataFrame:
    """Write a frame that is read several times to the shared scratch folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation of everything before.
    """
    root = f"{scratch_dir(df.sparkSession, label)}/tabla"
    writer = (df.hint("rebalance", *partition) if partition else df).write.option("compression", "zstd")
    with freed_shuffles(df.sparkSession):
        (writer.partitionBy(*partition) if partition else writer).parquet(root)
    return df.sparkSession.read.schema(df.schema).parquet(root).select(*df.columns)


def replace_partitions(df: DataFrame, root: str, values: Sequence[str], key: str = "mes",
                       max_rows_per_file: int = 5_000_000) -> dict[str, int]:
    """Make ``df`` the content of exactly the named partitions; returns the rows written per value.

    A rerun does not duplicate, other partitions stay, and a named value without rows ends up empty: dynamic overwrite
    alone would keep the old rows of such a value. A row outside ``values`` stops the job before anything is committed.
    """
    spark = df.sparkSession
    inside = F.col(key).isin(*values)
    guarded = df.withColumn(key, F.when(inside, F.col(key)).otherwise(
        F.raise_error(F.concat(F.lit("row outside the requested partitions: "), F.coalesce(F.col(key), F.lit("NULL")))).cast("string")
    ))
    even = balanced(guarded, key) if len(values) > 1 else guarded  # one value needs no gathering, its rows stay where they are
    counted, seen = observed(even, "replace", {f"n{i}": F.count_if(F.col(key) == v) for i, v in enumerate(values)})
    with freed_shuffles(spark):
        (
            counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
            .option("maxRecordsPerFile", max_rows_per_file).partitionBy(key).parquet(root)
        )
    metrics = seen.get
    written = {v: metrics[f"n{i}"] for i, v in enumerate(values)}
    for value, rows in written.items():
        if rows == 0:
            fs.delete(spark, f"{root}/{key}={value}")
    return written


def register_table(spark: SparkSession, name: str, root: str, columns: DataFrame, key: str = "mes") -> None:
    """Create the external partitioned table over ``root`` or refresh it; a changed column list is taken over."""
    fields = [f for f in columns.schema.fields if f.name != key]
    wanted = [(f.name, f.dataType.simpleString()) for f in fields]
    if spark.catalog.tableExists(name):
        have = [(c.name, c.dataType) for c in spark.catalog.listColumns(name) if c.name != key]
        if have != wanted:
            spark.sql(f"DROP TABLE {name}")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}, `{key}` STRING) USING parquet PARTITIONED BY (`{key}`) LOCATION '{root}'")
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
