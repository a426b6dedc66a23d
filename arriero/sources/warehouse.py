"""JDBC connectors to an external warehouse. The pipeline itself exchanges Parquet tables and does not need them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """Numeric or date column over which a query is read with several connections."""

    column: str
    lower: str
    upper: str
    partitions: int

    def options(self) -> dict[str, str]:
        return {"partitionColumn": self.column, "lowerBound": self.lower, "upperBound": self.upper,
                "numPartitions": str(self.partitions)}


def query_options(url: str, query: str, properties: dict[str, str], split: Split | None = None) -> dict[str, str]:
    return {**properties, "url": url, "dbtable": f"({query}) q", **(split.options() if split else {})}


def read_query(spark: SparkSession, url: str, query: str, properties: dict[str, str], split: Split | None = None) -> DataFrame:
    """Run a query in the database and read its result; without ``split`` one task reads it all."""
    return spark.read.format("jdbc").options(**query_options(url, query, properties, split)).load()


def overwrite_table(df: DataFrame, url: str, table: str, properties: dict[str, str], batch: int = 10_000) -> None:
    """Replace the rows of a database table, keeping its definition."""
    df.write.format("jdbc").mode("overwrite").options(
        **properties, url=url, dbtable=table, truncate="true", batchsize=str(batch)
    ).save()
