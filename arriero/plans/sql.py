"""SQL text with bound parameters and DataFrames under names."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession


def run_query(spark: SparkSession, text: str, args: dict[str, Any] | None = None, **frames: DataFrame) -> DataFrame:
    """One query. ``:name`` is a bound value, never text pasted into the query; ``{name}`` is a DataFrame."""
    return spark.sql(text, args=args, **frames)


def statements(text: str) -> list[str]:
    """The statements of a script; each ends with a semicolon at the end of a line."""
    parts = (part.strip() for part in text.replace(";\r\n", ";\n").split(";\n"))
    return [part.removesuffix(";").strip() for part in parts if part.removesuffix(";").strip()]


def run_script(spark: SparkSession, path: str, args: dict[str, Any] | None = None) -> list[DataFrame]:
    """Run the statements of a script file in order with the same bound values."""
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    return [spark.sql(part, args={k: v for k, v in (args or {}).items() if f":{k}" in part}) for part in statements(text)]
