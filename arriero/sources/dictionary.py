"""Service dictionary file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Header of the dictionary file.
DICTIONARY_COLUMNS = ["CODIGO_USUARIO", "CODIGO_MTT", "CODIGO_RUTA", "SERVICIO_DECO", "TIPO_SERVICIO", "CLI_DSC"]


def read_dictionary_csv(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.options(header="true", sep=";", encoding="UTF-8").csv(path)
    return raw.select(*[F.col(c).alias(c.lower()) for c in DICTIONARY_COLUMNS])
