"""Vehicle positions: payload, record parsing and freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arriero.functions.text import day_first_timestamp, reads_as_number

# Fields of one transmission, in order.
FIELDS = [
    "fecha_gps", "patente", "latitud", "longitud", "velocidad", "direccion",
    "operador", "servicio", "sentido", "ruta_consola", "ruta_sinoptico", "fecha_insercion",
]
NUMBERS = ("latitud", "longitud", "velocidad")
MESSAGE_SCHEMA = ", ".join(f"{n} {'double' if n in NUMBERS else 'string'}" for n in [*FIELDS, "consulta"])
PAYLOAD_SCHEMA = "fecha_consulta string, posiciones array<string>"
ACTIVE_MINUTES = 5


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Poll answers, one JSON object per file."""
    return spark.read.schema(PAYLOAD_SCHEMA).option("multiLine", "true").json(path)


def explode_payload(payloads: DataFrame) -> DataFrame:
    """One row per vehicle record. An answer without positions stops the job with its text."""
    positions = F.when(F.col("posiciones").isNotNull(), F.col("posiciones")).otherwise(
        F.raise_error(F.concat(F.lit("answer without positions: "), F.to_json(F.struct("fecha_consulta")))).cast("array<string>")
    )
    return payloads.select(F.col("fecha_consulta").alias("consulta"), F.explode(positions).alias("registro"))


def _bind(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row.

    A filter on a plain computed column is pushed below it and computes it again, once per reference; a filter is not
    pushed below a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def _parsed(records: DataFrame, now_utc: Column, max_age_minutes: int, max_future_minutes: int | None, record: str) -> DataFrame:
    """Records with their text parts in ``_p`` and the outcome of each test in ``_t``."""
    split = _bind(records, "_p", F.split(F.col(record), ";"))
    now = now_utc.cast("timestamp_ntz")
    numbers = {n: reads_as_number(F.get("_p", F.lit(FIELDS.index(n)))).alias(n) for n in NUMBERS}
    tests = F.struct(
        (F.coalesce(F.size("_p"), F.lit(0)) >= len(FIELDS)).alias("complete"),
        day_first_timestamp(F.get("_p", F.lit(0))).alias("gps"),
        *numbers.values(), now.alias("now"),
    )
    t = "_t."
    fresh = F.col(t + "gps") >= F.col(t + "now") - F.expr(f"interval {int(max_age_minutes)} minutes")
    if max_future_minutes is not None:
        fresh &= F.col(t + "gps") <= F.col(t + "now") + F.expr(f"interval {int(max_future_minutes)} minutes")
    numeric = F.col(t + NUMBERS[0]).isNotNull() & F.col(t + NUMBERS[1]).isNotNull() & F.col(t + NUMBERS[2]).isNotNull()
    return _bind(split, "_t", tests).withColumn("_fresh", fresh).withColumn("_numeric", numeric)


def parse_positions(records: DataFrame, now_utc: Column, max_age_minutes: int = ACTIVE_MINUTES,
                    max_future_minutes: int | None = None, record: str = "registro") -> DataFrame:
    """Typed positions whose newest transmission is at most ``max_age_minutes`` old.

    Each record is a ``;`` text with one to four transmissions of 12 fields, newest first; only the first is used. Short
    records, bad dates and bad numbers are dropped. A GPS time in the future passes unless ``max_future_minutes`` is set.
    Row-local column expressions: no shuffle. ``gps`` is the typed UTC time next to its ISO-8601 text.
    """
    values = {name: F.get("_p", F.lit(i)) for i, name in enumerate(FIELDS)}
    values["fecha_gps"] = F.concat(F.date_format("_t.gps", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    for name in NUMBERS:
        values[name] = F.col(f"_t.{name}")
    rows = _parsed(records, now_utc, max_age_minutes, max_future_minutes, record)
    return rows.where(F.col("_t.complete") & F.col("_fresh") & F.col("_numeric")).select(
        *[values[n].alias(n) for n in FIELDS], "consulta", F.col("_t.gps").alias("gps")
    )


def parse_report(records: DataFrame, now_utc: Column, max_age_minutes: int = ACTIVE_MINUTES, record: str = "registro") -> DataFrame:
    """How many records fall under each outcome; the first failing test names it."""
    outcome = (
        F.when(~F.col("_t.complete"), "corto").when(F.col("_t.gps").isNull(), "fecha inválida")
        .when(~F.col("_fresh"), "antiguo").when(~F.col("_numeric"), "número inválido").otherwise("activo")
    )
    rows = _parsed(records, now_utc, max_age_minutes, None, record)
    return rows.select(outcome.alias("resultado")).groupBy("resultado").agg(F.count(F.lit(1)).alias("registros"))


def keyed_messages(positions: DataFrame, key: str = "patente") -> DataFrame:
    """Key and JSON value, the shape a Kafka sink takes."""
    payload = [c for c in positions.columns if c != "gps"]
    return positions.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*payload)).alias("value"))


def decode_messages(messages: DataFrame) -> DataFrame:
    """Keyed messages back to typed columns, with ``gps`` as the UTC time; a message that is no JSON object, or has no key, is dropped.

    ``key`` and ``value`` may be text or bytes, as Kafka delivers them.
    """
    parsed = messages.select(F.from_json(F.col("value").cast("string"), MESSAGE_SCHEMA).alias("m")).where("m.patente is not null").select("m.*")
    return parsed.withColumn("gps", F.to_timestamp_ntz(F.substring("fecha_gps", 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss")))


def publish_messages(messages: DataFrame, fmt: str, options: dict[str, str]) -> None:
    """Append keyed messages to a sink. A Kafka sink places them by key; readers order by event time, not by arrival, so
    nothing here gathers a busy key in one task."""
    messages.write.format(fmt).options(**options).mode("append").save()


def explode_transmissions(records: DataFrame, record: str = "registro") -> DataFrame:
    """Every complete transmission of a record as a record of its own, newest first in ``transmision``."""
    parts = F.split(F.col(record), ";")
    width = len(FIELDS)
    starts = F.sequence(F.lit(0), F.floor(F.size(parts) / width).cast("int") - 1)
    usable = records.where(F.size(parts) >= width)
    joined = F.transform(starts, lambda i: F.array_join(F.slice(parts, i * width + 1, F.lit(width)), ";"))
    others = [c for c in records.columns if c != record]
    return usable.select(*others, F.posexplode(joined).alias("transmision", record))
