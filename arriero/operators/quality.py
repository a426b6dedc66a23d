"""Monthly quality checks, their alerts and the dashboard queries over both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arriero.functions.calendar import hours_between
from arriero.operators.dedupe import keep_latest

MAX_HOURS, MAX_DROP = 36, 0.10
COLUMNS = ["chequeo", "mes", "estado", "valor", "esperado", "detalle"]

# States, check names and texts stored in the check log.
OK, FAILED = "ok", "falla"
FRESHNESS, VOLUME, WITHOUT_ORDERS = "frescura_raw", "volumen_items", "items_sin_ordenes"
NO_EXPLANATION = "(sin explicación)"


def _state(failed: Column) -> Column:
    return F.when(failed, FAILED).otherwise(OK)


def _number(value: Column) -> Column:
    """Value as NUMERIC(20,2), the type of the check log."""
    return value.cast("decimal(20,2)")


def _text(value: Column, decimals: int) -> Column:
    """Number as text, halves rounded to even."""
    return F.format_string(f"%.{decimals}f", F.bround(value, decimals))


def check_freshness(months: DataFrame, listing: DataFrame, now_utc: Column, max_hours: int = MAX_HOURS) -> DataFrame:
    """Fails for a month without file or whose newest file is older than ``max_hours``; exactly that age passes.

    ``listing`` has ``mes``, ``ruta`` and ``modificado`` (UTC wall clock).
    """
    newest = listing.groupBy("mes").agg(F.max("modificado").alias("modificado"))
    rows = months.select("mes").distinct().join(newest, "mes", "left")
    hours = hours_between(now_utc, "modificado")
    missing = F.col("modificado").isNull()
    return rows.select(
        F.lit(FRESHNESS).alias("chequeo"), "mes",
        _state(missing | (hours > max_hours)).alias("estado"),
        _number(F.bround(hours, 1)).alias("valor"),
        F.lit(f"<= {max_hours} h").alias("esperado"),
        F.when(missing, F.concat(F.lit("No existe archivo del mes "), "mes"))
        .otherwise(F.concat(F.lit("Archivo cargado hace "), _text(hours, 1), F.lit(" h"))).alias("detalle"),
    )


def previous_measure(history: DataFrame, check: str, only_ok: bool = False) -> DataFrame:
    """The newest logged value of ``check`` per month; by default also when that run failed."""
    log = history.where(F.col("chequeo") == check)
    if only_ok:
        log = log.where(F.col("estado") == OK)
    return keep_latest(log, ["mes"], ["ejecutado_en", "chequeo_id"]).select("mes", F.col("valor").alias("previo"))


def check_volume(months: DataFrame, fact_items: DataFrame, history: DataFrame, drop: float = MAX_DROP,
                 baseline: str = "last") -> DataFrame:
    """Fails for a month without items or with fewer than ``1 - drop`` of the previous measure.

    ``baseline="last_ok"`` compares with the last passing run instead of the last run.
    """
    counts = fact_items.groupBy("mes").agg(F.count(F.lit(1)).alias("n"))
    rows = (
        months.select("mes").distinct()
        .join(counts, "mes", "left")
        .join(previous_measure(history, VOLUME, baseline == "last_ok"), "mes", "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
    )
    n, before = F.col("n"), F.col("previo").cast("double")
    floor = before * F.lit(1 - drop)
    empty, fell = n == 0, F.coalesce(n < floor, F.lit(False))
    limit = f"sin caída > {drop * 100:.0f}%"
    return rows.select(
        F.lit(VOLUME).alias("chequeo"), "mes", _state(empty | fell).alias("estado"), _number(n).alias("valor"),
        F.when(empty, "> 0").when(fell, F.concat(F.lit(">= "), _text(floor, 0))).otherwise(limit).alias("esperado"),
        F.when(empty, "El mes no tiene ítems en la bodega")
        .when(fell, F.concat(F.lit("Antes "), _text(before, 0), F.lit(" ítems, ahora "), n))
        .otherwise(F.concat(n, F.lit(" ítems"))).alias("detalle"),
    )


def check_items_without_orders(months: DataFrame, fact_items: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """Fails for a month that has items but no order."""
    items = fact_items.groupBy("mes").agg(F.count(F.lit(1)).alias("items"))
    orders = fact_orders.groupBy("mes").agg(F.count(F.lit(1)).alias("ordenes"))
    rows = months.select("mes").distinct().join(items, "mes", "left").join(orders, "mes", "left").fillna(0, ["items", "ordenes"])
    return rows.select(
        F.lit(WITHOUT_ORDERS).alias("chequeo"), "mes",
        _state((F.col("items") > 0) & (F.col("ordenes") == 0)).alias("estado"),
        _number(F.col("ordenes")).alias("valor"), F.lit("> 0 si hay ítems").alias("esperado"),
        F.concat("ordenes", F.lit(" órdenes y "), "items", F.lit(" ítems")).alias("detalle"),
    )


def run_checks(months: DataFrame, listing: DataFrame, fact_items: DataFrame, fact_orders: DataFrame, history: DataFrame,
               now_utc: Column) -> DataFrame:
    """All checks for all months in one plan, with the run time and an id that a rerun of the same run repeats."""
    rows = (
        check_freshness(months, listing, now_utc)
        .unionByName(check_volume(months, fact_items, history))
        .unionByName(check_items_without_orders(months, fact_items, fact_orders))
    )
    return rows.withColumn("ejecutado_en", now_utc).withColumn("chequeo_id", F.xxhash64("chequeo", "mes", "ejecutado_en"))


def alerts_from(checks: DataFrame) -> DataFrame:
    """One alert per failed check, linked by id; the explanation stays empty."""
    return checks.where(F.col("estado") == FAILED).select(
        F.xxhash64(F.lit("alerta"), "chequeo_id").alias("alerta_id"),
        F.col("ejecutado_en").alias("creada_en"), "chequeo_id",
        F.concat("chequeo", F.lit(" "), "mes", F.lit(": "), "detalle").alias("mensaje"),
        F.lit(None).cast("string").alias("explicacion"),
    )


# ---------------------------------------------------------------- dashboard queries

def failed_checks_24h(checks: DataFrame, now: Column) -> DataFrame:
    recent = F.col("ejecutado_en") > now - F.expr("interval 24 hours")
    return checks.where((F.col("estado") == FAILED) & recent).agg(F.count(F.lit(1)).alias("fallas"))


def alerts_total(alerts: DataFrame) -> DataFrame:
    return alerts.agg(F.count(F.lit(1)).alias("alertas"))


def items_per_month(fact_items: DataFrame) -> DataFrame:
    return fact_items.groupBy("mes").agg(F.count(F.lit(1)).alias("items")).orderBy("mes")


def latest_check_status(checks: DataFrame) -> DataFrame:
    return keep_latest(checks, ["chequeo", "mes"], ["ejecutado_en", "chequeo_id"]).select(
        "chequeo", "mes", "estado", "detalle", "ejecutado_en"
    )


def measure_over_time(checks: DataFrame, check: str = VOLUME) -> DataFrame:
    return checks.where(F.col("chequeo") == check).select(
        F.col("ejecutado_en").alias("time"), F.col("valor").alias("items"), F.col("mes").alias("metric")
    ).orderBy("time")


def alert_feed(alerts: DataFrame, checks: DataFrame, n: int = 20, verify: bool = False) -> DataFrame:
    """The newest alerts with the name of their check and a default explanation; only those few are joined with the log.

    ``verify`` first drops alerts whose check is not in the log, which the foreign key of the log otherwise rules out.
    """
    newest = [F.col("creada_en").desc(), F.col("alerta_id").desc()]
    few = alerts.join(checks.select("chequeo_id"), "chequeo_id", "left_semi") if verify else alerts
    return few.orderBy(*newest).limit(n).join(checks.select("chequeo_id", "chequeo"), "chequeo_id").orderBy(*newest).select(
        "creada_en", "chequeo", "mensaje", F.coalesce("explicacion", F.lit(NO_EXPLANATION)).alias("explicacion")
    )
