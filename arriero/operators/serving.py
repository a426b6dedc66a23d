"""Read queries over published documents and the current vehicle state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arriero.operators.dedupe import keep_top

# Output fields of the read interface and its default limits.
DEFAULT_ALERTS, DEFAULT_VEHICLES = 20, 100
VEHICLE_COLUMNS = ["patente", "latitud", "longitud", "velocidad", "sentido", "ruta_sinoptico", "fecha_gps"]


def _limit(n: int) -> int:
    if n < 1:
        raise ValueError("the limit must be at least 1")
    return n


def latest_month(documents: DataFrame) -> Column:
    """The newest published month, as a scalar subquery."""
    return documents.agg(F.max("mes")).scalar()


def entity_summary(documents: DataFrame, codigo: str | None = None, mes: str | None = None) -> DataFrame:
    """The document of one agency (or of all) for a month, by default the newest; no row means not found."""
    found = documents.where(F.col("mes") == (F.lit(mes) if mes else latest_month(documents)))
    return found if codigo is None else found.where(F.col("codigo_organismo") == codigo)


def concentration_alerts(documents: DataFrame, mes: str | None = None, hhi_min: int = 2500, limite: int | None = None) -> DataFrame:
    """Agencies at or above the HHI threshold, most concentrated first, each with its leading supplier only.

    With ``mes`` the result is that month's first ``limite`` (``DEFAULT_ALERTS`` unless given). Without it, all alerts of every
    month, or the first ``limite`` of each where one is asked for.
    """
    order = [F.col("hhi").desc(), F.col("monto_clp").desc(), F.col("codigo_organismo").asc()]
    hits = documents.where(F.col("hhi") >= hhi_min).withColumn(
        "principales_proveedores", F.slice("principales_proveedores", 1, 1)
    )
    if mes is not None:
        return hits.where(F.col("mes") == mes).orderBy(*order).limit(_limit(DEFAULT_ALERTS if limite is None else limite))
    if limite is None:
        return hits.orderBy("mes", *order)
    return keep_top(hits, ["mes"], order, _limit(limite), "posicion_alerta")


def active_by_service(state: DataFrame, servicio: str, sentido: str | None = None, limite: int = DEFAULT_VEHICLES) -> DataFrame:
    """Newest vehicles of a service with the number of active ones before the limit."""
    if sentido not in (None, "I", "R"):
        raise ValueError("sentido must be I or R")
    running = state.where(F.col("servicio") == servicio)
    if sentido:
        running = running.where(F.col("sentido") == sentido)
    total = running.agg(F.count(F.lit(1))).scalar()
    newest = running.orderBy(F.col("fecha_gps").desc(), F.col("patente").asc()).limit(_limit(limite))
    return newest.select(F.lit(servicio).alias("servicio"), total.alias("buses_activos"), *VEHICLE_COLUMNS)


def active_by_every_service(state: DataFrame, limite: int | None = None) -> DataFrame:
    """``active_by_service`` for all services in one pass: the vehicles of each and its total.

    All vehicles, or the newest ``limite`` of each service, numbered, where a limit is asked for.
    """
    totals = state.groupBy("servicio").agg(F.count(F.lit(1)).alias("buses_activos"))
    if limite is None:
        return state.join(totals, "servicio").select("servicio", "buses_activos", *VEHICLE_COLUMNS)
    order = [F.col("fecha_gps").desc(), F.col("patente").asc()]
    newest = keep_top(state, ["servicio"], order, _limit(limite), "posicion")
    return newest.join(totals, "servicio").select("servicio", "buses_activos", "posicion", *VEHICLE_COLUMNS)


def speed_class(kmh: Column | str) -> Column:
    """Fixed map classes: stopped, under 20 km/h, 20 km/h or more."""
    v = F.col(kmh) if isinstance(kmh, str) else kmh
    return F.when(v == 0, "detenido").when(v < 20, "menos de 20 km/h").when(v >= 20, "20 km/h o más")
