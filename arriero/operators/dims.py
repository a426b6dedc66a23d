"""Dimensions: calendar, overwrite-in-place (SCD1), versioned (SCD2) and the service dictionary."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arriero.functions.calendar import OPEN_END, date_key, iso_weekday, month_of
from arriero.functions.identity import surrogate_key
from arriero.functions.text import last_letter
from arriero.operators.dedupe import keep_first, representative


def _differs(left: str, right: str, cols: Sequence[str]) -> Column:
    """Null-safe "any of these columns is different"."""
    tests = [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in cols]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


# ---------------------------------------------------------------- calendar

def calendar_rows(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day between the dates in columns ``first`` and ``last`` of the one-row frame ``bounds``."""
    day = F.col("fecha")
    return bounds.select(F.explode(F.sequence(F.col(first), F.col(last), F.expr("interval 1 day"))).alias("fecha")).select(
        date_key(day).alias("fecha_id"), "fecha",
        F.year(day).alias("anio"), F.quarter(day).alias("trimestre"), F.month(day).alias("mes"),
        month_of(day).alias("anio_mes"), F.dayofmonth(day).alias("dia"),
        iso_weekday(day).alias("dia_semana"), iso_weekday(day).isin(6, 7).alias("es_fin_semana"),
    )


def calendar_dim(spark: SparkSession, first: str = "2010-01-01", last: str = "2030-12-31") -> DataFrame:
    """The calendar of a fixed range of days."""
    bounds = spark.range(1).select(F.lit(first).cast("date").alias("a"), F.lit(last).cast("date").alias("b"))
    return calendar_rows(bounds, "a", "b")


# ---------------------------------------------------------------- SCD1

def scd1_upsert(dim: DataFrame, source: DataFrame, key: str, compare: Sequence[str], update: Sequence[str],
                sk: str, now: Column) -> DataFrame:
    """New keys are added; a known key is rewritten (all of ``update``) only when one of ``compare`` changed.

    ``source`` has one row per key. A full outer join replaces MERGE, which plain Parquet tables do not take.
    """
    joined = dim.alias("d").join(source.alias("s"), F.col(f"d.{key}") == F.col(f"s.{key}"), "full_outer")
    is_new = F.col(f"d.{key}").isNull()
    write = is_new | (F.col(f"s.{key}").isNotNull() & _differs("d", "s", compare))
    code = F.coalesce(F.col(f"d.{key}"), F.col(f"s.{key}"))
    return joined.select(
        F.coalesce(F.col(f"d.{sk}"), surrogate_key(code)).alias(sk),
        code.alias(key),
        *[F.when(write, F.col(f"s.{c}")).otherwise(F.col(f"d.{c}")).alias(c) for c in update],
        F.when(write, now).otherwise(F.col("d.actualizado_en")).alias("actualizado_en"),
    )


def replace_or_insert(dim: DataFrame, source: DataFrame, key: str, update: Sequence[str], now: Column) -> DataFrame:
    """Upsert that rewrites every key the source brings; the dimension is keyed by its code, without a surrogate."""
    joined = dim.alias("d").join(source.alias("s"), F.col(f"d.{key}") == F.col(f"s.{key}"), "full_outer")
    brought = F.col(f"s.{key}").isNotNull()
    return joined.select(
        F.coalesce(F.col(f"s.{key}"), F.col(f"d.{key}")).alias(key),
        *[F.when(brought, F.col(f"s.{c}")).otherwise(F.col(f"d.{c}")).alias(c) for c in update],
        F.when(brought, now).otherwise(F.col("d.actualizado_en")).alias("actualizado_en"),
    )


def empty_scd1(source: DataFrame, key: str, update: Sequence[str], sk: str | None = None) -> DataFrame:
    """A dimension without rows, typed after ``source``."""
    lead = [F.lit(None).cast("bigint").alias(sk)] if sk else []
    return source.select(*lead, key, *update, F.lit(None).cast("timestamp").alias("actualizado_en")).where("false")


def upsert_agencies(dim: DataFrame | None, stage: DataFrame, now: Column) -> DataFrame:
    update = ["nombre_organismo", "sector"]
    source = representative(stage, "codigo_organismo", update)
    dim = empty_scd1(source, "codigo_organismo", update, "sk_organismo") if dim is None else dim
    return scd1_upsert(dim, source, "codigo_organismo", update, update, "sk_organismo", now)


def upsert_units(dim: DataFrame | None, stage: DataFrame, now: Column) -> DataFrame:
    """Only a new name or region triggers the rewrite, which then also takes the tax id and the agency."""
    update = ["nombre_unidad", "rut_unidad", "region_unidad", "codigo_organismo"]
    source = representative(stage, "codigo_unidad", update)
    dim = empty_scd1(source, "codigo_unidad", update, "sk_unidad") if dim is None else dim
    return scd1_upsert(dim, source, "codigo_unidad", ["nombre_unidad", "region_unidad"], update, "sk_unidad", now)


def scd1_history(months: DataFrame, key: str, since: str, compare: Sequence[str], update: Sequence[str], sk: str, now: Column) -> DataFrame:
    """The dimension after loading one row per (key, period) in ascending order into an empty one: each key has the ``update`` values
    of the last period in which one of ``compare`` changed. One shuffle; a key's group is bounded by the number of periods."""
    by_key = Window.partitionBy(key).orderBy(since)
    before = F.lag(F.struct(*compare)).over(by_key)
    changed = months.withColumn("_before", before).where(F.col("_before").isNull() | ~F.col("_before").eqNullSafe(F.struct(*compare)))
    last = changed.groupBy(key).agg(F.max_by(F.struct(*update), since).alias("_u"))
    return last.select(surrogate_key(F.col(key)).alias(sk), key, *[F.col(f"_u.{c}").alias(c) for c in update], now.alias("actualizado_en"))


AGENCY, AGENCY_ATTRIBUTES = "codigo_organismo", ["nombre_organismo", "sector"]
UNIT, UNIT_ATTRIBUTES, UNIT_COMPARED = "codigo_unidad", ["nombre_unidad", "rut_unidad", "region_unidad", "codigo_organismo"], ["nombre_unidad", "region_unidad"]
SUPPLIER, SUPPLIER_TRACKED, SUPPLIER_OVERWRITTEN, SUPPLIER_PASSIVE = (
    "codigo_proveedor", ["nombre_proveedor"], ["rut_proveedor", "actividad_proveedor", "region_proveedor"], ["es_persona_natural"])


def star_loads(stage: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What each month of ``stage`` brings to the dimensions: one row per (agency, month), (unit, month) and (supplier, month)."""
    return (representative(stage, [AGENCY, "mes"], AGENCY_ATTRIBUTES), representative(stage, [UNIT, "mes"], UNIT_ATTRIBUTES),
            representative(stage, [SUPPLIER, "mes"], [*SUPPLIER_TRACKED, *SUPPLIER_OVERWRITTEN], SUPPLIER_PASSIVE))


def agency_history(loads: DataFrame, now: Column) -> DataFrame:
    return scd1_history(loads, AGENCY, "mes", AGENCY_ATTRIBUTES, AGENCY_ATTRIBUTES, "sk_organismo", now)


def unit_history(loads: DataFrame, now: Column) -> DataFrame:
    return scd1_history(loads, UNIT, "mes", UNIT_COMPARED, UNIT_ATTRIBUTES, "sk_unidad", now)


def supplier_history(loads: DataFrame) -> DataFrame:
    """Supplier versions from loads whose ``mes`` is a month, or the whole date on which a stored version began."""
    dated = loads.withColumn("_desde", F.to_date(F.concat(F.substring("mes", 1, 7), F.lit("-01"))))
    versions = scd2_history(dated, SUPPLIER, "_desde", SUPPLIER_TRACKED, SUPPLIER_OVERWRITTEN, SUPPLIER_PASSIVE)
    return versions.select(surrogate_key(F.col(SUPPLIER), F.col("vigente_desde")).alias("sk_proveedor"), *versions.columns)


def star_history(stage: DataFrame, now: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(agencies, units, supplier versions) after loading all months of ``stage`` in ascending order, in one plan."""
    agencies, units, suppliers = star_loads(stage)
    return agency_history(agencies, now), unit_history(units, now), supplier_history(suppliers)


def splice_scd1(stored: DataFrame, history: DataFrame, key: str, update: Sequence[str]) -> DataFrame:
    """``stored`` with the keys of ``history`` replaced; a key whose values did not change keeps its time."""
    before = stored.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{c}") for c in update], F.col("actualizado_en").alias("_at"))
    same = F.lit(True)
    for c in update:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    fresh = history.join(before, F.col(key) == F.col("_k"), "left").withColumn("actualizado_en", F.when(F.col("_k").isNotNull() & same, F.col("_at")).otherwise(F.col("actualizado_en")))
    return stored.join(history.select(key), key, "left_anti").select(*stored.columns).unionByName(fresh.select(*stored.columns))


# ---------------------------------------------------------------- SCD2

def scd2_apply(dim: DataFrame, source: DataFrame, key: str, tracked: Sequence[str], overwrite: Sequence[str],
               effective: Column, sk: str, passive: Sequence[str] = ()) -> DataFrame:
    """Apply one load to a versioned dimension.

    In this order, for the current version of each key in ``source`` (one row per key):

    1. when one of ``overwrite`` differs, ``overwrite`` and ``passive`` take the new values;
    2. when ``tracked`` differs and the version began on or after ``effective``, it is corrected in place;
    3. when ``tracked`` differs and the version is older, it is closed the day before ``effective``;
    4. keys left without a current version get one that begins at ``effective``.

    Step 1 comes first, so a version closed by this load already carries its ``overwrite`` values. Loading an older
    period after a newer one falls under step 2. All four steps are one join that emits one or two rows per match.
    """
    attrs = [*tracked, *overwrite, *passive]
    names = [sk, key, *attrs, "vigente_desde", "vigente_hasta", "es_vigente"]
    d, s = (lambda c: F.col(f"d.{c}")), (lambda c: F.col(f"s.{c}"))
    joined = dim.alias("d").join(source.alias("s"), (d(key) == s(key)) & d("es_vigente"), "full_outer")

    matched = d(key).isNotNull() & s(key).isNotNull()
    refresh = matched & _differs("d", "s", overwrite)
    renamed = matched & _differs("d", "s", tracked)
    in_place = renamed & (d("vigente_desde") >= effective)
    closing = renamed & (d("vigente_desde") < effective)

    def version(values: dict[str, Column]) -> Column:
        return F.struct(*[values[n].cast(dim.schema[n].dataType).alias(n) for n in names])

    kept = version({
        sk: d(sk), key: d(key),
        **{c: F.when(in_place, s(c)).otherwise(d(c)) for c in tracked},
        **{c: F.when(refresh, s(c)).otherwise(d(c)) for c in [*overwrite, *passive]},
        "vigente_desde": d("vigente_desde"),
        "vigente_hasta": F.when(closing, F.date_sub(effective, 1)).otherwise(d("vigente_hasta")),
        "es_vigente": F.when(closing, F.lit(False)).otherwise(d("es_vigente")),
    })
    opened = version({
        sk: surrogate_key(s(key), effective), key: s(key), **{c: s(c) for c in attrs},
        "vigente_desde": effective, "vigente_hasta": F.lit(OPEN_END), "es_vigente": F.lit(True),
    })
    rows = F.when(d(key).isNull(), F.array(opened)).when(closing, F.array(kept, opened)).otherwise(F.array(kept))
    return joined.select(F.inline(rows))


def empty_scd2(source: DataFrame, key: str, attributes: Sequence[str], sk: str) -> DataFrame:
    return source.select(
        F.lit(None).cast("bigint").alias(sk), key, *attributes,
        F.lit(None).cast("date").alias("vigente_desde"), F.lit(None).cast("date").alias("vigente_hasta"),
        F.lit(None).cast("boolean").alias("es_vigente"),
    ).where("false")


def upsert_suppliers(dim: DataFrame | None, stage: DataFrame, effective: Column) -> DataFrame:
    """Only the name is versioned; branch attributes are overwritten on the current version."""
    tracked, overwrite = ["nombre_proveedor"], ["rut_proveedor", "actividad_proveedor", "region_proveedor"]
    passive = ["es_persona_natural"]
    source = representative(stage, "codigo_proveedor", [*tracked, *overwrite], passive)
    if dim is None:
        dim = empty_scd2(source, "codigo_proveedor", [*tracked, *overwrite, *passive], "sk_proveedor")
    return scd2_apply(dim, source, "codigo_proveedor", tracked, overwrite, effective, "sk_proveedor", passive)


def scd2_history(snapshots: DataFrame, key: str, since: str, tracked: Sequence[str], overwrite: Sequence[str],
                 passive: Sequence[str] = ()) -> DataFrame:
    """All versions at once, from one snapshot row per (key, period); ``since`` is the first day of the period.

    Equals applying ``scd2_apply`` period by period in ascending order. A closed version shows the ``overwrite`` values
    of the snapshot that opened its successor; the open one shows the last snapshot's. All windows hash on the key, so
    there is one shuffle, and a key's group is bounded by the number of periods.
    """
    by_key = Window.partitionBy(key).orderBy(since)
    whole = by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def pack(cols: Sequence[str]) -> Column:
        return F.struct(*[F.col(c).alias(c) for c in cols]) if cols else F.struct(F.lit(0).alias("_"))

    prior = snapshots.withColumn("_t", F.lag(pack(tracked)).over(by_key)).withColumn("_o", F.lag(pack(overwrite)).over(by_key))
    flagged = prior.withColumn("_opens", F.col("_t").isNull() | ~F.col("_t").eqNullSafe(pack(tracked))).withColumn(
        "_moved", F.col("_o").isNull() | ~F.col("_o").eqNullSafe(pack(overwrite))
    )
    held = flagged.withColumn("_p", F.last(F.when(F.col("_opens") | F.col("_moved"), pack(passive)), True).over(by_key))
    held = held.withColumn("_p_prior", F.lag("_p").over(by_key))
    at_end = held.withColumn("_last", F.last(F.struct(pack(overwrite).alias("o"), F.col("_p").alias("p"))).over(whole))
    closing = F.struct(
        pack(overwrite).alias("o"), F.when(F.col("_moved"), pack(passive)).otherwise(F.col("_p_prior")).alias("p")
    )
    openers = (
        at_end.withColumn("_closing", closing)
        .where(F.col("_opens"))
        .withColumn("_next", F.lead(F.struct(F.col(since).alias("d"), F.col("_closing").alias("c"))).over(by_key))
    )
    shown = F.coalesce(F.col("_next.c"), F.col("_last"))
    return openers.select(
        key, *tracked,
        *[shown["o"][c].alias(c) for c in overwrite],
        *[shown["p"][c].alias(c) for c in passive],
        F.col(since).alias("vigente_desde"),
        F.coalesce(F.date_sub(F.col("_next.d"), 1), F.lit(OPEN_END).cast("date")).alias("vigente_hasta"),
        F.col("_next").isNull().alias("es_vigente"),
    )


# ---------------------------------------------------------------- service dictionary

SERVICE_COLUMNS = ["codigo_mtt", "servicio_deco", "tipo_servicio", "unidad"]


def service_rows(deco: DataFrame) -> DataFrame:
    """One service per public code: the row of its first route code."""
    return keep_first(deco, ["codigo_usuario"], ["codigo_ruta", "codigo_mtt", "servicio_deco", "tipo_servicio", "cli_dsc"]).select(
        "codigo_usuario", "codigo_mtt", "servicio_deco", "tipo_servicio", F.col("cli_dsc").alias("unidad")
    )


def route_rows(deco: DataFrame) -> DataFrame:
    """Routes with the direction their code ends in (outbound, return), NULL for other endings."""
    return deco.select("codigo_ruta", "codigo_usuario", last_letter("codigo_ruta", ("I", "R")).alias("sentido"))


def unique_routes(routes: DataFrame) -> DataFrame:
    """The routes, one per code. Identical rows collapse; a code with different rows stops the job before anything is loaded."""
    grouped = routes.groupBy("codigo_ruta").agg(F.min(F.struct("codigo_usuario", "sentido")).alias("_a"), F.max(F.struct("codigo_usuario", "sentido")).alias("_b"))
    code = F.when(F.col("_a").eqNullSafe(F.col("_b")), F.col("codigo_ruta")).otherwise(
        F.raise_error(F.concat(F.lit("route code with different rows: "), F.coalesce("codigo_ruta", F.lit("NULL")))).cast("string"))
    return grouped.select(code.alias("codigo_ruta"), "_a.codigo_usuario", "_a.sentido")


def route_violations(routes: DataFrame, services: DataFrame) -> DataFrame:
    """Rows per broken rule (regla, filas): route codes that repeat, and routes whose service does not exist."""
    repeated = routes.groupBy("codigo_ruta").agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.count(F.lit(1)).alias("filas"))
    codes = routes.groupBy("codigo_usuario").agg(F.count(F.lit(1)).alias("n"))
    missing = codes.join(services.select("codigo_usuario"), "codigo_usuario", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("filas"))
    return repeated.select(F.lit("recorrido duplicado").alias("regla"), "filas").unionByName(missing.select(F.lit("recorrido sin servicio").alias("regla"), "filas"))


def service_dim(deco: DataFrame, now: Column, dim: DataFrame | None = None) -> DataFrame:
    rows = service_rows(deco)
    dim = empty_scd1(rows, "codigo_usuario", SERVICE_COLUMNS) if dim is None else dim
    return replace_or_insert(dim, rows, "codigo_usuario", SERVICE_COLUMNS, now)


def route_dim(deco: DataFrame, now: Column, dim: DataFrame | None = None) -> DataFrame:
    rows = unique_routes(route_rows(deco))
    dim = empty_scd1(rows, "codigo_ruta", ["codigo_usuario", "sentido"]) if dim is None else dim
    return replace_or_insert(dim, rows, "codigo_ruta", ["codigo_usuario", "sentido"], now)


def dictionary_summary(services: DataFrame, routes: DataFrame) -> DataFrame:
    """Labelled counters: services, routes, routes without direction; one pass over each table."""
    no_direction = F.count(F.when(F.col("sentido").isNull(), 1))
    route_counts = routes.agg(F.count(F.lit(1)).alias("n"), no_direction.alias("sin"))
    return services.agg(F.count(F.lit(1)).alias("total")).select(F.lit("servicios").alias("concepto"), "total").unionByName(
        route_counts.select(
            F.stack(F.lit(2), F.lit("recorridos"), F.col("n"), F.lit("sin sentido"), F.col("sin")).alias("concepto", "total")
        )
    )
