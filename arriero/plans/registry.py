"""The registered queries: each takes (spark, folder of the test tables) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arriero.functions.calendar import month_of
from arriero.functions.identity import is_natural_person
from arriero.functions.text import decimal_comma
from arriero.operators import concentration as conc
from arriero.operators import dims, facts, incremental, integrity, quality, serving
from arriero.operators.dedupe import keep_latest
from arriero.operators.privacy import keep_only, pseudonymise
from arriero.plans import fixtures as fx
from arriero.plans import jobs
from arriero.plans.oracle import PERSON_KEY
from arriero.plans.sql import run_query
from arriero.session import scratch_dir
from arriero.sinks.publish import publish_months
from arriero.sinks.tables import OPEN_FILES, freed_shuffles, register_table, replace_partitions, setting
from arriero.sources import positions as pos
from arriero.sources.dictionary import DICTIONARY_COLUMNS, read_dictionary_csv
from arriero.sources.files import content_digests
from arriero.sources.procurement import CSV_OPTIONS, read_items_csv, read_orders_json, typed_items, typed_orders
from arriero.streaming import positions as stream
from arriero.streaming.expiry import expiring_latest, rocksdb

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LOAD_1, LOAD_2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def register(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and times as ISO text: types that compare the same in any engine."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        out.append(c.alias(f.name))
    return df.select(*out)


def moment(text: str, kind: str = "timestamp_ntz"):
    return F.lit(text).cast(kind)


# ---------------------------------------------------------------- concentration

def pairs(spark: SparkSession, sf: str, newest_only: bool = False) -> DataFrame:
    """Agency-supplier amounts as a written table: the summary reads them twice."""
    newest = fx.table(spark, sf, "orders").agg(F.date_trunc("month", F.max("o_orderdate"))).scalar() if newest_only else None
    return fx.written(conc.pair_totals(fx.orders(spark, sf, newest)), "pares")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return conc.nest_top(conc.spend_concentration(pairs(spark, sf)))


def exploded(docs: DataFrame) -> DataFrame:
    """Documents with one row per listed supplier."""
    flat = [c for c in docs.columns if c != "principales_proveedores"]
    rows = docs.select(*flat, F.explode("principales_proveedores").alias("p"))
    return rows.select(*flat, *[F.col(f"p.{c}").alias(f"p_{c}") for c in (
        "posicion", "codigo_proveedor", "nombre_proveedor", "rut_proveedor", "monto_clp", "ordenes", "pct_monto")])


@register
def spend_concentration(spark: SparkSession, sf: str) -> DataFrame:
    """The newest month."""
    return plain(conc.spend_concentration(pairs(spark, sf, newest_only=True)))


@register
def spend_concentration_all_months(spark: SparkSession, sf: str) -> DataFrame:
    return plain(conc.spend_concentration(pairs(spark, sf)))


@register
def spend_concentration_star(spark: SparkSession, sf: str) -> DataFrame:
    """The same summary from facts and dimensions, summed on integer keys before the dimensions are joined."""
    stage, agency, unit, supplier = star_inputs(spark, sf, items=False)
    orders = facts.load_fact_orders(stage, agency, unit, supplier)
    return plain(conc.spend_concentration(fx.written(conc.star_pair_totals(orders, agency, supplier), "pares")))


@register
def entity_documents(spark: SparkSession, sf: str) -> DataFrame:
    return exploded(documents(spark, sf))


@register
def hhi_by_entity(spark: SparkSession, sf: str) -> DataFrame:
    return conc.entity_totals(conc.pair_totals(fx.orders(spark, sf))).select("mes", "codigo_organismo", "proveedores", "hhi")


@register
def flagged_spend_share(spark: SparkSession, sf: str) -> DataFrame:
    totals = conc.entity_totals(conc.pair_totals(fx.orders(spark, sf)))
    return plain(totals.select("mes", "codigo_organismo", "monto_trato_directo_clp", "monto_compra_agil_clp",
                               "pct_monto_trato_directo", "pct_monto_compra_agil"))


@register
def concentration_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Every month's alerts, each with its leading supplier."""
    return exploded(serving.concentration_alerts(documents(spark, sf)))


@register
def entity_summary_latest(spark: SparkSession, sf: str) -> DataFrame:
    """All agencies in the newest published month, read through the publication registry."""
    root = scratch_dir(spark, "resumen")
    docs = fx.written(documents(spark, sf), "docs").select(*jobs.DOCUMENT_COLUMNS)
    publish_months(root, jobs.DOCUMENTS, docs, fx.order_month_list(docs))
    return exploded(serving.entity_summary(jobs.read_documents(spark, root)))


# ---------------------------------------------------------------- ingestion

@register
def dedupe_latest_item(spark: SparkSession, sf: str) -> DataFrame:
    latest = keep_latest(fx.item_lines(spark, sf), ["id_item"], fx.ITEM_ORDER)
    return plain(latest.select("id_item", "codigo", "codigo_proveedor", "fecha_ultima_modificacion", "cantidad", "total_linea_neto"))


ITEM_OUTPUT = [
    "id_item", "codigo", "nombre", "tipo", "es_trato_directo", "es_compra_agil", "codigo_estado", "fecha_envio",
    "fecha_aceptacion", "fecha_ultima_modificacion", "total_neto_oc", "porcentaje_iva", "codigo_organismo", "region_unidad",
    "codigo_proveedor", "nombre_proveedor", "rut_proveedor", "codigo_licitacion", "cantidad", "precio_neto",
    "total_linea_neto", "mes",
]


#: How the fixtures write bulk files. A bulk file is one task however it is stored, so compressing it costs no parallelism.
RAW_OPTIONS = {k: v for k, v in CSV_OPTIONS.items() if k != "multiLine"} | {"emptyValue": "", "compression": "gzip"}


#: More months than a task keeps open at once are sorted, the others are not.
OPEN_MONTHS = "200"


def write_raw_items(rows: DataFrame, root: str, mode: str = "errorifexists") -> None:
    """Bulk files of the months, written where the rows are: a task appends to a file of each month, so that no text is shuffled.

    A month has at most as many files as there are tasks, which are two for each core.
    """
    spark = rows.sparkSession
    few = rows.coalesce(2 * spark.sparkContext.defaultParallelism)
    with freed_shuffles(spark), setting(spark, OPEN_FILES, OPEN_MONTHS):
        few.write.mode(mode).options(**RAW_OPTIONS).partitionBy("mes").csv(root)


def raw_item_files(spark: SparkSession, sf: str) -> str:
    root = f"{scratch_dir(spark, 'crudo')}/items"
    write_raw_items(fx.raw_items(spark, sf), root)
    return root


def raw_order_files(spark: SparkSession, sf: str) -> str:
    path = f"{scratch_dir(spark, 'crudo')}/ordenes"
    with freed_shuffles(spark):
        fx.raw_orders(spark, sf).write.option("compression", "gzip").text(path)
    return path


@register
def typed_items_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Text files in the bulk format, read back, typed and deduplicated."""
    return plain(typed_items(read_items_csv(spark, raw_item_files(spark, sf))).select(*ITEM_OUTPUT))


@register
def typed_orders_nested(spark: SparkSession, sf: str) -> DataFrame:
    orders = typed_orders(read_orders_json(spark, raw_order_files(spark, sf)))
    return plain(orders.drop("estado", "fecha_aceptacion", "fecha_cancelacion", "impuestos", "rut_unidad", "nombre_unidad",
                             "comuna_unidad", "actividad_proveedor"))


@register
def masked_items_job(spark: SparkSession, sf: str) -> DataFrame:
    """The whole items job: files in, masked partitions out, read back."""
    raw, base = raw_item_files(spark, sf), scratch_dir(spark, "items")
    months = fx.order_month_list(fx.order_headers(spark, sf))
    jobs.items_job(spark, raw, months, f"{base}/items", f"{base}/sensible", PERSON_KEY)
    return plain(jobs.read_months(spark, f"{base}/items").select("mes", "id_item", "nombre_proveedor", "rut_proveedor", "es_persona_natural"))


@register
def person_dictionary_job(spark: SparkSession, sf: str) -> DataFrame:
    """The restricted dictionary the items job writes, per month."""
    raw, base = raw_item_files(spark, sf), scratch_dir(spark, "items")
    months = fx.order_month_list(fx.order_headers(spark, sf))
    jobs.items_job(spark, raw, months, f"{base}/items", f"{base}/sensible", PERSON_KEY)
    return jobs.read_months(spark, f"{base}/sensible").select("mes", "token_proveedor", "rut_proveedor", "nombre_proveedor")


@register
def typed_items_mixed_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Bulk files whose months differ in column order, with an extra column or without an optional one."""
    raw = fx.written(fx.raw_items(spark, sf), "textos")  # read three times
    root = f"{scratch_dir(spark, 'mixto')}/items"
    month = F.substring("mes", 6, 2).cast("int") % 3
    shapes = [raw.columns, list(reversed(raw.columns)), ["Extra", *[c for c in raw.columns if c != "Estado"]]]
    for i, columns in enumerate(shapes):
        part = raw.withColumn("Extra", F.lit("sobra")).where(month == i).select(*columns)
        write_raw_items(part, root, "append")
    return plain(typed_items(read_items_csv(spark, root)).select(*ITEM_OUTPUT))


@register
def orders_job_table(spark: SparkSession, sf: str) -> DataFrame:
    """The orders job: nested files to a masked partition, registered in the catalog and read through it."""
    base = scratch_dir(spark, "ordenes")
    jobs.orders_job(spark, raw_order_files(spark, sf), "2024-01-31", f"{base}/ordenes", f"{base}/sensible", PERSON_KEY, "arriero_ordenes")
    return plain(spark.table("arriero_ordenes").select("codigo", "codigo_organismo", "codigo_proveedor", "total", "fecha"))


@register
def comma_decimal_parse(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    money = F.translate(F.col("c_acctbal").cast("decimal(12,2)").cast("string"), ".", ",")
    text = (
        F.when(key % 7 == 0, "   ").when(key % 7 == 1, F.concat(F.lit("1."), money))
        .when(key % 7 == 2, F.concat(F.lit("  "), money, F.lit(" "))).otherwise(money)
    )
    rows = fx.table(spark, sf, "customer").select("c_custkey", text.alias("texto"))
    return rows.select("c_custkey", "texto", decimal_comma("texto").cast("double").alias("monto"))


@register
def natural_person_flag(spark: SparkSession, sf: str) -> DataFrame:
    """Flag over plain, dotted, dashless, malformed and missing tax ids."""
    k = F.col("l_suppkey")
    body = F.substring_index("rut_proveedor", "-", 1).cast("bigint")
    dotted = F.concat(F.translate(F.format_number(body, 0), ",", "."), F.lit("-"), F.substring_index("rut_proveedor", "-", -1))
    variant = (
        F.when(k % 5 == 0, dotted).when(k % 5 == 1, body.cast("string")).when(k % 10 == 2, F.lit("sin rut"))
        .when(k % 10 == 7, F.lit(None).cast("string")).otherwise(F.col("rut_proveedor"))
    )
    rows = fx.suppliers(spark, sf).select(k.alias("s_suppkey"), variant.alias("rut"))
    return rows.withColumn("es_persona_natural", is_natural_person("rut"))


@register
def pseudonymised_items(spark: SparkSession, sf: str) -> DataFrame:
    masked, _ = pseudonymise(fx.decorated(fx.line_keys(spark, sf), spark, sf), PERSON_KEY)
    return plain(masked.select("id_item", "fecha_ultima_modificacion", "total_linea_neto", "nombre_proveedor", "rut_proveedor",
                               "es_persona_natural"))


@register
def pseudonym_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return pseudonymise(fx.decorated(fx.line_keys(spark, sf), spark, sf), PERSON_KEY)[1]


# ---------------------------------------------------------------- dimensions and facts

@register
def calendar_dim(spark: SparkSession, sf: str) -> DataFrame:
    """Calendar over the years the orders span."""
    day = F.col("o_orderdate")
    bounds = fx.table(spark, sf, "orders").agg(
        F.trunc(F.min(day), "year").alias("a"), F.last_day(F.max(day)).alias("b"))
    return plain(dims.calendar_rows(bounds, "a", "b"))


def two_loads(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    items = fx.written(
        fx.items(spark, sf)
        .select("mes", "codigo_organismo", "nombre_organismo", F.col("codigo").alias("sector"), "codigo_unidad", "nombre_unidad",
                F.col("rubro_n2").alias("rut_unidad"), F.col("rubro_n1").alias("region_unidad")), "cargas")
    return items.where(F.col("mes") < fx.SECOND_LOAD_FROM), items.where(F.col("mes") >= fx.SECOND_LOAD_FROM)


@register
def scd1_entity(spark: SparkSession, sf: str) -> DataFrame:
    first, second = two_loads(spark, sf)
    dim = dims.upsert_agencies(None, first, moment(LOAD_1, "timestamp"))
    return plain(dims.upsert_agencies(dim, second, moment(LOAD_2, "timestamp")).drop("sk_organismo"))


@register
def scd1_unit(spark: SparkSession, sf: str) -> DataFrame:
    """A changed name or region also rewrites the tax id and agency; a changed tax id alone does not."""
    first, second = two_loads(spark, sf)
    dim = dims.upsert_units(None, first, moment(LOAD_1, "timestamp"))
    return plain(dims.upsert_units(dim, second, moment(LOAD_2, "timestamp")).drop("sk_unidad"))


@register
def scd2_supplier(spark: SparkSession, sf: str) -> DataFrame:
    """Yearly loads applied one after another."""
    snapshots = fx.written(fx.buyer_snapshots(spark, sf, "year"), "anual", "desde")
    dim = dims.empty_scd2(snapshots.drop("desde"), "codigo", ["nombre", "region", "persona"], "sk")
    for start in fx.order_month_list(snapshots, "desde"):
        load = snapshots.where(F.col("desde") == F.lit(start)).drop("desde")
        dim = dims.scd2_apply(dim, load, "codigo", ["nombre"], ["region"], F.lit(start), "sk", ["persona"])
    return plain(dim.drop("sk"))


@register
def scd2_history(spark: SparkSession, sf: str) -> DataFrame:
    """All monthly loads at once."""
    return plain(dims.scd2_history(fx.buyer_snapshots(spark, sf, "month"), "codigo", "desde", ["nombre"], ["region"], ["persona"]))


#: Columns of the stage that only item facts and item checks read.
ITEM_ONLY = ("id_item", "fecha_ultima_modificacion", "codigo_producto_onu", "producto_generico", "rubro_n1", "rubro_n2", "rubro_n3", "cantidad",
             "unidad_medida", "moneda_item", "precio_neto", "total_linea_neto")


def star_inputs(spark: SparkSession, sf: str, items: bool = True) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Stage and dimensions as written tables, the state the fact loads start from; without ``items`` for order facts only, all rows in fewer columns."""
    stage = _star_stage(spark, sf, without=() if items else ITEM_ONLY)
    now = moment(LOAD_1, "timestamp")
    return (
        stage,
        fx.written(dims.upsert_agencies(None, stage, now), "organismo"),
        fx.written(dims.upsert_units(None, stage, now), "unidad"),
        fx.written(dims.upsert_suppliers(None, stage, F.lit("1990-01-01").cast("date")), "proveedor"),
    )


def _codes(fact: DataFrame, *joins: tuple[DataFrame, str, str]) -> DataFrame:
    for dim, sk, code in joins:
        fact = fact.join(dim.select(sk, code), sk, "left").drop(sk)
    return fact


@register
def fact_items(spark: SparkSession, sf: str) -> DataFrame:
    items = fx.written(fx.items(spark, sf).withColumn("actividad_proveedor", F.lit(None).cast("string")), "items")
    agency = fx.written(dims.upsert_agencies(None, items, moment(LOAD_1, "timestamp")), "organismo")
    supplier = fx.written(dims.upsert_suppliers(None, items, F.lit("1990-01-01").cast("date")), "proveedor")
    fact = facts.load_fact_items(items, agency, supplier)
    return plain(_codes(fact, (agency, "sk_organismo", "codigo_organismo"), (supplier, "sk_proveedor", "codigo_proveedor")))


@register
def fact_orders(spark: SparkSession, sf: str) -> DataFrame:
    stage, agency, unit, supplier = star_inputs(spark, sf, items=False)
    fact = facts.load_fact_orders(stage, agency, unit, supplier)
    named = _codes(fact, (agency, "sk_organismo", "codigo_organismo"), (unit, "sk_unidad", "codigo_unidad"),
                   (supplier, "sk_proveedor", "codigo_proveedor"))
    return plain(named)


@register
def month_replace(spark: SparkSession, sf: str) -> DataFrame:
    """Load all months, reload them, then replace the newest month by nothing."""
    root = f"{scratch_dir(spark, 'meses')}/items"
    items = fx.written(fx.items(spark, sf).select("id_item", "codigo", "mes", "total_linea_neto"), "items", "mes")
    months = fx.order_month_list(items)
    replace_partitions(items, root, months)
    replace_partitions(items, root, months)
    replace_partitions(items.where("false"), root, months[-1:])
    return plain(jobs.read_months(spark, root, schema=items.schema).select(*items.columns))


def _star_stage(spark: SparkSession, sf: str, without: tuple[str, ...] = ()) -> DataFrame:
    """Stage as a written table, without folders per month: gathering them is a shuffle of all columns."""
    stage = fx.stage(spark, sf).withColumn("rut_unidad", F.lit(None).cast("string")).withColumn("actividad_proveedor", F.lit(None).cast("string"))
    return fx.written(stage.drop(*without), "stage")


@register
def warehouse_months(spark: SparkSession, sf: str) -> DataFrame:
    """The star of all months in one load through the publication registry, then summarised and published as documents."""
    base = scratch_dir(spark, "bodega")
    stage = _star_stage(spark, sf)
    months = fx.order_month_list(stage)
    jobs.backfill_months(spark, stage, base, months, moment(LOAD_1, "timestamp"), calendar=dims.calendar_dim(spark, "1990-01-01"))
    jobs.summary_job(spark, base, months, f"{base}/api")
    return exploded(jobs.read_documents(spark, f"{base}/api"))


@register
def minimised_items(spark: SparkSession, sf: str) -> DataFrame:
    """Items without any column of a person, by an allow-list that also names columns the table lacks."""
    rows = fx.decorated(fx.line_keys(spark, sf), spark, sf)
    return plain(keep_only(rows, ["id_item", "codigo", "cantidad", "total_linea_neto", "sector", "no_existe"]))


@register
def warehouse_increment(spark: SparkSession, sf: str) -> DataFrame:
    """The star of every second month, then of the months between them in one plan; summarised and published."""
    base = scratch_dir(spark, "bodega")
    stage = _star_stage(spark, sf)
    months, calendar = fx.order_month_list(stage), dims.calendar_dim(spark, "1990-01-01")
    for some in (months[::2], months[1::2]):
        jobs.increment_months(spark, stage, base, some, moment(LOAD_1, "timestamp"), calendar)
    jobs.summary_job(spark, base, months, f"{base}/api")
    return exploded(jobs.read_documents(spark, f"{base}/api"))


@register
def publish_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents published twice and read through the registry."""
    root = scratch_dir(spark, "publicado")
    docs = fx.written(documents(spark, sf), "docs").select(*jobs.DOCUMENT_COLUMNS)
    months = fx.order_month_list(docs)
    publish_months(root, jobs.DOCUMENTS, docs, months)
    publish_months(root, jobs.DOCUMENTS, docs, months)
    return exploded(jobs.read_documents(spark, root))


@register
def register_catalog_table(spark: SparkSession, sf: str) -> DataFrame:
    """Partitioned files registered in the catalog and counted through it."""
    root = f"{scratch_dir(spark, 'catalogo')}/items"
    items = fx.items(spark, sf).select("id_item", "codigo", "mes", "total_linea_neto")
    items.hint("rebalance", "mes").write.partitionBy("mes").parquet(root)
    register_table(spark, "arriero_items", root, items)
    return quality.items_per_month(spark.table("arriero_items"))


# ---------------------------------------------------------------- quality

@register
def items_per_month(spark: SparkSession, sf: str) -> DataFrame:
    return quality.items_per_month(fx.items(spark, sf))


@register
def latest_check_status(spark: SparkSession, sf: str) -> DataFrame:
    return plain(quality.latest_check_status(fx.check_log(spark, sf)))


@register
def volume_over_time(spark: SparkSession, sf: str) -> DataFrame:
    return plain(quality.measure_over_time(fx.check_log(spark, sf), "view"))


@register
def alert_feed(spark: SparkSession, sf: str) -> DataFrame:
    log = fx.check_log(spark, sf)
    alerts = quality.alerts_from(log).withColumn("alerta_id", F.col("chequeo_id"))
    return plain(quality.alert_feed(alerts, log))


@register
def alerts_total(spark: SparkSession, sf: str) -> DataFrame:
    return quality.alerts_total(quality.alerts_from(fx.check_log(spark, sf)))


@register
def failed_checks_24h(spark: SparkSession, sf: str) -> DataFrame:
    log = fx.check_log(spark, sf)
    return quality.failed_checks_24h(log, log.agg(F.max("ejecutado_en")).scalar())


def _pending_orders(spark: SparkSession, sf: str) -> DataFrame:
    """All orders, of which only those of one status know their month, so some months have items but no order."""
    return fx.order_headers(spark, sf).withColumn("mes", F.when(F.col("tipo") == "P", F.col("mes")))


@register
def check_volume(spark: SparkSession, sf: str) -> DataFrame:
    return plain(quality.check_volume(fx.months_expected(spark, sf), fx.items(spark, sf), fx.volume_history(spark, sf)))


@register
def check_items_without_orders(spark: SparkSession, sf: str) -> DataFrame:
    return plain(quality.check_items_without_orders(fx.months_expected(spark, sf), fx.items(spark, sf), _pending_orders(spark, sf)))


@register
def check_freshness(spark: SparkSession, sf: str) -> DataFrame:
    return plain(quality.check_freshness(fx.months_expected(spark, sf), fx.listing(spark, sf), moment(fx.RUN_AT)))


def _checks(spark: SparkSession, sf: str) -> DataFrame:
    items = fx.written(fx.items(spark, sf).select("mes"), "items")
    return quality.run_checks(fx.months_expected(spark, sf), fx.listing(spark, sf), items, _pending_orders(spark, sf),
                              fx.volume_history(spark, sf), moment(fx.RUN_AT))


@register
def run_checks(spark: SparkSession, sf: str) -> DataFrame:
    return plain(_checks(spark, sf).drop("chequeo_id"))


@register
def monitoring_log(spark: SparkSession, sf: str) -> DataFrame:
    """The check log of a loaded star after two runs an hour apart; the first was made twice and is logged once."""
    base = scratch_dir(spark, "monitoreo")
    stage = _star_stage(spark, sf)
    jobs.backfill_months(spark, stage, f"{base}/bodega", fx.order_month_list(stage), moment(LOAD_1, "timestamp"), calendar=dims.calendar_dim(spark, "1990-01-01"))
    for at in (fx.RUN_AT, fx.RUN_AT, "2024-02-01 01:00:00"):
        jobs.monitoring_job(spark, f"{base}/bodega", fx.months_expected(spark, sf), fx.listing(spark, sf), f"{base}/log", moment(at))
    return plain(jobs.check_log(spark, f"{base}/log").drop("chequeo_id"))


@register
def check_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return plain(quality.alerts_from(_checks(spark, sf)).select("creada_en", "mensaje", "explicacion"))


@register
def reconcile_layers(spark: SparkSession, sf: str) -> DataFrame:
    stage, agency, unit, supplier = star_inputs(spark, sf)
    totals = integrity.fact_totals(facts.load_fact_items(stage, agency, supplier), facts.load_fact_orders(stage, agency, unit, supplier))
    return plain(integrity.reconcile(integrity.layer_totals(stage), totals))


@register
def reconcile_raw_layer(spark: SparkSession, sf: str) -> DataFrame:
    """Item versions before and after the dedupe; months with several versions of an item disagree."""
    lines = fx.item_lines(spark, sf).join(
        fx.order_headers(spark, sf).select("l_orderkey", "mes"), "l_orderkey").withColumn("monto_total_oc_clp", F.col("total_linea_neto"))
    return plain(integrity.reconcile(integrity.layer_totals(lines), integrity.layer_totals(keep_latest(lines, ["id_item"], fx.ITEM_ORDER))))


@register
def integrity_suite(spark: SparkSession, sf: str) -> DataFrame:
    stage, agency, unit, supplier = star_inputs(spark, sf)
    items = fx.written(facts.load_fact_items(stage, agency, supplier), "items")  # each rule reads them
    orders = fx.written(facts.load_fact_orders(stage, agency, unit, supplier), "pedidos")
    return integrity.integrity_suite(stage, agency, unit, supplier, dims.calendar_dim(spark, "1990-01-01"), items, orders)


@register
def integrity_raw_layer(spark: SparkSession, sf: str) -> DataFrame:
    """Rules broken by item versions that were not deduplicated, against suppliers of which those of the last nations have another code."""
    lines = fx.item_lines(spark, sf)
    code = F.col("s_suppkey").cast("string")
    some = fx.table(spark, sf, "supplier").select(F.when(F.col("s_nationkey") < 20, code).otherwise(F.concat(F.lit("baja-"), code)).alias("codigo_proveedor"))
    return (
        integrity.duplicates(lines, ["id_item"], "item duplicado")
        .unionByName(integrity.orphans(lines, {"item sin proveedor": ("codigo_proveedor", some, "codigo_proveedor")}))
        .unionByName(integrity.violations(lines, {
            "item con texto largo": integrity.too_long({"codigo": 7}),
            "monto alto": F.col("total_linea_neto") > 90000}))
    )


# ---------------------------------------------------------------- incremental control

@register
def in_processing_window(spark: SparkSession, sf: str) -> DataFrame:
    """Three days into a month in local time: both months are open."""
    stage = fx.order_headers(spark, sf)
    return plain(incremental.in_processing_window(stage, moment("1998-03-04 02:00:00")).select("mes", "l_orderkey", "fecha_envio"))


@register
def partition_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.partition_coverage(fx.listing(spark, sf), fx.months_expected(spark, sf), F.lit("2024-01-31").cast("date"))


@register
def changed_files(spark: SparkSession, sf: str) -> DataFrame:
    return plain(incremental.changed_files(fx.listing(spark, sf), fx.manifest(spark, sf)))


# ---------------------------------------------------------------- positions

def _positions(spark: SparkSession, sf: str) -> DataFrame:
    return pos.parse_positions(fx.position_records(spark, sf), F.col("ahora"))


@register
def changed_real_files(spark: SparkSession, sf: str) -> DataFrame:
    """Stored files against a manifest of what their month held at the last load: every file was written again, a third of the months
    with the same orders, a third with other amounts, and a third had no file before."""
    base = scratch_dir(spark, "archivos")
    orders = fx.table(spark, sf, "orders").withColumn("mes", month_of("o_orderdate")).select("mes", "o_orderkey", "o_custkey", F.col("o_totalprice").alias("monto"))
    kind = F.right("mes", F.lit(2)).cast("int") % 3
    one_file = lambda rows, path: rows.repartition("mes").write.partitionBy("mes").csv(f"{base}/{path}")
    one_file(orders.where(kind != 2), "antes")
    manifest = fx.written(content_digests(spark, f"{base}/antes", "*.csv").select("mes", "huella"), "manifiesto")
    one_file(orders.withColumn("monto", F.when(kind == 1, F.col("monto") + 1).otherwise(F.col("monto"))).sort("o_custkey"), "ahora")
    return incremental.changed_files(content_digests(spark, f"{base}/ahora", "*.csv"), manifest).select("mes", "lineas")


@register
def parse_positions(spark: SparkSession, sf: str) -> DataFrame:
    return plain(_positions(spark, sf))


@register
def parse_report(spark: SparkSession, sf: str) -> DataFrame:
    return pos.parse_report(fx.position_records(spark, sf), F.col("ahora"))


@register
def active_vehicles(spark: SparkSession, sf: str) -> DataFrame:
    """Records received and vehicles active per poll."""
    received = fx.position_records(spark, sf).groupBy("consulta").agg(F.count(F.lit(1)).alias("buses_respuesta"))
    active = _positions(spark, sf).groupBy("consulta").agg(F.count(F.lit(1)).alias("buses_activos"))
    return received.join(active, "consulta", "left").fillna(0, ["buses_activos"])


@register
def keyed_publish(spark: SparkSession, sf: str) -> DataFrame:
    """Keyed messages through a file sink and back."""
    path = f"{scratch_dir(spark, 'mensajes')}/m"
    pos.publish_messages(pos.keyed_messages(_positions(spark, sf)), "parquet", {"path": path})
    return spark.read.parquet(path)


@register
def active_by_service(spark: SparkSession, sf: str) -> DataFrame:
    return serving.active_by_service(fx.vehicle_state(spark, sf), "error", "I", 25)


@register
def active_by_every_service(spark: SparkSession, sf: str) -> DataFrame:
    return serving.active_by_every_service(fx.vehicle_state(spark, sf))


@register
def speed_class(spark: SparkSession, sf: str) -> DataFrame:
    kmh = F.when(F.col("event_id") % 9 == 0, F.lit(0.0)).otherwise(F.col("value"))
    return fx.table(spark, sf, "events").select("event_id", serving.speed_class(kmh).alias("clase"))


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = fx.table(spark, sf, "events").schema
    return stream.read_stream(spark, sf, schema, glob="events.parquet")


@register
def stream_latest_state(spark: SparkSession, sf: str) -> DataFrame:
    """Newest event per user kept by the snapshot merge."""
    base = scratch_dir(spark, "estado")
    stream.latest_state(_event_stream(spark, sf), f"{base}/t", f"{base}/cp", ["user_id"], ["ts", "event_id"]).awaitTermination()
    return plain(stream.current_snapshot(spark, f"{base}/t").drop("cubeta"))


@register
def stream_restart_state(spark: SparkSession, sf: str) -> DataFrame:
    """Two streams with checkpoints of their own feed one table; the second starts its batch numbers again."""
    base = scratch_dir(spark, "reinicio")
    for i, rows in enumerate((fx.table(spark, sf, "events").where("event_id % 3 = 0"), fx.table(spark, sf, "events").where("event_id % 3 != 0"))):
        rows.write.parquet(f"{base}/in{i}")
        source = stream.read_stream(spark, f"{base}/in{i}", rows.schema)
        stream.latest_state(source, f"{base}/t", f"{base}/cp{i}", ["user_id"], ["ts", "event_id"]).awaitTermination()
    return plain(stream.current_snapshot(spark, f"{base}/t").drop("cubeta"))


@register
def stream_both_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """Records of the history and vehicles of the snapshot per hour, from one stream."""
    base = scratch_dir(spark, "ambas")
    stream.both_outputs(_event_stream(spark, sf), f"{base}/t", f"{base}/h", f"{base}/cp", ["user_id"], ["ts", "event_id"], at=F.col("ts")).awaitTermination()
    history = spark.read.schema("event_id bigint, fecha string, hora string").json(f"{base}/h").groupBy("fecha", "hora").agg(F.count(F.lit(1)).alias("registros"))
    state = stream.current_snapshot(spark, f"{base}/t").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("fecha"), F.date_format("ts", "HH").alias("hora")).agg(
        F.count(F.lit(1)).alias("vigentes"))
    return history.join(state, ["fecha", "hora"], "left").fillna(0, ["vigentes"])


#: Far more than the files of a week times the read tasks, so that dealing rows in turn leaves no file empty.
WEEK_FILE_ROWS = 20_000


def _weekly(spark: SparkSession, sf: str, base: str, repeated: bool) -> DataFrame:
    """Events as a stream of one batch a week; with ``repeated`` each batch also brings all records of the week before again.

    All weeks have the same number of files, as a batch is so many files: one for every ``WEEK_FILE_ROWS`` rows of the smallest week.
    """
    events = fx.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    week = F.floor((F.dayofmonth("ts") - 1) / 7)
    held = {r.week: r["count"] for r in events.groupBy(week.alias("week")).count().collect()}  # at most five weeks
    sizes = [held.get(i, 0) + (held.get(i - 1, 0) if repeated else 0) for i in range(5 + repeated)]
    files = max(1, min(sizes) // WEEK_FILE_ROWS)
    for i in range(5 + repeated):
        rows = events.where((week == i) | (week == i - 1) if repeated else week == i)
        (rows.coalesce(1) if files == 1 else rows.repartition(files)).write.mode("append").parquet(f"{base}/in")
    return stream.read_stream(spark, f"{base}/in", events.schema, files_per_batch=files)


@register
def stream_retries(spark: SparkSession, sf: str) -> DataFrame:
    """Every record comes twice, the second time a week late; history and snapshot have it once."""
    base = scratch_dir(spark, "reintentos")
    stream.both_outputs(_weekly(spark, sf, base, True), f"{base}/t", f"{base}/h", f"{base}/cp", ["user_id"], ["ts", "event_id"], at=F.date_trunc("day", "ts"),
                        once=(["event_id"], "ts", "16 days")).awaitTermination()
    history = stream.read_history(spark, f"{base}/h", "event_id bigint, user_id bigint").groupBy("user_id").agg(F.count(F.lit(1)).alias("registros"))
    return history.join(stream.current_snapshot(spark, f"{base}/t").select("user_id", F.col("event_id").alias("vigente")), "user_id")


@register
def stream_state_ttl(spark: SparkSession, sf: str) -> DataFrame:
    """Per user, the silences of four days or more that ended their state, and whether a state is left after the last batch.

    The state left is what the last batch to touch the user said; a timer says it without a further record of the user.
    """
    base = scratch_dir(spark, "vigencia")
    with rocksdb(spark):
        changes = expiring_latest(_weekly(spark, sf, base, False), ["user_id"], "ts", ["event_id"], timedelta(days=4))
        stream.write_updates(changes, f"{base}/t", f"{base}/cp").awaitTermination()
    told = spark.read.parquet(f"{base}/t")
    last = F.max_by(F.struct("event_id", "vigente", "registros"), F.struct("lote", "vence", ~F.col("vigente")))
    return told.groupBy("user_id").agg(F.sum(F.when(~F.col("vigente"), 1).otherwise(0)).alias("vencimientos"), last.alias("u")).select(
        "user_id", "vencimientos", F.col("u.event_id").alias("ultimo"), F.col("u.vigente").alias("vigente"), F.col("u.registros").alias("registros"))


@register
def history_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """Records and files per day of a history that was packed twice, with batches before, between and after."""
    base = scratch_dir(spark, "paquetes")
    fields = "event_id bigint, user_id bigint, value double"
    events = fx.table(spark, sf, "events")
    for i in range(4):
        events.where(F.col("event_id") % 4 == i).repartition(3, "event_id").write.mode("append").parquet(f"{base}/in")
        source = stream.read_stream(spark, f"{base}/in", events.schema, files_per_batch=1)
        stream.both_outputs(source, f"{base}/t", f"{base}/h", f"{base}/cp", ["user_id"], ["ts", "event_id"], at=F.date_trunc("day", "ts")).awaitTermination()
        if i in (1, 3):
            stream.compact_history(spark, f"{base}/h", fields)
    rows = stream.read_history(spark, f"{base}/h", fields).withColumn("archivo", F.input_file_name())
    return rows.groupBy("fecha", "hora").agg(F.count(F.lit(1)).alias("registros"), F.min("event_id").alias("desde"), F.max("event_id").alias("hasta"), F.count_distinct("archivo").alias("archivos"))


@register
def position_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """Payload files to records, positions, keyed messages, decoded again by a stream into the state and the history."""
    base = scratch_dir(spark, "posiciones")
    fx.position_records(spark, sf).groupBy(F.col("consulta").alias("fecha_consulta")).agg(F.collect_list("registro").alias("posiciones")).write.json(f"{base}/respuestas")
    answers = spark.read.schema(pos.PAYLOAD_SCHEMA).json(f"{base}/respuestas")
    records = pos.explode_payload(answers).withColumn("ahora", F.to_timestamp_ntz("consulta", F.lit("yyyyMMddHHmmss")))
    pos.publish_messages(pos.keyed_messages(pos.parse_positions(records, F.col("ahora"))), "parquet", {"path": f"{base}/mensajes"})
    decoded = pos.decode_messages(stream.read_stream(spark, f"{base}/mensajes", "key string, value string"))
    stream.both_outputs(decoded, f"{base}/t", f"{base}/h", f"{base}/cp", ["patente"], ["gps", "latitud", "longitud", "velocidad", "servicio"], at=F.col("gps")).awaitTermination()
    history = spark.read.schema("patente string").json(f"{base}/h").groupBy("patente").agg(F.count(F.lit(1)).alias("registros"))
    return stream.current_snapshot(spark, f"{base}/t").join(history, "patente").select("patente", "fecha_gps", "latitud", "longitud", "velocidad", "servicio", "registros")


@register
def stream_latest_updates(spark: SparkSession, sf: str) -> DataFrame:
    """Newest event per user kept in the state store; each batch writes its changed keys."""
    base = scratch_dir(spark, "cambios")
    newest = stream.latest_updates(_event_stream(spark, sf), ["user_id"], ["ts", "event_id"])
    stream.write_updates(newest, f"{base}/t", f"{base}/cp").awaitTermination()
    return plain(stream.read_updates(spark, f"{base}/t", ["user_id"], ["ts", "event_id"]))


@register
def stream_archive(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_dir(spark, "archivo")
    stream.archive_stream(_event_stream(spark, sf), f"{base}/t", f"{base}/cp", F.col("ts")).awaitTermination()
    back = spark.read.schema("event_id bigint, user_id bigint, value double, fecha string, hora string").json(f"{base}/t")
    return back.groupBy("fecha", "hora").agg(
        F.count(F.lit(1)).alias("registros"), F.min("event_id").alias("desde"), F.max("event_id").alias("hasta"))


# ---------------------------------------------------------------- service dictionary

def _dictionary_dims(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Services and routes after a partial first load and a full second one."""
    deco = fx.dictionary(spark, sf)
    early = deco.where(F.col("codigo_mtt") < "M25")
    a, b = moment(LOAD_1, "timestamp"), moment(LOAD_2, "timestamp")
    late = deco.where(F.col("codigo_mtt") >= "M2")
    return (dims.service_dim(late, b, dims.service_dim(early, a)), dims.route_dim(late, b, dims.route_dim(early, a)))


@register
def service_dim(spark: SparkSession, sf: str) -> DataFrame:
    return plain(_dictionary_dims(spark, sf)[0])


@register
def route_dim(spark: SparkSession, sf: str) -> DataFrame:
    return plain(_dictionary_dims(spark, sf)[1])


@register
def dictionary_file(spark: SparkSession, sf: str) -> DataFrame:
    """The service dictionary through its file."""
    path = scratch_dir(spark, "diccionario")
    deco = fx.dictionary(spark, sf)
    deco.select(*[F.col(c.lower()).alias(c) for c in DICTIONARY_COLUMNS]).write.options(header="true", sep=";").csv(path)
    return read_dictionary_csv(spark, path)


@register
def dictionary_summary(spark: SparkSession, sf: str) -> DataFrame:
    return dims.dictionary_summary(*_dictionary_dims(spark, sf))


# ---------------------------------------------------------------- SQL text

@register
def parameterised_sql(spark: SparkSession, sf: str) -> DataFrame:
    """Bound values and a named DataFrame in SQL text: positive amounts of a span of months."""
    return run_query(
        spark, """
        SELECT mes, codigo_organismo, count(*) AS ordenes, CAST(sum(monto_total_oc_clp) AS DOUBLE) AS monto_clp
        FROM {ordenes} WHERE mes >= :desde AND monto_total_oc_clp > :minimo GROUP BY mes, codigo_organismo
        """, {"desde": "1992-01", "minimo": 0}, ordenes=fx.orders(spark, sf))
