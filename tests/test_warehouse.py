import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from arriero.operators import dims, facts, integrity, quality
from arriero.operators.incremental import changed_files, in_processing_window, partition_coverage
from arriero.plans import fixtures as fx
from arriero.plans import jobs
from arriero.sinks import fs
from arriero.sinks.publish import Publication, insert_in_batches, prune, publish_months, published_months, read_published, read_whole
from tests.conftest import rows


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.fixture(scope="module")
def stage(spark, sf):
    df = fx.stage(spark, sf).withColumn("rut_unidad", F.lit("u")).withColumn("actividad_proveedor", F.lit("a"))
    year = df.withColumn("mes", F.concat(F.substring("mes", 1, 4), F.lit("-01")))
    return fx.written(year, "prueba").cache()


def now():
    return F.lit("2026-01-01 00:00:00").cast("timestamp")


def load(spark, stage, root, mes):
    return jobs.warehouse_job(spark, stage, root, mes, now(), dims.calendar_dim(spark, "1990-01-01"))


def fact_rows(spark, root):
    items = read_published(spark, root, "fact_orden_compra_item", jobs.FACT_ITEM_SCHEMA)
    orders = read_published(spark, root, "fact_orden_compra", jobs.FACT_ORDER_SCHEMA)
    return items, orders


def test_load_twice_equals_once_and_layers_agree(spark, stage, tmp_path):
    root = str(tmp_path / "dw")
    a, b = fx.order_month_list(stage)[:2]
    for mes in (a, b):
        load(spark, stage, root, mes)
    items, orders = fact_rows(spark, root)
    before = rows(items), rows(orders), rows(read_whole(spark, root, "dim_proveedor"))
    part = stage.where(F.col("mes").isin(a, b))
    report = integrity.reconcile(integrity.layer_totals(part), integrity.fact_totals(items, orders))
    assert report.count() == 2 and report.where("not coincide").count() == 0
    load(spark, stage, root, b)
    items, orders = fact_rows(spark, root)
    assert (rows(items), rows(orders), rows(read_whole(spark, root, "dim_proveedor"))) == before
    assert published_months(spark, root, "fact_orden_compra") == [a, b]
    docs = str(tmp_path / "api")
    jobs.summary_job(spark, root, [a, b], docs)
    first = rows(jobs.read_documents(spark, docs))
    jobs.summary_job(spark, root, [a, b], docs)
    assert rows(jobs.read_documents(spark, docs)) == first and len(first) > 0
    assert jobs.read_documents(spark, docs, [a]).select("mes").distinct().count() == 1


def test_empty_month_leaves_facts_alone(spark, stage, tmp_path):
    root = str(tmp_path / "dw")
    mes = fx.order_month_list(stage)[0]
    load(spark, stage, root, mes)
    n = fact_rows(spark, root)[0].count()
    assert load(spark, stage.where("false"), root, mes) is None
    assert fact_rows(spark, root)[0].count() == n > 0


def test_order_that_moves_month_stops_the_load_untouched(spark, stage, tmp_path):
    root = str(tmp_path / "dw")
    a, b = fx.order_month_list(stage)[:2]
    load(spark, stage, root, a)
    registry = sorted(os.listdir(f"{root}/_cargas"))
    moved = stage.where(F.col("mes") == a).limit(3).withColumn("mes", F.lit(b)).withColumn("id_item", -F.col("id_item") - 1)
    with pytest.raises(RuntimeError, match="otro mes"):
        load(spark, stage.unionByName(moved), root, b)
    assert sorted(os.listdir(f"{root}/_cargas")) == registry
    assert published_months(spark, root, "fact_orden_compra") == [a]


def test_date_outside_the_calendar_stops_the_load(spark, stage, tmp_path):
    mes = fx.order_month_list(stage)[0]
    old = stage.withColumn("fecha_envio", F.lit("1950-01-01").cast("date"))
    with pytest.raises(RuntimeError, match="fuera del calendario"):
        load(spark, old, str(tmp_path / "dw"), mes)
    assert not os.path.exists(tmp_path / "dw" / "_publicado.json")


def test_lookups_keep_rows_without_dimension(spark, stage):
    agency = spark.createDataFrame([], "sk_organismo bigint, codigo_organismo string")
    supplier = spark.createDataFrame([(5, "1", True), (6, "1", False)], "sk_proveedor bigint, codigo_proveedor string, es_vigente boolean")
    got = facts.load_fact_items(stage, agency, supplier)
    assert got.count() == stage.count() and got.where("sk_organismo is not null").count() == 0
    assert [r[0] for r in got.select("sk_proveedor").distinct().orderBy("sk_proveedor").collect()] == [None, 5]


def test_skewed_lookup_is_split(spark):
    """A code holding most rows does not end up in one task when the dimension is too large to broadcast."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 200_000
        fact = spark.range(0, n, 1, 8).select("id", F.when(F.col("id") % 3 < 2, "hot").otherwise(F.col("id").cast("string")).alias("codigo"))
        dim = spark.range(n).select(F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("codigo"), F.col("id").alias("sk"))
        joined = facts._lookup(fact, dim, "codigo", "sk")
        assert joined.count() == n
        joined = facts._lookup(fact, dim, "codigo", "sk")
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "isSkew=true" in joined._jdf.queryExecution().executedPlan().toString() or "skewed" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_publication_is_all_or_nothing(spark, tmp_path):
    root = str(tmp_path / "p")
    df = spark.createDataFrame([(1, "2026-01"), (2, "2026-02")], "x int, mes string")
    load = Publication(spark, root)
    load.months("t", df, ["2026-01", "2026-02"])
    load.whole("d", df)
    assert read_published(spark, root, "t", df.schema).count() == 0 and read_whole(spark, root, "d") is None
    load.commit()
    assert read_published(spark, root, "t", df.schema).count() == 2 and read_whole(spark, root, "d").count() == 2
    publish_months(root, "t", df.where("x = 9"), ["2026-01"])
    assert published_months(spark, root, "t") == ["2026-01", "2026-02"]
    publish_months(root, "t", df.where("x = 9"), ["2026-01"], keep_missing=False)
    assert published_months(spark, root, "t") == ["2026-02"]
    publish_months(root, "t", df.where("mes = '2026-02'").withColumn("x", F.col("x") * 10), ["2026-02"])
    assert rows(read_published(spark, root, "t", df.schema)) == [(20, "2026-02")]
    assert rows(read_published(spark, root, "t", df.schema, ["2026-01"])) == []
    assert len(prune(spark, root)) == 2 and prune(spark, root) == []
    assert rows(read_published(spark, root, "t", df.schema)) == [(20, "2026-02")] and read_whole(spark, root, "d").count() == 2


def test_interleaved_loads_are_both_visible(spark, tmp_path):
    root = str(tmp_path / "p")
    df = spark.createDataFrame([(1, "2026-01"), (2, "2026-02")], "x int, mes string")
    first, second = Publication(spark, root), Publication(spark, root)
    first.months("t", df.where("x = 1"), ["2026-01"])
    second.months("t", df.where("x = 2"), ["2026-02"])
    second.commit()
    first.commit()
    assert published_months(spark, root, "t") == ["2026-01", "2026-02"]
    path = f"{root}/_prueba.json"
    assert fs.create_text(spark, path, "a") and not fs.create_text(spark, path, "b") and fs.read_text(spark, path) == "a"


def test_rows_outside_the_published_months_stop_the_load(spark, tmp_path):
    df = spark.createDataFrame([(1, "2026-01"), (2, "2026-02"), (3, None)], "x int, mes string")
    for bad in (df.where("x < 3"), df.where("x != 2")):
        with pytest.raises(Exception, match="outside the published months"):
            publish_months(str(tmp_path / "p"), "t", bad, ["2026-01"])
    assert published_months(spark, str(tmp_path / "p"), "t") == []


def test_backfill_equals_the_ascending_loop(spark, stage, tmp_path):
    loop, once = str(tmp_path / "a"), str(tmp_path / "b")
    chosen = fx.order_month_list(stage)[:3]
    for mes in chosen:
        load(spark, stage, loop, mes)
    jobs.backfill_months(spark, stage, once, chosen, now(), dims.calendar_dim(spark, "1990-01-01"))
    for name in ("dim_organismo", "dim_unidad_compra", "dim_proveedor"):
        a, b = read_whole(spark, loop, name), read_whole(spark, once, name)
        assert rows(a.select(*sorted(a.columns))) == rows(b.select(*sorted(a.columns))), name
    for a, b in zip(fact_rows(spark, loop), fact_rows(spark, once)):
        assert rows(a) == rows(b)
    with pytest.raises(ValueError):
        jobs.backfill_months(spark, stage, once, chosen, now())


def versions_of(spark, seed):
    """Items of four months whose supplier and agency attributes move, in and out of single months."""
    import random

    rng, out, order = random.Random(seed), [], 0
    for mes in ("2024-01", "2024-02", "2024-03", "2024-04", "2024-05"):
        for code in range(12):
            if rng.random() < 0.7:
                order += 1
                out.append((order, f"OC{order}", mes, f"P{code}", rng.choice("AB"), rng.choice("xyz"), rng.random() < 0.5, f"O{code % 4}", rng.choice("mn"), f"U{code % 5}", rng.choice("ru")))
    return out


def small_stage(spark, stage, found):
    base = stage.limit(1).drop("id_item", "codigo", "mes", "codigo_proveedor", "nombre_proveedor", "region_proveedor", "es_persona_natural", "codigo_organismo", "sector", "codigo_unidad", "nombre_unidad")
    given = spark.createDataFrame(found, "id_item long, codigo string, mes string, codigo_proveedor string, nombre_proveedor string, region_proveedor string, es_persona_natural boolean, "
                                  "codigo_organismo string, sector string, codigo_unidad string, nombre_unidad string")
    return given.crossJoin(base).select(*stage.columns)


@pytest.mark.parametrize("first, then", [([0, 1, 2], [3, 4]), ([3], [0, 1, 2, 4]), ([0, 1, 2, 3, 4], [1, 2])])
def test_increments_equal_one_backfill(spark, stage, tmp_path, first, then):
    """Months behind, before and between the loaded ones, and months loaded again."""
    once, twice = str(tmp_path / "a"), str(tmp_path / "b")
    rows_ = small_stage(spark, stage, versions_of(spark, 7)).cache()
    months, calendar = sorted(r.mes for r in rows_.select("mes").distinct().collect()), dims.calendar_dim(spark, "1990-01-01")
    jobs.backfill_months(spark, rows_, once, months, now(), calendar)
    jobs.increment_months(spark, rows_, twice, [months[i] for i in first], now(), calendar)
    jobs.increment_months(spark, rows_, twice, [months[i] for i in then], now(), calendar)
    for name in ("dim_organismo", "dim_unidad_compra", "dim_proveedor"):
        a, b = read_whole(spark, once, name), read_whole(spark, twice, name)
        assert rows(a.select(*sorted(a.columns))) == rows(b.select(*sorted(a.columns))), name
    for a, b in zip(fact_rows(spark, once), fact_rows(spark, twice)):
        assert rows(a) == rows(b)
    rows_.unpersist()


def test_an_order_in_two_loads_is_found_by_the_index(spark, stage, tmp_path):
    root, calendar = str(tmp_path), dims.calendar_dim(spark, "1990-01-01")
    found = versions_of(spark, 8)
    one, two = [r for r in found if r[2] == "2024-01"], [r for r in found if r[2] == "2024-02"]
    jobs.increment_months(spark, small_stage(spark, stage, one), root, ["2024-01"], now(), calendar)
    clash = [(*two[0][:1], one[0][1], *two[0][2:]), *two[1:]]
    with pytest.raises(RuntimeError, match="otro mes=1"):
        jobs.increment_months(spark, small_stage(spark, stage, clash), root, ["2024-02"], now(), calendar)
    keys = jobs.order_keys(small_stage(spark, stage, two))
    other = jobs.keys_of_other_months(spark, root, keys, ["2024-02"])
    assert other.count() > 0 and all(f"/{jobs.KEY_INDEX}/" in f for f in other.inputFiles())
    with pytest.raises(RuntimeError, match="otro mes=1"):
        jobs.warehouse_job(spark, small_stage(spark, stage, clash), root, "2024-02", now(), calendar)


def test_route_codes_are_unique_and_have_a_service(spark):
    deco = spark.createDataFrame([("T1", "1I"), ("T1", "1I"), ("T2", "2R")], "codigo_usuario string, codigo_ruta string")
    assert dims.route_dim(deco, now()).count() == 2
    other = deco.union(spark.createDataFrame([("T9", "1I")], deco.schema))
    with pytest.raises(Exception, match="route code with different rows"):
        dims.route_dim(other, now()).collect()
    services = spark.createDataFrame([("T1",)], "codigo_usuario string")
    assert rows(dims.route_violations(other, services)) == [("recorrido duplicado", 1), ("recorrido sin servicio", 2)]


def test_batches_reach_the_store_complete(spark, tmp_path):
    target = str(tmp_path)

    def connect():
        import uuid

        def insert(documents):
            with open(f"{target}/{uuid.uuid4().hex}.json", "w") as f:
                json.dump([d["id"] for d in documents], f)
        return insert

    insert_in_batches(spark.range(0, 1250, 1, 2), connect, 500)
    batches = [json.load(open(tmp_path / f)) for f in os.listdir(target)]
    assert sorted(len(b) for b in batches) == [125, 125, 500, 500]
    assert sorted(x for b in batches for x in b) == list(range(1250))


# ---------------------------------------------------------------- checks

def months(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "mes string")


def history(spark, *records):
    return spark.createDataFrame([("volumen_items", m, e, v, dt.datetime(2026, 1, d), d) for m, e, v, d in records],
                                 "chequeo string, mes string, estado string, valor decimal(20,2), ejecutado_en timestamp_ntz, chequeo_id bigint")


def dec(n):
    from decimal import Decimal
    return Decimal(n)


def test_volume_bounds(spark):
    items = spark.range(90).select(F.lit("2026-01").alias("mes")).unionByName(spark.range(89).select(F.lit("2026-02").alias("mes")))
    log = history(spark, ("2026-01", "ok", dec(100), 1), ("2026-02", "ok", dec(100), 1), ("2026-03", "ok", dec(5), 1))
    got = {r.mes: r for r in quality.check_volume(months(spark, "2026-01", "2026-02", "2026-03", "2026-04"), items, log).collect()}
    assert {m: r.estado for m, r in got.items()} == {"2026-01": "ok", "2026-02": "falla", "2026-03": "falla", "2026-04": "falla"}
    assert got["2026-02"].esperado == ">= 90" and got["2026-02"].detalle == "Antes 100 ítems, ahora 89"
    assert got["2026-03"].detalle == "El mes no tiene ítems en la bodega" and got["2026-01"].esperado == "sin caída > 10%"


def test_volume_baseline(spark):
    items = spark.range(80).select(F.lit("2026-01").alias("mes"))
    log = history(spark, ("2026-01", "ok", dec(100), 1), ("2026-01", "falla", dec(80), 2))
    assert quality.check_volume(months(spark, "2026-01"), items, log).first().estado == "ok"
    assert quality.check_volume(months(spark, "2026-01"), items, log, baseline="last_ok").first().estado == "falla"


def test_halves_in_texts_round_to_even(spark):
    items = spark.range(1).select(F.lit("2026-01").alias("mes"))
    log = history(spark, ("2026-01", "ok", dec("425"), 1))
    assert quality.check_volume(months(spark, "2026-01"), items, log).first().esperado == ">= 382"


def test_deleting_a_fifth_of_a_month_fails_until_restored(spark, stage, tmp_path):
    mes = fx.order_month_list(stage)[0]
    full = stage.where(F.col("mes") == mes).select("mes", "id_item")
    n = full.count()
    cut = full.orderBy("id_item").limit(int(n * .8))
    log = history(spark, (mes, "ok", dec(n), 1))
    assert quality.check_volume(months(spark, mes), full, log).first().estado == "ok"
    assert quality.check_volume(months(spark, mes), cut, log).first().estado == "falla"


def test_freshness_bounds(spark):
    listing = spark.createDataFrame(
        [("2026-01", "a", dt.datetime(2026, 1, 1, 0, 0)), ("2026-02", "b", dt.datetime(2025, 12, 31, 23, 59, 59)),
         ("2026-03", "c", dt.datetime(2025, 1, 1)), ("2026-03", "d", dt.datetime(2026, 1, 2, 11, 30))], "mes string, ruta string, modificado timestamp_ntz")
    got = {r.mes: r for r in quality.check_freshness(months(spark, "2026-01", "2026-02", "2026-03", "2026-04"), listing, ts("2026-01-02 12:00:00")).collect()}
    assert {m: r.estado for m, r in got.items()} == {"2026-01": "ok", "2026-02": "falla", "2026-03": "ok", "2026-04": "falla"}
    assert got["2026-01"].detalle == "Archivo cargado hace 36.0 h" and got["2026-03"].valor == dec("0.50") and got["2026-04"].valor is None


def test_items_without_orders(spark):
    one = spark.createDataFrame([("2026-01",), ("2026-02",)], "mes string")
    got = {r.mes: r.estado for r in quality.check_items_without_orders(months(spark, "2026-01", "2026-02", "2026-03"), one, one.where("mes = '2026-01'")).collect()}
    assert got == {"2026-01": "ok", "2026-02": "falla", "2026-03": "ok"}


def test_monitoring_job_logs_and_compares_with_the_last_run(spark, stage, tmp_path):
    root, log = str(tmp_path / "dw"), str(tmp_path / "log")
    mes = fx.order_month_list(stage)[0]
    load(spark, stage, root, mes)
    listing = spark.createDataFrame([(mes, "f", dt.datetime(2026, 1, 1))], "mes string, ruta string, modificado timestamp_ntz")
    first = jobs.monitoring_job(spark, root, months(spark, mes), listing, log, ts("2026-01-01 10:00:00"))
    assert {r.chequeo: r.estado for r in first.collect()} == {"frescura_raw": "ok", "volumen_items": "ok", "items_sin_ordenes": "ok"}
    for _ in range(2):  # a rerun with the same time replaces its results and alerts
        second = jobs.monitoring_job(spark, root, months(spark, mes), listing, log, ts("2026-01-05 10:00:00"))
    assert {r.chequeo for r in second.where("estado = 'falla'").collect()} == {"frescura_raw"}
    alerts = spark.read.parquet(f"{log}/alertas").drop("ejecucion")
    (a,) = alerts.collect()
    assert a.mensaje.startswith(f"frescura_raw {mes}: Archivo cargado hace 106.0 h") and a.explicacion is None
    checks = jobs.check_log(spark, log)
    assert checks.count() == 6 and quality.latest_check_status(checks).count() == 3
    (feed,) = quality.alert_feed(alerts, checks).collect()
    assert feed.chequeo == "frescura_raw" and feed.explicacion == "(sin explicación)"
    assert quality.failed_checks_24h(checks, ts("2026-01-06 10:00:00")).first().fallas == 0
    assert quality.failed_checks_24h(checks, ts("2026-01-06 09:59:59")).first().fallas == 1


def test_integrity_counts_what_is_broken(spark):
    dup = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, c string")
    assert integrity.duplicates(dup, ["k"], "d").first().infracciones == 1
    dim = spark.createDataFrame([("a",)], "c string")
    assert rows(integrity.orphans(dup, {"o": ("c", dim, "c"), "todas": ("c", dup, "c")})) == [("o", 1), ("todas", 0)]
    assert rows(integrity.orphans(dup.where("false"), {"o": ("c", dim, "c")})) == [("o", 0)]
    assert rows(integrity.violations(dup, {"nulo": F.col("c").isNull(), "largo": integrity.too_long({"c": 0})})) == [("largo", 2), ("nulo", 1)]
    with pytest.raises(RuntimeError, match="d=1"):
        integrity.require_clean(integrity.duplicates(dup, ["k"], "d"))


def test_reconcile_sees_missing_months(spark):
    a = spark.createDataFrame([("1", 1), ("2", None)], "mes string, n int")
    b = spark.createDataFrame([("1", 1), ("2", None), ("3", 1)], "mes string, n int")
    got = {r.mes: r.coincide for r in integrity.reconcile(a, b, ["n"]).collect()}
    assert got == {"1": True, "2": True, "3": False}


# ---------------------------------------------------------------- incremental control

@pytest.mark.parametrize("run, want", [
    ("2026-01-05 12:00:00", ["2025-12", "2026-01"]), ("2026-01-06 12:00:00", ["2026-01"]),
    ("2026-01-06 02:00:00", ["2025-12", "2026-01"]), ("2026-03-01 02:00:00", ["2026-02"]),
])
def test_processing_window(spark, run, want):
    df = months(spark, "2025-12", "2026-01", "2026-02", "2026-03")
    assert [r[0] for r in rows(in_processing_window(df, ts(run)))] == want


def test_processing_window_prunes_partitions(spark, tmp_path):
    root = str(tmp_path / "t")
    months(spark, "2025-11", "2025-12", "2026-01").withColumn("x", F.lit(1)).write.partitionBy("mes").parquet(root)
    df = spark.read.schema("x int, mes string").parquet(root)
    plan = in_processing_window(df, ts("2026-01-05 12:00:00"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((mes" in plan.replace("isnotnull(mes", "") or "2026-01" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_coverage(spark):
    listing = spark.createDataFrame([("2026-01", dt.datetime(2026, 2, 2, 3, 0)), ("2026-02", dt.datetime(2026, 2, 2, 2, 59))], "mes string, modificado timestamp_ntz")
    date = F.lit("2026-02-02").cast("date")
    got = rows(partition_coverage(listing, months(spark, "2026-01", "2026-02", "2026-03"), date))
    assert got == [("2026-01", True, True, False), ("2026-02", True, False, False), ("2026-03", False, False, False)]
    assert rows(partition_coverage(listing, months(spark, "2026-01"), date)) == [("2026-01", True, True, True)]


def test_changed_files(spark):
    listing = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c"), ("4", None)], "mes string, huella string")
    manifest = spark.createDataFrame([("1", "a"), ("2", "x"), ("4", None)], "mes string, huella string")
    assert rows(changed_files(listing, manifest)) == [("2", "b"), ("3", "c")]
    assert rows(changed_files(listing, manifest, ["3"])) == [("3", "c")]
