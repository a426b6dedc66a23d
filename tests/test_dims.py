import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from arriero.operators import dims
from tests.conftest import rows

def at(text):
    return F.lit(text).cast("timestamp")


STAGE = ("codigo_proveedor string, nombre_proveedor string, rut_proveedor string, actividad_proveedor string, "
         "region_proveedor string, es_persona_natural boolean")
END = dt.date(9999, 12, 31)


def day(text):
    return F.lit(text).cast("date")


def load(spark, dim, effective, *suppliers):
    stage = spark.createDataFrame(list(suppliers), STAGE)
    return dims.upsert_suppliers(dim, stage, day(effective))


def versions(dim):
    return rows(dim.select("codigo_proveedor", "nombre_proveedor", "region_proveedor", "es_persona_natural", "vigente_desde",
                           "vigente_hasta", "es_vigente"))


def sup(code, name, region="r", person=False):
    return (code, name, "1-9", "a", region, person)


def test_new_name_closes_and_opens(spark):
    dim = load(spark, None, "2026-07-01", sup("p", "uno"), sup("q", "otro"))
    dim = load(spark, dim, "2026-08-01", sup("p", "dos"))
    assert versions(dim) == [
        ("p", "dos", "r", False, dt.date(2026, 8, 1), END, True),
        ("p", "uno", "r", False, dt.date(2026, 7, 1), dt.date(2026, 7, 31), False),
        ("q", "otro", "r", False, dt.date(2026, 7, 1), END, True),
    ]
    assert dim.select("sk_proveedor").distinct().count() == 3


def test_same_period_corrects_in_place(spark):
    dim = load(spark, None, "2026-07-01", sup("p", "uno"))
    dim = load(spark, dim, "2026-07-01", sup("p", "dos"))
    assert versions(dim) == [("p", "dos", "r", False, dt.date(2026, 7, 1), END, True)]


def test_older_load_overwrites_newer_name(spark):
    dim = load(spark, None, "2026-08-01", sup("p", "agosto"))
    dim = load(spark, dim, "2026-07-01", sup("p", "julio"))
    assert versions(dim) == [("p", "julio", "r", False, dt.date(2026, 8, 1), END, True)]


def test_overwrite_precedes_close(spark):
    dim = load(spark, None, "2026-07-01", sup("p", "uno", "norte"))
    dim = load(spark, dim, "2026-08-01", sup("p", "dos", "sur"))
    assert [(v[1], v[2]) for v in versions(dim)] == [("dos", "sur"), ("uno", "sur")]


def test_flag_is_rewritten_but_does_not_trigger(spark):
    dim = load(spark, None, "2026-07-01", sup("p", "uno", "norte", False))
    same = load(spark, dim, "2026-08-01", sup("p", "uno", "norte", True))
    assert versions(same)[0][3] is False
    moved = load(spark, dim, "2026-08-01", sup("p", "uno", "sur", True))
    assert versions(moved)[0][2:4] == ("sur", True)


def test_going_back_in_the_same_month_leaves_equal_neighbours(spark):
    dim = load(spark, None, "2026-07-01", sup("p", "uno"))
    dim = load(spark, dim, "2026-08-01", sup("p", "dos"))
    dim = load(spark, dim, "2026-08-01", sup("p", "uno"))
    assert [(v[1], v[4]) for v in versions(dim)] == [("uno", dt.date(2026, 7, 1)), ("uno", dt.date(2026, 8, 1))]


def test_a_b_a_gives_three_versions_and_null_names_compare(spark):
    dim = None
    for month, name in (("07", "a"), ("08", None), ("09", "a")):
        dim = load(spark, dim, f"2026-{month}-01", sup("p", name))
    assert [(v[1], v[6]) for v in versions(dim)] == [(None, False), ("a", False), ("a", True)]


def test_rerun_changes_nothing(spark):
    dim = load(spark, None, "2026-07-01", sup("p", "uno"))
    once = load(spark, dim, "2026-08-01", sup("p", "dos"), sup("n", "x"))
    assert versions(load(spark, once, "2026-08-01", sup("p", "dos"), sup("n", "x"))) == versions(once)


@pytest.mark.parametrize("seed", [1, 2])
def test_history_equals_fold(spark, seed):
    rng = random.Random(seed)
    months = [f"2026-{m:02d}-01" for m in range(1, 6)]
    snap = [(f"k{k}", m, rng.choice(["a", "b", None]), rng.choice(["x", "y", None]), rng.choice([True, False]))
            for k in range(40) for m in months if rng.random() < .7]
    df = spark.createDataFrame(snap, "codigo string, desde string, nombre string, region string, persona boolean").withColumn("desde", F.col("desde").cast("date"))
    dim = dims.empty_scd2(df.drop("desde"), "codigo", ["nombre", "region", "persona"], "sk")
    for m in months:
        dim = dims.scd2_apply(dim, df.where(F.col("desde") == m).drop("desde"), "codigo", ["nombre"], ["region"], day(m), "sk", ["persona"])
        # The fold reads itself again each time; a written table per load is what the job does.
        dim = spark.createDataFrame(dim.collect(), dim.schema)
    history = dims.scd2_history(df, "codigo", "desde", ["nombre"], ["region"], ["persona"])
    assert rows(history) == rows(dim.drop("sk").select(*history.columns))


def test_history_shuffles_once(spark):
    df = spark.createDataFrame([("k", dt.date(2026, 1, 1), "a", "x")], "codigo string, desde date, nombre string, region string")
    plan = dims.scd2_history(df, "codigo", "desde", ["nombre"], ["region"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def unit(code, name, region, rut="1-9", org="o"):
    return (code, name, rut, region, org)


UNITS = "codigo_unidad string, nombre_unidad string, rut_unidad string, region_unidad string, codigo_organismo string"


def test_scd1_rewrites_only_on_compared_columns(spark):
    first = spark.createDataFrame([unit("a", "A", "n"), unit("b", "B", "n"), unit("c", "C", None), unit(None, "x", "x")], UNITS)
    dim = dims.upsert_units(None, first, at("2026-01-01 00:00:00"))
    second = spark.createDataFrame([unit("a", "A", "n", "2-7", "p"), unit("b", "B", "s", "2-7", "p"), unit("d", "D", "n")], UNITS)
    got = rows(dims.upsert_units(dim, second, at("2026-02-01 00:00:00")).select("codigo_unidad", "rut_unidad", "region_unidad", "codigo_organismo", F.month("actualizado_en")))
    assert got == [("a", "1-9", "n", "o", 1), ("b", "2-7", "s", "p", 2), ("c", "1-9", None, "o", 1), ("d", "1-9", "n", "o", 2)]


def test_scd1_keeps_surrogate_keys(spark):
    first = spark.createDataFrame([unit("a", "A", "n")], UNITS)
    dim = dims.upsert_units(None, first, at("2026-01-01 00:00:00"))
    again = dims.upsert_units(dim, spark.createDataFrame([unit("a", "Z", "n")], UNITS), at("2026-02-01 00:00:00"))
    assert dim.first().sk_unidad == again.first().sk_unidad


def test_calendar(spark):
    cal = dims.calendar_dim(spark)
    assert cal.count() == 7670
    r = cal.where("fecha_id = 20240229").first()
    assert (r.trimestre, r.dia_semana, r.es_fin_semana, r.anio_mes) == (1, 4, False, "2024-02")


def test_dictionary(spark):
    deco = spark.createDataFrame(
        [("T1", "m2", "T1 00R", "d", "t", "c2"), ("T1", "m1", "T1 00I", "d", "t", "c1"), ("T2", "m", "T2 X", "d", "t", "c")],
        "codigo_usuario string, codigo_mtt string, codigo_ruta string, servicio_deco string, tipo_servicio string, cli_dsc string")
    services, routes = dims.service_dim(deco, at("2026-01-01 00:00:00")), dims.route_dim(deco, at("2026-01-01 00:00:00"))
    assert rows(services.select("codigo_usuario", "codigo_mtt", "unidad")) == [("T1", "m1", "c1"), ("T2", "m", "c")]
    assert rows(routes.select("codigo_ruta", "sentido")) == [("T1 00I", "I"), ("T1 00R", "R"), ("T2 X", None)]
    again = dims.service_dim(deco.where("codigo_usuario = 'T2'"), at("2026-02-01 00:00:00"), services)
    assert rows(again.select("codigo_usuario", F.month("actualizado_en"))) == [("T1", 1), ("T2", 2)]
    assert rows(dims.dictionary_summary(services, routes)) == [("recorridos", 3), ("servicios", 2), ("sin sentido", 1)]
