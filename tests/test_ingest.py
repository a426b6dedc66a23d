import hashlib
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from arriero.operators.dedupe import keep_first, keep_latest
from arriero.operators.privacy import keep_only, pseudonymise
from arriero.plans import jobs
from arriero.sinks import fs
from arriero.sinks.tables import register_table, replace_partitions
from arriero.sources.dictionary import read_dictionary_csv
from arriero.sources.files import content_digests, file_listing
from arriero.sources.procurement import ITEM_FIELDS, read_items_csv, read_months, read_orders_json, typed_items, typed_items_schema, typed_orders
from arriero.sources.warehouse import Split, query_options
from tests.conftest import rows

HEADER = [source for source, _, _ in ITEM_FIELDS]


def write_csv(path, *records):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    lines = [";".join([*HEADER, "Telefono"])]
    for r in records:
        lines.append(";".join('"' + str(r.get(c, "")).replace('"', '""') + '"' for c in [*HEADER, "Telefono"]))
    with open(path, "w", encoding="ISO-8859-1", newline="") as f:
        f.write("\n".join(lines) + "\n")


def item(id_, modified, supplier="a", rut="12.345.678-9", **more):
    return {"IDItem": id_, "Codigo": f"oc-{id_}", "fechaUltimaModificacion": modified, "CodigoProveedor": supplier,
            "NombreProveedor": f"Niño {supplier}", "RutSucursal": rut, "EsTratoDirecto": "Si", "totalLineaNeto": "1,5",
            "Telefono": "555", **more}


@pytest.fixture
def raw_root(tmp_path):
    root = str(tmp_path / "raw")
    write_csv(f"{root}/mes=2026-07/2026-7.csv",
              item("1", "2026-07-01", "vieja"), item("1", "2026-07-09", "nueva", Nombre='con ; "comillas"\ny salto'),
              item("2", "", "sin fecha"), item("2", "2026-07-02", "con fecha"), item("", "2026-07-02", "sin id"),
              item("3", "2026-07-03", "empresa", "76.000.000-1", RegionProveedor="  Ñuble ", CodigoLicitacion=""))
    write_csv(f"{root}/mes=2026-08/2026-8.csv", item("1", "2026-08-01", "otro mes"), item("4", "mala", "x", rut=""))
    return root


def test_items_from_files(spark, raw_root):
    typed = typed_items(read_items_csv(spark, raw_root))
    got = {(r.mes, r.id_item): r for r in typed.collect()}
    assert sorted(got) == [("2026-07", 1), ("2026-07", 2), ("2026-07", 3), ("2026-08", 1), ("2026-08", 4)]
    assert got["2026-07", 1].codigo_proveedor == "nueva"
    assert got["2026-07", 1].nombre == 'con ; "comillas"\ny salto'
    assert got["2026-07", 2].codigo_proveedor == "con fecha"
    assert got["2026-07", 3].region_proveedor == "Ñuble" and got["2026-07", 3].codigo_licitacion is None
    assert got["2026-08", 4].fecha_ultima_modificacion is None
    assert got["2026-07", 1].total_linea_neto == Decimal("1.5000") and got["2026-07", 1].es_trato_directo is True
    assert "Telefono" not in typed.columns and len(typed.columns) == 43


def test_items_job_masks_and_is_idempotent(spark, raw_root, tmp_path):
    out, sensitive = str(tmp_path / "items"), str(tmp_path / "sensible")
    months = ["2026-07", "2026-08", "2026-09"]
    first = jobs.items_job(spark, raw_root, months, out, sensitive, "clave")
    assert first == {"2026-07": 3, "2026-08": 2, "2026-09": 0, "personas": 3, "desconocidos": 1}
    before = rows(read_months(spark, out))
    jobs.items_job(spark, raw_root, months, out, sensitive, "clave")
    assert rows(read_months(spark, out)) == before
    token = hashlib.sha256(b"clave123456789").hexdigest()
    july = {r.id_item: r for r in read_months(spark, out, ["2026-07"]).collect()}
    assert (july[1].nombre_proveedor, july[1].rut_proveedor) == ("PERSONA NATURAL", token)
    assert (july[3].nombre_proveedor, july[3].rut_proveedor) == ("Niño empresa", "76.000.000-1")
    text = "".join(str(r) for r in before)
    assert "12.345.678" not in text and "555" not in text
    people = rows(read_months(spark, sensitive, ["2026-07"]).select("token_proveedor", "rut_proveedor", "nombre_proveedor"))
    assert people == [(token, "12.345.678-9", "Niño con fecha"), (token, "12.345.678-9", "Niño nueva")]
    assert read_months(spark, out, ["2030-01"]).count() == 0


def test_orders_from_json(spark, tmp_path):
    path = tmp_path / "ordenes"
    path.mkdir()
    base = {"Codigo": "o1", "CodigoEstado": 6, "TotalNeto": 100.5, "Total": "119.9", "PorcentajeIva": 19, "CodigoLicitacion": "",
            "Fechas": {"FechaCreacion": "2026-09-01T10:00:00.123", "FechaCancelacion": None, "FechaUltimaModificacion": "2026-09-02T00:00:00"},
            "Comprador": {"CodigoOrganismo": "7", "ContactoEmail": "x@y"}, "Proveedor": {"Codigo": "p", "RutSucursal": "1-9", "Region": ""},
            "Items": {"Cantidad": 3}}
    newer = {**base, "Estado": "Aceptada", "Fechas": {**base["Fechas"], "FechaUltimaModificacion": "2026-09-03T00:00:00"}}
    undated = {**base, "Estado": "sin fecha", "Fechas": {}}
    (path / "a.json").write_text("\n".join(json.dumps(r) for r in (base, newer, undated)), encoding="utf-8")
    typed = typed_orders(read_orders_json(spark, str(path)), "2026-09-05")
    (r,) = typed.collect()
    assert (r.estado, r.codigo_estado, r.total, r.total_neto, r.cantidad_items) == ("Aceptada", 6, Decimal("119.90"), Decimal("100.50"), 3)
    assert r.codigo_licitacion is None and r.region_proveedor is None and r.fecha == "2026-09-05"
    assert not any("contacto" in c.lower() for c in typed.columns)
    done = jobs.orders_job(spark, str(path), "2026-09-05", str(tmp_path / "o"), str(tmp_path / "s"), "k")
    assert done == {"2026-09-05": 1, "personas": 1, "desconocidos": 0}
    jobs.orders_job(spark, str(path), "2026-09-05", str(tmp_path / "o"), str(tmp_path / "s"), "k", "arriero_prueba_ordenes")
    assert spark.table("arriero_prueba_ordenes").count() == 1
    spark.sql("DROP TABLE arriero_prueba_ordenes")


def test_each_file_is_bound_by_its_own_header(spark, tmp_path):
    root = tmp_path / "raw"
    for month, text in (("2026-01", "Codigo;Nombre;IDItem\na;x;1\n"), ("2026-02", "IDItem;Nombre;Codigo\n2;y;b\n"), ("2026-03", "Extra;Codigo;IDItem\nz;c;3\n")):
        os.makedirs(root / f"mes={month}")
        (root / f"mes={month}" / "f.csv").write_text(text, encoding="ISO-8859-1")
    got = read_items_csv(spark, str(root)).select("mes", "IDItem", "Codigo", "Nombre")
    assert rows(got.select(F.col("mes").cast("string"), "IDItem", "Codigo", "Nombre")) == [
        ("2026-01", "1", "a", "x"), ("2026-02", "2", "b", "y"), ("2026-03", "3", "c", None)]


def test_unknown_ids_are_counted_and_may_be_masked_by_the_job(spark, raw_root, tmp_path):
    months = ["2026-07", "2026-08"]
    done = jobs.items_job(spark, raw_root, months, str(tmp_path / "o"), str(tmp_path / "s"), "k", on_unknown="mask")
    assert done["desconocidos"] == 1
    assert read_months(spark, str(tmp_path / "o"), ["2026-08"]).where("nombre_proveedor = 'PERSONA NATURAL'").count() == 2


def test_a_table_that_does_not_exist_yet_has_no_months(spark, tmp_path):
    schema = typed_items_schema(spark)
    assert read_months(spark, str(tmp_path / "none"), ["2026-01"], schema=schema).count() == 0
    assert jobs.load_months(spark, str(tmp_path / "none"), str(tmp_path / "dw"), ["2026-01"], F.lit("2026-01-01").cast("timestamp")) == {"2026-01": None}


def test_unknown_ids_keep_or_mask(spark):
    df = spark.createDataFrame([("x", None), ("y", "abc"), ("z", "1-9"), ("w", "60000000-1")], "nombre_proveedor string, rut_proveedor string")
    kept = rows(pseudonymise(df, "k")[0].select("nombre_proveedor"))
    assert kept == [("PERSONA NATURAL",), ("w",), ("x",), ("y",)]
    masked, people = pseudonymise(df, "k", on_unknown="mask")
    assert [r[0] for r in rows(masked.select("nombre_proveedor"))] == ["PERSONA NATURAL"] * 3 + ["w"]
    assert people.count() == 3
    with pytest.raises(ValueError):
        pseudonymise(df, "k", on_unknown="drop")


def test_key_stays_out_of_plans(spark):
    df = spark.createDataFrame([("x", "1-9")], "nombre_proveedor string, rut_proveedor string")
    masked, people = pseudonymise(df, "mi clave, secreta")
    for frame in (masked, people):
        assert "secreta" not in frame._jdf.queryExecution().toString()


def test_allow_list(spark):
    df = spark.createDataFrame([(1, "a")], "x int, email string")
    assert keep_only(df, ["x", "y"]).columns == ["x"]


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_dedupe_does_not_depend_on_partitioning(spark, parts):
    # One key holds a third of the rows.
    data = [(0 if i % 3 == 0 else i, i % 5, f"v{i}") for i in range(300)] + [(0, None, "nulo")]
    df = spark.createDataFrame(data, "k int, t int, v string").repartition(parts)
    got = rows(keep_latest(df, ["k"], ["t", "v"]))
    best = {}
    for k, t, v in data:
        best[k] = max(best.get(k, (-1, "")), (-1 if t is None else t, v))
    assert got == sorted(((k, t, v) for k, (t, v) in best.items()), key=lambda r: [str(x) for x in r])
    first = {r.k: (r.t, r.v) for r in keep_first(df, ["k"], ["t", "v"]).collect()}
    assert first[0] == min((t, v) for k, t, v in data if k == 0 and t is not None)


def test_replace_partitions(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "2026-01"), (2, "2026-01"), (3, "2026-02")], "x int, mes string")
    assert replace_partitions(df, root, ["2026-01", "2026-02"]) == {"2026-01": 2, "2026-02": 1}
    assert replace_partitions(df.where("x = 1"), root, ["2026-01"]) == {"2026-01": 1}
    assert rows(read_months(spark, root)) == [(1, "2026-01"), (3, "2026-02")]
    assert replace_partitions(df.where("false"), root, ["2026-02"]) == {"2026-02": 0}
    assert rows(read_months(spark, root)) == [(1, "2026-01")]
    with pytest.raises(Exception, match="outside the requested"):
        replace_partitions(df, root, ["2026-01"])
    assert rows(read_months(spark, root)) == [(1, "2026-01")]


def test_a_dominant_month_is_split(spark, tmp_path):
    """The rebalance hint cuts the partition of a month holding nearly all rows into several files."""
    root = str(tmp_path / "t")
    df = spark.range(200_000).select("id", F.when(F.col("id") < 190_000, "2026-01").otherwise("2026-02").alias("mes"), F.sha2(F.col("id").cast("string"), 256).alias("s"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        replace_partitions(df, root, ["2026-01", "2026-02"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    assert len([f for f in os.listdir(f"{root}/mes=2026-01") if f.endswith(".parquet")]) > 1


def test_catalog_registration(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "2026-01")], "x int, mes string")
    replace_partitions(df, root, ["2026-01"])
    register_table(spark, "prueba_registro", root, df)
    assert spark.table("prueba_registro").count() == 1
    wider = spark.createDataFrame([(2, [("a", 1)], "2026-02")], "x int, l array<struct<n: string, v: int>>, mes string")
    replace_partitions(wider, root, ["2026-02"])
    register_table(spark, "prueba_registro", root, wider)
    assert sorted((r.x, r.mes) for r in spark.table("prueba_registro").collect()) == [(1, "2026-01"), (2, "2026-02")]
    assert dict(spark.table("prueba_registro").dtypes)["l"] == "array<struct<n:string,v:int>>"


def test_file_listing(spark, raw_root):
    got = file_listing(spark, raw_root, "*.csv").collect()
    assert sorted(r.mes for r in got) == ["2026-07", "2026-08"]
    assert all(r.bytes > 0 and r.modificado is not None and len(r.huella) == 64 for r in got)


def test_dictionary_file(spark, tmp_path):
    path = tmp_path / "deco.csv"
    path.write_text("CODIGO_USUARIO;CODIGO_MTT;CODIGO_RUTA;SERVICIO_DECO;TIPO_SERVICIO;CLI_DSC\nT1;m;T1 00I;d;t;Ñ\n", encoding="utf-8")
    assert read_dictionary_csv(spark, str(path)).first().asDict() == {
        "codigo_usuario": "T1", "codigo_mtt": "m", "codigo_ruta": "T1 00I", "servicio_deco": "d", "tipo_servicio": "t", "cli_dsc": "Ñ"}


def test_jdbc_options():
    got = query_options("jdbc:x", "select 1", {"user": "u"}, Split("id", "0", "100", 4))
    assert got == {"user": "u", "url": "jdbc:x", "dbtable": "(select 1) q", "partitionColumn": "id", "lowerBound": "0",
                   "upperBound": "100", "numPartitions": "4"}


def test_replace_text(spark, tmp_path):
    path = str(tmp_path / "p.json")
    assert fs.read_text(spark, path) is None
    fs.replace_text(spark, path, "uno ñ")
    fs.replace_text(spark, path, "dos ñ")
    assert fs.read_text(spark, path) == "dos ñ"
    assert [f for f in os.listdir(tmp_path) if "tmp" in f] == []


def test_digests_follow_the_content_alone(spark, tmp_path):
    def put(name, data):
        path = tmp_path / "r" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)

    put("mes=2026-01/a b+c%.csv", b"x;1\ny;2\ny;2\n")
    put("mes=2026-02/a.csv", b"y;2\r\nx;1\r\ny;2")
    put("mes=2026-03/a.csv", b"x;1\ny;2\n")
    put("mes=2026-04/a.csv", b"")
    put("mes=2026-05/a.csv", b"x;1\nx;1\ny;2\n")
    got = {r.mes: r for r in content_digests(spark, str(tmp_path / "r"), "*.csv").collect()}
    assert {m: r.lineas for m, r in got.items()} == {"2026-01": 3, "2026-02": 3, "2026-03": 2, "2026-05": 3}
    assert got["2026-01"].huella == got["2026-02"].huella and len({r.huella for r in got.values()}) == 3
