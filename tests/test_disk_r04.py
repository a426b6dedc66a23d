"""Shuffles that end with their write, bulk files written without a shuffle of their text, months loaded in batches."""

import time

from pyspark.sql import functions as F

from arriero.plans import fixtures as fx
from arriero.plans import jobs, registry
from arriero.sinks import fs
from arriero.sinks.publish import Publication
from arriero.sinks.tables import CLEANUP, OPEN_FILES, freed_shuffles, replace_partitions, setting, written
from tests.conftest import rows


def shuffle_files(spark) -> set[str]:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while found.hasNext():
        names.add(found.next().getName())
    return {n for n in names if n.startswith("shuffle_")}


def left_by(spark, write) -> set[str]:
    """Shuffle files that ``write`` leaves; they are removed in the background."""
    before = shuffle_files(spark)
    write()
    until = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    return left


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 3).cast("string").alias("mes")).repartition(3, "id")
    assert left_by(spark, lambda: written(df, "prueba")) == set()
    assert left_by(spark, lambda: replace_partitions(df, str(tmp_path / "t"), ["0", "1", "2"])) == set()
    load = Publication(spark, str(tmp_path / "p"))
    assert left_by(spark, lambda: load.months("hechos", df, ["0", "1", "2"])) == set()
    assert left_by(spark, lambda: load.whole("dim", df)) == set()


def test_settings_are_as_before_behind_a_write(spark):
    before = spark.conf.get(CLEANUP)
    with freed_shuffles(spark), setting(spark, OPEN_FILES, "7"):
        assert (spark.conf.get(CLEANUP), spark.conf.get(OPEN_FILES)) == ("true", "7")
    assert (spark.conf.get(CLEANUP), spark.conf.get(OPEN_FILES)) == (before, "0")


def test_bulk_rows_are_not_gathered_by_a_shuffle(spark, sf):
    plan = fx.raw_items(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE" not in plan


def test_more_months_than_a_task_keeps_open(spark, sf, monkeypatch):
    whole = spark.read.options(**registry.CSV_OPTIONS).csv(registry.raw_item_files(spark, sf))
    monkeypatch.setattr(registry, "OPEN_MONTHS", "2")
    some = spark.read.options(**registry.CSV_OPTIONS).csv(registry.raw_item_files(spark, sf))
    assert rows(whole) == rows(some)


def test_months_are_loaded_in_batches_of_bounded_size(spark, sf, tmp_path, monkeypatch):
    raw = registry.raw_item_files(spark, sf)
    months = fx.order_month_list(fx.order_headers(spark, sf))[:5]
    sizes = [fs.size(spark, f"{raw}/mes={m}") for m in months]
    seen = []

    def replaced(df, root, values, *rest):
        seen.append((root.rpartition("/")[2], list(values)))
        return replace_partitions(df, root, values, *rest)

    monkeypatch.setattr(jobs, "replace_partitions", replaced)
    got = {}
    for label, size in (("una", 1 << 40), ("varias", sizes[0] + sizes[1])):
        monkeypatch.setattr(jobs, "BATCH_BYTES", size)
        seen.clear()
        metrics = jobs.items_job(spark, raw, months, f"{tmp_path}/{label}/items", f"{tmp_path}/{label}/sensible", "k")
        got[label] = (metrics, rows(jobs.read_months(spark, f"{tmp_path}/{label}/items").drop("mes")), rows(jobs.read_months(spark, f"{tmp_path}/{label}/sensible")))
        masked = [values for table, values in seen if table == "items"]
        assert [m for b in masked for m in b] == months and (len(masked) == 1) == (label == "una")
        assert all(len(b) == 1 or sum(sizes[months.index(m)] for m in b) <= size for b in masked)
    assert got["una"] == got["varias"]
    assert jobs.month_batches(spark, raw, []) == [[]] and jobs.month_batches(spark, raw, ["2050-01"]) == [["2050-01"]]


def labels_written(monkeypatch) -> list[tuple]:
    """What a query writes to scratch tables: label and partition columns of each."""
    seen = []

    def recorded(df, label, *partition):
        seen.append((label, *partition))
        return written(df, label, *partition)

    monkeypatch.setattr(fx, "written", recorded)
    return seen


def test_bulk_texts_of_different_headers_are_made_once(spark, sf, monkeypatch):
    seen = labels_written(monkeypatch)
    registry.typed_items_mixed_headers(spark, sf)
    assert seen == [("textos",)]


def test_order_files_leave_no_shuffle_files(spark, sf):
    assert left_by(spark, lambda: registry.raw_order_files(spark, sf)) == set()


def test_facts_that_every_rule_reads_are_written_once(spark, sf, monkeypatch):
    seen = labels_written(monkeypatch)
    registry.integrity_suite(spark, sf)
    assert [label for (label,) in seen] == ["stage", "organismo", "unidad", "proveedor", "items", "pedidos"]


def test_the_stage_of_an_increment_is_not_gathered_by_month(spark, sf, monkeypatch):
    seen = labels_written(monkeypatch)
    monkeypatch.setattr(registry.jobs, "increment_months", lambda *a: None)
    monkeypatch.setattr(registry.jobs, "summary_job", lambda *a: None)
    monkeypatch.setattr(registry.jobs, "read_documents", lambda *a: registry.fx.table(spark, sf, "nation").selectExpr("array(struct(1 posicion, 1 codigo_proveedor, 1 nombre_proveedor, 1 rut_proveedor, 1 monto_clp, 1 ordenes, 1 pct_monto)) principales_proveedores"))
    registry.warehouse_increment(spark, sf)
    assert seen == [("stage",)]
