"""Shuffles that carry few columns, compressed bulk files and streams whose batches are many files."""

import gzip

from pyspark.sql import functions as F

from arriero.operators import facts
from arriero.plans import fixtures as fx
from arriero.plans import registry
from arriero.sinks import fs
from arriero.sinks.tables import replace_partitions
from arriero.sources.procurement import read_items_csv
from arriero.streaming import positions as stream


def shuffles(df) -> list[str]:
    return [x for x in df._jdf.queryExecution().executedPlan().toString().split("\n") if " Exchange " in x and "plan_id" in x]


def test_the_first_line_of_a_compressed_file(spark, tmp_path):
    with gzip.open(tmp_path / "a.csv.gz", "wt", encoding="ISO-8859-1") as f:
        f.write("IDItem;Ñandú\n1;2\n")
    assert fs.first_line(spark, str(tmp_path / "a.csv.gz"), "ISO-8859-1") == "IDItem;Ñandú"


def test_compressed_files_with_different_headers_keep_their_columns(spark, tmp_path):
    for name, text in (("a", "IDItem;Codigo\n1;x\n"), ("b", "Codigo;IDItem\ny;2\n")):
        with gzip.open(tmp_path / f"{name}.csv.gz", "wt") as f:
            f.write(text)
    got = read_items_csv(spark, str(tmp_path)).select("IDItem", "Codigo").collect()
    assert sorted(map(tuple, got)) == [("1", "x"), ("2", "y")]


def test_bulk_files_are_compressed_and_gathered_by_month(spark, sf):
    root = registry.raw_item_files(spark, sf)
    files = fs.files(spark, f"{root}/mes=*/*.csv*")
    assert files and all(f.endswith(".gz") for f in files)
    assert len(files) == len(fs.folders(spark, f"{root}/mes=*"))  # one each: a month this small is not cut


def test_texts_are_made_behind_the_last_shuffle(spark, sf):
    plan = fx.raw_items(spark, sf)._jdf.queryExecution().executedPlan().toString()
    last = plan.index("Exchange")  # the topmost
    assert "Orden " in plan[:last] and "Orden " not in plan[last:]


def test_an_order_is_rolled_up_with_one_shuffle(spark, sf):
    assert len(shuffles(facts.order_rollup(fx.written(fx.stage(spark, sf), "prueba")))) == 1


def test_the_amount_of_an_order_is_that_of_its_latest_items(spark, sf):
    rows = fx.stage(spark, sf).groupBy("codigo").agg(F.sum("total_linea_neto").alias("a"), F.min("monto_total_oc_clp").alias("b"), F.max("monto_total_oc_clp").alias("c"))
    assert rows.where("a <> b or a <> c").isEmpty() and not rows.isEmpty()


def test_one_partition_value_is_not_shuffled(spark, tmp_path):
    df = spark.range(0, 100, 1, 4).withColumn("mes", F.lit("2026-01"))
    assert replace_partitions(df, str(tmp_path / "t"), ["2026-01"]) == {"2026-01": 100}
    assert len(list((tmp_path / "t" / "mes=2026-01").glob("*.parquet"))) == 4  # where the rows were


def test_a_week_of_many_files_is_one_batch(spark, sf, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "WEEK_FILE_ROWS", 10)
    source = registry._weekly(spark, sf, str(tmp_path), True)
    seen = []
    stream._trigger(source.writeStream.foreachBatch(lambda b, i: seen.append((b.count(), len(b.inputFiles()))))
                    .option("checkpointLocation", str(tmp_path / "cp")), None).start().awaitTermination()
    events = fx.table(spark, sf, "events").withColumn("w", F.floor((F.dayofmonth("ts") - 1) / 7))
    n = [events.where(F.col("w") == i).count() for i in range(5)] + [0]
    assert [rows for rows, _ in seen] == [n[i] + (n[i - 1] if i else 0) for i in range(6)]


def test_a_bucket_of_the_snapshot_is_one_file_in_a_stream(spark, sf, tmp_path):
    rows = fx.table(spark, sf, "events").repartition(4)
    rows.write.parquet(str(tmp_path / "in"))
    source = stream.read_stream(spark, str(tmp_path / "in"), rows.schema)
    stream.latest_state(source, str(tmp_path / "t"), str(tmp_path / "cp"), ["user_id"], ["ts", "event_id"]).awaitTermination()
    buckets = list((tmp_path / "t").glob("version=*/cubeta=*"))
    assert buckets and all(len(list(b.glob("*.parquet"))) == 1 for b in buckets)
