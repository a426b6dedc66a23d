import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from arriero.operators import serving
from arriero.operators.dedupe import keep_latest
from arriero.sources import positions as pos
from arriero.streaming import positions as stream
from arriero.streaming.expiry import PROVIDER_SETTING, expiring_latest, rocksdb
from tests.conftest import rows

NOW = dt.datetime(2026, 9, 1, 12, 0, 0)
SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, value double"


def now():
    return F.lit("2026-09-01 12:00:00").cast("timestamp_ntz")


def record(stamp, lat="-33.4", fields=12, plate="ABCD12", repeat=1):
    parts = [stamp, plate, lat, "-70.6", "12.5", "3", "5", "T502", "I", "T502 00I", "502I", "01-09-2026 12:00:01"][:fields]
    return ";".join(parts * repeat) + (";" if repeat > 1 or fields == 12 else "")


def frame(spark, *records):
    return spark.createDataFrame([("20260901080000", r) for r in records], "consulta string, registro string")


def test_freshness_and_malformed(spark):
    df = frame(
        spark,
        record("01-09-2026 11:55:00", plate="justo"), record("01-09-2026 11:54:59", plate="viejo"),
        record("01-09-2027 00:00:00", plate="futuro"), record("2026-09-01 12:00:00", plate="fecha"),
        record("01-09-2026 12:00:00", lat="", plate="vacio"), record("01-09-2026 12:00:00", fields=5, plate="corto"),
        record("01-09-2026 11:59:00", plate="varias", repeat=4), "", None)
    got = pos.parse_positions(df, now())
    assert sorted(r.patente for r in got.collect()) == ["futuro", "justo", "varias"]
    assert sorted(r.patente for r in pos.parse_positions(df, now(), max_future_minutes=10).collect()) == ["justo", "varias"]
    r = got.where("patente = 'justo'").first()
    assert r.fecha_gps == "2026-09-01T11:55:00+00:00" and r.gps == dt.datetime(2026, 9, 1, 11, 55)
    assert (r.latitud, r.velocidad, r.direccion, r.consulta) == (-33.4, 12.5, "3", "20260901080000")
    report = dict(rows(pos.parse_report(df, now())))
    assert report == {"activo": 3, "antiguo": 1, "corto": 3, "fecha inválida": 1, "número inválido": 1}


def test_parsing_adds_no_shuffle_and_ignores_the_session_zone(spark):
    df = frame(spark, record("01-09-2026 11:59:00"))
    assert "Exchange" not in pos.parse_positions(df, now())._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.session.timeZone", "America/Santiago")
    try:
        assert pos.parse_positions(df, now()).first().fecha_gps == "2026-09-01T11:59:00+00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_all_transmissions(spark):
    df = frame(spark, record("01-09-2026 11:59:00", repeat=3), record("x", fields=5))
    every = pos.explode_transmissions(df)
    assert sorted(r.transmision for r in every.collect()) == [0, 1, 2]
    assert pos.parse_positions(every, now()).count() == 3


def test_payload(spark, tmp_path):
    (tmp_path / "ok.json").write_text(json.dumps({"fecha_consulta": "c1", "posiciones": [record("01-09-2026 11:59:00"), "x"]}, indent=1))
    assert pos.explode_payload(pos.read_payloads(spark, str(tmp_path / "ok.json"))).count() == 2
    (tmp_path / "bad.json").write_text(json.dumps({"error": "sin acceso"}))
    with pytest.raises(Exception, match="answer without positions"):
        pos.explode_payload(pos.read_payloads(spark, str(tmp_path / "bad.json"))).count()


def test_messages_are_keyed_json(spark, tmp_path):
    df = frame(spark, *[record("01-09-2026 11:59:00", plate=f"P{i % 5}") for i in range(40)])
    path = str(tmp_path / "m")
    pos.publish_messages(pos.keyed_messages(pos.parse_positions(df, now())), "parquet", {"path": path})
    back = spark.read.parquet(path).collect()
    assert len(back) == 40 and all(json.loads(r.value)["patente"] == r.key for r in back)
    assert list(json.loads(back[0].value)) == [*pos.FIELDS, "consulta"]


@pytest.fixture
def event_files(spark, tmp_path):
    """Events in several files, out of order, with ties in time; one user has a third of them."""
    rng = random.Random(3)
    base = dt.datetime(2026, 1, 1)
    data = [(i, base + dt.timedelta(minutes=rng.randint(0, 50)), 0 if i % 3 == 0 else rng.randint(1, 30), float(i)) for i in range(600)]
    rng.shuffle(data)
    folder = str(tmp_path / "in")
    for k in range(4):
        spark.createDataFrame(data[k * 150:(k + 1) * 150], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return folder


def expected(spark, folder):
    return rows(keep_latest(spark.read.parquet(folder), ["user_id"], ["ts", "event_id"]))


def test_snapshot_equals_batch_over_many_micro_batches(spark, event_files, tmp_path):
    root, cp = str(tmp_path / "t"), str(tmp_path / "cp")
    source = stream.read_stream(spark, event_files, SCHEMA, files_per_batch=1)
    stream.latest_state(source, root, cp, ["user_id"], ["ts", "event_id"]).awaitTermination()
    assert rows(stream.current_snapshot(spark, root)) == expected(spark, event_files)
    assert stream._version(spark, root)[0] == 4
    late = spark.createDataFrame([(9999, dt.datetime(2025, 1, 1), 0, 1.0), (10000, dt.datetime(2027, 1, 1), 77, 1.0)], SCHEMA)
    late.coalesce(1).write.mode("append").parquet(event_files)
    stream.latest_state(stream.read_stream(spark, event_files, SCHEMA, files_per_batch=1), root, cp, ["user_id"], ["ts", "event_id"]).awaitTermination()
    assert rows(stream.current_snapshot(spark, root)) == expected(spark, event_files)


def test_replayed_batch_is_harmless(spark, tmp_path):
    root = str(tmp_path / "t")
    a = spark.createDataFrame([(1, NOW, 1, 1.0)], SCHEMA)
    b = spark.createDataFrame([(2, NOW, 1, 2.0), (3, NOW, 2, 3.0)], SCHEMA)
    for batch, n in ((a, 0), (b, 1), (b, 1), (a, 0)):
        stream.apply_batch(root, batch, n, ["user_id"], ["ts", "event_id"])
    assert [r[0] for r in rows(stream.current_snapshot(spark, root))] == [2, 3]


def test_state_store_updates_equal_batch_and_emit_changes_only(spark, event_files, tmp_path):
    path = str(tmp_path / "u")
    newest = stream.latest_updates(stream.read_stream(spark, event_files, SCHEMA, files_per_batch=1), ["user_id"], ["ts", "event_id"])
    stream.write_updates(newest, path, str(tmp_path / "cp")).awaitTermination()
    log = spark.read.parquet(path)
    state = stream.read_updates(spark, path, ["user_id"], ["ts", "event_id"]).select("event_id", "ts", "user_id", "value")
    assert rows(state) == expected(spark, event_files)
    assert log.count() < 4 * state.count()


def test_archive_and_both_outputs(spark, event_files, tmp_path):
    source = stream.read_stream(spark, event_files, SCHEMA, files_per_batch=2)
    stream.archive_stream(source, str(tmp_path / "a"), str(tmp_path / "cpa")).awaitTermination()
    archived = spark.read.json(str(tmp_path / "a"))
    assert archived.count() == 600 and {"fecha", "hora"} <= set(archived.columns)
    stream.both_outputs(source, str(tmp_path / "s"), str(tmp_path / "h"), str(tmp_path / "cpb"), ["user_id"], ["ts", "event_id"]).awaitTermination()
    assert spark.read.json(str(tmp_path / "h")).count() == 600
    assert rows(stream.current_snapshot(spark, str(tmp_path / "s"))) == expected(spark, event_files)


def test_history_is_packed_and_read_once(spark, tmp_path):
    """Loose and packed batches, a full pack, a replay of a packed batch, an unfinished batch, and two packers at once."""
    history, fields = str(tmp_path / "h"), "event_id bigint"
    hour = lambda h: F.lit(dt.datetime(2024, 1, 1, h))
    ids = lambda: sorted(r.event_id for r in stream.read_history(spark, history, fields).collect())
    put = lambda low, high, batch, h: stream.write_history(spark.range(low, high, 1, 3).toDF("event_id"), history, batch, "s", hour(h))
    assert stream.compact_history(spark, history, fields) == 0 and ids() == []
    put(0, 10, 0, 5)
    put(10, 20, 1, 5)
    assert ids() == list(range(20))
    assert stream.compact_history(spark, history, fields) == 2 and ids() == list(range(20))
    put(10, 20, 1, 5)  # replayed after it was packed
    put(20, 30, 2, 5)
    put(30, 40, 3, 6)
    (tmp_path / "h/flujo=s/lote=4/fecha=2024-01-01/hora=06").mkdir(parents=True)  # still being written
    assert ids() == list(range(40))
    before = stream._packed(spark, history)
    assert stream.compact_history(spark, history, fields) == 2 and ids() == list(range(40))
    rows_ = stream.read_history(spark, history, fields).withColumn("f", F.input_file_name()).groupBy("hora").agg(F.count_distinct("f").alias("n")).collect()
    assert {r.hora: r.n for r in rows_} == {"05": 1, "06": 1}
    put(40, 50, 5, 5)
    assert stream.compact_history(spark, history, fields, pack_bytes=1) == 1 and ids() == list(range(50))  # the full pack stays as it is
    assert len(stream._packed(spark, history)[1]["horas"]["2024-01-01/05"]) == 2
    put(50, 60, 6, 7)
    now = stream._packed
    try:
        stream._packed = lambda *_: (now(spark, history)[0] - 1, now(spark, history)[1])  # another packer was faster
        assert stream.compact_history(spark, history, fields) == 0
    finally:
        stream._packed = now
    assert before[0] == 1 and ids() == list(range(60))


def test_retries_reach_neither_output(spark, tmp_path):
    rows_ = [(1, NOW, 1, 1.0), (2, NOW + dt.timedelta(minutes=1), 1, 2.0)]
    for _ in range(2):
        spark.createDataFrame(rows_, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    typed = stream.read_stream(spark, str(tmp_path / "in"), SCHEMA, files_per_batch=1).withColumn("ts", F.col("ts").cast("timestamp"))
    stream.both_outputs(typed, str(tmp_path / "s"), str(tmp_path / "h"), str(tmp_path / "cp"), ["user_id"], ["ts", "event_id"], once=(["event_id"], "ts", "1 hour")).awaitTermination()
    assert stream.read_history(spark, str(tmp_path / "h"), "event_id bigint").count() == 2
    assert [r.event_id for r in stream.current_snapshot(spark, str(tmp_path / "s")).collect()] == [2]


def test_a_new_checkpoint_on_an_old_table_loses_nothing(spark, tmp_path):
    """Batch numbers start again from 0; all three writers keep what the first stream stored."""
    root, hist, ups = str(tmp_path / "t"), str(tmp_path / "h"), str(tmp_path / "u")
    data = [[(1, NOW, 1, 1.0), (2, NOW, 2, 2.0)], [(3, NOW - dt.timedelta(days=1), 1, 3.0), (4, NOW, 5, 4.0)]]
    for i, part in enumerate(data):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"in{i}"))
        source = stream.read_stream(spark, str(tmp_path / f"in{i}"), SCHEMA)
        stream.both_outputs(source, root, hist, str(tmp_path / f"cpb{i}"), ["user_id"], ["ts", "event_id"]).awaitTermination()
        newest = stream.latest_updates(stream.read_stream(spark, str(tmp_path / f"in{i}"), SCHEMA), ["user_id"], ["ts", "event_id"])
        stream.write_updates(newest, ups, str(tmp_path / f"cpu{i}")).awaitTermination()
    assert sorted(r.event_id for r in stream.current_snapshot(spark, root).collect()) == [1, 2, 4]
    assert spark.read.json(hist).count() == 4
    assert sorted(r.event_id for r in stream.read_updates(spark, ups, ["user_id"], ["ts", "event_id"]).collect()) == [1, 2, 4]
    compacted = str(tmp_path / "c")
    assert stream.compact_updates(spark, ups, compacted, ["user_id"], ["ts", "event_id"]) == 2
    assert stream.compact_updates(spark, ups, compacted, ["user_id"], ["ts", "event_id"]) == 0
    assert sorted(r.event_id for r in stream.current_snapshot(spark, compacted).collect()) == [1, 2, 4]


def test_a_replay_in_another_hour_replaces_the_history_of_its_batch(spark, tmp_path):
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    assert old.lower() == "dynamic"
    batch = spark.createDataFrame([(1, NOW, 1, 1.0)], SCHEMA)
    for hour in ("10", "11"):
        stream.write_history(batch, str(tmp_path / "h"), 0, "s", F.lit(f"2026-01-01 {hour}:00:00").cast("timestamp_ntz"))
    assert [(r.hora, r.event_id) for r in spark.read.json(str(tmp_path / "h")).select(F.col("hora").cast("string"), "event_id").collect()] == [("11", 1)]


def test_a_batch_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    root = str(tmp_path / "t")
    stream.apply_batch(root, spark.range(200).selectExpr("id event_id", "timestamp_ntz'2026-01-01' ts", "id user_id", "1D value"), 0, ["user_id"], ["ts", "event_id"])
    before = stream._version(spark, root)[1]["cubetas"]
    stream.apply_batch(root, spark.createDataFrame([(999, NOW, 7, 2.0)], SCHEMA), 1, ["user_id"], ["ts", "event_id"])
    after = stream._version(spark, root)[1]["cubetas"]
    assert sum(before[b] != after[b] for b in after) == 1 and stream.current_snapshot(spark, root).count() == 200
    old = F.col("ts") >= F.lit("2026-06-01").cast("timestamp_ntz")
    stream.apply_batch(root, spark.createDataFrame([(1000, NOW, 7, 2.0)], SCHEMA), 2, ["user_id"], ["ts", "event_id"], keep=old)
    assert stream.current_snapshot(spark, root).count() < 200


def test_decode_reverses_the_messages(spark):
    positions = pos.parse_positions(frame(spark, record("01-09-2026 11:59:00", plate="P1")), now())
    messages = pos.keyed_messages(positions)
    assert rows(pos.decode_messages(messages).select(*positions.columns)) == rows(positions)
    as_bytes = messages.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
    assert pos.decode_messages(as_bytes).count() == 1
    assert pos.decode_messages(spark.createDataFrame([("k", "no json"), ("k", None), ("k", "{}")], "key string, value string")).count() == 0


def test_retries_are_dropped_within_the_watermark(spark, tmp_path):
    spark.createDataFrame([(1, NOW, 1, 1.0), (1, NOW, 1, 1.0), (2, NOW, 1, 1.0)], SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in"))
    once = stream.without_retries(stream.read_stream(spark, str(tmp_path / "in"), SCHEMA).withColumn("at", F.col("ts").cast("timestamp")), ["event_id"], "at", "1 hour")
    stream.archive_stream(once, str(tmp_path / "a"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.json(str(tmp_path / "a")).count() == 2


STATE = "patente string, latitud double, longitud double, velocidad double, servicio string, sentido string, ruta_sinoptico string, fecha_gps string"


def test_active_by_service(spark):
    state = spark.createDataFrame(
        [(f"P{i}", 1.0, 2.0, float(i), "T1" if i % 2 else "T2", "I" if i < 4 else "R", "", f"2026-01-01T00:0{i % 3}:00+00:00") for i in range(8)], STATE)
    got = serving.active_by_service(state, "T1", limite=2).collect()
    assert [(r.patente, r.buses_activos) for r in got] == [("P5", 4), ("P1", 4)]
    assert [r.patente for r in serving.active_by_service(state, "T1", "R").collect()] == ["P5", "P7"]
    assert serving.active_by_service(state, "T9").count() == 0
    every = serving.active_by_every_service(state, 1).collect()
    assert sorted((r.servicio, r.patente, r.buses_activos) for r in every) == [("T1", "P5", 4), ("T2", "P2", 4)]
    assert serving.active_by_every_service(state).count() == 8
    assert serving.active_by_service(state, "T1", limite=100_000).count() == 4
    for bad in ({"sentido": "X"}, {"limite": 0}):
        with pytest.raises(ValueError):
            serving.active_by_service(state, "T1", **bad)


def test_speed_class(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (19.9,), (20.0,), (None,)], "v double")
    assert [r[0] for r in df.select(serving.speed_class("v")).collect()] == [
        "detenido", "menos de 20 km/h", "menos de 20 km/h", "20 km/h o más", None]


def test_silent_keys_expire_by_a_timer(spark, tmp_path):
    """Key 1 falls silent and no record of it comes again; key 2 goes on; key 3 returns after a silence within one batch."""
    base, day = str(tmp_path), lambda d, h=0: dt.datetime(2024, 1, d, h)
    fields = "clave long, orden long, en timestamp, texto string"
    batches = [
        [(1, 1, day(1), "a"), (2, 2, day(1), None), (3, 3, day(1), "c"), (3, 4, day(1), "c2")],
        [(2, 5, day(2), "b"), (2, 6, day(1, 12), "older"), (None, 7, day(2), "null key"), (4, 8, None, "no time")],
        [(2, 9, day(6), "d"), (3, 10, day(6), "e")],
        [(2, 11, day(7), "f")],
    ]
    for rows in batches:
        spark.createDataFrame(rows, fields).coalesce(1).write.mode("append").parquet(f"{base}/in")
    schema = spark.read.parquet(f"{base}/in").schema
    changes = expiring_latest(stream.read_stream(spark, f"{base}/in", schema, files_per_batch=1), ["clave"], "en", ["orden"], dt.timedelta(days=3))
    before = spark.conf.get(PROVIDER_SETTING, None)
    with rocksdb(spark):
        query = stream.write_updates(changes, f"{base}/t", f"{base}/cp")
        query.awaitTermination()
    assert spark.conf.get(PROVIDER_SETTING, None) == before
    told = sorted(((r.lote, r.clave, r.orden, r.vigente, r.registros, r.vence.day) for r in spark.read.parquet(f"{base}/t").collect()), key=str)
    ended = sorted(((c, o, n, due) for _, c, o, holds, n, due in told if not holds), key=str)
    assert ended == sorted([(1, 1, 1, 4), (2, 5, 3, 5), (3, 4, 2, 4), (None, 7, 1, 5)], key=str)
    live = {}
    for _, c, o, holds, n, due in sorted(told, key=lambda r: (r[0], r[5], not r[3])):
        live[c] = (o, n) if holds else None
    assert live == {1: None, 2: (11, 2), 3: (10, 1), None: None}
    rows = [p["stateOperators"][0]["numRowsTotal"] for p in (json.loads(x.json) for x in query.recentProgress) if p["stateOperators"]]
    assert rows and rows[-1] < max(rows)


def test_two_writers_of_one_snapshot_lose_nothing(spark, tmp_path, monkeypatch):
    """While one batch is about to become visible two of another stream do, in the same buckets, and delete what the first one read."""
    root, fields = str(tmp_path / "t"), "k long, at long, who string"
    batch = lambda who, at: spark.createDataFrame([(k, at + (k % 2 if who == "a" else 0), who) for k in range(20)] + [(100 + at, at, who)], fields)
    apply = lambda who, n, at: stream.apply_batch(root, batch(who, at), n, ["k"], ["at", "who"], who, buckets=4)
    apply("a", 0, 1)
    create, pending = stream.fs.create_text, [5, 6]

    def interrupted(session, path, text):
        if pending:
            at = pending.pop()
            apply("b", at, at)
        return create(session, path, text)

    monkeypatch.setattr(stream.fs, "create_text", interrupted)
    apply("a", 1, 6)
    got = {r.k: (r.at, r.who) for r in stream.current_snapshot(spark, root).collect()}
    assert got == {**{k: (7, "a") if k % 2 else (6, "b") for k in range(20)}, 101: (1, "a"), 105: (5, "b"), 106: (6, "b")} and not pending
    spark.createDataFrame([(1, 9, "c")], fields).write.parquet(str(tmp_path / "in"))
    before = stream.current_snapshot(spark, root).count()
    for n in range(14):  # old versions and folders go
        stream.apply_batch(root, spark.read.parquet(str(tmp_path / "in")), n, ["k"], ["at", "who"], "c", buckets=4)
    assert stream.current_snapshot(spark, root).count() == before
    assert len(list((tmp_path / "t" / stream.VERSIONS).glob("*.json"))) == stream.KEPT_VERSIONS
