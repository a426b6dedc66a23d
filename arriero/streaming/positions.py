"""Latest state and history of a keyed stream.

Every writer puts its stream's id into the paths it writes. The id lives beside the stream's checkpoint: a restart keeps it, a new
checkpoint gets a new one, so batch numbers that start again from 0 never meet what an earlier stream stored.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from arriero.operators.dedupe import keep_latest
from arriero.sinks import fs
from arriero.sinks.tables import observed, written

#: Numbered versions of a snapshot, each created only if absent; how many are kept, and how often a writer tries again.
VERSIONS, KEPT_VERSIONS, ATTEMPTS = "_versiones", 10, 20
STREAM_FILE = "_flujo"
#: Hash buckets of a snapshot table; a batch rewrites only those it touches.
BUCKETS = 64


def read_stream(spark: SparkSession, directory: str | None = None, schema=None, fmt: str = "parquet", glob: str | None = None,
                files_per_batch: int = 500, options: Mapping[str, str] | None = None) -> DataFrame:
    """A source as a stream of micro-batches.

    File sources take a folder and a schema. Other formats have a schema of their own and take ``options`` only; for Kafka at
    least ``kafka.bootstrap.servers`` and ``subscribe``, with ``maxOffsetsPerTrigger`` to bound a batch.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if directory is None:
        return reader.load()
    reader = reader.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(directory)


def _trigger(writer, every: str | None):
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that owns the checkpoint folder."""
    path = f"{checkpoint}/{STREAM_FILE}"
    if not fs.exists(spark, path):
        fs.replace_text(spark, path, uuid.uuid4().hex)
    return fs.read_text(spark, path)


def without_retries(stream: DataFrame, ids: Sequence[str], at: str, within: str) -> DataFrame:
    """Drop records that repeat ``ids`` within ``within`` of event time ``at``; state older than that is forgotten."""
    return stream.withWatermark(at, within).dropDuplicatesWithinWatermark(list(ids))


def merge_latest(previous: DataFrame | None, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key of the snapshot and the batch, by event order and not by arrival."""
    rows = batch if previous is None else previous.unionByName(batch)
    return keep_latest(rows, keys, order)


def _versions(spark: SparkSession, root: str) -> list[str]:
    return sorted(fs.files(spark, f"{root}/{VERSIONS}/*.json"))


def _version(spark: SparkSession, root: str) -> tuple[int, dict]:
    """Number and content of the newest version: the folder of each bucket, and the folders it took the place of."""
    for _ in range(ATTEMPTS):
        records = _versions(spark, root)
        if not records:
            return 0, {"cubetas": {}, "retiradas": []}
        text = fs.read_text(spark, records[-1])
        if text:  # else others wrote so many versions meanwhile that this one was deleted
            return int(records[-1].rpartition("/")[2].split(".")[0]), json.loads(text)
    raise RuntimeError(f"{root}: no version could be read")


def current_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    """The live rows: one folder per bucket, whatever number of updates there were. None before the first batch."""
    folders = sorted(_version(spark, root)[1]["cubetas"].values())
    return spark.read.parquet(*[f"{root}/{f}" for f in folders]) if folders else None


def apply_batch(root: str, batch: DataFrame, batch_id: int, keys: Sequence[str], order: Sequence[str], stream: str = "",
                keep: Column | None = None, buckets: int = BUCKETS) -> None:
    """Merge one micro-batch into the snapshot table, whose rows are dealt to hash buckets of their keys.

    Only buckets the batch has keys of are read and written, to new folders; a numbered version, created only if absent, then makes
    them visible. Several streams may write one table: who finds the number taken merges its batch with the newer version instead.
    A replay merges the same rows again, which changes nothing. ``keep`` expires rows of the touched buckets. Folders that one
    version retires are deleted by the next, so readers of the version before finish.
    """
    spark = batch.sparkSession
    dealt = batch.withColumn("cubeta", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    touched = [r.cubeta for r in dealt.select("cubeta").distinct().collect()]  # at most ``buckets``
    if not touched:
        return
    for _ in range(ATTEMPTS):
        number, state = _version(spark, root)
        folder = f"version={stream or 'directo'}-{batch_id}-{uuid.uuid4().hex[:8]}"
        try:
            live = _merge_into(root, folder, state, dealt, touched, keys, order, keep, buckets)
        except Exception:
            fs.delete(spark, f"{root}/{folder}")
            if _version(spark, root)[0] == number:
                raise
            continue  # others moved on twice and deleted what this attempt read
        old = state["retiradas"]
        after = {"cubetas": dict(state["cubetas"]), "retiradas": live}
        for b in touched:
            if fs.exists(spark, f"{root}/{folder}/cubeta={b}"):
                after["cubetas"][str(b)] = f"{folder}/cubeta={b}"
            else:
                after["cubetas"].pop(str(b), None)
        if fs.create_text(spark, f"{root}/{VERSIONS}/{number + 1:012d}.json", json.dumps(after, sort_keys=True)):
            for path in [*(f"{root}/{f}" for f in old), *_versions(spark, root)[:-KEPT_VERSIONS]]:
                fs.delete(spark, path)
            return
        fs.delete(spark, f"{root}/{folder}")
    raise RuntimeError(f"{root}: {ATTEMPTS} attempts met other writers")


def _merge_into(root: str, folder: str, state: dict, dealt: DataFrame, touched: Sequence[int], keys: Sequence[str], order: Sequence[str],
                keep: Column | None, buckets: int) -> list[str]:
    """Write the touched buckets with the batch's rows to a new folder; returns the folders they take the place of."""
    spark = dealt.sparkSession
    live = [state["cubetas"][str(b)] for b in touched if str(b) in state["cubetas"]]
    previous = spark.read.parquet(*[f"{root}/{f}" for f in live]).withColumn("cubeta", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")) if live else None
    merged = merge_latest(previous, dealt, ["cubeta", *keys], order)
    merged = merged if keep is None else merged.where(keep)
    # inside a stream AQE is off and the hint deals nothing: every task would write a file of every bucket
    adaptive = spark.conf.get("spark.sql.adaptive.enabled") == "true"
    merged = merged.hint("rebalance", "cubeta") if adaptive else merged.repartition("cubeta")
    merged.write.partitionBy("cubeta").parquet(f"{root}/{folder}")
    return live


def latest_state(stream: DataFrame, root: str, checkpoint: str, keys: Sequence[str], order: Sequence[str],
                 every: str | None = None, keep: Column | None = None) -> StreamingQuery:
    """Keep a snapshot table with the newest row per key; a batch costs as much as the buckets it touches."""
    name = stream_id(stream.sparkSession, checkpoint)

    def merge(batch: DataFrame, batch_id: int) -> None:
        apply_batch(root, batch, batch_id, keys, order, name, keep)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()


def latest_updates(stream: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key as a stateful aggregate, to run in update mode.

    State stays in the state store, hashed by key, and each batch touches and emits only the keys it changes: the form to
    use when there are many keys. The order columns are wrapped in a struct, so a row with a NULL order still counts.
    """
    others = [c for c in stream.columns if c not in keys]
    newest = F.max_by(F.struct(*others), F.struct(*order)).alias("_r")
    return stream.groupBy(*keys).agg(newest).select(*keys, "_r.*")


def write_updates(newest: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Store the keys each batch changed under the stream's id (``flujo``) and the batch's number (``lote``).

    A replayed batch overwrites its own folder, and no other.
    """
    name = stream_id(newest.sparkSession, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/flujo={name}/lote={batch_id}")

    writer = newest.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()


def read_updates(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest stored row per key, by event order: batch numbers of different streams do not compare."""
    return keep_latest(spark.read.parquet(path).drop("flujo", "lote"), keys, order)


def compact_updates(spark: SparkSession, path: str, root: str, keys: Sequence[str], order: Sequence[str]) -> int:
    """Move stored updates into the snapshot table at ``root`` and delete them; returns the folders moved.

    A crash in between leaves updates in both places, which merge to the same state. Run it while no batch is being written.
    """
    done = fs.folders(spark, f"{path}/flujo=*/lote=*")
    if done:
        apply_batch(root, spark.read.parquet(*done), 0, keys, order, "compactado")
        for folder in done:
            fs.delete(spark, folder)
    return len(done)


def archive_stream(stream: DataFrame, path: str, checkpoint: str, at: Column | None = None, every: str | None = None) -> StreamingQuery:
    """Append every record as JSON lines under ``fecha=/hora=`` of ``at``, by default the processing time (UTC)."""
    moment = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()) if at is None else at
    dated = stream.withColumn("fecha", F.date_format(moment, "yyyy-MM-dd")).withColumn("hora", F.date_format(moment, "HH"))
    writer = (
        dated.writeStream.format("json").outputMode("append").partitionBy("fecha", "hora")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, every).start()


def write_history(batch: DataFrame, history: str, batch_id: int, stream: str, at: Column | None = None) -> None:
    """One batch's records as JSON lines in a folder of its own, replaced as a whole by a replay, in whatever hour that runs."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()) if at is None else at
    dated = batch.withColumn("fecha", F.date_format(now, "yyyy-MM-dd")).withColumn("hora", F.date_format(now, "HH"))
    (
        dated.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("fecha", "hora")
        .json(f"{history}/flujo={stream}/lote={batch_id}")
    )


def both_outputs(stream: DataFrame, root: str, history: str, checkpoint: str, keys: Sequence[str], order: Sequence[str],
                 every: str | None = None, at: Column | None = None, keep: Column | None = None,
                 once: tuple[Sequence[str], str, str] | None = None) -> StreamingQuery:
    """Snapshot and history from one stream; the batch is read from its source once per output, not kept in memory.

    ``once`` (ids, event time, delay) absorbs retries: a record whose ids came before within the delay is in neither output, and one
    later than the delay is dropped. The batch is then written aside first, so its state is computed once. ``keep`` expires snapshot rows.
    """
    name = stream_id(stream.sparkSession, checkpoint)
    stream = without_retries(stream, *once) if once else stream

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = written(batch, "lote") if once else batch
        write_history(batch, history, batch_id, name, at)
        apply_batch(root, batch, batch_id, keys, order, name, keep)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()


# ---------------------------------------------------------------- compaction of the history

#: Numbered records of what the packed history holds, each created only if absent.
PACKED = "_compactado"
#: Bytes from which on a packed hour is not opened again.
PACK_BYTES = 256 << 20


def _packed(spark: SparkSession, history: str) -> tuple[int, dict]:
    """Number and content of the newest record: the last packed batch of each stream, and folders and bytes by hour."""
    records = sorted(fs.files(spark, f"{history}/{PACKED}/*.json"))
    if not records:
        return 0, {"hasta": {}, "horas": {}, "retiradas": []}
    return int(records[-1].rpartition("/")[2].split(".")[0]), json.loads(fs.read_text(spark, records[-1]))


def _pending(spark: SparkSession, history: str, state: dict) -> dict[tuple[str, int], str]:
    """Complete batch folders that no record covers, by stream and batch. A replay of a packed batch is covered already."""
    out = {}
    for folder in fs.folders(spark, f"{history}/flujo=*/lote=*"):
        flujo, lote = (x.split("=", 1)[1] for x in folder.rstrip("/").split("/")[-2:])
        if int(lote) > state["hasta"].get(flujo, -1) and fs.exists(spark, f"{folder}/_SUCCESS"):
            out[flujo, int(lote)] = folder
    return out


def _history_rows(spark: SparkSession, history: str, schema: str, batches: Sequence[str], hours: Sequence[str]) -> DataFrame:
    reader = spark.read.schema(f"{schema}, fecha string, hora string").option("basePath", history)
    empty = spark.createDataFrame([], f"{schema}, fecha string, hora string")
    loose = reader.json(list(batches)).select(*empty.columns) if batches else empty
    return loose.unionByName(reader.json([f"{history}/{h}" for h in hours]).select(*empty.columns)) if hours else loose


def read_history(spark: SparkSession, history: str, schema: str) -> DataFrame:
    """All records of the history once, packed or not, with ``fecha`` and ``hora``; ``schema`` names the record's fields."""
    state = _packed(spark, history)[1]
    return _history_rows(spark, history, schema, list(_pending(spark, history, state).values()), [f for packs in state["horas"].values() for f, _ in packs])


def compact_history(spark: SparkSession, history: str, schema: str, pack_bytes: int = PACK_BYTES) -> int:
    """Pack the finished batches into few files per hour; returns the batches packed.

    Each hour's new records join the hour's last pack unless that is full, so an hour has as many packs as it has multiples of
    ``pack_bytes``, and full packs are not read again. Everything becomes visible with one numbered record, which readers follow: they see a batch either loose or
    packed. Someone else's record with the same number makes this run undo itself and return 0. What a record retires is deleted by
    the next one, so readers of the version before finish. It may run beside the stream that writes batches.
    """
    number, state = _packed(spark, history)
    pending = _pending(spark, history, state)
    if not pending:
        return 0
    loose = _history_rows(spark, history, schema, list(pending.values()), [])
    touched = {f"{r.fecha}/{r.hora}" for r in loose.select("fecha", "hora").distinct().collect()}  # the hours of these batches
    open_packs = {h: state["horas"][h][-1][0] for h in touched if h in state["horas"] and state["horas"][h][-1][1] < pack_bytes}
    rows = _history_rows(spark, history, schema, list(pending.values()), list(open_packs.values()))
    run = f"paquete={uuid.uuid4().hex}"
    counted, seen = observed(rows.hint("rebalance", "fecha", "hora"), "paquete")
    counted.write.partitionBy("fecha", "hora").json(f"{history}/{run}")
    made = _history_rows(spark, history, schema, [], [run])
    if made.count() != seen.get["filas"]:
        raise RuntimeError(f"{run}: rows stored and rows written differ")
    hours = {h: [p for p in packs if p[0] != open_packs.get(h)] for h, packs in state["horas"].items()}
    for h in touched:
        folder = "{}/fecha={}/hora={}".format(run, *h.split("/"))
        hours.setdefault(h, []).append([folder, fs.size(spark, f"{history}/{folder}")])
    until = dict(state["hasta"])
    for flujo, lote in pending:
        until[flujo] = max(lote, until.get(flujo, -1))
    retired = [*(f"flujo={f}/lote={n}" for f, n in pending), *open_packs.values()]
    record = json.dumps({"hasta": until, "horas": hours, "retiradas": retired}, sort_keys=True)
    if not fs.create_text(spark, f"{history}/{PACKED}/{number + 1:012d}.json", record):
        fs.delete(spark, f"{history}/{run}")
        return 0
    for old in state["retiradas"]:
        fs.delete(spark, f"{history}/{old}")
    for old in sorted(fs.files(spark, f"{history}/{PACKED}/*.json"))[:-2]:
        fs.delete(spark, old)
    return len(pending)
