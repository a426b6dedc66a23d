"""Session settings and the scratch folder shared by driver and executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Keyed stream state on the executors' disks instead of their heaps.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Keeps the pseudonym key out of plan strings and the UI.
    "spark.sql.redaction.string.regex": r"(?is)(?<=sha2\(cast\(concat\().*?(?=, regexp_replace\()",
}


def build_session(app: str = "arriero", master: str | None = None, shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Build a session with the settings the operators are tuned for.

    On a cluster leave ``shuffle_partitions`` high (AQE coalesces downwards); locally pass the core count.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(name, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach, under ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to the machine's own temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/arriero-{label}-{uuid.uuid4().hex}"
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix=f"arriero-{label}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder
