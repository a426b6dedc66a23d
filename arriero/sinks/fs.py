"""Small driver-side file operations through the cluster's Hadoop file system."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.delete(p, True)


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob pattern."""
    fs, p = _open(spark, pattern)
    return [str(status.getPath().toString()) for status in fs.globStatus(p) or [] if status.isDirectory()]


def read_text(spark: SparkSession, path: str) -> str | None:
    """The file's text, or None when there is none."""
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str, encoding: str = "UTF-8") -> str:
    """The first line of a text file, without reading the rest; empty for an empty file. Compressed files are known by their ending."""
    fs, p = _open(spark, path)
    jvm = spark._jvm
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(p)
    stream = fs.open(p) if codec is None else codec.createInputStream(fs.open(p))
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, encoding))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


#: File systems whose rename is atomic. Elsewhere (object stores) a single put is.
RENAMING = ("file", "hdfs", "viewfs", "abfs", "abfss")


def _put(fs, p, text: str, overwrite: bool) -> None:
    stream = fs.create(p, overwrite)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def _place(spark: SparkSession, path: str, text: str, overwrite: bool) -> None:
    jvm = spark._jvm
    fs, p = _open(spark, path)
    if fs.getUri().getScheme() not in RENAMING:
        _put(fs, p, text, overwrite)
        return
    tmp = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    _put(fs, tmp, text, True)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE if overwrite else jvm.org.apache.hadoop.fs.Options.Rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(tmp), fs.makeQualified(p), options)
    except Exception:
        fs.delete(tmp, False)
        raise


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file so that readers see the old or the new text: by rename, or by one put on an object store."""
    _place(spark, path, text, True)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file unless it exists; returns whether it was created. Readers never see a part of it.

    On an object store this needs one that refuses to overwrite when asked to.
    """
    try:
        _place(spark, path, text, False)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception) or exists(spark, path):
            return False
        raise


def files(spark: SparkSession, pattern: str) -> list[str]:
    """Plain files matching a glob pattern."""
    fs, p = _open(spark, pattern)
    return [str(status.getPath().toString()) for status in fs.globStatus(p) or [] if status.isFile()]


def size(spark: SparkSession, path: str) -> int:
    """Bytes below a path."""
    fs, p = _open(spark, path)
    return fs.getContentSummary(p).getLength()
