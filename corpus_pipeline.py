"""The corpus pipeline: toxicity, near duplicates, benchmark leaks, secrets, mixing. Each stage works on all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arriero.llm import decontaminate, mixing, near_dup, secrets, toxicity
from arriero.llm.prefilter import with_possible_match
from arriero.llm.queries import table
from arriero.sinks.tables import written


def _renamed(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with generated names for all columns but doc_id and text, so that none clashes with an operator's, and the names given."""
    names = {c: c if c in ("doc_id", "text") else f"given_{n}" for n, c in enumerate(docs.columns)}
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), {n: c for c, n in names.items()}


def _restored(rows: DataFrame, given: dict[str, str]) -> DataFrame:
    return rows.select(*[F.col(n).alias(c) for n, c in given.items()])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject; the model learns from the labelled ones among them."""
    rows, given = _renamed(docs)
    model = toxicity.fit(rows, table(spark, sf_dir, "labels"))
    return _restored(toxicity.toxicity(rows, model).where("predicted = 0"), given)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the least doc_id. Null ids all stay.

    A document is a doc_id with a text: of several texts under one id each is decided for itself, of rows that repeat both one stays.
    """
    rows, given = _renamed(docs)
    text_hash = F.xxhash64("text")  # a null text hashes as well
    several = written(rows.where("doc_id is not null").groupBy("doc_id").agg(F.min(text_hash).alias("a"), F.max(text_hash).alias("b"), F.count("*").alias("n")).where("n > 1").select(
        F.col("doc_id").alias("repeated_id"), (F.col("a") != F.col("b")).alias("texts_differ")), "repeated")
    split = with_possible_match(rows, "doc_id", several, "repeated_id", "maybe_repeated")
    found = split.where("maybe_repeated").join(several, F.col("doc_id") == F.col("repeated_id"), "left")
    alone = split.where("not maybe_repeated").withColumn("repeated_id", F.lit(None).cast("long")).withColumn("texts_differ", F.lit(None).cast("boolean"))
    nodes = found.unionByName(alone).withColumn("node_id", F.when(F.col("texts_differ"), F.xxhash64("doc_id", "text")).otherwise(F.col("doc_id").cast("long")))
    any_several = several.limit(1).count() > 0
    nodes = written(nodes.drop("maybe_repeated"), "nodes") if any_several else nodes.drop("maybe_repeated")

    marks = written(near_dup.near_duplicates(nodes.select(F.col("node_id").alias("doc_id"), "text")).where("doc_id is not null").select(
        F.col("doc_id").alias("marked_id"), "component_id", "kept"), "marks")
    if any_several:  # the least doc_id of a group decides, not the least node
        ids = nodes.where("texts_differ").select("node_id", F.col("doc_id").cast("long").alias("own_id")).distinct()
        owned = marks.select("marked_id", "component_id").distinct().join(ids, F.col("marked_id") == F.col("node_id"), "left").withColumn("own_id", F.coalesce("own_id", "marked_id"))
        first = owned.groupBy("component_id").agg(F.min(F.struct("own_id", "marked_id")).alias("first"))
        gone = owned.join(first, "component_id").where(F.col("marked_id") != F.col("first.marked_id")).select("marked_id")
    else:
        gone = marks.where("not kept").select("marked_id").distinct()
    gone = written(gone, "dropped")
    marked = with_possible_match(nodes, "node_id", gone, "marked_id", "suspect_row")  # only these can be among the dropped, the others stay as they are
    out = marked.where("suspect_row").join(gone, F.col("node_id") == F.col("marked_id"), "left_anti").unionByName(marked.where("not suspect_row"))
    if any_several:
        again = F.row_number().over(Window.partitionBy("node_id").orderBy(F.xxhash64("text"), "text"))
        once = out.where("repeated_id is not null").withColumn("place_of_row", again).where("place_of_row = 1").drop("place_of_row")
        out = once.unionByName(out.where("repeated_id is null"))
    return _restored(out, given)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item or a re-parameterised copy of one."""
    rows, given = _renamed(docs)
    found = decontaminate.leaks(rows, table(spark, sf_dir, "benchmark"))
    ids = written(found.select(F.col("doc_id").alias("leak_id")).distinct(), "leaks")
    return _restored(rows.join(ids, F.col("doc_id") == F.col("leak_id"), "left_anti"), given)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts and n_chars counted anew."""
    clean = secrets.redact(docs, secrets.fit(docs))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mix takes from each document."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_leaks),
    ("secret_scan", redact_secrets),
    ("mixing", mix_sources),
]

#: No stage but the last could be written in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage before is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
