"""The registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arriero.llm import alignment, centroids, decontaminate, jaccard_join, language, mixing, near_dup, pivots, repeats, secrets, toxicity, url_filter, warc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: Rows per Arrow batch for tables of whole texts; Spark's default of 10000 rows is some 35 MB of them at once.
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


def register(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Texts are long, so Arrow batches of the session become smaller unless they are set already."""
    if spark.conf.get(BATCH_SETTING) == "10000":
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op10_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under shingle similarity 0.75."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


@register
def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 200-byte strings that occur twice."""
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


@register
def op4_toxicity_boosted_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document; labels of the rows held out are never read."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.toxicity(docs.select("doc_id", "text"), toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("held_out"), "score", "predicted")


@register
def op7_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


@register
def op8_url_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return url_filter.judge(table(spark, sf_dir, "pages"))


@register
def op6_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, as read back from the archives."""
    return warc.archived(table(spark, sf_dir, "pages"))


@register
def op5_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows for every fiftieth vector."""
    return pivots.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@register
def op9_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; rows held out are never learned from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    named = language.label(docs, language.fit(docs))
    return named.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("held_out"), "lang_pred", "score")


@register
def op3_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item or a re-parameterised copy of it."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register
def op1_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document with the forest's verdict."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.scan(docs, secrets.fit(docs))


@register
def op11_fragment_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token groups and links of two tokenizers in every document."""
    return alignment.align(table(spark, sf_dir, "documents"))


@register
def op12_va_file_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after five rounds from forty centroids."""
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


@register
def op13_multi_match_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under shingle similarity 0.8."""
    return jaccard_join.join(table(spark, sf_dir, "documents"))
