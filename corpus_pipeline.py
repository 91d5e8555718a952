"""A training-data pipeline of operators from ``objsync.llm``, from documents to packed sequences.

Every stage but the last returns the columns of the documents it was given. Texts that a
stage changes have their ``n_chars``, where there is one, counted again.

Defined results: an empty table passes through; documents with null or empty texts are
kept by all stages, further columns are kept until the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from objsync.llm import decontamination, jaccard_join, packing, secret_scan, toxic_spans
from objsync.llm.queries import tokenizer_path
from objsync.llm.shared import maybe_among, table, written


#: Bytes of the batches in which rows go to Python workers and come back; each core of an
#: executor holds a few of them.
BATCH_BYTES = "8m"


def _in_small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxic span field does not reject."""
    _in_small_batches(spark)
    tagger = toxic_spans.fit(toxic_spans.labelled_texts(docs, table(spark, sf_dir, "labels")))
    return toxic_spans.drop_toxic(docs, tagger)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates.

    Rows go by a hash of id and text, so documents that share an id are told apart; of
    rows alike in both, one stays where they have words. The row of the smallest hash stays.
    """
    _in_small_batches(spark)
    key = "__row_key"
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    groups = written(jaccard_join.similar_documents(keyed, id_column=key).withColumnRenamed("doc_id", key), "groups")
    later = groups.where(F.col("component_id") < F.col(key)).select(key, F.lit(False).alias("__stays"))
    first = groups.where((F.col("n_shingles") > 0) & (F.col("component_id") == F.col(key)))
    repeated = first.groupBy(key).count().where("count > 1").select(key, F.lit(True).alias("__stays"))
    listed = written(later.unionByName(repeated).distinct(), "listed")
    # most rows are ruled out by a bitmap and stay; the others are joined
    among = maybe_among(spark, listed, key)(key)
    rest = keyed.where(among).join(listed, key, "left")
    once = rest.where("__stays").dropDuplicates([key]).unionByName(rest.where("__stays is null"))
    return keyed.where(~among).unionByName(once.drop("__stays")).drop(key)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a benchmark item has."""
    _in_small_batches(spark)
    return _counted(decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked."""
    return _counted(secret_scan.mask_secrets(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents, ids included, and their places in packed sequences."""
    _in_small_batches(spark)
    return packing.pack_documents(docs, tokenizer_path(), with_ids=True)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("secrets", secrets),
    ("packing", packing_stage),
]
#: The tokens of the last stage have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and reread before the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
