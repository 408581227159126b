"""The corpus pipeline: quality, near duplicates, repeated passages, benchmark leaks, token ids.

Every stage takes (spark, docs, sf_dir) and works on all documents that its predecessor kept; all but the last
return the columns they got, whatever their names; doc_id and text are needed. Null and empty texts pass all filters but the classifier's, which scores them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.llm.bpe import encode, vocabulary
from civiclake.llm.common import free_name, shared_dir, table
from civiclake.llm.decontaminate import without_leaks
from civiclake.llm.ngramjoin import near_duplicates
from civiclake.llm.quality import GOOD, score, train
from civiclake.llm.suffixdedup import drop_repeats


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. It learns from the labelled documents of its own input."""
    name = free_name(docs, "__score")
    return score(docs, train(docs, table(spark, sf_dir, "labels")), name).where(F.col(name) >= GOOD).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, 80 percent. Documents without words all stay; of rows
    that repeat id and text, one does."""
    key, size, group = (free_name(docs, n) for n in ("__key", "__size", "__group"))
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    groups = near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text"), width=5, percent=80).distinct()
    groups = groups.select(F.col("doc_id").alias(key), F.col("n_shingles").alias(size), F.col("component_id").alias(group))
    placed = keyed.join(groups, key)
    single = placed.where((F.col(size) > 0) & (F.col(key) == F.col(group))).dropDuplicates([key])
    return placed.where(F.col(size) == 0).unionByName(single).select(*docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 200-byte strings that occur more than once; ``n_chars``, where it is, follows the text."""
    cut = drop_repeats(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and round trip of what is left."""
    return encode(docs, vocabulary())


STAGES = [
    ("quality", good_quality),
    ("near duplicates", one_of_each_group),
    ("repeated passages", without_repeats),
    ("benchmark leaks", without_benchmark),
    ("token ids", token_ids),
]

#: The stages cannot be written in SQL; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written and read again before the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_dir(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
