"""A training-data pipeline over `documents`: quality, repeated lines, near duplicates, source mix, tokens.

STAGES are (name, function); each function takes (spark, docs, sf_dir) and works on all that the stage before kept. Every
result is written to the shared folder and read again as the next stage's docs.

Defined results: a document that loses all its lines stays with an empty text (no words, so no near duplicates, no
share of the mix); where the text changes and the table has `n_chars`, that is its new length; the near-duplicate
stage decides by row, not by doc_id: of equal ids the text with the smaller hash stays, a null id yields to any other,
and of rows with equal id and text one stays; an empty table gives no rows in every stage.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolume.llm import bpe, lines, mixing, near, quality
from cargolume.llm.common import stored, table
from cargolume.session import materialise

# SQL can express neither the classifier nor byte-pair merges; tests hold each stage against plain Python.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = quality.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.accepted(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go from the texts."""
    cut = lines.without_repeated_lines(docs)
    length = {"n_chars": F.when(F.col("l_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return cut.withColumns(length).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays, that with the smallest id."""
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("t"))
    groups = near.near_groups(docs.select(key.alias("doc_id"), "text")).where("n_shingles > 0")
    keys = groups.groupBy(F.col("doc_id").alias("g_key")).agg(F.min("component_id").alias("kept"), F.count(F.lit(1)).alias("n"))
    keys = stored(keys.select("g_key", (F.col("g_key") != F.col("kept")).alias("gone"), "n").where("gone OR n > 1"), "near-decided")
    alone = docs.join(keys, key == F.col("g_key"), "left_anti")
    equal = docs.select(key.alias("key"), F.struct(*docs.columns).alias("row")).join(keys.where("NOT gone"), F.col("key") == F.col("g_key"))
    return alone.unionByName(equal.groupBy("key").agg(F.min("row").alias("row")).select("row.*"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeat_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and the digests of ids and of the bytes that they decode to."""
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.digests(bpe.decode(bpe.encode(docs, path, pattern), path, pattern), "ids")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
