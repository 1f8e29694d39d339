"""The corpus pipeline: documents that are good, one of each group of near copies, clean of benchmarks, mixed by source, in shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.llm import contamination, mixing, quality, sharding, similarity
from quillmark.llm.common import dropped, written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; so do null and empty texts. Repeated rows are judged alike; an empty docs stays empty."""
    return quality.good_documents(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that a chain of links joins (0.8 of 5-word shingles), the one with the smallest doc_id stays; rows without key or words all stay."""
    return similarity.one_of_each(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with one word in 20 or more inside benchmark windows go; from the others, spans of 13 such words or more are cut out, and n_chars follows.

    Null and empty texts stay; so do all documents if the benchmark is empty. Repeated rows are judged alike, and an empty docs stays empty.
    """
    out = contamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), longest=13)
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, each up to 3 times, so that each source comes near its target, in order of virtual finish time. A null source is a source; texts without words stay once; ties go by doc_id; repeated rows are as many documents; an empty docs stays empty."""
    return mixing.mix_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows and columns of documents with shard and slot, and what shard_records adds besides; null keys share the empty key's shard, repeated rows are numbered one after the other, and an empty docs stays empty."""
    return sharding.shard_records(docs)


STAGES = [("quality", keep_good), ("near_copies", keep_one_of_each), ("contamination", keep_clean), ("mix", mix), ("shard", shard)]

#: SQL can't express the trained classifier of the first stage; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet in the shared folder and read again; a stage's table goes when the next one's is there."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            dropped(spark, before)
        before = docs
    return docs
