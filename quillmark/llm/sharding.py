"""Sharding by rendezvous hashing over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.llm.common import buckets_for, prefix_sums, unit_hash


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """The shard (int) with the highest score -weight / ln(u), u in (0, 1) from the MD5 of "key:shard".

    A shard's score depends on the key and on that shard alone, so one more shard takes records only into
    itself, and each shard gets a share in proportion to its weight. Ties go to the lowest shard; shards
    with no weight get nothing; a null key counts as the empty one.
    """
    scores = [F.struct((F.lit(-float(w)) / F.ln(unit_hash(key, F.lit(s)))).alias("score"), F.lit(-s).alias("s")) for s, w in enumerate(weights) if w > 0]
    if not scores:
        raise ValueError("no shard has a weight")
    best = F.array_max(F.array(*scores)) if len(scores) > 1 else scores[0]
    return (-best["s"]).cast("int")


def shard_records(df: DataFrame, key: str = "doc_id", text: str = "text", weights: Sequence[float] = (1.0,) * 24, next_weight: float = 1.0) -> DataFrame:
    """All rows and columns of df, and shard, slot, grown_shard, size, text_crc32.

    shard: by rendezvous_shard. grown_shard: the shard if one of next_weight were added.
    slot: gapless from 0 in each shard, by the hash of key, CRC-32 and size, then by these themselves.
    size: UTF-8 bytes of the text and 8; a null text has none. text_crc32: unsigned, of the UTF-8 bytes (null: of none).
    Null keys share the empty key's shard; rows of one key stay in one shard; an empty df gives no rows.
    Columns of df by the names of new ones are replaced.
    """
    new = ["size", "text_crc32", "shard", "grown_shard", "slot"]
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    # hidden columns first, so that a column of df named "size", say, can still be the key
    given = df.select(*[F.col(c).alias(f"in_{i}") for i, c in enumerate(df.columns)], F.col(key).alias("_k"), (F.octet_length(raw) + 8).cast("long").alias("_size"), F.crc32(raw).alias("_crc"))
    placed = given.withColumns({"_shard": rendezvous_shard(F.col("_k"), weights), "_one": F.lit(1), "_pos": unit_hash(F.col("_k"), F.col("_crc"), F.col("_size"))})
    grown = F.when(rendezvous_is_last(F.col("_k"), [*weights, next_weight], F.col("_shard")), F.lit(len(weights))).otherwise(F.col("_shard")).cast("int")
    placed = placed.withColumn("_grown", grown)
    numbered = prefix_sums(placed, "_shard", "_pos", ["_k", "_crc", "_size"], "_one", "_slot", buckets_for(df.count() // max(1, len(weights))))
    kept = [F.col(f"in_{i}").alias(c) for i, c in enumerate(df.columns) if c not in new]
    return numbered.select(*kept, F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), F.col("_shard").alias("shard"), F.col("_grown").alias("grown_shard"), F.col("_slot").cast("long").alias("slot"))


def rendezvous_is_last(key: Column, weights: Sequence[float], shard: Column) -> Column:
    """Whether the last of weights beats shard, the best of those before it."""
    last = len(weights) - 1
    score = lambda s, w: -w / F.ln(unit_hash(key, s))
    held = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), shard + 1)
    return F.lit(weights[last] > 0) & (score(F.lit(last), F.lit(float(weights[last]))) > score(shard, held))
