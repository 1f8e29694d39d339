"""What the operators of this subpackage share: the shared folder, prefix sums, helper columns."""

from __future__ import annotations

import math
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows that one bucket of an ordered prefix sum holds on average, and the fewest buckets of a group.
BUCKET_ROWS = 200_000
LEAST_BUCKETS = 64
#: A key with more than one in HEAVY of all rows is dealt out under SALTS numbers: there are fewer than HEAVY such keys, whatever the data.
HEAVY, SALTS = 500, 64


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir; a temporary one only where that is unset and Spark runs in one process (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is unset: on a cluster it must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="quillmark-")
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def run_dir(spark: SparkSession) -> str:
    """The folder of this application's tables in the shared folder."""
    return f"{shared_dir(spark)}/quillmark/{spark.sparkContext.applicationId}"


def new_table(spark: SparkSession, name: str) -> str:
    """A place for a table in the folder of this application."""
    return f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage, survives the loss of executors."""
    spark = df.sparkSession
    path = new_table(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_tables(spark: SparkSession) -> None:
    """Removes all tables that operators of this application have left in the shared folder: once their results are stored elsewhere, as results read them."""
    _remove(spark, run_dir(spark))


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def dropped(spark: SparkSession, *tables: DataFrame) -> None:
    """Removes tables that written() made and that nothing reads any more."""
    for table in tables:
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            _remove(spark, folder)


def heavy_keys(counts: DataFrame, key: str, n: str, total: int) -> DataFrame:
    """(key) of the keys of counts (key, n: its rows) that hold more than one in HEAVY of all rows; fewer than HEAVY rows, so they may be broadcast."""
    return counts.where(F.col(n) * HEAVY > total).select(key)


def joined_evenly(rows: DataFrame, groups: DataFrame, key: str, heavy: DataFrame, spread: Column, how: str = "inner", also: tuple[str, ...] = ()) -> DataFrame:
    """rows joined with groups on key and also (columns of both), none of which is null; heavy keys are salted, so that one that holds a third of all rows is dealt to many tasks.

    spread: a number that differs among the rows of a key; it chooses a row's salt. The few groups of heavy keys are repeated
    for each salt.
    """
    mark = F.broadcast(heavy.select(F.col(key).alias("_heavy")))
    marked = lambda df: df.join(mark, F.col(key) == F.col("_heavy"), "left")
    salted = marked(rows).withColumn("_salt", F.when(F.col("_heavy").isNotNull(), F.pmod(spread.cast("long"), F.lit(SALTS)).cast("int")).otherwise(0)).drop("_heavy")
    every = F.when(F.col("_heavy").isNotNull(), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    many = marked(groups).withColumn("_salt", F.explode(every)).drop("_heavy")
    return salted.join(many, [key, *also, "_salt"], how).drop("_salt")


def hidden(df: DataFrame) -> DataFrame:
    """df with its columns named in_0, in_1, ..., so that none clashes with what an operator adds."""
    return df.toDF(*[f"in_{i}" for i in range(len(df.columns))])


def hidden_name(df: DataFrame, column: str) -> str:
    return f"in_{df.columns.index(column)}"


def shown(out: DataFrame, df: DataFrame) -> DataFrame:
    """The columns that hidden(df) named, under their own names again."""
    return out.select(*[F.col(f"in_{i}").alias(c) for i, c in enumerate(df.columns)])


def unit_hash(*cols: Column) -> Column:
    """A number in (0, 1) from the MD5 of the columns joined by a colon (52 bits); null counts as empty."""
    joined = F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return (F.conv(F.substring(F.md5(joined.cast("binary")), 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**52))


def buckets_for(rows: int) -> int:
    return max(LEAST_BUCKETS, math.ceil(rows / BUCKET_ROWS))


def prefix_sums(df: DataFrame, group: str, position: str, order: list[str], value: str, out: str, buckets: int) -> DataFrame:
    """Adds out: the sum of value over the rows of the same group before this one, by position (uniform in (0, 1)), then order. group isn't null.

    Each group is cut into ranges of position, so that a group that holds a third of all rows is spread
    over many tasks; only one total for each range is summed up over a whole group.
    """
    bucket, total = f"{out}_bucket", f"{out}_total"
    cut = df.withColumn(bucket, F.floor(F.col(position) * buckets).cast("int"))
    before = Window.partitionBy(group, bucket).orderBy(position, *order).rowsBetween(Window.unboundedPreceding, -1)
    inside = cut.withColumn(f"{out}_inside", F.coalesce(F.sum(value).over(before), F.lit(0)))
    totals = cut.groupBy(group, bucket).agg(F.sum(value).alias(total))
    upto = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(group, bucket, F.coalesce(F.sum(total).over(upto), F.lit(0)).alias(f"{out}_start"))
    return inside.join(starts, [group, bucket]).withColumn(out, F.col(f"{out}_inside") + F.col(f"{out}_start")).drop(bucket, f"{out}_inside", f"{out}_start")
