"""Running totals over a whole order without a task that holds it: ranges, a total for each, offsets added back; and points looked up in intervals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.sources.sinks import kept


def running_totals(df: DataFrame, by: Sequence[str], order: Sequence[Column], totals: Mapping[str, Column], ranges: int | None = None) -> DataFrame:
    """Adds for each name of totals the sum of its column over the rows of the same group (by; null is a group) before this one in order (long).

    Rows are dealt out by ranges of by and order (as many as the session has shuffle partitions, unless ranges says otherwise), so the ranges are about as large whatever the groups are, and written with their range's number; a total of each
    group's part of a range is summed up over the ranges, and rows are summed up within their part alone. order should end with a key: rows that it doesn't tell apart are in any order, and in one range.
    """
    spark = df.sparkSession
    numbered = df.select(*df.columns, *[c.cast("long").alias(f"_v_{n}") for n, c in totals.items()])
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = numbered.repartitionByRange(ranges, *[F.col(b).asc_nulls_last() for b in by], *order).withColumn("_range", F.spark_partition_id())
    rows = kept(dealt, "ranges")
    parts = rows.groupBy("_range", *by).agg(*[F.sum(f"_v_{n}").alias(f"_v_{n}") for n in totals])
    upto = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(F.col("_range").alias("_of"), *[F.col(b).alias(f"_by_{b}") for b in by], *[F.coalesce(F.sum(f"_v_{n}").over(upto), F.lit(0)).alias(f"_start_{n}") for n in totals])
    inside = Window.partitionBy("_range", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = rows.withColumns({f"_inside_{n}": F.coalesce(F.sum(f"_v_{n}").over(inside), F.lit(0)) for n in totals})
    at = F.col("_range") == F.col("_of")
    for b in by:
        at = at & F.col(b).eqNullSafe(F.col(f"_by_{b}"))
    return own.join(starts, at).select(*df.columns, *[(F.col(f"_start_{n}") + F.col(f"_inside_{n}")).alias(n) for n in totals])


def in_intervals(points: DataFrame, intervals: DataFrame, by: str, point: str, start: str, end: str, width: int) -> DataFrame:
    """Points joined with the intervals of the same group that hold them (start inclusive, end exclusive): all columns of both; by and the names of the columns are told apart by the caller.

    An interval is dealt out to each bucket of width that it reaches into, a point to its own, and both are joined by equality of group and bucket: no nested loop, and a group
    with very many of either is spread over its buckets. Points in no interval are left out; empty intervals hold none.
    """
    reach = F.sequence(F.expr(f"`{start}` div {width}"), F.expr(f"(`{end}` - 1) div {width}"))
    many = intervals.where(F.col(end) > F.col(start)).withColumn("_bucket", F.explode(reach))
    one = points.withColumn("_bucket", F.expr(f"`{point}` div {width}"))
    joined = one.join(many, [by, "_bucket"])
    return joined.where((F.col(point) >= F.col(start)) & (F.col(point) < F.col(end))).drop("_bucket")
