"""Step plans: which steps run, and how far a run came."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def planned(steps: DataFrame, only: Sequence[str] = (), start: str = "", skip_weekly: bool = False, leader: bool = False) -> DataFrame:
    """Steps (pos, id, weekly, needs_leader) of one plan that run; see planned_for_each."""
    own = {"_only": F.array(*[F.lit(x) for x in only]).cast("array<string>"), "_start": F.lit(start), "_skip": F.lit(skip_weekly), "_leader": F.lit(leader)}
    return _running(steps.withColumns(own), Window.partitionBy()).select(*steps.columns)


def planned_for_each(steps: DataFrame, plans: DataFrame, plan: str) -> DataFrame:
    """Steps (plan, pos, id, weekly, needs_leader) that run by the parameters of their plan in plans (plan, only, start, skip_weekly, leader).

    only: these ids (none or null: all; commas separate ids too). start: from this id on, among those that only leaves, in the order of pos; empty or null: from the first; an unknown id runs nothing. Then weekly steps
    go if skipped, and steps that need the leader's document if there is none; null flags are false. Steps of plans without parameters don't run.
    """
    own = plans.select(F.col(plan).alias("_plan"), F.col("only").alias("_only"), F.col("start").alias("_start"), F.col("skip_weekly").alias("_skip"), F.col("leader").alias("_leader"))
    joined = steps.join(own, F.col(plan) == F.col("_plan"))
    return _running(joined, Window.partitionBy("_plan")).select(*steps.columns)


def _running(steps: DataFrame, together) -> DataFrame:
    said = lambda c: F.coalesce(c, F.lit(False))
    ids = F.filter(F.transform(F.split(F.array_join("_only", ","), ","), lambda x: F.trim(x)), lambda x: x != "")
    ids = F.coalesce(ids, F.array().cast("array<string>"))
    wanted = steps.where((F.size(ids) == 0) | F.array_contains(ids, F.col("id")))
    reached = F.max(F.col("id") == F.col("_start")).over(together.orderBy("pos"))
    from_start = wanted.withColumn("_on", (F.coalesce("_start", F.lit("")) == "") | said(reached)).where("_on")
    return from_start.where(~(said(F.col("_skip")) & said(F.col("weekly"))) & (said(F.col("_leader")) | ~said(F.col("needs_leader"))))


def resumed(steps: DataFrame, runs: DataFrame, plan: str, id_: str = "id", exit_code: str = "exit_code") -> DataFrame:
    """Steps that no run in runs (plan, id, exit_code) has ended well: what is left to do; an anti join, so that it doesn't matter how often a step was tried."""
    done = runs.where(F.col(exit_code) == 0).select(plan, id_).distinct()
    return steps.join(done, [plan, id_], "left_anti").select(*steps.columns)


def executed(runs: DataFrame, run: str, pos: str = "pos", exit_code: str = "exit_code") -> DataFrame:
    """Rows of each run up to the first that failed, itself included."""
    before = Window.partitionBy(run).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    return runs.withColumn("_failed", F.coalesce(F.max(F.col(exit_code) != 0).over(before), F.lit(False))).where(~F.col("_failed")).drop("_failed")
