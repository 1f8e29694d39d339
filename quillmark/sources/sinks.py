"""Sinks: logs, reports, catalogs, archives."""

from __future__ import annotations

import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append_log(lines: DataFrame, path: str) -> None:
    """Adds lines (one string column) to a log."""
    lines.write.mode("append").text(path)


#: The lines of a report of checks.
CHECK_LINE, VERDICT_LINE = "  %s %s（%s）", "[%s] 版式体检：%d 项，%d 项不通过"


def report_lines(checks: DataFrame) -> DataFrame:
    """(doc_id, ord, line): a marked line for each check, then the verdict."""
    line = F.format_string(CHECK_LINE, F.when(F.col("passed"), F.lit("✓")).otherwise(F.lit("✗")), "name", "detail")
    each = checks.select("doc_id", "ord", line.alias("line"))
    failed = F.count_if(~F.col("passed"))
    verdict = F.format_string(VERDICT_LINE, F.when(failed == 0, F.lit("PASS")).otherwise(F.lit("FAIL")), F.count("*"), failed)
    return each.union(checks.groupBy("doc_id").agg((F.max("ord") + 1).alias("ord"), verdict.alias("line")))


def write_issue(df: DataFrame, path: str, trial_path: str | None = None) -> str:
    """Writes an issue: once only to its place, again and again to that of a trial. Returns the place."""
    df.write.mode("overwrite" if trial_path else "errorifexists").parquet(trial_path or path)
    return trial_path or path


def write_archive(items: DataFrame, path: str) -> None:
    """Originals by board, a folder each."""
    items.write.mode("overwrite").partitionBy("board").parquet(path)


def markdown_catalog(items: DataFrame) -> DataFrame:
    """(board, text): the list of each board, in order of rank."""
    entries = F.array_sort(F.collect_list(F.struct("rank", F.format_string("%d. %s（%s）", "rank", "title", "unit").alias("line"))))
    return items.groupBy("board").agg(entries.alias("e")).select("board", F.array_join(F.transform("e", lambda x: x["line"]), "\n").alias("text"))


class NotConfigured(SystemExit):
    """A settings file was missing and has been laid down from the template: fill it in and run again. The status is 2."""

    def __init__(self, path: str) -> None:
        super().__init__(2)
        self.path = path


def settings(path: str, template: str) -> str:
    """The place of a settings file; if there is none, a copy of the template goes there and NotConfigured is raised."""
    if not Path(path).exists():
        copy_file(template, path)
        raise NotConfigured(path)
    return path


def copy_file(source: str, target: str) -> str:
    """Copies a file on the driver; folders on the way are made."""
    Path(target).parent.mkdir(parents=True, exist_ok=True)
    shutil.copyfile(source, target)
    return target


def exit_status(verdict: DataFrame) -> int:
    """0 if all passed, else 1."""
    return 0 if verdict.where(~F.col("passed")).isEmpty() else 1


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder's place for files that are written and read again: below spark.checkpoint.dir, which all executors share; a temporary one only where that is unset and Spark runs in one process (tests)."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is unset: on a cluster it must name a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="quillmark-")
    return f"{shared.rstrip('/')}/quillmark/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """df written below the shared folder and read again: cuts the lineage, and outlives the executors that made it."""
    place = workspace(df.sparkSession, name)
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)
