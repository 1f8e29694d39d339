"""Catalogs: preconditions, headings, summaries, artefacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.functions.text import first_group, int_or_zero

#: The catalog's line with the total; what pending bodies begin with; fields that a period needs; what a placeholder holds.
TOTAL_LINE = r"- 条目总数：(\d+)"
PENDING = "待补"
REQUIRED = ("window_from", "window_to", "collect_date", "title_range", "issue_label")
PLACEHOLDER = "(?i)X|N"


def catalog_total(text: Column) -> Column:
    """The total that a catalog's text states; 0 without one."""
    return int_or_zero(first_group(text, TOTAL_LINE))


def preconditions(selection: DataFrame, catalog: DataFrame, status: str = "body_source", text: str = "text") -> DataFrame:
    """One row: n_selected, n_catalog, n_pending; stop (the counts differ, or either is missing) and warn (bodies are pending)."""
    chosen = selection.agg(F.count("*").alias("n_selected"), F.count_if(F.col(status).startswith(PENDING)).alias("n_pending"))
    stated = catalog.agg(F.max(catalog_total(F.col(text))).alias("n_catalog"))
    both = chosen.crossJoin(stated)  # one row each
    stop = F.coalesce((F.col("n_selected") != F.col("n_catalog")) | (F.col("n_selected") == 0), F.lit(True))
    return both.select("n_selected", "n_catalog", "n_pending", stop.alias("stop"), (F.col("n_pending") > 0).alias("warn"))


def period_warnings(periods: DataFrame, key: str, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """(key, field, value): required fields that are missing, empty, or look like a placeholder."""
    fields = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in required])).alias("f")
    value = F.col("value")
    return periods.select(key, fields).select(key, "f.*").where(value.isNull() | (value == "") | F.regexp_like(value, F.lit(PLACEHOLDER)))


def files_by_board(files: DataFrame, boards: tuple[str, ...], board: str = "board") -> DataFrame:
    """(board, n_files) for boards that have files."""
    return files.where(F.col(board).isin(*boards)).groupBy(board).agg(F.count("*").alias("n_files"))


#: The lines of a catalog's head and of the closing summary.
RANGE_LINE, COUNT_LINE, TIME_LINE = "- 采集范围：%s—%s", "- 条目总数：%d", "- 生成时间：%s"
TOTAL_SAID, FILES_SAID = "[汇总] 目录条数 %s", "[汇总] %s 原文归档 %d 份"


def heading(items: DataFrame, first: Column, last: Column) -> DataFrame:
    """The lines of a catalog's head but the time: range and total."""
    return items.agg(F.count("*").alias("n")).select(F.explode(F.array(F.format_string(RANGE_LINE, first, last), F.format_string(COUNT_LINE, F.col("n")))).alias("line"))


def full_heading(items: DataFrame, first: Column, last: Column, made: Column) -> DataFrame:
    """(ord, line): the three lines of a catalog's head: range, total, time of making (a timestamp)."""
    lines = F.array(F.format_string(RANGE_LINE, first, last), F.format_string(COUNT_LINE, F.col("n")), F.format_string(TIME_LINE, F.date_format(made, "yyyy-MM-dd HH:mm:ss")))
    return items.agg(F.count("*").alias("n")).select(F.posexplode(lines).alias("pos", "line")).select((F.col("pos") + 1).alias("ord"), "line")


def summary(catalog: DataFrame, files: DataFrame, boards: tuple[str, ...], text: str = "text", board: str = "board") -> DataFrame:
    """(ord, line): the total that the catalog states, then the files of each board that has some, in the order of boards."""
    place = F.array_position(F.array(*map(F.lit, boards)), F.col(board))
    total = catalog.agg(F.max(first_group(F.col(text), TOTAL_LINE)).alias("t")).select(F.lit(0).cast("long").alias("ord"), F.format_string(TOTAL_SAID, "t").alias("line"))
    return total.union(files_by_board(files, boards, board).select(place.cast("long"), F.format_string(FILES_SAID, board, "n_files")))


def last_by_name(paths: DataFrame, group: str, path: str = "path") -> DataFrame:
    """(group, path): the last path of each group in the order of names; empty for a group without paths."""
    return paths.groupBy(group).agg(F.coalesce(F.max(path), F.lit("")).alias(path))


def latest(artefacts: DataFrame, group: str, path: str = "path", time: str = "mtime") -> DataFrame:
    """(group, path): the newest artefact of each group; of equally new ones, the last path."""
    return artefacts.groupBy(group).agg(F.max_by(path, F.struct(time, path)).alias(path))


def first_ok(candidates: DataFrame, group: str, value: str = "name", ok: str = "ok", pos: str = "pos") -> DataFrame:
    """(group, value): the first candidate that is ok, else the first; of equal places, the least value."""
    return candidates.groupBy(group).agg(F.coalesce(F.min_by(value, F.when(F.col(ok), F.struct(pos, value))), F.min_by(value, F.struct(pos, value))).alias(value))


def ordered_distinct(values: Column) -> Column:
    """Values that aren't empty, once each without regard to case, where they first stand.

    Two sorts, by lower-cased value and back by place, so that long arrays cost little more than short ones.
    """
    kept = F.filter(values, lambda x: x.isNotNull() & (x != ""))
    keyed = F.array_sort(F.transform(kept, lambda x, i: F.struct(F.lower(x).alias("low"), i.alias("at"), x.alias("value"))))
    # within transform, the sorted array is a variable: it isn't made anew for each element
    firsts = F.transform(F.array(keyed), lambda s: F.filter(s, lambda x, i: (i == 0) | (x["low"] != F.get(s, i - 1)["low"])))[0]
    return F.transform(F.array_sort(F.transform(firsts, lambda x: F.struct(x["at"].alias("at"), x["value"].alias("value")))), lambda x: x["value"])


def missing_fonts(required: DataFrame, available: DataFrame, font: str = "font") -> DataFrame:
    """Required fonts that aren't available: to warn of, never to replace."""
    return required.select(font).distinct().join(available.select(font), font, "left_anti")
