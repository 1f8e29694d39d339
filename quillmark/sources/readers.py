"""Sources: whole texts, records, listings, landed channels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The names of a period's fields, as its file has them.
_STRINGS = ("issue_name", "issue_dir", "window_from", "window_to", "collect_date", "title_range", "issue_label", "publish_date", "editor_unit")
PERIOD = T.StructType([*[T.StructField(f, T.StringType()) for f in _STRINGS], *[T.StructField(f, T.IntegerType()) for f in ("draft_target", "final_target_low", "final_target_high")], T.StructField("leader_label", T.StringType()), T.StructField("selection_report", T.StringType())])
GLYPHS = "array<struct<text:string,size:double,top:double>>"
LINES = "array<struct<top:double>>"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): one row for each UTF-8 file."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def records(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Records of JSON files: an object, or an array of them, a file; fields that a record lacks are null."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def periods(spark: SparkSession, path: str) -> DataFrame:
    return records(spark, path, PERIOD)


#: Fixed value: the field of a selected item that says where its body comes from.
BODY_SOURCE = "正文来源"


def selection(spark: SparkSession, path: str) -> DataFrame:
    """(body_source): the chosen items; the field has a Chinese name in the files."""
    return records(spark, path, f"`{BODY_SOURCE}` string").select(F.col(f"`{BODY_SOURCE}`").alias("body_source"))


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length, mtime) of the files below path by name; contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", F.col("modificationTime").alias("mtime"))


#: A page of an extracted issue, as its file has it.
PAGE = f"doc_id long, page_no int, text string, chars {GLYPHS}, lines {LINES}"


def issue_files(spark: SparkSession, path: str, columns: tuple[str, ...] = ("doc_id", "page_no", "text", "chars", "lines")) -> DataFrame:
    """Pages of extracted issues from files of one JSON object a page: the columns asked for alone are parsed. Null texts are empty, and glyphs and lines that a page lacks are none."""
    schema = T.StructType([f for f in T._parse_datatype_string(PAGE).fields if f.name in columns])
    pages = spark.read.schema(schema).json(path)
    for name, empty in (("text", F.lit("")), ("chars", F.array().cast(GLYPHS)), ("lines", F.array().cast(LINES))):
        pages = pages.withColumn(name, F.coalesce(name, empty)) if name in columns else pages
    return pages.select(*columns)


def listed_by(files: DataFrame, *by: str) -> DataFrame:
    """(by, n_files, length, newest) of a listing: how many files, their bytes together, and the newest time; nothing for what has no file."""
    return files.groupBy(*by).agg(F.count("*").alias("n_files"), F.sum("length").alias("length"), F.max("mtime").alias("newest"))


def constant(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def union_of_channels(channels: dict[str, DataFrame]) -> DataFrame:
    """Items of all channels, with origin; columns that a channel lacks are null."""
    named = [df.withColumn("origin", F.lit(name)) for name, df in channels.items()]
    out = named[0]
    for df in named[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def searched(items: DataFrame, text: str, query: str, category: str | None = None, column: str = "category") -> DataFrame:
    """Landed items whose text holds the query, of a category if one is given."""
    out = items.where(F.contains(F.col(text), F.lit(query)))
    return out if category is None else out.where(F.col(column) == category)


def open_sources(items: DataFrame, status: str, barred: tuple[str, ...] = ("captcha", "paywall", "login")) -> DataFrame:
    """Items without those of sources that ask for more than a reader: such sources are given up, never got round."""
    return items.where(~F.coalesce(F.col(status).isin(*barred), F.lit(False)))


def connected(items: DataFrame, category: str, wanted: str, pages: int, page_rows: int, order: list[Column]) -> DataFrame:
    """What a list connector of a landed site brings in: the first pages of page_rows items each of a category, in the site's order."""
    return items.where(F.col(category) == wanted).orderBy(*order).limit(pages * page_rows)


def parameters(kind, given: dict, environment: dict[str, str], prefix: str):
    """kind (a frozen dataclass of parameters) from what is given, else from the environment (prefix and field name in capitals), else its defaults."""
    import dataclasses

    def read(field):
        raw = environment.get(prefix + field.name.upper())
        if raw is None:
            return field.default
        if isinstance(field.default, bool):
            return raw.strip().lower() in ("1", "true", "yes", "on")
        return type(field.default)(raw) if isinstance(field.default, (int, str)) else tuple(raw.split(","))

    return kind(**{f.name: given.get(f.name, read(f)) for f in dataclasses.fields(kind)})


def process_lines(spark: SparkSession, command: list[str], timeout: float = 600) -> tuple[DataFrame, int]:
    """(pos, line) of what a program prints, errors included, and its exit code; runs on the driver, for tools that aren't part of a plan."""
    import subprocess

    done = subprocess.run(command, stdout=subprocess.PIPE, stderr=subprocess.STDOUT, text=True, timeout=timeout, check=False)
    return constant(spark, list(enumerate(done.stdout.splitlines(), 1)), "pos int, line string"), done.returncode
