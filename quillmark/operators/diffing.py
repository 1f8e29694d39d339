"""Comparison of originals, issues and renditions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.functions.text import WS
from quillmark.sources.sinks import kept


def paragraphs(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pos from 1, paragraph): one line is one paragraph, empty ones included; null texts have none."""
    return docs.select(key, F.posexplode(F.split(text, "\n", -1)).alias("_p", "paragraph")).select(key, (F.col("_p") + 1).alias("pos"), "paragraph")


def missing_paragraphs(originals: DataFrame, issue: DataFrame, key: str, clean: Column) -> DataFrame:
    """(key, paragraph, missing): how many times more the cleaned paragraph stands in the originals than in the issue, where more."""
    counted = lambda df, sign: df.select(key, clean.alias("paragraph"), F.lit(sign).alias("n")).where("paragraph <> ''")
    both = counted(originals, 1).union(counted(issue, -1))
    return both.groupBy(key, "paragraph").agg(F.sum("n").alias("missing")).where("missing > 0")


def omissions(originals: DataFrame, issue: DataFrame, key: str, clean: Column, on_purpose: Column) -> DataFrame:
    """(key, paragraph, missing, verdict): what the originals have and the issue lacks, as missing_paragraphs has it; removed if on_purpose says so of the paragraph as it stood, else omitted."""
    counted = lambda df, sign, gone: df.select(key, clean.alias("paragraph"), F.lit(sign).alias("n"), gone.alias("gone")).where("paragraph <> ''")
    both = counted(originals, 1, F.coalesce(on_purpose, F.lit(False))).union(counted(issue, -1, F.lit(False)))
    return _omitted(both, key)


def omissions_by_mark(originals: DataFrame, key: str, clean: Column, on_purpose: Column, in_issue: Column) -> DataFrame:
    """omissions of originals and those of their rows for which in_issue holds, from one reading: rows that the issue has and that weren't to be removed add nothing, so neither are they cleaned nor moved."""
    gone, missing = F.coalesce(on_purpose, F.lit(False)), F.when(in_issue, 0).otherwise(1)
    rows = originals.where(gone | (missing > 0)).select(key, clean.alias("paragraph"), missing.alias("n"), gone.alias("gone")).where("paragraph <> ''")
    return _omitted(rows, key)


def _omitted(rows: DataFrame, key: str) -> DataFrame:
    lost = rows.groupBy(key, "paragraph").agg(F.sum("n").alias("missing"), F.max("gone").alias("gone")).where("missing > 0")
    return lost.select(key, "paragraph", "missing", F.when(F.col("gone"), F.lit("removed")).otherwise(F.lit("omitted")).alias("verdict"))


def consistent(issues: DataFrame) -> DataFrame:
    """(consistent): whether there is not one issue."""
    return issues.agg((F.count("*") == 0).alias("consistent"))


def differences(one: DataFrame, two: DataFrame) -> DataFrame:
    """Rows of one beyond those of two and the other way, as bags, with side."""
    return one.exceptAll(two).withColumn("side", F.lit("only first")).union(two.exceptAll(one).withColumn("side", F.lit("only second")))


def page_mismatches(physical: DataFrame, toc: DataFrame, footer: DataFrame, front: int, key: str = "article") -> DataFrame:
    """Articles for which physical page less front matter, contents page and footer page don't agree; a missing one doesn't."""
    pages = physical.select(key, (F.col("page") - front).alias("body_page")).join(toc.select(key, F.col("page").alias("toc_page")), key, "full").join(footer.select(key, F.col("page").alias("footer_page")), key, "full")
    same = F.col("body_page").eqNullSafe(F.col("toc_page")) & F.col("toc_page").eqNullSafe(F.col("footer_page"))
    return pages.where(~same)


def page_totals(physical: DataFrame, toc: DataFrame, footer: DataFrame, front: int) -> DataFrame:
    """One row: n_articles, last_page and page_sum of each of the three numberings (physical ones less front matter), and agree: whether all three have the same."""
    one = lambda df, kind, off: df.agg(F.lit(kind).alias("kind"), F.count("page").alias("n"), F.max(F.col("page") - off).alias("last"), F.sum(F.col("page") - off).alias("sum"))
    kinds = {"physical": (physical, front), "toc": (toc, 0), "footer": (footer, 0)}
    rows = None
    for kind, (df, off) in kinds.items():
        rows = one(df, kind, off) if rows is None else rows.union(one(df, kind, off))
    of = lambda kind, c: F.max(F.when(F.col("kind") == kind, F.col(c)))
    wide = rows.agg(*[of(kind, c).alias(f"{kind}_{c}") for kind in kinds for c in ("n", "last", "sum")])
    same = F.lit(True)
    for c in ("n", "last", "sum"):
        same = same & F.col(f"physical_{c}").eqNullSafe(F.col(f"toc_{c}")) & F.col(f"toc_{c}").eqNullSafe(F.col(f"footer_{c}"))
    return wide.withColumn("agree", same)


def footer_number(text: Column) -> Column:
    """The number between dashes on a page (int; null without one)."""
    return F.nullif(F.regexp_extract(text, rf"—{WS}*(\p{{Nd}}+){WS}*—", 1), F.lit("")).try_cast("int")


def backfilled_contents(headings: DataFrame, pages: DataFrame, doc: str = "doc_id", page: str = "page_no") -> DataFrame:
    """headings with printed: the number in the footer of their page, not the page's place."""
    printed = pages.select(doc, page, footer_number(F.col("text")).alias("printed"))
    return headings.join(printed, [doc, page], "left")


def until_stable(state: DataFrame, step, most: int = 10) -> tuple[DataFrame, int]:
    """state after step has been applied until it no longer changes a row, and the number of times; an error beyond most. Each round is a table, so that none is worked out again."""
    state = kept(state, "state")
    for n in range(1, most + 1):
        new = kept(step(state), "state")
        if new.exceptAll(state).isEmpty() and state.exceptAll(new).isEmpty():
            return new, n
        state = new
    raise RuntimeError(f"not stable after {most} steps")


def settled(state: DataFrame, step, key: str, most: int = 50) -> DataFrame:
    """state, and round: the number of times that step was applied to the rows of each key until it changed none of them; null for those that still change after most.

    step takes and gives rows of whole keys, with the columns of state; keys don't depend on each other. Only keys of which a row changed go on to the next round, each round is a table, and keys that have settled are never touched again. Null keys are left out.
    """
    going = kept(state.where(F.col(key).isNotNull()), "state")
    done = None
    for n in range(1, most + 1):
        new = kept(step(going).select(*state.columns), "state")
        rows = lambda df, sign: df.select(*state.columns, F.lit(sign).alias("_sign"))
        changed = rows(new, 1).union(rows(going, -1)).groupBy(*state.columns).agg(F.sum("_sign").alias("_n")).where("_n <> 0")
        changed = kept(changed.select(F.col(key).alias("_key")).distinct(), "changed")
        same = new.join(changed, F.col(key) == F.col("_key"), "left_anti").withColumn("round", F.lit(n))
        done = same if done is None else done.union(same)
        going = kept(new.join(changed, F.col(key) == F.col("_key"), "left_semi"), "state")
        if going.isEmpty():
            return done
    return done.union(going.withColumn("round", F.lit(None).cast("int")))


def paginated(entries: DataFrame, doc: str = "doc_id", ord_: str = "ord", line_chars: int = 30, page_lines: int = 20, most: int = 50) -> DataFrame:
    """(doc, ord, title_chars, n_pages, front, page, round): on which page each entry (doc, ord, title_chars, n_pages) begins, when the contents in front take as many pages as they need with these numbers.

    A contents line has the title, two characters' space and the number; what passes line_chars goes on in another line, page_lines make a page. The pages of the contents move all articles, whose numbers may then need another line: so it goes round until
    nothing moves (settled).
    """
    start = entries.select(doc, ord_, "title_chars", "n_pages", F.lit(0).cast("long").alias("front"), F.lit(0).cast("long").alias("page"))

    def step(now: DataFrame) -> DataFrame:
        before = Window.partitionBy(doc).orderBy(ord_).rowsBetween(Window.unboundedPreceding, -1)
        page = F.col("front") + 1 + F.coalesce(F.sum("n_pages").over(before), F.lit(0))
        placed = now.withColumn("page", page)
        lines = F.ceil((F.col("title_chars") + 2 + F.length(F.col("page").cast("string"))) / line_chars)
        return placed.withColumn("front", F.ceil(F.sum(lines).over(Window.partitionBy(doc)) / page_lines).cast("long"))

    return settled(start, step, doc, most)
