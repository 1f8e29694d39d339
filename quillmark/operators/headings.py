"""Headings and labels in the text of an issue as its pages run on: where headings stand, and how often labels occur, page breaks or not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.functions.text import remove_footers, remove_prefix, remove_space
from quillmark.operators.diffing import footer_number
from quillmark.operators.ordering import in_intervals

#: Characters of a bucket of the interval join; pages that are put together at a time.
BUCKET_CHARS, BLOCK_PAGES = 4096, 256


def running_text(text: Column, boards: Sequence[str]) -> Column:
    """What of a page belongs to the text that runs on: no white space, no page number, no board's name in front; null is empty."""
    return remove_prefix(remove_footers(remove_space(F.coalesce(text, F.lit("")))), boards)


def heading_offsets(headings: DataFrame, texts: DataFrame, doc: str, ord_: str, title: str) -> DataFrame:
    """(doc, ord, title, offset) of headings in texts (doc, text): each at the first place behind the one before it, from 0; null where it doesn't occur, which holds up none of the others.

    Titles are looked up without white space; empty ones and those of documents without a text don't occur.
    """
    listed = headings.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct(F.col(ord_).alias("ord"), F.col(title).alias("title")))).alias("_headings"))
    none = F.struct(F.lit(0).alias("next"), F.array().cast("array<int>").alias("found"))

    def step(state, heading):
        clean = F.coalesce(remove_space(heading["title"]), F.lit(""))
        at = F.when(clean != "", F.position(clean, F.col("text"), state["next"] + 1))
        at = F.coalesce(at, F.lit(0))
        return F.struct(F.when(at > 0, at - 1 + F.length(clean)).otherwise(state["next"]).alias("next"), F.array_append(state["found"], F.when(at > 0, at - 1)).alias("found"))

    found = listed.join(texts, doc, "left").withColumn("_found", F.aggregate("_headings", none, step, lambda s: s["found"]))
    rows = found.select(doc, F.explode(F.arrays_zip(F.col("_headings").alias("h"), F.col("_found").alias("f"))).alias("z"))
    return rows.select(doc, F.col("z.h.ord").alias(ord_), F.col("z.h.title").alias(title), F.col("z.f").cast("long").alias("offset"))


def heading_pages(headings: DataFrame, pages: DataFrame, boards: Sequence[str], front: int = 0, doc: str = "doc_id", ord_: str = "ord", title: str = "title", page: str = "page_no", text: str = "text") -> DataFrame:
    """(doc, ord, title, page, printed): the page on which each heading begins, found in the pages' text, and the number that page prints.

    headings (doc, ord, title) are in the order of the contents; pages (doc, page, text). The first `front` pages (cover, contents) list titles, so they aren't searched. The others run on
    as one text, so a heading across a page break counts to the page on which it begins. Offsets of headings are joined with the ranges that pages take in that text, by buckets. Headings that aren't there have no page; repeated titles
    are found one behind the other.
    """
    clean = pages.where(F.col(page) > front).select(doc, F.col(page).alias("_page"), running_text(F.col(text), boards).alias("_clean"), footer_number(F.col(text)).alias("printed"))
    before = Window.partitionBy(doc).orderBy("_page").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("_clean")).over(before), F.lit(0))
    ranges = clean.select(doc, "_page", "printed", start.alias("_start"), (start + F.length("_clean")).alias("_end"))
    joined = F.array_sort(F.collect_list(F.struct("_page", "_clean")))
    texts = clean.groupBy(doc).agg(F.array_join(F.transform(joined, lambda p: p["_clean"]), "").alias("text"))
    offsets = heading_offsets(headings, texts, doc, ord_, title)
    found = in_intervals(offsets.where("offset IS NOT NULL"), ranges, doc, "offset", "_start", "_end", BUCKET_CHARS)
    placed = found.select(doc, ord_, F.col("_page").alias(page), "printed")
    return offsets.drop("offset").join(placed, [doc, ord_], "left").select(doc, ord_, title, page, "printed")


def contents_lines(found: DataFrame, doc: str = "doc_id", ord_: str = "ord", title: str = "title") -> DataFrame:
    """(doc, ord, line): the contents as printed: title, tab, the number of its page; a heading that wasn't found has none, so that it is seen."""
    return found.select(doc, ord_, F.concat(F.col(title), F.lit("\t"), F.coalesce(F.col("printed").cast("string"), F.lit("?"))).alias("line"))


def transitions(text: Column, label: str) -> Column:
    """For a piece of text, from each state (characters of label that stood at the end of what came before; fewer than all): the state behind it, and the occurrences completed.

    array<struct<to:int, n:long>>, one for each state. From state s the piece reads like itself behind the first s characters of label; occurrences are taken from the left and apart.
    """
    m = len(label)

    def after(s: int) -> Column:
        parts = F.split(F.concat(F.lit(label[:s]), text), f"\\Q{label}\\E", -1)
        rest = F.element_at(parts, -1)
        to = F.lit(0)
        for k in range(1, m):
            to = F.when(rest.endswith(F.lit(label[:k])), k).otherwise(to)
        return F.struct(to.cast("int").alias("to"), (F.size(parts) - 1).cast("long").alias("n"))

    return F.array(*[after(s) for s in range(m)])


def _composed(tables: Column, m: int) -> Column:
    """Transitions one after the other are transitions."""
    start = F.array(*[F.struct(F.lit(s).alias("to"), F.lit(0).cast("long").alias("n")) for s in range(m)])

    def step(done: Column, table: Column) -> Column:
        return F.transform(done, lambda x: F.struct(F.get(table, x["to"])["to"].alias("to"), (x["n"] + F.get(table, x["to"])["n"]).alias("n")))

    return F.aggregate(tables, start, step)


def label_counts(pages: DataFrame, labels: Sequence[str], doc: str = "doc_id", page: str = "page_no", text: str = "text") -> DataFrame:
    """(doc, label, n): occurrences of each label in a document, pages in order and without white space, over any number of page breaks (long).

    Each page becomes the transitions of the label's matching automaton, a few numbers whatever its length; these are put together by blocks of pages and then by document, in order. So a document's text is never joined in one row,
    and text isn't shuffled. Labels hold no white space; a document without any has 0; null texts are empty; pages of one number are taken in the order of their transitions.
    """
    raw = remove_space(F.coalesce(F.col(text), F.lit("")))
    out = None
    for label in labels:
        own = pages.select(doc, F.col(page).alias("_page"), raw.alias("_text")).select(doc, "_page", transitions(F.col("_text"), label).alias("_t"))
        in_order = lambda at: F.transform(F.array_sort(F.collect_list(F.struct(at, "_t"))), lambda x: x["_t"])
        blocks = own.groupBy(doc, F.floor(F.col("_page") / BLOCK_PAGES).alias("_block")).agg(in_order("_page").alias("_all"))
        blocks = blocks.select(doc, "_block", _composed(F.col("_all"), len(label)).alias("_t"))
        whole = blocks.groupBy(doc).agg(in_order("_block").alias("_all"))
        counts = whole.select(doc, F.lit(label).alias("label"), _composed(F.col("_all"), len(label))[0]["n"].alias("n"))
        out = counts if out is None else out.union(counts)
    return out
