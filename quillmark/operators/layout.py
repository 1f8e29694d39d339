"""Layout checks of finished issues: one aggregate for each document, all checks from its row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.functions.text import count_literal, is_blank_page, remove_space, round_one_decimal

#: Fixed values.
BOARDS = ("政策法规", "技术应用类", "科技前沿类")
RETIRED_BOARD = "媒体动态类"
SOURCE_LABEL, LINK_LABEL = "来源：", "原文链接："
TITLE = "测绘地理信息月刊"
TITLE_SIZE, HEADER_TOP, LINE_TOP = 30, 80, 95
#: Names of the checks, in their order, and what their details say. (The hint at a setting, which the fourth one's detail ends with elsewhere, is left out.)
NAMES = {
    "pages": "页数>0",
    "boards": "三栏目齐全",
    "retired": f"无“{RETIRED_BOARD}”",
    "links": "来源行＝原文链接",
    "no links": "正文不排原文链接（固定规则）",
    "items": "条数符合预期",
    "title": "封面红字刊名",
    "header": "正文页眉就位",
    "blank": "无空白页",
}


@dataclass(frozen=True)
class LayoutRules:
    """Parameters of the checks: items expected (0: not checked), whether links are printed."""

    expected_items: int = 0
    print_links: bool = False
    boards: tuple[str, ...] = BOARDS


def _list(values: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(values, lambda x: x.cast("string")), ", "), F.lit("]"))


def large_text(chars: Column) -> Column:
    """Glyphs above the title size, joined in their order; glyphs without a size don't count."""
    return F.array_join(F.transform(F.filter(chars, lambda c: F.coalesce(c["size"], F.lit(0.0)) > TITLE_SIZE), lambda c: c["text"]), "")


def document_facts(pages: DataFrame, rules: LayoutRules) -> DataFrame:
    """One row for each doc_id of pages (doc_id, page_no from 1, text, chars, lines): what the checks need.

    Pages are joined in order before anything is counted, so that a label across a page break counts once. Only glyphs of the first and the
    third page (or the last, if there are fewer) leave the scan.
    """
    early = F.col("page_no") <= 3
    facts = pages.groupBy("doc_id").agg(
        F.count("*").alias("n_pages"),
        F.array_sort(F.collect_list(F.struct("page_no", F.coalesce("text", F.lit("")).alias("text")))).alias("pages"),
        F.array_sort(F.collect_list(F.when(is_blank_page(F.col("text"), rules.boards), F.col("page_no")))).alias("blank"),
        F.max(F.when(F.col("page_no") == 1, large_text(F.col("chars")))).alias("title"),
        F.max_by(F.filter("chars", lambda c: c["top"] < HEADER_TOP), F.when(early, F.col("page_no"))).alias("header"),
        F.max_by(F.filter("lines", lambda x: x["top"] < LINE_TOP), F.when(early, F.col("page_no"))).alias("ruled"),
    )
    text = remove_space(F.array_join(F.transform("pages", lambda p: p["text"]), ""))
    return facts.withColumn("text", text).drop("pages").withColumns({"n_sources": count_literal(F.col("text"), SOURCE_LABEL), "n_links": count_literal(F.col("text"), LINK_LABEL)})


def layout_checks(pages: DataFrame, rules: LayoutRules | None = None) -> DataFrame:
    """(doc_id, ord, name, passed, detail): the checks of each document, in order; that of the items only if some are expected."""
    rules = rules or LayoutRules()
    facts = document_facts(pages, rules)
    present = F.filter(F.array(*map(F.lit, rules.boards)), lambda b: F.contains(F.col("text"), b))
    retired = F.contains(F.col("text"), F.lit(RETIRED_BOARD))
    tops = F.transform("header", lambda c: F.bround(c["top"], 0).cast("long").cast("string"))
    lines = F.transform(F.slice("ruled", 1, 2), lambda x: round_one_decimal(x["top"]))

    def row(name: str, passed: Column, detail: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), F.coalesce(passed, F.lit(False)).alias("passed"), detail.alias("detail"))

    links = (
        row(NAMES["links"], (F.col("n_sources") == F.col("n_links")) & (F.col("n_sources") > 0), F.format_string("%d / %d", "n_sources", "n_links"))
        if rules.print_links
        else row(NAMES["no links"], F.col("n_links") == 0, F.format_string("原文链接 %d 行", "n_links"))
    )
    checks = [
        row(NAMES["pages"], F.col("n_pages") > 0, F.format_string("%d 页", "n_pages")),
        row(NAMES["boards"], F.size(present) == len(rules.boards), F.array_join(present, "、")),
        row(NAMES["retired"], ~retired, F.when(retired, F.lit("仍出现")).otherwise(F.lit("0 处"))),
        links,
        *([row(NAMES["items"], F.col("n_sources") == rules.expected_items, F.format_string("期望 %d，实际 %d", F.lit(rules.expected_items), "n_sources"))] if rules.expected_items else []),
        row(NAMES["title"], F.contains(F.col("title"), F.lit(TITLE)), F.coalesce(F.nullif("title", F.lit("")), F.lit("未见大字号刊名"))),
        row(NAMES["header"], (F.size("header") > 0) & (F.size("ruled") > 0), F.concat(F.lit("栏名 top="), F.coalesce(F.try_element_at(tops, F.lit(1)), F.lit("-")), F.lit("｜线 "), F.coalesce(_list(lines), F.lit("[]")))),
        row(NAMES["blank"], F.size("blank") == 0, F.when(F.size("blank") == 0, F.lit("空白页 0 个")).otherwise(F.concat(F.lit("空白页 "), _list(F.col("blank"))))),
    ]
    listed = facts.select("doc_id", F.posexplode(F.array(*checks)).alias("pos", "c"))
    return listed.select("doc_id", (F.col("pos") + 1).alias("ord"), "c.name", "c.passed", "c.detail")


def verdicts(checks: DataFrame, *by: str) -> DataFrame:
    """(by, n_checks, n_failed, passed): without checks a document passes; without documents and by, one row that passes."""
    return checks.groupBy(*by).agg(F.count("*").alias("n_checks"), F.count_if(~F.col("passed")).alias("n_failed"), F.coalesce(F.every("passed"), F.lit(True)).alias("passed"))
