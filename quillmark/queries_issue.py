"""Registered queries of issues as they come out: headings on pages, paragraphs against their originals, labels over page breaks, step runs, undeclared fields."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmark.functions import text as X
from quillmark.operators import articles, diffing, headings, layout, ruling
from quillmark.operators import stories as story
from quillmark.plans import steps
from quillmark.sources import readers, sinks
from quillmark.sources.readers import table


def _headed_issue(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Conversations as issues behind a page of contents: (doc_id, ord, title) and (doc_id, page_no, text).

    Each turn is a page with an article, its title in front; the title of each third one is broken after two characters, and its rest stands on the next page (if there is one). Of issues
    whose number is 3 mod 7, the contents begin with a title that no page has.
    """
    c = table(spark, sf_dir, "conversations")
    title = F.format_string("第%d篇%s报告", F.col("turn") + 1, F.coalesce("role", F.lit("")))
    order = Window.partitionBy("conv_id").orderBy("turn")
    broken = (F.col("turn") % 3 == 1) & F.lead("turn").over(order).isNotNull()
    told = c.select("conv_id", "turn", "text", title.alias("title"), broken.alias("broken"))
    rest = F.when(F.lag("broken").over(order), F.substring(F.lag("title").over(order), 3, 1000)).otherwise(F.lit(""))
    board = F.element_at(F.array(*map(F.lit, layout.BOARDS)), (F.col("turn") % 3 + 1).cast("int"))
    whole, half = F.when(F.col("broken"), F.lit("")).otherwise(F.col("title")), F.when(F.col("broken"), F.substring("title", 1, 2)).otherwise(F.lit(""))
    text = F.concat(board, F.lit("\n"), rest, whole, F.lit(" \n"), F.coalesce("text", F.lit("")), half, F.format_string("\n— %d —", F.col("turn") + 1))
    pages = told.select(F.col("conv_id").alias("doc_id"), (F.col("turn") + 2).cast("int").alias("page_no"), text.alias("text"))
    listed = told.select(F.col("conv_id").alias("doc_id"), (F.col("turn") + 1).cast("int").alias("ord"), "title")
    absent = told.where("turn = 0 AND conv_id % 7 = 3").select(F.col("conv_id").alias("doc_id"), F.lit(0).alias("ord"), F.lit("未见之篇").alias("title"))
    listed = listed.union(absent)
    front = listed.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("ord", "title"))).alias("h")).select("doc_id", F.lit(1).alias("page_no"), F.array_join(F.transform("h", lambda h: h["title"]), "\n").alias("text"))
    return listed, front.union(pages)


def heading_pages(spark, sf_dir):
    listed, pages = _headed_issue(spark, sf_dir)
    return headings.heading_pages(listed, pages, layout.BOARDS, front=1)


def contents_printed(spark, sf_dir):
    """The lines of the contents, with the numbers that the headings' own pages print."""
    listed, pages = _headed_issue(spark, sf_dir)
    return headings.contents_lines(headings.heading_pages(listed, pages, layout.BOARDS, front=1))


def broken_labels(spark, sf_dir):
    """Labels in conversations whose turns begin or end with parts of one: over one page break, over two, and within a page."""
    kind = F.col("turn") % 5
    text = F.coalesce("text", F.lit(""))
    page = F.when(kind == 0, F.concat(text, F.lit("\n来"))).when(kind == 1, F.lit("源 ")).when(kind == 2, F.concat(F.lit(" ："), text)).when(kind == 3, F.concat(text, F.lit("来源：来源"))).otherwise(F.concat(F.lit("："), text))
    pages = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), (F.col("turn") + 1).cast("int").alias("page_no"), page.alias("text"))
    return headings.label_counts(pages, (layout.SOURCE_LABEL, "ee", "the"))


def _edited_issue(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All paragraphs of documents, numbered within their text, as originals, and an issue of them: (doc_id, pos, paragraph) each.

    By number, one in eleven each is lost, has a character changed, is cut in two, or stands at the issue's end (if three more follow it); the others have white space in front.
    """
    own = diffing.paragraphs(table(spark, sf_dir, "documents"), "doc_id", "text")
    n = F.max("pos").over(Window.partitionBy("doc_id"))
    text = F.concat(F.format_string("第%d段落原文如下：", "pos"), "paragraph")
    kind = F.pmod(F.col("doc_id") + F.col("pos"), F.lit(11))
    own = own.select("doc_id", "pos", text.alias("paragraph"), F.when((kind == 3) & (F.col("pos") + 3 > n), 4).otherwise(kind).alias("kind"))
    half = F.floor(F.length("paragraph") / 2).cast("int")
    parts = F.when(F.col("kind") == 1, F.array(F.regexp_replace("paragraph", "如下：", "如左："))).when(F.col("kind") == 2, F.array(F.expr("left(paragraph, half)"), F.expr("substring(paragraph, half + 1)")))
    made = own.where("kind <> 0").withColumn("half", half).select("doc_id", "pos", (F.col("kind") == 3).alias("late"), F.posexplode(parts.otherwise(F.array(F.concat(F.lit("　 "), "paragraph")))).alias("part", "text"))
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("late", "pos", "part"))
    return own.select("doc_id", "pos", "paragraph"), made.select("doc_id", place.alias("pos"), F.col("text").alias("paragraph"))


def paragraph_verdicts(spark, sf_dir):
    originals, issue = _edited_issue(spark, sf_dir)
    return articles.paragraph_verdicts(originals, issue, "doc_id").select("doc_id", "pos", "verdict", "issue_pos")


def omitted_spans(spark, sf_dir):
    """Words that all paragraphs of documents lack beside originals with two more behind a word by number; each fifth has another word in their place."""
    own = diffing.paragraphs(table(spark, sf_dir, "documents"), "doc_id", "text").withColumn("w", F.filter(F.split("paragraph", X.WS + "+"), lambda x: x != ""))
    at = F.pmod(F.col("doc_id") + F.col("pos"), F.size("w") + 1)
    planted = lambda *words: F.array_join(F.concat(F.slice("w", 1, at), F.array(*words), F.slice("w", at + 1, F.size("w"))), " ")
    number = F.format_string("%d-%d", "doc_id", "pos")
    original = planted(F.concat(F.lit("lost:"), number), F.concat(F.lit("gone:"), number))
    issue = F.when(F.col("pos") % 5 == 0, planted(F.concat(F.lit("new:"), number))).otherwise(F.col("paragraph"))
    pairs = own.select("doc_id", "pos", original.alias("original"), issue.alias("issue"))
    return articles.omitted_spans(pairs, ["doc_id", "pos"])


def page_totals(spark, sf_dir):
    """Totals of the three numberings of conversations as articles, whose contents miss one page in six."""
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"))
    return diffing.page_totals(c.select((F.col("n") + 3).alias("page")), c.select(F.when(F.col("conv_id") % 6 == 0, F.col("n") + 1).otherwise(F.col("n")).alias("page")), c.select(F.col("n").alias("page")), 3)


def _event_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as steps of their user's plan: views are weekly, steps of a high value need the leader's document."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("plan"), F.col("event_id").alias("pos"), F.concat_ws("-", "event_type", F.col("event_id") % 7).alias("id"), (F.col("event_type") == "view").alias("weekly"), F.when(F.col("value") > 60, True).alias("needs_leader"))


def step_plan(spark, sf_dir):
    """The steps that run, of a plan for each user, with parameters by the user's number: all; a start and no weekly ones; a leader's document; some ids alone; an unknown start."""
    s = _event_steps(spark, sf_dir)
    case = F.col("plan") % 5
    start = F.when(case == 1, F.lit("click-3")).when(case == 3, F.lit("click-5")).when(case == 4, F.lit("none")).otherwise(F.lit(""))
    only = F.when(case == 3, F.array(F.lit("click-5, view-2"), F.lit("purchase-1")))
    plans = s.select("plan").distinct().select("plan", only.alias("only"), start.alias("start"), (case == 1).alias("skip_weekly"), (case == 2).alias("leader"))
    return steps.planned_for_each(s, plans, "plan").select("plan", "pos", "id")


def step_resume(spark, sf_dir):
    """Steps of each user's run in two goes over one table of runs: the first stops at the first failure, the second does what no run has ended well."""
    place = sinks.workspace(spark, "runs")
    s = _event_steps(spark, sf_dir).withColumn("id", F.col("pos").cast("string"))
    code = F.when(F.col("needs_leader") & (F.col("pos") % 3 == 0), 1).otherwise(0)
    first = steps.executed(s.withColumn("exit_code", code), "plan").select("plan", "pos", "id", "exit_code", F.lit(1).alias("go"))
    first.write.mode("append").parquet(place)
    left = steps.resumed(s, spark.read.parquet(place), "plan")
    left.select("plan", "pos", "id", F.lit(0).alias("exit_code"), F.lit(2).alias("go")).write.mode("append").parquet(place)
    return spark.read.parquet(place)


def undeclared_fields(spark, sf_dir):
    """Fields of the properties that nobody declared: each key with the types of its values and how many events have it."""
    e = table(spark, sf_dir, "events").select("event_type", F.try_parse_json("props").alias("v")).where("v IS NOT NULL")
    fields = e.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
    return fields.groupBy("event_type", "key", F.schema_of_variant("value").alias("type")).agg(F.count("*").alias("n"), F.sum(F.try_variant_get("value", "$", "double")).alias("total"))


def _many_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four rules of each item of the benchmark: two neighbouring words as they stand, either of two others in any case, a word behind another, and a short beginning of a word; boards by number."""
    w = F.filter(F.split(F.regexp_replace("text", "[^A-Za-z]+", " "), " +"), lambda x: x != "")
    b = table(spark, sf_dir, "benchmark").select("item_id", w.alias("w")).where(F.size("w") >= 9)
    at = lambda n: F.col("w")[n - 1]
    patterns = F.array(F.concat_ws(" ", at(2), at(3)), F.concat(F.lit("(?i)"), at(4), F.lit(" x|"), at(5), F.lit(" "), at(6)), F.concat(at(7), F.lit(r"\s+(?:"), at(8), F.lit("|q)")), F.concat(F.lit(r"\b"), F.substring(at(9), 1, 2), F.lit("zz")))
    rules = b.select("item_id", F.posexplode(patterns).alias("k", "pattern"))
    board = F.element_at(F.array(*map(F.lit, layout.BOARDS)), (F.pmod(F.col("item_id") + F.col("k"), F.lit(3)) + 1).cast("int"))
    return rules.select((F.col("item_id") * 4 + F.col("k")).alias("ord"), board.alias("board"), F.concat_ws("-", F.lit("tag"), F.pmod("item_id", F.lit(17))).alias("tag"), "pattern")


def rules_met(spark, sf_dir):
    """Documents and the rules, hundreds of them, that they meet."""
    return ruling.rules_met(table(spark, sf_dir, "documents"), "text", _many_rules(spark, sf_dir), "doc_id").select("doc_id", "ord")


def classified_by_rules(spark, sf_dir):
    out = ruling.classified_by(table(spark, sf_dir, "documents"), "text", _many_rules(spark, sf_dir), "doc_id", layout.BOARDS[1])
    return out.select("doc_id", "board", F.array_join("tags", ",").alias("tags"))


def _told_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and, for each, another one that tells the same but for its last words; official sites (by number) come before accounts."""
    p = table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("html", "<[^>]*>", " ").alias("text"))
    # whole words alone are tried, and none is given back: what the SQL's pattern finds, without its trials
    again = F.regexp_replace("text", r"(?<!\w)\w++\W++\w++\W*+$", "as told elsewhere")
    told = p.select("page_id", "text", F.explode(F.array(F.lit(False), F.lit(True))).alias("again"))
    told = told.select(F.when(F.col("again"), F.col("page_id") + 1_000_000_000).otherwise(F.col("page_id")).alias("page_id"), F.when(F.col("again"), again).otherwise(F.col("text")).alias("text"))
    return told.withColumn("priority", F.pmod(F.col("page_id"), F.lit(3)))


def stories(spark, sf_dir):
    return story.with_stories(_told_pages(spark, sf_dir), "page_id", "text", percent=70).select("page_id", "story")


def story_picks(spark, sf_dir):
    return story.story_picks(_told_pages(spark, sf_dir), "page_id", "text", "priority", percent=70).select("story", "page_id", "priority")


def pagination_settled(spark, sf_dir):
    """Pages on which the articles of conversations begin behind contents that print these numbers: long titles, short lines, five lines a page."""
    c = table(spark, sf_dir, "conversations")
    entries = c.select(F.col("conv_id").alias("doc_id"), (F.col("turn") + 1).alias("ord"), (F.pmod(F.length(F.coalesce("text", F.lit(""))), F.lit(29)) + 3).alias("title_chars"), (F.pmod(F.length(F.coalesce("text", F.lit(""))), F.lit(7)) + 1).cast("long").alias("n_pages"))
    return diffing.paginated(entries, line_chars=12, page_lines=5).select("doc_id", "ord", "front", "page")


def preserved_spans(spark, sf_dir):
    """Spans that proofing leaves alone, in all paragraphs of documents, with nested and unbalanced quotations, tabs, article numbers and headings by number."""
    own = diffing.paragraphs(table(spark, sf_dir, "documents"), "doc_id", "text")
    kind, text = F.pmod(F.col("doc_id") + F.col("pos"), F.lit(7)), F.col("paragraph")
    made = F.when(kind == 0, F.concat(F.lit("甲“乙“丙”丁”"), text)).when(kind == 1, F.concat(F.lit("“甲"), text, F.lit("“乙”"))).when(kind == 2, F.concat(F.lit("甲”\t"), text)).when(kind == 3, F.concat(F.lit("第十条 “甲”"), text))
    made = made.when(kind == 4, F.concat(F.lit("第三章 "), F.regexp_replace("paragraph", "[,;:!?]", ""))).when(kind == 5, F.concat(F.lit("“甲”“乙”"), text)).otherwise(text)
    spans = F.array_join(F.transform(X.preserved_spans(made), lambda x: F.concat_ws("-", x["start"], x["end"])), ",")
    return own.select("doc_id", "pos", spans.alias("spans")).where("spans <> ''")


def issue_files(spark, sf_dir):
    """The layout checks of issues that were written as files and read again."""
    from quillmark.queries import issue_pages

    place = sinks.workspace(spark, "issues")
    issue_pages(spark, sf_dir).write.json(place)
    return layout.layout_checks(readers.issue_files(spark, place), layout.LayoutRules(expected_items=3))


def period_objects(spark, sf_dir):
    """Settings written as files of one JSON object each, and read by schema."""
    place = sinks.workspace(spark, "settings")
    b = table(spark, sf_dir, "benchmark")
    record = F.to_json(F.struct(F.col("text").alias("issue_name"), F.col("item_id").cast("int").alias("draft_target"), F.lit("2031-02-01").alias("window_from")), {"pretty": "true"})
    b.select(record.alias("value")).write.option("maxRecordsPerFile", 1).text(place)
    return readers.periods(spark, place).select("issue_name", "draft_target", "window_from", "window_to")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (heading_pages, contents_printed, broken_labels, paragraph_verdicts, omitted_spans, page_totals, step_plan, step_resume, undeclared_fields, rules_met, classified_by_rules, stories, story_picks, pagination_settled, preserved_spans, issue_files, period_objects)
    return {f.__name__: f for f in own}


#: DuckDB SQL for these queries: what each rule above makes, said directly.
SPACE = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
HEADED = """SELECT conv_id AS doc_id, (turn + 1)::INT AS ord, '第' || (turn + 1) || '篇' || coalesce(role, '') || '报告' AS title, (turn + 2)::INT AS page_no, (turn + 1)::INT AS printed FROM conversations
    UNION ALL SELECT DISTINCT conv_id, 0, '未见之篇', NULL::INT, NULL::INT FROM conversations WHERE turn = 0 AND conv_id % 7 = 3"""
PARAGRAPHS = "(SELECT doc_id, unnest(range(1, len(p) + 1))::INT AS pos, unnest(p) AS paragraph, len(p) AS n FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents))"
EVENT_STEPS = "s AS (SELECT user_id AS plan, event_id AS pos, event_type || '-' || (event_id % 7) AS id, event_type = 'view' AS weekly, coalesce(value > 60, false) AS needs, user_id % 5 AS k FROM events)"

MANY_RULES = r"""b AS (SELECT item_id, list_filter(string_split(regexp_replace(text, '[^A-Za-z]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM benchmark),
    r AS (SELECT item_id, unnest([0, 1, 2, 3]) AS k, unnest([w[2] || ' ' || w[3], '(?i)' || w[4] || ' x|' || w[5] || ' ' || w[6], w[7] || '\s+(?:' || w[8] || '|q)', '\b' || w[9][1:2] || 'zz']) AS pattern FROM b WHERE len(w) >= 9),
    rules AS (SELECT item_id * 4 + k AS ord, ['政策法规', '技术应用类', '科技前沿类'][((item_id + k) % 3 + 1)::INT] AS board, 'tag-' || (item_id % 17) AS tag, pattern FROM r),
    met AS (SELECT doc_id, ord, board, tag FROM documents, rules WHERE regexp_matches(text, pattern))"""

TOLD = r"""p AS (SELECT page_id, regexp_replace(html, '<[^>]*>', ' ', 'g') AS text FROM pages),
    told AS (SELECT * FROM p UNION ALL SELECT page_id + 1000000000, regexp_replace(text, '[A-Za-z0-9_]+[^A-Za-z0-9_]+[A-Za-z0-9_]+[^A-Za-z0-9_]*$', 'as told elsewhere') FROM p),
    words AS (SELECT page_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM told),
    gram AS (SELECT DISTINCT page_id, unnest(CASE WHEN len(w) > 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) ELSE [array_to_string(w, ' ')] END) AS g FROM words WHERE len(w) > 0),
    size AS (SELECT page_id, count(*) AS n FROM gram GROUP BY page_id),
    common AS (SELECT a.page_id AS a, b.page_id AS b, count(*) AS c FROM gram a JOIN gram b ON a.g = b.g AND a.page_id <> b.page_id GROUP BY ALL),
    link AS (SELECT a, b FROM common JOIN size x ON a = x.page_id JOIN size y ON b = y.page_id WHERE 100 * c >= 70 * (x.n + y.n - c)),
    reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
    story AS (SELECT page_id, least(page_id, coalesce((SELECT min(b) FROM reach WHERE a = page_id), page_id)) AS story FROM told)"""



def _settled(times: int = 12) -> str:
    now = "SELECT conv_id AS doc_id, turn + 1 AS ord, length(coalesce(text, '')) % 29 + 3 AS chars, length(coalesce(text, '')) % 7 + 1 AS n, 0 AS front, 0 AS page FROM conversations"
    for _ in range(times):
        placed = f"SELECT doc_id, ord, chars, n, front, front + 1 + coalesce(sum(n) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS page FROM ({now})"
        now = f"SELECT doc_id, ord, chars, n, ceil(sum(ceil((chars + 2 + length(page::BIGINT::VARCHAR)) / 12)) OVER (PARTITION BY doc_id) / 5) AS front, page FROM ({placed})"
    return f"SELECT doc_id, ord, front::BIGINT AS front, page::BIGINT AS page FROM ({now})"


ORACLES = {
    "period_objects": "SELECT text AS issue_name, item_id::INT AS draft_target, '2031-02-01' AS window_from, NULL::VARCHAR AS window_to FROM benchmark",
    "pagination_settled": _settled(),
    "preserved_spans": f"""SELECT * FROM (SELECT doc_id, pos, CASE (doc_id + pos) % 7 WHEN 0 THEN '1-8' WHEN 1 THEN (length(paragraph) + 2) || '-' || (length(paragraph) + 5) WHEN 2 THEN '2-3' WHEN 3 THEN '0-4,4-7'
        WHEN 4 THEN '0-' || (4 + length(regexp_replace(paragraph, '[,;:!?]', '', 'g'))) WHEN 5 THEN '0-3,3-6' ELSE '' END AS spans FROM {PARAGRAPHS}) WHERE spans <> ''""",
    "stories": f"WITH RECURSIVE {TOLD} SELECT page_id, story FROM story",
    "story_picks": f"WITH RECURSIVE {TOLD} SELECT story, page_id, page_id % 3 AS priority FROM story QUALIFY row_number() OVER (PARTITION BY story ORDER BY page_id % 3, page_id) = 1",
    "rules_met": f"WITH {MANY_RULES} SELECT doc_id, ord FROM met",
    "classified_by_rules": f"""WITH {MANY_RULES}, scores AS (SELECT doc_id, board, count(*) AS n FROM met GROUP BY ALL), firsts AS (SELECT board, min(ord) AS f FROM rules GROUP BY board),
        best AS (SELECT doc_id, arg_max(board, n * 1000000 - f) AS board FROM scores JOIN firsts USING (board) GROUP BY doc_id),
        tags AS (SELECT doc_id, string_agg(tag, ',' ORDER BY o) AS tags FROM (SELECT doc_id, tag, min(ord) AS o FROM met GROUP BY ALL) GROUP BY doc_id)
        SELECT documents.doc_id, coalesce(board, '技术应用类') AS board, coalesce(tags, '') AS tags FROM documents LEFT JOIN best USING (doc_id) LEFT JOIN tags USING (doc_id)""",
    "heading_pages": HEADED,
    "contents_printed": f"SELECT doc_id, ord, title || chr(9) || coalesce(printed::VARCHAR, '?') AS line FROM ({HEADED})",
    "broken_labels": rf"""WITH pages AS (SELECT conv_id AS doc_id, turn, CASE turn % 5 WHEN 0 THEN coalesce(text, '') || '来' WHEN 1 THEN '源' WHEN 2 THEN '：' || coalesce(text, '') WHEN 3 THEN coalesce(text, '') || '来源：来源' ELSE '：' || coalesce(text, '') END AS text FROM conversations),
        whole AS (SELECT doc_id, regexp_replace(string_agg(text, '' ORDER BY turn), '{SPACE}+', '', 'g') AS t FROM pages GROUP BY doc_id)
        SELECT doc_id, label, ((length(t) - length(replace(t, label, ''))) // length(label))::BIGINT AS n FROM whole, (VALUES ('来源：'), ('ee'), ('the')) AS l(label)""",
    "paragraph_verdicts": f"""WITH own AS (SELECT doc_id, pos, CASE WHEN (doc_id + pos) % 11 = 3 AND pos + 3 > n THEN 4 ELSE (doc_id + pos) % 11 END AS kind FROM {PARAGRAPHS}),
        made AS (SELECT doc_id, pos, kind, unnest(range(CASE kind WHEN 2 THEN 2 ELSE 1 END)) AS part FROM own WHERE kind <> 0),
        placed AS (SELECT doc_id, pos, part, row_number() OVER (PARTITION BY doc_id ORDER BY kind = 3, pos, part) AS issue_pos FROM made)
        SELECT own.doc_id, own.pos, CASE kind WHEN 0 THEN 'lost' WHEN 1 THEN 'edited' WHEN 2 THEN 'split' WHEN 3 THEN 'moved' ELSE 'same' END AS verdict, issue_pos::INT AS issue_pos
        FROM own LEFT JOIN placed ON own.doc_id = placed.doc_id AND own.pos = placed.pos AND part = 0""",
    "omitted_spans": f"""SELECT doc_id, pos, ((doc_id + pos) % (len(w) + 1))::INT AS start, ((doc_id + pos) % (len(w) + 1) + 2)::INT AS "end", 'lost:' || doc_id || '-' || pos || ' gone:' || doc_id || '-' || pos AS lost, pos % 5 = 0 AS replaced
        FROM (SELECT doc_id, pos, regexp_extract_all(paragraph, '[^{SPACE[1:]}+') AS w FROM {PARAGRAPHS})""",
    "page_totals": """WITH c AS (SELECT conv_id, count(*) AS n, CASE WHEN conv_id % 6 = 0 THEN 1 ELSE 0 END AS off FROM conversations GROUP BY conv_id),
        t AS (SELECT count(*) AS k, max(n) AS last, sum(n)::BIGINT AS s, max(n + off) AS toc_last, sum(n + off)::BIGINT AS toc_s FROM c)
        SELECT k AS physical_n, last AS physical_last, s AS physical_sum, k AS toc_n, toc_last, toc_s AS toc_sum, k AS footer_n, last AS footer_last, s AS footer_sum, last = toc_last AND s = toc_s AS agree FROM t""",
    "step_plan": f"""WITH {EVENT_STEPS}, wanted AS (SELECT * FROM s WHERE k <> 3 OR id IN ('click-5', 'view-2', 'purchase-1')),
        reached AS (SELECT *, coalesce(max(CASE WHEN id = CASE k WHEN 1 THEN 'click-3' WHEN 3 THEN 'click-5' WHEN 4 THEN 'none' END THEN 1 END) OVER (PARTITION BY plan ORDER BY pos), 0) = 1 OR k IN (0, 2) AS on_ FROM wanted)
        SELECT plan, pos, id FROM reached WHERE on_ AND NOT (k = 1 AND weekly) AND (k = 2 OR NOT needs)""",
    "step_resume": f"""WITH {EVENT_STEPS}, coded AS (SELECT plan, pos, pos::VARCHAR AS id, CASE WHEN needs AND pos % 3 = 0 THEN 1 ELSE 0 END AS code FROM s),
        run AS (SELECT *, coalesce(max(code) OVER (PARTITION BY plan ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM coded)
        SELECT plan, pos, id, code::INT AS exit_code, 1 AS go FROM run WHERE before = 0 UNION ALL SELECT plan, pos, id, 0, 2 FROM run WHERE before = 1 OR code = 1""",
    "undeclared_fields": """WITH f AS (SELECT event_type, unnest(json_keys(props)) AS key, props FROM events WHERE props IS NOT NULL)
        SELECT event_type, key, CASE json_type(props, '$.' || key) WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'VARCHAR' THEN 'STRING' ELSE json_type(props, '$.' || key) END AS type, count(*) AS n, sum(try_cast(json_extract_string(props, '$.' || key) AS DOUBLE)) AS total FROM f GROUP BY ALL""",
}
