"""Editorial operators against plain Python and small fixtures."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quillmark.functions import text as X
from quillmark.operators import catalog, diffing, layout, selecting
from quillmark.plans import steps
from quillmark.sources import readers, sinks

BOARDS = layout.BOARDS


def plain_blank(text):
    t = re.sub(r"—\d+—", "", re.sub(r"\s+", "", text or ""))
    for b in BOARDS:
        if t.startswith(b):
            return t[len(b) :] == ""
    return t == ""


def test_text_functions_equal_python(spark):
    r = random.Random(1)
    parts = [" ", "\n", "\t", "　", "\xa0", " ", "\x1c", "—", "1", "12", "３", "来源：", "来", "源：", *BOARDS, "文", "aa"]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 9)))) for i in range(1500)] + [(9999, None)]
    df = spark.createDataFrame(rows, "i int, t string")
    out = df.select("i", X.remove_space(F.col("t")).alias("s"), X.is_blank_page(F.col("t"), BOARDS).alias("b"), X.count_literal(F.col("t"), "来源：").alias("n"), X.count_literal(F.col("t"), "aa").alias("a"))
    for (i, t), x in zip(rows, sorted(out.collect(), key=lambda x: x["i"]), strict=True):
        assert x["i"] == i and x["b"] == plain_blank(t) and (x["n"], x["a"]) == ((t or "").count("来源："), (t or "").count("aa"))
        assert x["s"] == (None if t is None else re.sub(r"\s+", "", t))


def test_small_scalars(spark):
    row = spark.range(1).select(
        X.first_group(F.lit("# t\r\n- 条目总数：12\r\n- 条目总数：34"), catalog.TOTAL_LINE).alias("a"), X.int_or_zero(F.lit("")).alias("b"), X.int_or_zero(F.lit("x")).alias("c"), X.falsy(F.lit(""), F.lit("d")).alias("d"), X.parse_flag(F.lit(None).cast("string")).alias("e"),
        X.with_suffix(F.lit("a/b.c/d.docx"), "_x").alias("f"), X.with_suffix(F.lit("a/d"), "_x").alias("g"), X.file_stem(F.lit("a\\b.tar.gz")).alias("h"), X.parent_path(F.lit("a/b/c")).alias("i"), X.with_extension(F.lit("a.b/c"), ".pdf").alias("j"),
        *[X.round_half_even(F.lit(v)).alias(f"r{i}") for i, v in enumerate((79.5, 80.5, 2.5, -0.5))],
    ).first()
    assert tuple(row) == ("12", 0, 0, "d", False, "a/b.c/d_x.docx", "a/d_x", "b.tar", "a/b", "a.b/c.pdf", 80, 80, 2, 0)


def test_normaliser_changes_nothing_the_second_time(spark):
    r = random.Random(2)
    parts = ["汉", "字", "A", "9", " ", "  ", "\xa0", " ", "，", ",", ":", "“", "”", "。", "\t", "—"]
    df = spark.createDataFrame([("".join(r.choice(parts) for _ in range(12)),) for _ in range(1500)], "t string").select(X.cjk_normalise(F.col("t")).alias("t"))
    assert df.where(X.cjk_normalise(F.col("t")) != F.col("t")).collect() == []


PAGES = [(1, 1, "测绘月刊封面"), (1, 2, "目录甲1乙2"), (1, 3, "政策法规\n甲文\n来源：某厅\n— 1 —"), (1, 4, "技术应用类\n乙文 来"), (1, 5, "源：某局 科技前沿类"), (1, 6, "政策法规\n—2—")]


def issue(spark, rows, chars=(), lines=()):
    return spark.createDataFrame([(*r, list(chars), [(x,) for x in lines]) for r in rows], f"doc_id int, page_no int, text string, chars {readers.GLYPHS}, lines {readers.LINES}")


@pytest.mark.parametrize(("expected", "rows", "passed"), [(0, 7, None), (2, 8, True), (3, 8, False)])
def test_layout_of_an_issue(spark, expected, rows, passed):
    glyphs = [("测绘地理信息", 36.0, 100.0), ("小", 30.0, 10.0), ("月刊", 36.0, 120.0), ("空", None, 79.9)]
    checks = layout.layout_checks(issue(spark, PAGES, glyphs, (94.94, 95.0)), layout.LayoutRules(expected_items=expected)).collect()
    by = {c["name"]: c for c in checks}
    assert len(checks) == rows and by["三栏目齐全"]["passed"] and by["封面红字刊名"]["detail"] == "测绘地理信息月刊" and by["正文页眉就位"]["detail"] == "栏名 top=10｜线 [94.9]"
    assert by["无空白页"]["detail"] == "空白页 [6]" and not by["无空白页"]["passed"] and by.get("条数符合预期", {"passed": None})["passed"] is passed


def test_no_page_and_no_check(spark):
    empty = layout.layout_checks(issue(spark, []))
    assert empty.count() == 0
    assert layout.verdicts(empty).collect()[0]["passed"] is True and sinks.exit_status(layout.verdicts(empty)) == 0


STEPS = [(1, "a", None, None), (2, "b", True, None), (3, "c", None, True), (4, "d", None, None)]


@pytest.mark.parametrize(("options", "runs"), [({}, "abd"), ({"start": "b", "skip_weekly": True}, "d"), ({"start": "c", "leader": True}, "cd"), ({"only": ["a,d"], "start": "b"}, ""), ({"start": "zz"}, ""), ({"only": ["d", "a"]}, "ad")])
def test_planned_steps(spark, options, runs):
    s = spark.createDataFrame(STEPS, "pos int, id string, weekly boolean, needs_leader boolean")
    assert "".join(r["id"] for r in sorted(steps.planned(s, **options).collect())) == runs


def test_random_runs_stop_at_the_first_failure(spark):
    r = random.Random(3)
    rows = [(run, pos, r.choice([0, 0, 0, 1, -5])) for run in range(60) for pos in range(r.randint(1, 9))]
    got = {(x["run"], x["pos"]) for x in steps.executed(spark.createDataFrame(rows, "run int, pos int, exit_code int"), "run").collect()}
    want = set()
    for run, pos, _ in rows:
        if all(c == 0 for a, p, c in rows if a == run and p < pos):
            want.add((run, pos))
    assert got == want


def test_order_quota_and_skeleton(spark):
    rows = [("a", "P", 1, 2, "2026-03-01"), ("b", "P", 1, 1, "2026-02-01"), ("c", "P", 2, 1, "2026-03-05"), ("d", "P", 1, 1, "2026-03-02"), ("e", "T", 3, 1, "2026-01-01"), ("f", "T", 1, 9, None)]
    items = spark.createDataFrame(rows, "id string, board string, level int, centrality int, pub_date string")
    ranked = selecting.ranked(items, "id")
    assert [r["id"] for r in ranked.orderBy("board", "rank").collect()] == list("dbacfe")
    assert {r["id"] for r in selecting.within_quota(items, {"P": 3, "T": 1}, "id").collect()} == set("dbaf")
    place = spark.createDataFrame([("d", 1), ("c", 2), ("a", 3)], "id string, place int")
    out = selecting.inserted(ranked.join(place, "id"), ranked.where("id = 'b'"))
    assert [r["id"] for r in out.orderBy("position").collect()] == ["d", "b", "c", "a"]


def test_sources_are_judged_by_link(spark):
    items = spark.createDataFrame([(1, "https://News.Unit.gov.example/x", "site"), (2, "https://unit.gov.example.evil.example/x", "site"), (3, "https://mp.example/s?a=1&__biz=KEY", "site"), (4, "no link", "site"), (5, "https://unit.gov.example/", "weekly"), (6, None, None)], "id int, url string, origin string")
    known = spark.createDataFrame([("u", "unit.gov.example", None), ("u", None, "KEY")], "unit string, host string, account string")
    assert sorted(r["id"] for r in selecting.from_known_sources(items, known, "id").collect()) == [1, 3]
    assert sorted(r["id"] for r in selecting.from_unknown_sources(items, known, "id").collect()) == [2, 4, 6]


def test_missing_paragraphs_count_each_time(spark):
    one = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y")], "d int, paragraph string")
    two = spark.createDataFrame([(1, "x"), (1, "z")], "d int, paragraph string")
    assert sorted(map(tuple, diffing.missing_paragraphs(one, two, "d", F.col("paragraph")).collect())) == [(1, "x", 1), (1, "y", 1)]


def test_page_numbers(spark):
    make = lambda rows: spark.createDataFrame(rows, "article int, page int")
    out = diffing.page_mismatches(make([(1, 4), (2, 6), (3, 9)]), make([(1, 1), (2, 3), (3, 5)]), make([(1, 1), (2, 3)]), 3)
    assert [tuple(r) for r in out.collect()] == [(3, 6, 5, None)]


def test_preconditions(spark):
    make = lambda t: spark.createDataFrame([(t,)], "text string")
    chosen = spark.createDataFrame([("待补:x",), (None,)], "body_source string")
    cases = {"# t\r\n- 条目总数：2\r\n": False, "- 条目总数：12\n- 条目总数：2": True, "none": True}
    for text, stop in cases.items():
        row = catalog.preconditions(chosen, make(text)).first()
        assert row["stop"] is stop and row["n_pending"] == 1 and row["warn"]
    assert catalog.preconditions(chosen.limit(0), make("- 条目总数：0")).first()["stop"]


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "s.json").write_text('[{"正文来源": "待补:x"}, {}]', encoding="utf-8")
    assert sorted(map(tuple, readers.selection(spark, str(tmp_path / "s.json")).collect()), key=repr) == [("待补:x",), (None,)]
    (tmp_path / "p.json").write_text('{"window_from": "2031-02-01", "draft_target": 35}', encoding="utf-8")
    period = readers.periods(spark, str(tmp_path / "p.json"))
    assert period.first()["draft_target"] == 35 and {r["field"] for r in catalog.period_warnings(period.withColumn("k", F.lit(1)), "k").collect()} == {"window_to", "collect_date", "title_range", "issue_label"}
    (tmp_path / "a.md").write_text("一\n二", encoding="utf-8")
    assert readers.whole_texts(spark, str(tmp_path / "a.md")).first()["text"] == "一\n二"
    assert readers.listing(spark, str(tmp_path), "*.json").count() == 2
    place = sinks.write_issue(period, str(tmp_path / "issue"))
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.write_issue(period, place)
    assert sinks.write_issue(period, place, str(tmp_path / "trial")) == sinks.write_issue(period, place, str(tmp_path / "trial"))
    sinks.append_log(spark.createDataFrame([("one",)], "value string"), str(tmp_path / "log"))
    sinks.append_log(spark.createDataFrame([("two",)], "value string"), str(tmp_path / "log"))
    assert spark.read.text(str(tmp_path / "log")).count() == 2
    sinks.write_archive(spark.createDataFrame([(1, BOARDS[0]), (2, BOARDS[1])], "id int, board string"), str(tmp_path / "archive"))
    assert sorted(p.name for p in (tmp_path / "archive").glob("board=*"))


def test_until_stable(spark):
    out, n = diffing.until_stable(spark.createDataFrame([(7,)], "n int"), lambda s: s.withColumn("n", F.least(F.col("n") + 1, F.lit(9))))
    assert out.first()["n"] == 9 and n == 3
    with pytest.raises(RuntimeError):
        diffing.until_stable(spark.createDataFrame([(7,)], "n int"), lambda s: s.withColumn("n", F.col("n") + 1), most=2)


def test_normaliser_does_not_repeat_its_passes(spark):
    """Marks behind marks lose their spaces too."""
    lines = ["甲 ， ， 乙", "甲,乙;丙", "甲 ,乙", "  ， x", "第三条 甲 ， 乙,丙", "a ( b,c )"]
    df = spark.createDataFrame([(x,) for x in lines], "t string").select(X.cjk_normalise(F.col("t")).alias("t"))
    assert [x["t"] for x in df.collect()] == ["甲，，乙", "甲，乙；丙", "甲 ,乙", "，x", "第三条 甲，乙，丙", "a ( b,c )"]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "startswith" in plan.lower()  # so most lines don't meet the patterns of headings and articles
