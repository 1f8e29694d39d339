"""Rounding by binary value, rankings with a large board, driver-side sources and sinks, the benchmark's list."""

import random
import sys
from dataclasses import dataclass

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import bench
from quillmark.functions import text as X
from quillmark.operators import selecting
from quillmark.sources import readers, sinks


def test_one_decimal_as_python_rounds(spark):
    r = random.Random(1)
    values = [0.05, 0.15, 0.25, 0.35, 2.45, 2.5, 90.25, 90.35, -0.25, -0.35, 0.0, 1e-9, 94.95, 1e6 + 0.25, *(round(r.uniform(0, 900), 2) for _ in range(3000)), *(r.uniform(-5, 5) for _ in range(500))]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = dict(df.select("i", X.round_one_decimal(F.col("v"))).collect())
    assert [got[i] for i in range(len(values))] == [round(v, 1) for v in values]


def test_ranks_of_a_board_with_half_of_all_rows(spark):
    r = random.Random(2)
    rows = [(i, "A" if i % 2 else r.choice("BCD"), r.choice([1, 2, None]), r.choice([1, 2, 3]), r.choice(["2031-01-01", "2031-01-02", None])) for i in range(2000)]
    items = spark.createDataFrame(rows, "id int, board string, level int, centrality int, pub_date string")
    key = lambda x: (x[2] is None, x[2] or 0, x[3], x[4] is None, [-ord(c) for c in x[4] or ""], x[0])
    want = {x[0]: n for b in "ABCD" for n, x in enumerate(sorted((x for x in rows if x[1] == b), key=key), 1)}
    assert {x["id"]: x["rank"] for x in selecting.ranked(items, "id").collect()} == want
    quota = {"A": 7, "C": 3}
    got = {x["id"]: x["rank"] for x in selecting.within_quota(items, quota, "id").collect()}
    assert got == {x[0]: want[x[0]] for x in rows if want[x[0]] <= quota.get(x[1], 0)}


def test_credits_of_any_length_go_and_sentences_stay(spark):
    lines = ["张" * 60 + "/摄", "图为：" + "会场" * 50, "这里说到供图单位。另有一句，李某 供图", "图为：甲。图中还有乙。", "字号：" + "大" * 40, "分享到：" + "站" * 30, "扫一扫，就可以打开。"]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, p string")
    got = {x[0]: (x[1], x[2]) for x in df.select("i", X.is_sign_off(F.col("p")), X.is_furniture(F.col("p"))).collect()}
    assert got == {0: (True, False), 1: (True, False), 2: (False, False), 3: (False, False), 4: (False, True), 5: (False, True), 6: (False, False)}


def test_settings_are_laid_down_once(tmp_path):
    template, place = tmp_path / "template.json", tmp_path / "issue" / "period.json"
    template.write_text("{}")
    with pytest.raises(sinks.NotConfigured) as stopped:
        sinks.settings(str(place), str(template))
    assert stopped.value.code == 2 and place.read_text() == "{}"
    place.write_text('{"a": 1}')
    assert sinks.settings(str(place), str(template)) == str(place) and place.read_text() == '{"a": 1}'


def test_process_lines_and_parameters(spark):
    lines, code = readers.process_lines(spark, [sys.executable, "-c", "import sys; print('one'); print('two', file=sys.stderr); sys.exit(3)"])
    assert code == 3 and {x["line"] for x in lines.collect()} == {"one", "two"}

    @dataclass(frozen=True)
    class Rules:
        items: int = 0
        links: bool = False
        label: str = "leader"

    assert readers.parameters(Rules, {"items": 4}, {"APP_LINKS": " Yes", "APP_ITEMS": "9"}, "APP_") == Rules(4, True, "leader")


def test_any_line(spark):
    df = spark.createDataFrame([(1, ["a", None, "Hits: none"]), (2, []), (3, None), (4, [None])], "i int, l array<string>")
    assert dict(df.select("i", X.any_line_matches(F.col("l"), "hits: NONE")).collect()) == {1: True, 2: False, 3: False, 4: False}


def test_benchmark_names_resolve():
    queries = __spark_entry__.queries()
    names = bench.default_names(queries)
    assert len(names) == len(set(names)) >= len(bench.HEADLINE) and all(n in queries for n in names)
    assert bench.default_names({"open_sources": 1, "op10_b": 1, "op2_a": 1}) == ["op2_a", "op10_b"]
