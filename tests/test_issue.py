"""Issues as they come out: alignment, omissions, headings, labels, orders, steps, sign-offs; against plain versions and small fixtures."""

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillmark.functions import text as X
from quillmark.operators import articles, diffing, headings, ordering, ruling, selecting, stories
from quillmark.plans import steps

BOARDS = ("政策法规", "技术应用类", "科技前沿类")


def longest_common(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_lost_spans_leave_a_longest_common_run():
    r = random.Random(1)
    for _ in range(4000):
        a, b = ([r.choice("abcd") for _ in range(r.randint(0, 9))] for _ in range(2))
        gone = {i for s, e, _ in articles.lost_spans(a, b) for i in range(s, e)}
        kept, rest = [c for i, c in enumerate(a) if i not in gone], iter(b)
        assert len(kept) == longest_common(a, b) and all(c in rest for c in kept)
    assert articles.lost_spans("abcdef", "abef") == [(2, 4, False)] and articles.lost_spans("abcdef", "abxef") == [(2, 4, True)]
    assert articles.lost_spans("abc", "") == [(0, 3, False)] and articles.lost_spans("", "abc") == []
    long_ = [str(i) for i in range(30_000)]
    assert articles.lost_spans(long_, long_[:100] + long_[150:20_000] + ["x"] + long_[20_003:]) == [(100, 150, False), (20_000, 20_003, True)]


def chains(pairs):
    for m in range(1 << len(pairs)):
        some = sorted(pairs[i] for i in range(len(pairs)) if m >> i & 1)
        if all(x[0] < y[0] and x[1] < y[1] for x, y in zip(some, some[1:], strict=False)):
            yield some


def test_chains_are_the_heaviest():
    r = random.Random(2)
    for _ in range(300):
        pairs = [(*p, r.choice([0.5, 0.75, 1.0])) for p in {(r.randint(0, 5), r.randint(0, 5)) for _ in range(r.randint(0, 8))}]
        weight, chain = {p[:2]: p[2] for p in pairs}, articles.heaviest_chain(pairs)
        assert sum(weight[p] for p in chain) == max(sum(p[2] for p in c) for c in chains(pairs))
        assert all(a < c and b < d for (a, b), (c, d) in zip(chain, chain[1:], strict=False))


def test_similar_pairs_are_all_found():
    r = random.Random(3)
    for percent in (30, 60, 90):
        for _ in range(200):
            one, two = ({i: "".join(r.choice("abc") for _ in range(r.randint(1, 9))) for i in range(6)} for _ in range(2))
            grams = articles.grams
            want = {(i, j) for i in one for j in two if 200 * len(grams(one[i]) & grams(two[j])) >= percent * (len(grams(one[i])) + len(grams(two[j])))}
            assert {p[:2] for p in articles.similar_pairs(one, two, percent)} == want


def test_verdicts_of_an_article(spark):
    original = ["全省测绘工作会议召开。", "会议总结了上半年的工作，部署了下半年的任务。", "同一句话。", "", "会议要求，各单位抓好落实。", "同一句话。", "第一项工作已经完成并验收。", "第二项工作正在推进之中。", "这一段没有了。", "最后一段在前面。"]
    issue = ["最后一段在前面。", "全省测绘 工作会议召开。", "会议总结了上半年的工作，", "部署了下半年的任务。", "同一句话。", "会议要求，各单位要抓好落实。", "同一句话。", "第一项工作已经完成并验收。第二项工作正在推进之中。"]
    rows = lambda df, key: [(key, i, t) for i, t in enumerate(df, 1)]
    schema = "art string, pos int, paragraph string"
    one = spark.createDataFrame(rows(original, "a") + rows(["独有"], "b") + [(None, 1, "x")], schema)
    two = spark.createDataFrame(rows(issue, "a") + rows(["别处"], "c"), schema)
    got = {(x["art"], x["pos"]): (x["verdict"], x["issue_pos"]) for x in articles.paragraph_verdicts(one, two, "art").collect()}
    assert got == {
        ("a", 1): ("same", 2), ("a", 2): ("split", 3), ("a", 3): ("same", 5), ("a", 5): ("edited", 6), ("a", 6): ("same", 7),
        ("a", 7): ("merged", 8), ("a", 8): ("merged", 8), ("a", 9): ("lost", None), ("a", 10): ("moved", 1), ("b", 1): ("lost", None),
    }
    assert articles.paragraph_verdicts(one.limit(0), two.limit(0), "art").count() == 0
    judged = articles.removed_or_lost(articles.paragraph_verdicts(one, two, "art"), F.col("pos") == 9)
    assert {x["verdict"] for x in judged.collect()} == {"same", "split", "edited", "merged", "moved", "removed", "omitted"}


def test_verdicts_of_many_equal_paragraphs():
    same, n = ["甲"], 3000
    found = articles.aligned(same * n, same * (n - 5))
    assert [v for v, _, _ in found].count("same") == n - 5 and [v for v, _, _ in found].count("lost") == 5


def test_omitted_spans_of_han_text(spark):
    pairs = spark.createDataFrame([(1, "建成 GNSS 基准站网", "建成基准站网"), (2, "甲乙丙", "甲丁丙"), (3, "甲", None), (4, None, "甲"), (5, "一 二", "一二")], "k int, original string, issue string")
    assert sorted(map(tuple, articles.omitted_spans(pairs, ["k"]).collect())) == [(1, 2, 3, "GNSS", False), (2, 1, 2, "乙", True), (3, 0, 1, "甲", False)]


def test_headings_over_page_breaks(spark):
    pages = [(1, 1, "封面"), (1, 2, "目录\n甲文一\n乙文二\n乙文二\n无"), (1, 3, "政策法规\n甲 文一\n正文\n乙\n— 1 —"), (1, 4, "技术应用类\n文\n— 2 —"), (1, 5, "二\n又乙文二\n— 3 —"), (2, 3, None)]
    listed = [(1, 1, "甲文一"), (1, 2, "乙文二"), (1, 3, "乙文二"), (1, 4, "无"), (1, 5, None), (2, 1, "甲"), (3, 1, "甲")]
    out = headings.heading_pages(spark.createDataFrame(listed, "doc_id int, ord int, title string"), spark.createDataFrame(pages, "doc_id int, page_no int, text string"), BOARDS, front=2)
    got = {(x["doc_id"], x["ord"]): (x["page_no"], x["printed"]) for x in out.collect()}
    assert got == {(1, 1): (3, 1), (1, 2): (3, 1), (1, 3): (5, 3), (1, 4): (None, None), (1, 5): (None, None), (2, 1): (None, None), (3, 1): (None, None)}
    assert {x["line"] for x in headings.contents_lines(out.where("doc_id = 1 AND ord IN (3, 4)")).collect()} == {"乙文二\t3", "无\t?"}


def test_points_in_intervals(spark):
    r = random.Random(5)
    points = [(r.choice("ab"), r.randint(0, 400), i) for i in range(120)]
    spans = [(r.choice("ab"), s, s + r.randint(0, 150), i) for i, s in enumerate(r.randint(0, 400) for _ in range(60))]
    p, q = spark.createDataFrame(points, "g string, x long, i int"), spark.createDataFrame(spans, "g string, s long, e long, j int")
    got = sorted((x["i"], x["j"]) for x in ordering.in_intervals(p, q, "g", "x", "s", "e", 32).collect())
    assert got == sorted((i, j) for g, x, i in points for h, s, e, j in spans if g == h and s <= x < e)


@pytest.mark.parametrize("label", ["来源：", "aa", "aab", "x"])
def test_labels_over_any_number_of_breaks(spark, monkeypatch, label):
    r = random.Random(7)
    monkeypatch.setattr(headings, "BLOCK_PAGES", 3)
    pages = [(d, n, r.choice([None, "".join(r.choice("aab来源：x \n") for _ in range(r.randint(0, 5)))])) for d in range(30) for n in range(r.randint(1, 14))]
    got = dict(headings.label_counts(spark.createDataFrame(pages, "doc_id int, page_no int, text string"), [label]).select("doc_id", "n").collect())
    assert got == {d: "".join("".join((t or "").split()) for x, _, t in pages if x == d).count(label) for d in {p[0] for p in pages}}


def test_running_totals_equal_a_window(spark):
    r = random.Random(9)
    rows = [(i, r.choice([None, "P", "T", "T"]), r.choice([None, 1, 2]), r.choice([None, "2026-01-01", "2026-02-01"])) for i in range(700)]
    items = spark.createDataFrame(rows, "id int, board string, level int, pub_date string").withColumn("centrality", F.lit(1))
    order = [F.col("level").asc_nulls_last(), F.col("pub_date").desc_nulls_last(), F.col("id").asc()]
    out = ordering.running_totals(items, ["board"], order, {"n": F.lit(1), "s": F.col("id")}, ranges=9)
    want = {}
    for b in (None, "P", "T"):
        own = sorted((x for x in rows if x[1] == b), key=lambda x: (x[2] is None, x[2] or 0, x[3] is None, [-ord(c) for c in x[3] or ""], x[0]))
        for k, x in enumerate(own):
            want[x[0]] = (k, sum(y[0] for y in own[:k]))
    assert {x["id"]: (x["n"], x["s"]) for x in out.collect()} == want
    assert {x["id"]: x["rank"] for x in selecting.ranked(items, "id").collect()} == {i: k + 1 for i, (k, _) in want.items()}
    assert "_range" not in out.columns and ordering.running_totals(items.limit(0), ["board"], order, {"n": F.lit(1)}).count() == 0


def test_insertion_equals_its_definition(spark):
    r = random.Random(11)
    ranks = [(i, b, n) for b in "PT" for n, i in enumerate(r.sample(range(100), 40), 1)]
    ranks = [(f"{b}{i}", b, n) for i, b, n in ranks]
    fixed = {b: r.sample([x for x in ranks if x[1] == b], 15) for b in "PT"}
    skeleton = [(i, b, n, p) for b in "PT" for p, (i, b, n) in enumerate(fixed[b], 1)]
    names = {x[0] for x in skeleton}
    extras = [x for x in ranks if x[0] not in names]
    out = selecting.inserted(spark.createDataFrame(skeleton, "id string, board string, rank int, place int"), spark.createDataFrame(extras, "id string, board string, rank int"))
    for b in "PT":
        slots = [(p, 0, n, i) for i, c, n, p in skeleton if c == b] + [(sum(m <= n for _, c, m, _ in skeleton if c == b), 1, n, i) for i, c, n in extras if c == b]
        got = {x["id"]: x["position"] for x in out.collect() if x["board"] == b}
        assert got == {x[3]: k for k, x in enumerate(sorted(slots), 1)}


def test_many_plans_and_resumption(spark):
    s = spark.createDataFrame([(p, *x) for p in "uvwxyz" for x in ((1, "a", None, None), (2, "b", True, None), (3, "c", None, True), (4, "d", None, None))], "plan string, pos int, id string, weekly boolean, needs_leader boolean")
    rows = [("u", [], "", None, None), ("v", None, "b", True, False), ("w", [], "c", False, True), ("x", ["a, d"], "b", False, False), ("y", ["d", "a"], None, False, False)]
    plans = spark.createDataFrame(rows, "plan string, only array<string>, start string, skip_weekly boolean, leader boolean")
    got = {}
    for x in sorted(steps.planned_for_each(s, plans, "plan").collect()):
        got[x["plan"]] = got.get(x["plan"], "") + x["id"]
    assert got == {"u": "abd", "v": "d", "w": "cd", "y": "ad"}
    runs = spark.createDataFrame([("u", "a", 0), ("u", "b", 1), ("u", "b", 0), ("u", "c", 1), ("v", "a", 0)], "plan string, id string, exit_code int")
    assert sorted((x["plan"], x["id"]) for x in steps.resumed(s.where("plan IN ('u', 'v')"), runs, "plan").collect()) == [("u", "c"), ("u", "d"), ("v", "b"), ("v", "c"), ("v", "d")]


def test_sign_offs_stand_behind_the_end(spark):
    article = ["图为：封面", "张某/摄", "会议召开。（如图）", "结果（详见下表）", "印发《测绘成果管理办法》（试行）", "各省级单位（下同）", "提供服务（如图）", "本文高度重视（高清）", "会议闭幕。（高清）", "记者见面会结束。（刘某）", "（测绘局 王某）", " ", "李某 供图", "图为：会场"]
    rows = [(1, i, t) for i, t in enumerate(article)] + [(2, 1, "印发《办法》（试行）"), (3, 1, "（刘某）"), (3, 2, "张某/摄"), (4, 1, None), (5, 1, "（见附件）"), (6, 1, "工作完成。(测绘院)")]
    d = spark.createDataFrame(rows, "id int, pos int, paragraph string")
    got = {(x["id"], x["pos"]): x["paragraph"] for x in articles.without_sign_offs(d, "id").collect()}
    want = {(1, i): t for i, t in enumerate(article[:10])} | {(1, 9): "记者见面会结束。", (1, 11): " ", (2, 1): "印发《办法》（试行）", (4, 1): None, (5, 1): "（见附件）", (6, 1): "工作完成。"}
    assert got == want


@pytest.mark.parametrize(("line", "want"), [
    ("第三条 测绘 单位 应当 按规定 , 依法", "第三条 测绘单位应当按规定 , 依法"), ("第一章 总 则", "第一章 总 则"), ("第十二条 测绘,制图", "第十二条 测绘，制图"), ("第二章 规定,如下 所示", "第二章规定，如下所示"), ("第1234567节 附 则", "第1234567节 附 则"), ("第 三 条", "第三条"),
])
def test_headings_stay_and_articles_are_corrected(spark, line, want):
    df = spark.createDataFrame([(line,)], "t string")
    assert df.select(X.cjk_normalise(F.col("t"))).first()[0] == want


def test_mandatory_strings_are_in_every_match():
    known = {"福建|本省": {"福建", "本省"}, "(?i)Licen[sc]ed? UNDER": {" under"}, "a*": None, "(ab|cd)+x": {"ab", "cd"}, "(?:ab)?c": {"c"}, "[ab]": None, "x|": None, "(": None, "a(bc)d": {"abcd"}, r"(\d)\1é": {"é"}}
    assert {p: ruling.mandatory(p) for p in known} == known


@pytest.mark.parametrize("broadcast_bytes", [0, 16_000_000])
def test_rules_met_equal_trying_all(spark, monkeypatch, broadcast_bytes):
    r = random.Random(13)
    words = ["ab", "abc", "Ab", "é", "福建", "本省福", "x1", "测绘地理", " ", "q", "zzzzzz"]
    texts = [None, "", *("".join(r.choice(words) for _ in range(r.randint(0, 12))) for _ in range(200))]
    part = lambda: r.choice(["ab", "b.?q", "(?i)ABQ", "福建|é", "绘地", "[xq]1", "z{3}", "^q", "(ab|福)+x", "abc ", "x*"])
    patterns = [None, *sorted({part() + r.choice(["", "a", "|q1"]) for _ in range(40)} - {""})]
    patterns = [p for p in patterns if p is None or "(?i)" not in p[1:]]
    monkeypatch.setattr(ruling, "STEP_BYTES", 50)
    items, rules = spark.createDataFrame(list(enumerate(texts)), "k int, t string"), spark.createDataFrame(list(enumerate(patterns)), "ord int, pattern string")
    got = {(x["k"], x["ord"]) for x in ruling.rules_met(items, "t", rules, "k", broadcast_bytes=broadcast_bytes).collect()}
    assert got == {(i, n) for i, t in enumerate(texts) for n, p in enumerate(patterns) if t is not None and p is not None and re.search(p, t)}
    assert ruling.rules_met(items, "t", rules.limit(0), "k").count() == 0 and ruling.rules_met(items.limit(0), "t", rules, "k").count() == 0


def plain_quotations(line):
    """Spans of outermost quotations, by a stack."""
    open_, pairs = [], []
    for i, c in enumerate(line):
        if c == "“":
            open_.append(i)
        elif c == "”" and open_:
            pairs.append((open_.pop(), i + 1))
    return sorted(p for p in pairs if not any(q != p and q[0] <= p[0] and p[1] <= q[1] for q in pairs))


def test_quotations_by_a_stack(spark):
    r = random.Random(17)
    lines = ["".join(r.choice("甲乙 a“”“”\t") for _ in range(r.randint(0, 14))) for _ in range(800)] + [None, "", "“", "”“"]
    got = spark.createDataFrame(list(enumerate(lines)), "i int, t string").select("i", X.quoted_pieces(F.col("t")).alias("p"), X.preserved_spans(F.col("t")).alias("s")).collect()
    for x in got:
        line = lines[x["i"]]
        if line is None:
            assert x["p"] is None and x["s"] is None
            continue
        at, spans = 0, []
        for p in x["p"]:
            if p["quoted"]:
                spans.append((at, at + len(p["text"])))
            at += len(p["text"])
        assert "".join(p["text"] for p in x["p"]) == line and spans == plain_quotations(line)
        tabs = {(i, i + 1) for i, c in enumerate(line) if c == "\t" and not any(a <= i < b for a, b in spans)}
        assert [tuple(s) for s in x["s"]] == sorted({*spans, *tabs})


def test_pages_settle_one_issue_at_a_time(spark):
    rows = [(1, 5), (2, 95), (3, 1), (None, 2)]
    rounds = []

    def step(state):
        rounds.append(sorted(x["k"] for x in state.collect()))
        return state.withColumn("n", F.least(F.col("n") + 40, F.lit(100)))

    out = {x["k"]: (x["n"], x["round"]) for x in diffing.settled(spark.createDataFrame(rows, "k int, n int"), step, "k").collect()}
    assert out == {1: (100, 4), 2: (100, 2), 3: (100, 4)} and rounds == [[1, 2, 3], [1, 2, 3], [1, 3], [1, 3]]
    going = diffing.settled(spark.createDataFrame([(1, 0), (2, 7)], "k int, n int"), lambda s: s.withColumn("n", F.when(F.col("k") == 1, 1 - F.col("n")).otherwise(F.col("n"))), "k", most=3)
    assert {x["k"]: x["round"] for x in going.collect()} == {1: None, 2: 1}


def test_contents_that_push_their_own_numbers(spark):
    entries = [(1, i, 8, 4) for i in range(1, 31)] + [(2, 1, 3, 1)]
    got = {(x["doc_id"], x["ord"]): (x["front"], x["page"]) for x in diffing.paginated(spark.createDataFrame(entries, "doc_id int, ord int, title_chars int, n_pages long"), line_chars=12, page_lines=10).collect()}
    for doc in (1, 2):
        own, front = [e for e in entries if e[0] == doc], 0
        for _ in range(10):
            pages = [front + 1 + sum(e[3] for e in own[:i]) for i in range(len(own))]
            front = -(-sum(-(-(e[2] + 2 + len(str(p))) // 12) for e, p in zip(own, pages, strict=True)) // 10)
        assert [got[doc, e[1]] for e in own] == [(front, p) for p in pages]


def test_stories_equal_all_pairs(spark):
    r = random.Random(19)
    texts = [" ".join(f"w{r.randint(0, 60)}" for _ in range(r.randint(0, 25))) for _ in range(40)]
    for t in list(texts):
        for _ in range(2):
            words = t.split()
            for _ in range(r.randint(0, 2)):
                if words:
                    words[r.randrange(len(words))] = "new"
            texts.append(" ".join(words))
    texts += [None, "", "w1", "W1!", "w1 w2", "w2 w1"]
    sets = [{tuple(w[k : k + 3]) for k in range(len(w) - 2)} or ({tuple(w)} if w else set()) for w in (re.findall(r"\w+", (t or "").lower()) for t in texts)]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 60 * len(sets[a] | sets[b]):
                one, two = sorted((root[a], root[b]))
                root = [one if x == two else x for x in root]
    items = spark.createDataFrame(list(enumerate(texts)), "k int, t string").withColumn("priority", -F.col("k") % 5)
    got = {x["k"]: x["story"] for x in stories.with_stories(items, "k", "t").collect()}
    assert got == dict(enumerate(root))
    picks = {x["story"]: x["k"] for x in stories.story_picks(items, "k", "t", "priority").collect()}
    assert picks == {s: min((k for k in got if got[k] == s), key=lambda k: (-(k % 5), k)) for s in set(root)}
    assert stories.with_stories(items.limit(0), "k", "t").count() == 0


def _sets(r, sizes):
    """Sets of runs as stories keeps them: sorted numbers, one set behind the other."""
    rows = [np.array(sorted(r.sample(range(1 << 62), k)), np.uint64) for k in sizes]
    return rows, np.concatenate(rows), np.array(sizes)


def test_sketches_never_differ_in_more_bits_than_sets_in_runs():
    r = random.Random(5)
    rows, _, _ = _sets(r, [1, 7, 100, 140, 400, 3000])
    rows += [np.unique(np.concatenate((rows[4][:300], rows[5][:k]))) for k in (0, 60, 500)]
    n = np.array([len(x) for x in rows])
    bits, held = stories.sketches(np.concatenate(rows), n)
    ends = np.cumsum(held)
    marks = [bits[a:b] for a, b in zip(ends - held, ends, strict=True)]
    for a in range(len(rows)):
        for b in range(len(rows)):
            differ = len(set(rows[a].tolist()) ^ set(rows[b].tolist()))
            assert stories.fewest_differences(marks[a], marks[b]) <= differ
    assert 170 * stories.fewest_differences(marks[2], marks[3]) > 30 * 240  # unlike sets are told to be less than 70% similar without their runs


def test_similar_sets_share_one_of_their_rarest_runs_in_any_order():
    r = random.Random(6)
    for percent in (60, 70, 100):
        for _ in range(200):
            (one,), _, _ = _sets(r, [r.randint(1, 40)])
            two = np.unique(np.concatenate((one[r.randint(0, 9) :], _sets(r, [r.randint(1, 9)])[1])))
            common = len(np.intersect1d(one, two))
            levels = np.frombuffer(r.randbytes(1 << 10), np.uint8).repeat(1 << (stories.SLOT_BITS - 10))
            keys, most = stories.rarest(np.concatenate((one, two)), np.array([len(one), len(two)]), levels, percent)
            if 100 * common >= percent * (len(one) + len(two) - common):
                assert set(keys[: most[0]].tolist()) & set(keys[most[0] :].tolist())


def test_stories_shuffle_little_of_what_they_read(spark, tmp_path):
    """Sets are shuffled to be verified alone: unlike texts that share many runs are told apart by their sketches, and no full set moves."""
    r = random.Random(23)
    phrases = [" ".join(f"p{i}x{j}" for j in range(12)) for i in range(400)]
    texts = [(i, " ".join(r.sample(phrases, 30))) for i in range(600)]
    items = spark.createDataFrame(texts, "k int, t string")
    moved = []
    real = stories.kept

    def watched(df, name):
        out = real(df, name)
        moved.append((name, out.count()))
        return out

    stories.kept = watched
    try:
        got = stories.with_stories(items, "k", "t", percent=70).collect()
    finally:
        stories.kept = real
    assert all(x["k"] == x["story"] for x in got)
    tried = sum(n for name, n in moved if name == "pairs")
    assert tried > 0 and [n for name, n in moved if name == "wanted"] and sum(n for name, n in moved if name == "wanted") * 20 < tried


def test_issue_files_lack_what_they_lack(spark, tmp_path):
    from quillmark.sources import readers

    (tmp_path / "a.json").write_text('{"doc_id": 1, "page_no": 1, "text": "一", "chars": [{"text": "刊", "size": 36.0, "top": 10.0}], "other": 5}\n{"doc_id": 1, "page_no": 2}\n', encoding="utf-8")
    rows = {x["page_no"]: x for x in readers.issue_files(spark, str(tmp_path)).collect()}
    assert rows[1]["text"] == "一" and rows[1]["chars"][0]["size"] == 36.0 and rows[1]["lines"] == [] and rows[2]["text"] == "" and rows[2]["chars"] == []
    few = readers.issue_files(spark, str(tmp_path), ("doc_id", "text"))
    assert few.columns == ["doc_id", "text"] and "chars" not in few._jdf.queryExecution().executedPlan().toString()


def test_rules_are_looked_up_in_bounded_memory(monkeypatch):
    """What the look-up holds at once follows its step, not the batch, even if every place of the text may be a rule's."""
    texts = ["ab " * 1000] * 1500 + [None, ""]
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], names=["k", "t"])
    scan = ruling._looked_up(np.arange(1 << ruling.FILTER_BITS), False)
    tracemalloc.start()
    try:
        rows = sum(len(b) for b in scan(iter([batch])))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 1500 and most < 10 * batch.nbytes


def test_sign_offs_are_told_from_one_reading(spark):
    """Neither are paragraphs read twice nor their ends joined back, and what can't be a sign-off meets no pattern."""
    d = spark.createDataFrame([(1, 1, "a"), (None, 1, "（刘某）")], "id int, pos int, paragraph string")
    out = articles.with_ends(d, "id")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("LogicalRDD") == 1
    assert [tuple(x)[-2:] for x in out.orderBy("id").collect()] == [(True, False), (False, True)]


def test_omissions_by_mark_equal_those_of_two_tables(spark):
    r = random.Random(23)
    rows = [(r.choice([1, 2, None]), r.choice(["a b", "ab", " ", "c", None]), r.choice([True, False, None]), r.choice([True, False, None])) for _ in range(300)]
    d = spark.createDataFrame(rows, "id int, paragraph string, gone boolean, kept boolean")
    clean = X.remove_space(F.col("paragraph"))
    want = diffing.omissions(d, d.where("kept"), "id", clean, F.col("gone")).collect()
    assert want and sorted(map(str, diffing.omissions_by_mark(d, "id", clean, F.col("gone"), F.col("kept")).collect())) == sorted(map(str, want))


@pytest.mark.parametrize("direct", [0, 10**6])
def test_similar_pairs_by_either_way(monkeypatch, direct):
    r = random.Random(29)
    monkeypatch.setattr(articles, "DIRECT_PAIRS", direct)
    one, two = ({k: "".join(r.choice("abc") for _ in range(r.randint(1, 9))) for k in range(60)} for _ in range(2))
    want = set()
    for i, a in one.items():
        for j, b in two.items():
            x, y = articles.grams(a), articles.grams(b)
            if 200 * len(x & y) >= 60 * (len(x) + len(y)):
                want.add((i, j, 2 * len(x & y) / (len(x) + len(y))))
    got = articles.similar_pairs(one, two, 60)
    assert len(got) == len(set(got)) and set(got) == want


def test_ends_in_common_are_cut_by_whole_tokens(monkeypatch):
    """Only what stands between them is compared; the spans are those of the whole texts."""
    r = random.Random(31)
    for _ in range(3000):
        a, b = ("".join(r.choice(["x", "xy", " ", "  ", "　", "甲", "乙"]) for _ in range(r.randint(0, 9))) for _ in range(2))
        front, back = (r.choice(["", "x y ", "甲乙 ", "x"]) * r.randint(0, 3) for _ in range(2))
        a, b = front + a + back, front + b + back
        same, one, two = articles._unlike(a, b)
        n = len(articles.TOKEN.findall(same))
        want = articles.lost_spans(articles.TOKEN.findall(a), articles.TOKEN.findall(b))
        assert want == [(s + n, e + n, x) for s, e, x in articles.lost_spans(articles.TOKEN.findall(one), articles.TOKEN.findall(two))]
    long = " ".join(f"w{k}" for k in range(1000))
    assert [len(x) for x in articles._unlike(long + " lost " + long, long + " " + long)][1:] == [len("lost w0"), len("w0")]
