"""DuckDB SQL for the queries of quillmark.queries."""

from __future__ import annotations

from quillmark import queries_issue

WS = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
BOARDS = "['政策法规', '技术应用类', '科技前沿类']"
PAGES = """pages AS (
    SELECT doc_id, n::INT AS page_no, CASE WHEN n % 3 = 0 THEN board || foot WHEN n % 4 = 2 THEN body || foot ELSE board || ' ' || chr(10) || body || foot END AS text
    FROM (SELECT conv_id AS doc_id, turn + 1 AS n, ['政策法规', '技术应用类', '科技前沿类'][(turn % 3 + 1)::INT] AS board, chr(10) || '—　' || (turn + 1) || ' —' AS foot,
        (CASE WHEN (turn + 1) % 4 = 2 THEN '源：' ELSE '来源： ' END) || coalesce(text, '') || (CASE WHEN (turn + 1) % 4 = 1 THEN chr(10) || '来 ' ELSE '' END) AS body FROM conversations))"""
BLANK = rf"regexp_replace(regexp_replace(regexp_replace(text, '{WS}', '', 'g'), '—\p{{Nd}}+—', '', 'g'), '^(?:政策法规|技术应用类|科技前沿类)', '') = ''"
FACTS = rf"""facts AS (
    SELECT doc_id, count(*) AS n_pages, min(page_no) AS first_page, max(page_no) FILTER (WHERE page_no <= 3) AS body, regexp_replace(string_agg(text, '' ORDER BY page_no), '{WS}', '', 'g') AS text, coalesce(list(page_no ORDER BY page_no) FILTER (WHERE {BLANK}), []) AS blank
    FROM pages GROUP BY doc_id), counted AS (
    SELECT *, (length(text) - length(replace(text, '来源：', ''))) // 3 AS n_sources, (length(text) - length(replace(text, '原文链接：', ''))) // 5 AS n_links, list_filter({BOARDS}, lambda b: contains(text, b)) AS present FROM facts)"""


def _checks(expected: int = 0, links: bool = False) -> str:
    rows = [
        ("页数>0", "n_pages > 0", "n_pages || ' 页'"),
        ("三栏目齐全", "len(present) = 3", "array_to_string(present, '、')"),
        ("无“媒体动态类”", "NOT contains(text, '媒体动态类')", "CASE WHEN contains(text, '媒体动态类') THEN '仍出现' ELSE '0 处' END"),
        ("来源行＝原文链接", "n_sources = n_links AND n_sources > 0", "n_sources || ' / ' || n_links") if links else ("正文不排原文链接（固定规则）", "n_links = 0", "'原文链接 ' || n_links || ' 行'"),
        *([("条数符合预期", f"n_sources = {expected}", f"'期望 {expected}，实际 ' || n_sources")] if expected else []),
        ("封面红字刊名", "doc_id % 3 = 0 AND first_page = 1", "CASE WHEN doc_id % 3 = 0 AND first_page = 1 THEN '测绘地理信息月刊' ELSE '未见大字号刊名' END"),
        ("正文页眉就位", "(doc_id + body) % 2 = 0 AND body * 25 + 0.5 < 80 AND (doc_id + body) % 3 <> 0",
            "'栏名 top=' || (CASE WHEN (doc_id + body) % 2 = 0 AND body * 25 + 0.5 < 80 THEN round_even(body * 25 + 0.5, 0)::BIGINT::VARCHAR ELSE '-' END) || '｜线 ' || (CASE WHEN (doc_id + body) % 3 <> 0 THEN '[' || printf('%.1f', 90.25 + body::DOUBLE) || ', ' || printf('%.1f', 94.05 + body / 1000.0::DOUBLE) || ']' ELSE '[]' END)"),
        ("无空白页", "len(blank) = 0", "CASE WHEN len(blank) = 0 THEN '空白页 0 个' ELSE '空白页 [' || array_to_string(blank, ', ') || ']' END"),
    ]
    return f"WITH {PAGES}, {FACTS}, checks AS (" + " UNION ALL ".join(f"SELECT doc_id, {i} AS ord, '{n}' AS name, {p} AS passed, {d} AS detail FROM counted" for i, (n, p, d) in enumerate(rows, 1)) + ")"


GLYPHS = "SELECT l_orderkey AS doc_id, l_linenumber AS pos, l_returnflag || l_linestatus AS text, l_quantity AS size, l_extendedprice / 1000 AS top, l_discount * 1000 AS line FROM lineitem"
SOURCED = """sourced AS (SELECT page_id, CASE WHEN page_id % 7 = 3 THEN 'https://mp.example.org/s?__biz=' || (CASE WHEN page_id % 2 = 0 THEN 'MzA1' ELSE 'MzB2' END) || '&mid=' || page_id WHEN page_id % 11 = 5 THEN 'not a link' ELSE url END AS url,
    CASE WHEN page_id % 5 = 0 THEN 'weekly' ELSE 'site' END AS origin FROM pages)"""
KNOWN = rf"""{SOURCED}, hosts AS (SELECT DISTINCT regexp_replace(lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)), '^www\.', '') AS host FROM pages WHERE page_id % 4 = 1),
known AS (SELECT DISTINCT page_id FROM (SELECT *, lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)) AS own FROM sourced) s
    WHERE regexp_extract(url, '[?&]__biz=([^&]*)', 1) = 'MzA1' OR EXISTS (SELECT 1 FROM hosts h WHERE s.own = h.host OR suffix(s.own, '.' || h.host)))"""
ITEMS = """items AS (SELECT o_orderkey AS id, o_orderstatus AS board, substr(o_orderpriority, 1, 1)::INT AS level, CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'AUTOMOBILE' THEN 2 WHEN 'MACHINERY' THEN 3 ELSE 4 END AS centrality,
    CASE WHEN o_orderkey % 9 <> 0 THEN o_orderdate END AS pub_date FROM orders JOIN customer ON o_custkey = c_custkey),
ranked AS (SELECT *, row_number() OVER (PARTITION BY board ORDER BY level, centrality, pub_date DESC NULLS LAST, id)::INT AS rank FROM items)"""
QUOTA = "rank <= CASE board WHEN 'F' THEN 6 WHEN 'O' THEN 24 WHEN 'P' THEN 5 ELSE 0 END"
PATH = r"(SELECT page_id, regexp_replace(url, '\?.*$', '.html') AS path FROM pages)"


def _classified() -> str:
    rules = (("政策法规", "law", "the law|licen"), ("政策法规", "rule", " and the "), ("技术应用类", "data", "token|password"), ("技术应用类", "use", " to the "), ("科技前沿类", "new", "thing|neu"), ("科技前沿类", "next", "ation"))
    meets = lambda p: f"coalesce(regexp_matches(text, '{p}'), false)"
    scores = ", ".join(f"{' + '.join(f'{meets(p)}::INT' for b, _, p in rules if b == board)} AS s{i}" for i, board in enumerate(("政策法规", "技术应用类", "科技前沿类")))
    tags = ", ".join(f"CASE WHEN {meets(p)} THEN '{t}' END" for _, t, p in rules)
    return f"""SELECT doc_id, CASE WHEN greatest(s0, s1, s2) = 0 THEN '技术应用类' WHEN s0 = greatest(s0, s1, s2) THEN '政策法规' WHEN s1 = greatest(s0, s1, s2) THEN '技术应用类' ELSE '科技前沿类' END AS board, tags
        FROM (SELECT doc_id, {scores}, coalesce(array_to_string(list_filter([{tags}], lambda x: x IS NOT NULL), ','), '') AS tags FROM documents)"""


def _stable(times: int = 8) -> str:
    inner = "SELECT conv_id, count(*) AS n, 0::BIGINT AS front FROM conversations GROUP BY conv_id"
    for _ in range(times):
        inner = f"SELECT conv_id, n, ceil((n + front) / 5)::BIGINT AS front FROM ({inner})"
    return inner


def _diff() -> str:
    own = "SELECT doc_id, unnest(range(1, len(p) + 1)) AS pos, unnest(p) AS paragraph FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents)"
    clean = f"regexp_replace(paragraph, '{WS}', '', 'g')"
    return f"""WITH own AS ({own}), both_ AS (SELECT doc_id, {clean} AS paragraph, 1 AS n FROM own UNION ALL SELECT doc_id, {clean}, -1 FROM own WHERE (doc_id + pos) % 3 <> 0)
        SELECT doc_id, paragraph, sum(n)::BIGINT AS missing FROM both_ WHERE paragraph <> '' GROUP BY ALL HAVING sum(n) > 0"""


HAN = r"\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}"
MARKS = "，。；：？！、（）《》"
BLANKS = r"[\x{a0}\x{2000}-\x{200b}\x{202f}\x{205f}\x{3000}]"
NUMBER = r"[\p{Nd}零〇一二三四五六七八九十百千两]+"
KEEP = rf"^第{NUMBER}[编章节](?:[ \x{{3000}}][^。，；：！？,;:!?]*)?$|^ *— *\p{{Nd}}+ *— *$"
PARAGRAPH_ROWS = "(SELECT doc_id AS id, unnest(range(1, len(p) + 1))::INT AS pos, unnest(p) AS paragraph FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents))"
HAN_LINES = f"WITH lines AS (SELECT id, pos, (CASE WHEN pos % 5 = 0 THEN '第二章 ' WHEN pos % 7 = 0 THEN '第十三条 ' ELSE '' END) || translate(paragraph, 'etaoinzx', '的一是在不了' || chr(160) || chr(12288)) AS raw FROM {PARAGRAPH_ROWS})"
SIGNED = f"""WITH inner_ AS (SELECT id, pos, CASE (id + pos) % 9 WHEN 0 THEN paragraph || '。（刘某）' WHEN 1 THEN paragraph || '（详见下表）' WHEN 2 THEN paragraph || '/摄' WHEN 3 THEN '图为：' || paragraph
    WHEN 4 THEN '字号：' || paragraph WHEN 5 THEN '扫一扫' || paragraph || '分享' ELSE paragraph END AS paragraph FROM {PARAGRAPH_ROWS}),
ends AS (SELECT id, n, CASE id % 6 WHEN 0 THEN ['正文到此。', '（刘某）'] WHEN 1 THEN ['正文到此。', '张某/摄', ' ', '图为：会场'] WHEN 2 THEN ['工作会议召开。（测绘局 王某）'] WHEN 3 THEN ['印发《测绘成果管理办法》（试行）'] WHEN 4 THEN ['结果公布（详见下表）'] ELSE ['正文到此。'] END AS e
    FROM (SELECT id, max(pos) AS n FROM {PARAGRAPH_ROWS} GROUP BY id)),
signed AS (SELECT * FROM inner_ UNION ALL SELECT id, (n + unnest(range(1, len(e) + 1)))::INT, unnest(e) FROM ends)"""
PARAGRAPHS = """(VALUES (1, '全省工作会议召开。（刘某）'), (2, '结果公布（详见下表）'), (3, '张某/摄'), (4, '图为：会场'), (5, '（王某 测绘院）'), (6, '李某 供图'), (7, '正文提到供图单位和地图。'), (8, '扫一扫打开当前页'), (9, '用手机扫一扫随机获取的地图，系统即可自动识别'), (10, '打印本页')) AS t(id, paragraph)"""
#: What stands behind the planted ends, and planted furniture (texts of the tables have no full-width marks and no such endings); the constant ones beside them.
BEHIND = "(id >= 0 AND paragraph IN ('（刘某）', '张某/摄', '图为：会场') AND pos > (SELECT max(p.pos) FROM inner_ p WHERE p.id = s.id) OR id IN (-3, -4, -5, -6))"
FURNITURE = "(prefix(paragraph, '字号：') OR prefix(paragraph, '扫一扫') AND suffix(paragraph, '分享') OR paragraph IN ('扫一扫打开当前页', '打印本页'))"
ALL_SIGNED = f"{SIGNED}, every AS (SELECT * FROM signed UNION ALL SELECT -id, 1, paragraph FROM {PARAGRAPHS}), judged AS (SELECT *, {BEHIND} AS behind, {FURNITURE} AS furniture FROM every s)"


def _tidied() -> str:
    """Spacing and marks of lines without quotations; patterns that take neighbours along go over the text twice."""
    article = rf"^第{NUMBER}条 +"
    x = f"regexp_replace(regexp_replace(raw, '{article}', ''), '{BLANKS}', ' ', 'g')"
    for left, right in ((f"[{HAN}]", f"[{HAN}A-Za-z0-9]"), ("[A-Za-z0-9]", f"[{HAN}]")):
        for _ in range(2):
            x = f"regexp_replace({x}, '({left}) +({right})', '\\1\\2', 'g')"
    x = f"regexp_replace({x}, ' *([{MARKS}]) *', '\\1', 'g')"
    for half, full in ((",", "，"), (";", "；"), (":", "："), ("?", "？"), ("!", "！")):
        for _ in range(2):
            x = f"regexp_replace({x}, '([{HAN}])[{half}]([{HAN}])', '\\1{full}\\2', 'g')"
    return f"tidied AS (SELECT id, pos, raw, regexp_extract(raw, '{article}') || {x} AS full_ FROM lines)"


def _proofed() -> str:
    """Hits of the three rules, from each line's characters, with runs of spaces made one."""
    a, b = "c[i - 1]", "c[i + 1]"
    of = lambda kind, at: f"regexp_matches(coalesce({at}, ''), '[{kind}]')"
    alnum = "A-Za-z0-9"
    behind = f"i > 1 AND ({of(HAN, a)} AND {of(HAN + alnum, b)} OR {of(alnum, a)} AND {of(HAN, b)} OR {of(MARKS, a)})"
    space, half = f"x = ' ' AND ({behind} OR {of(MARKS, b)})", f"x IN (',', ';', ':', '?', '!') AND i > 1 AND {of(HAN, a)} AND {of(HAN, b)}"
    return f"""chars AS (SELECT id, pos, raw, string_split(regexp_replace(raw, ' +', ' ', 'g'), '') AS c FROM lines),
        proofed AS (SELECT id, pos, 'extra_space' AS rule, len(list_filter(c, lambda x, i: {space}))::INT AS hits FROM chars
        UNION ALL SELECT id, pos, 'special_blank', (length(raw) - length(regexp_replace(raw, '{BLANKS}', '', 'g')))::INT FROM chars UNION ALL SELECT id, pos, 'half_width_mark', len(list_filter(c, lambda x, i: {half}))::INT FROM chars)"""


ORACLES = {
    "layout_checks": _checks(3) + " SELECT * FROM checks",
    "layout_checks_links": _checks(links=True) + " SELECT * FROM checks WHERE ord = 4",
    "layout_verdict": _checks() + " SELECT doc_id, count(*) AS n_checks, count(*) FILTER (WHERE NOT passed) AS n_failed, bool_and(passed) AS passed FROM checks GROUP BY doc_id",
    "layout_report": _checks() + """ SELECT doc_id, ord, '  ' || (CASE WHEN passed THEN '✓' ELSE '✗' END) || ' ' || name || '（' || detail || '）' AS line FROM checks UNION ALL
        SELECT doc_id, (max(ord) + 1)::INT, '[' || (CASE WHEN bool_and(passed) THEN 'PASS' ELSE 'FAIL' END) || '] 版式体检：' || count(*) || ' 项，' || count(*) FILTER (WHERE NOT passed) || ' 项不通过' FROM checks GROUP BY doc_id""",
    "blank_pages": f"WITH {PAGES} SELECT doc_id, page_no FROM pages WHERE {BLANK}",
    "cross_page_count": f"""WITH {PAGES}, {FACTS} SELECT doc_id, n_sources::INT AS joined, by_page FROM counted JOIN
        (SELECT doc_id, sum((length(t) - length(replace(t, '来源：', ''))) // 3)::BIGINT AS by_page FROM (SELECT doc_id, regexp_replace(text, '{WS}', '', 'g') AS t FROM pages) GROUP BY doc_id) USING (doc_id)""",
    "literal_count": f"""SELECT doc_id, ((length(text) - length(replace(text, 'the', ''))) // 3)::INT AS n_the, ((length(t) - length(replace(t, 'ee', ''))) // 2)::INT AS n_ee
        FROM (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '{WS}', '', 'g') AS t FROM documents)""",
    "glyph_title": f"SELECT doc_id, coalesce(string_agg(text, '' ORDER BY pos, text, size) FILTER (WHERE size > 30), '') AS title FROM ({GLYPHS}) GROUP BY doc_id",
    "header_present": f"SELECT doc_id, bool_or(top < 80) AND bool_or(line < 95) AS passed FROM ({GLYPHS}) GROUP BY doc_id",
    "html_paragraphs": rf"""SELECT * FROM (SELECT page_id, unnest(range(1, len(p) + 1))::INT AS pos, unnest(p) AS paragraph
        FROM (SELECT page_id, string_split(regexp_replace(regexp_replace(html || CASE page_id % 3 WHEN 0 THEN '<p>打印本页</p>' WHEN 1 THEN '<p>　扫一扫在手机上打开当前页 </p>' ELSE '<p>扫一扫。打开当前页</p>' END, '(?i)</p>|<br>|</h1>|</li>', chr(10), 'g'), '<[^>]*>', '', 'g'), chr(10)) AS p FROM pages))
        WHERE regexp_replace(paragraph, '{WS}', '', 'g') NOT IN ('打印本页', '扫一扫在手机上打开当前页')""",
    "document_paragraphs": "SELECT doc_id, len(string_split(text, chr(10))) AS n_paragraphs, (length(text) + 1)::BIGINT AS n_chars FROM documents WHERE text IS NOT NULL",
    "source_whitelist_semi": f"WITH {KNOWN} SELECT * FROM sourced WHERE origin <> 'weekly' AND page_id IN (SELECT page_id FROM known)",
    "source_unverified_anti": f"WITH {KNOWN} SELECT * FROM sourced WHERE page_id NOT IN (SELECT page_id FROM known)",
    "weekly_clue_anti": f"WITH {SOURCED}, clues AS (SELECT url, min(page_id) AS clue FROM sourced WHERE origin = 'weekly' GROUP BY url) SELECT page_id, url, clue FROM sourced LEFT JOIN clues USING (url) WHERE origin <> 'weekly'",
    "channel_union": "SELECT 'site' AS origin, lang, NULL::VARCHAR AS role, count(*) AS n FROM documents GROUP BY lang UNION ALL SELECT 'weekly', NULL, role, count(*) FROM conversations GROUP BY role",
    "channel_search": "SELECT doc_id, lang FROM documents WHERE contains(text, 'license') AND lang = 'en'",
    "open_sources": "SELECT event_id, event_type AS status FROM events WHERE event_type NOT IN ('click', 'captcha', 'paywall', 'login')",
    "window_filter": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1996-02-01' AND DATE '1996-03-31'",
    "scope_filter": r"SELECT doc_id, lang FROM documents WHERE lang IN ('en', 'de') AND NOT coalesce(regexp_matches(text, '(?i)licen[sc]ed? under') OR regexp_matches(text, '@[a-z]+\.') OR regexp_matches(text, '\(\d{3}\) \d{3}'), false)",
    "board_classify": _classified(),
    "r4_rank": f"WITH {ITEMS} SELECT id, board, rank FROM ranked",
    "board_quota": f"WITH {ITEMS} SELECT id, board, rank FROM ranked WHERE {QUOTA}",
    "board_quota_direct": f"WITH {ITEMS} SELECT board, count(*) AS n, max(rank) AS last FROM ranked GROUP BY board",
    "priority_pick": "SELECT story, priority, id FROM (SELECT *, row_number() OVER (PARTITION BY story ORDER BY priority, id) AS n FROM (SELECT l_orderkey AS story, l_suppkey % 3 AS priority, l_suppkey || '-' || l_linenumber AS id FROM lineitem)) WHERE n = 1",
    "skeleton_insert": f"""WITH {ITEMS}, both_ AS (SELECT board, id, rank, row_number() OVER (PARTITION BY board ORDER BY id % 97, id) AS place, 0 AS extra FROM ranked WHERE id % 5 = 0
        UNION ALL SELECT board, id, rank, NULL, 1 FROM ranked WHERE id % 5 <> 0), slots AS (SELECT *, CASE WHEN extra = 0 THEN place ELSE sum(1 - extra) OVER (PARTITION BY board ORDER BY rank) END AS slot FROM both_)
        SELECT board, id, row_number() OVER (PARTITION BY board ORDER BY slot, extra, rank, id)::INT AS position FROM slots""",
    "page_breaks": f"WITH {ITEMS} SELECT id, rank > 1 AS page_break FROM ranked",
    "step_failfast": """SELECT run, count(*) AS n_steps, max(code)::INT AS failed FROM (SELECT *, coalesce(max(code) OVER (PARTITION BY run ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM (SELECT user_id AS run, event_id AS pos, CASE WHEN value > 95 THEN 1 ELSE 0 END AS code FROM events)) WHERE before = 0 GROUP BY run""",
    "period_validate": """SELECT c_custkey, field, value FROM (
        SELECT c_custkey, 'window_from' AS field, CASE WHEN c_custkey % 3 = 0 THEN '2031-02-01' ELSE '2031-XX-XX' END AS value FROM customer UNION ALL SELECT c_custkey, 'window_to', CASE WHEN c_custkey % 4 <> 0 THEN '2031-03-01' END FROM customer
        UNION ALL SELECT c_custkey, 'collect_date', nullif(substr(c_mktsegment, 1, 3), 'BUI') FROM customer UNION ALL SELECT c_custkey, 'title_range', '' FROM customer UNION ALL SELECT c_custkey, 'issue_label', c_name FROM customer)
        WHERE value IS NULL OR value = '' OR regexp_matches(value, '(?i)X|N')""",
    "precondition_counts": "SELECT count(*) AS n_selected, count(*)::INT AS n_catalog, count(*) FILTER (WHERE doc_id % 6 = 0) AS n_pending, count(*) = 0 AS stop, count(*) FILTER (WHERE doc_id % 6 = 0) > 0 AS warn FROM labels",
    "pending_items": "SELECT doc_id FROM labels WHERE doc_id % 6 = 0",
    "closing_summary": f"SELECT {BOARDS}[(doc_id % 4 + 1)::INT] AS board, count(*) AS n_files FROM documents WHERE doc_id % 4 < 3 GROUP BY 1",
    "catalog_heading": "SELECT '- 采集范围：2031-02-01—2031-03-31' AS line UNION ALL SELECT '- 条目总数：' || count(*) FROM orders JOIN customer ON o_custkey = c_custkey",
    "catalog_archive_counts": "SELECT a AS n_items, b AS n_files, a = b AS same FROM (SELECT (SELECT count(*) FROM documents) AS a, (SELECT count(*) FROM labels) AS b)",
    "markdown_catalog": f"WITH {ITEMS} SELECT board, string_agg(rank || '. item ' || id || '（' || level || '）', chr(10) ORDER BY rank) AS text FROM ranked WHERE {QUOTA} GROUP BY board",
    "board_containment": "SELECT doc_id, array_to_string(f, '、') AS found, len(f) = 3 AS all_found FROM (SELECT doc_id, list_filter(['the', 'und', 'que'], lambda b: contains(text, b)) AS f FROM documents)",
    "paragraph_diff": _diff(),
    "golden_regression": """WITH new AS (SELECT item_id, CASE WHEN item_id % 10 = 0 THEN text || '!' ELSE text END AS text FROM benchmark WHERE item_id % 7 <> 3)
        SELECT *, 'only first' AS side FROM (SELECT item_id, text FROM benchmark EXCEPT ALL SELECT * FROM new) UNION ALL SELECT *, 'only second' FROM (SELECT * FROM new EXCEPT ALL SELECT item_id, text FROM benchmark)""",
    "page_reconcile": """WITH c AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id), pages_ AS (SELECT conv_id AS article, n AS body_page, CASE WHEN conv_id % 8 <> 5 THEN CASE WHEN conv_id % 6 = 0 THEN n + 1 ELSE n END END AS toc_page, CASE WHEN conv_id % 9 <> 2 THEN n END AS footer_page FROM c)
        SELECT * FROM pages_ WHERE body_page IS DISTINCT FROM toc_page OR toc_page IS DISTINCT FROM footer_page""",
    "toc_backfill": f"WITH {PAGES} SELECT doc_id, page_no, page_no AS printed FROM pages",
    "cjk_normalise": f"""{HAN_LINES}, {_tidied()} SELECT id, pos, CASE WHEN regexp_matches(raw, '{KEEP}') THEN raw ELSE full_ END AS line FROM tidied WHERE id >= 0 UNION ALL
        SELECT -id, 1, line FROM (VALUES (1, '于2025年建成GNSS网'), (2, '该项工作，已完成'), (3, '测量，制图'), (4, '版本v2, 精度0.5'), (5, '第二章 附 则'), (6, '口号“守护安全 激活数据”已发布'), (7, '— 12 —'), (8, '甲乙丙丁'), (9, 'Open Data平台'), (10, '目录' || chr(9) || '7'),
        (11, '汉A字B汉'), (12, '于2025年建成'), (13, '编辑部；来稿'), (14, '他说:“好 的,再 见”，然后走了'), (15, '')) AS t(id, line)""",
    "proof_report": f"""{HAN_LINES}, {_proofed()} SELECT id, pos, rule, hits FROM proofed WHERE hits > 0 AND id >= 0 UNION ALL
        SELECT -id, 1, rule, hits FROM (VALUES (1, 'extra_space', 4), (2, 'extra_space', 3), (3, 'half_width_mark', 1), (4, 'extra_space', 2), (5, 'extra_space', 2), (6, 'extra_space', 1), (8, 'extra_space', 3), (9, 'extra_space', 1), (11, 'extra_space', 4), (12, 'special_blank', 2), (13, 'special_blank', 1), (13, 'half_width_mark', 1),
        (14, 'extra_space', 4), (14, 'half_width_mark', 1)) AS t(id, rule, hits)""",
    "sign_off_strip": f"""{ALL_SIGNED} SELECT id, pos, CASE WHEN id % 6 = 2 AND paragraph = '工作会议召开。（测绘局 王某）' THEN '工作会议召开。' WHEN id = -1 THEN '全省工作会议召开。' ELSE paragraph END AS paragraph FROM judged WHERE NOT behind""",
    "boilerplate_lines": f"{ALL_SIGNED} SELECT id, pos, paragraph FROM judged WHERE NOT furniture",
    "proof_omissions": f"""{ALL_SIGNED}, both_ AS (SELECT id, regexp_replace(paragraph, '{WS}', '', 'g') AS paragraph, 1 AS n, behind OR furniture AS gone FROM judged
        UNION ALL SELECT id, regexp_replace(paragraph, '{WS}', '', 'g'), -1, false FROM judged WHERE NOT behind AND NOT furniture AND (id + pos) % 11 <> 0)
        SELECT id, paragraph, sum(n)::BIGINT AS missing, CASE WHEN max(gone::INT) = 1 THEN 'removed' ELSE 'omitted' END AS verdict FROM both_ WHERE paragraph <> '' GROUP BY id, paragraph HAVING sum(n) > 0""",
    "toc_backfill_front": "SELECT conv_id AS doc_id, (turn + 1)::INT AS page_no, CASE WHEN turn + 1 > conv_id % 3 THEN (turn + 1 - conv_id % 3)::INT END AS printed FROM conversations",
    "precondition_stop": "SELECT s AS n_selected, c::INT AS n_catalog, p AS n_pending, s <> c OR s = 0 AS stop, p > 0 AS warn FROM (SELECT (SELECT count(*) FROM labels) AS s, (SELECT count(*) FROM documents) AS c, (SELECT count(*) FROM labels WHERE doc_id % 6 = 0) AS p)",
    "rounded_tops": "SELECT l_orderkey, l_linenumber, printf('%.1f', l_extendedprice / 1000)::DOUBLE AS price, printf('%.1f', l_quantity / 20)::DOUBLE AS quantity, printf('%.1f', -l_discount / 4)::DOUBLE AS discount FROM lineitem",
    "first_tops": f"""WITH g AS ({GLYPHS}) SELECT doc_id, array_to_string(list(printf('%.1f', line) ORDER BY pos, text, size, top, line)[1:2], ',') AS tops, round_even(list(top ORDER BY pos, text, size, top, line)[1], 0)::BIGINT::VARCHAR AS first FROM g GROUP BY doc_id""",
    "elapsed_steps": "SELECT event_id, round_even((epoch_us(stop) - epoch_us(ts)) / 1e6, 0)::BIGINT AS seconds FROM (SELECT event_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS stop FROM events) WHERE stop IS NOT NULL",
    "log_names": "SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') || '_draft.log' AS name FROM events",
    "clean_reports": r"SELECT conv_id, coalesce(bool_or(regexp_matches(text, '(?i)\bthe [a-m]')), false) AS found FROM conversations GROUP BY conv_id",
    "catalog_head": "SELECT 1 AS ord, '- 采集范围：2031-02-01—2031-03-31' AS line UNION ALL SELECT 2, '- 条目总数：' || count(*) FROM orders JOIN customer ON o_custkey = c_custkey UNION ALL SELECT 3, '- 生成时间：2031-04-01 09:30:00'",
    "closing_lines": f"""SELECT 0::BIGINT AS ord, '[汇总] 目录条数 ' || count(*) AS line FROM documents
        UNION ALL SELECT (doc_id % 3 + 1)::BIGINT, '[汇总] ' || {BOARDS}[(doc_id % 3 + 1)::INT] || ' 原文归档 ' || count(*) || ' 份' FROM documents WHERE doc_id % 3 < 2 GROUP BY doc_id % 3""",
    "last_renderer": "SELECT o_custkey AS folder, max('v' || o_orderkey || '/render.py') AS path FROM orders GROUP BY o_custkey",
    "consistency": """WITH c AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id), wrong AS (SELECT count(*) AS n FROM c WHERE conv_id % 8 = 5 OR conv_id % 6 = 0 OR conv_id % 9 = 2)
        SELECT n = 0 AS consistent, 'as found' AS what FROM wrong UNION ALL SELECT true, 'none'""",
    "excluded_kinds": """SELECT doc_id, ['local', 'international', 'popular science and maps', 'party building', 'promotion', 'training and lectures', 'acceptance reviews', 'prefecture level', 'not text', '', 'local,party building'][(doc_id % 11 + 1)::INT] AS kinds FROM documents WHERE doc_id % 11 <> 9""",
    "list_connector": """SELECT 'list a' AS origin, o_orderkey FROM (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT' ORDER BY o_orderdate DESC, o_orderkey LIMIT 40)
        UNION ALL SELECT 'list b', o_orderkey FROM (SELECT * FROM orders WHERE o_orderpriority = '5-LOW' ORDER BY o_orderdate DESC, o_orderkey LIMIT 20)""",
    "whole_text_scan": "SELECT item_id, text FROM benchmark",
    "json_records": "SELECT c_name AS issue_name, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS issue_label, c_nationkey AS draft_target, NULL::VARCHAR AS window_from FROM customer",
    "json_selection": "SELECT CASE WHEN doc_id % 6 = 0 THEN '待补：正文' WHEN doc_id % 6 <> 1 THEN '官网' END AS body_source, count(*) AS n FROM labels GROUP BY 1",
    "archive_listing": f"SELECT DISTINCT {BOARDS}[(doc_id % 3 + 1)::INT] AS board, true AS has_files, true AS has_bytes, true AS is_new FROM documents",
    "log_append": "SELECT '=== [' || event_id || '] ' || event_type AS line FROM events",
    "trial_issue": "SELECT n_nationkey, 'issue' AS kind FROM nation UNION ALL SELECT n_nationkey, 'trial' FROM nation WHERE n_nationkey < 10",
    "latest_artifact": "SELECT folder, path FROM (SELECT o_custkey AS folder, 'out/' || o_orderkey || '.pdf' AS path, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, 'out/' || o_orderkey || '.pdf' DESC) AS n FROM orders) WHERE n = 1",
    "first_ok_candidate": "SELECT run, name FROM (SELECT l_orderkey AS run, l_returnflag || l_suppkey AS name, row_number() OVER (PARTITION BY l_orderkey ORDER BY (l_returnflag = 'R') DESC, l_linenumber, l_returnflag || l_suppkey) AS n FROM lineitem) WHERE n = 1",
    "ordered_dedup": """SELECT doc_id, array_to_string(list_filter(w, lambda x, i: list_position(l, lower(x)) = i), ' ') AS words FROM (SELECT doc_id, w, list_transform(w, lambda x: lower(x)) AS l
        FROM (SELECT doc_id, list_filter(string_split(text, ' '), lambda x: x <> '') AS w FROM documents))""",
    "missing_fonts": "SELECT DISTINCT p_brand || '/' || p_size AS font FROM part WHERE p_brand || '/' || p_size NOT IN (SELECT p_brand || '/' || p_size FROM part WHERE p_retailprice > 1500)",
    "elapsed_round": "SELECT event_id, round_even(event_id / 2, 0)::BIGINT AS seconds FROM events",
    "flag_parse": "SELECT event_type, count(*) FILTER (WHERE event_id % 4 IN (0, 2)) AS n_on, count(*) AS n FROM events GROUP BY event_type",
    "path_parts": rf"""SELECT page_id, name, regexp_replace(name, '^(.+)\.[^.]*$', '\1') AS stem, regexp_replace(path, '[/][^/]*$', '') AS parent, regexp_replace(path, '\.[^./]*$', '') || '.pdf' AS pdf,
        CASE WHEN name = '' THEN path WHEN contains(name, '.') THEN regexp_replace(path, '(\.[^./]*)$', '_v2\1') ELSE path || '_v2' END AS v2 FROM (SELECT page_id, path, regexp_extract(path, '([^/]*)$', 1) AS name FROM {PATH})""",
    "pagination_stable": _stable(),
} | queries_issue.ORACLES
ORACLES["issue_files"] = ORACLES["layout_checks"]
