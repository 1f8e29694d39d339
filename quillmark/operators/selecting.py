"""Selection of items: window, scope, sources, boards, order, quotas, skeletons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.operators.ordering import running_totals
from quillmark.operators.ruling import rules_met


def in_window(items: DataFrame, date: str, first: Column, last: Column) -> DataFrame:
    """Items of a collection window, both ends included."""
    return items.where(F.col(date).between(first, last))


def in_scope(items: DataFrame, text: str, excluded: Mapping[str, str], level: str, levels: Sequence[str]) -> DataFrame:
    """Items of the levels wanted that meet no exclusion rule (name: pattern); null texts meet none."""
    out = items.where(F.col(level).isin(*levels))
    for pattern in excluded.values():
        out = out.where(~F.coalesce(F.regexp_like(F.col(text), F.lit(pattern)), F.lit(False)))
    return out


def with_source(items: DataFrame, url: str = "url") -> DataFrame:
    """Adds host (lower case) and account (of a public account's link): null for URLs that can't be parsed."""
    return items.withColumns({"host": F.lower(F.try_parse_url(F.col(url), F.lit("HOST"))), "account": F.try_parse_url(F.col(url), F.lit("QUERY"), F.lit("__biz"))})


def _suffixes(host: Column) -> Column:
    """The host and all domains above it."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def _known(sourced: DataFrame, whitelist: DataFrame, key: str) -> DataFrame:
    hosts = whitelist.where("host IS NOT NULL").select(F.col("host").alias("_host")).distinct()
    accounts = whitelist.where("account IS NOT NULL").select(F.col("account").alias("_account")).distinct()
    by_host = sourced.where("host IS NOT NULL").select(key, F.explode(_suffixes(F.col("host"))).alias("_host")).join(hosts, "_host", "left_semi").select(key)
    by_account = sourced.select(key, F.col("account").alias("_account")).join(accounts, "_account", "left_semi").select(key)
    return by_host.union(by_account).distinct()


def from_known_sources(items: DataFrame, whitelist: DataFrame, key: str, url: str = "url", origin: str = "origin", clue: str = "weekly") -> DataFrame:
    """Items whose link belongs to a unit of whitelist (unit, host, account), by host, the domains above it, or account; names don't count.

    A clue's origin is no source, so its items go too.
    """
    wanted = items.where(~F.coalesce(F.col(origin) == clue, F.lit(False)))
    return wanted.join(_known(with_source(wanted, url), whitelist, key), key, "left_semi").select(*items.columns)


def from_unknown_sources(items: DataFrame, whitelist: DataFrame, key: str, url: str = "url") -> DataFrame:
    """Items whose link belongs to no unit of whitelist."""
    return items.join(_known(with_source(items, url), whitelist, key), key, "left_anti").select(*items.columns)


def classified(items: DataFrame, text: str, rules: Sequence[tuple[str, str, str]], fallback: str) -> DataFrame:
    """Adds board and tags: rules are (board, tag, pattern). The board has most matching rules, ties by their order; without any, it is the fallback."""
    boards = list(dict.fromkeys(b for b, _, _ in rules))
    meets = lambda p: F.coalesce(F.regexp_like(F.col(text), F.lit(p)), F.lit(False))
    scores = [sum((meets(p).cast("int") for b, _, p in rules if b == board), F.lit(0)) for board in boards]
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    board = F.when(best == 0, F.lit(fallback))
    for name, score in zip(boards, scores, strict=True):
        board = board.when(score == best, F.lit(name))
    tags = F.array_distinct(F.array_compact(F.array(*[F.when(meets(p), F.lit(tag)) for _, tag, p in rules])))
    return items.withColumns({"board": board, "tags": tags})


def ranked(items: DataFrame, key: str, board: str = "board", level: str = "level", centrality: str = "centrality", date: str = "pub_date") -> DataFrame:
    """Adds rank: within a board by level, then centrality, then the newest date (nulls last), then key.

    Items are dealt out by ranges of this order, so neither a board nor many items of one level, centrality and date are numbered in one task (see ordering).
    """
    order = [F.col(level).asc_nulls_last(), F.col(centrality).asc_nulls_last(), F.col(date).desc_nulls_last(), F.col(key).asc()]
    out = running_totals(items, [board], order, {"rank": F.lit(1)})
    return out.withColumn("rank", (F.col("rank") + 1).cast("int"))


def within_quota(items: DataFrame, quota: Mapping[str, int], key: str, direct: bool = False, **columns) -> DataFrame:
    """Ranked items up to each board's quota (boards without one have none); direct takes the selection as it is.

    The largest quota bounds the numbering as such, so each task hands on its first items of a board alone.
    """
    if direct:
        return ranked(items, key, **columns)
    board, level, centrality, date = (columns.get(c, d) for c, d in (("board", "board"), ("level", "level"), ("centrality", "centrality"), ("date", "pub_date")))
    order = Window.partitionBy(board).orderBy(F.col(level).asc_nulls_last(), F.col(centrality).asc_nulls_last(), F.col(date).desc_nulls_last(), key)
    most = F.lit(0)
    for name, n in quota.items():
        most = F.when(F.col(board) == name, F.lit(n)).otherwise(most)
    wanted = items.where(F.col(board).isin(*quota)).withColumn("rank", F.row_number().over(order))
    return wanted.where(F.col("rank") <= max(quota.values(), default=0)).where(F.col("rank") <= most)


def preferred(items: DataFrame, story: str, priority: str, key: str) -> DataFrame:
    """One item for each story: that of the lowest priority number, then key."""
    order = Window.partitionBy(story).orderBy(F.col(priority).asc_nulls_last(), key)
    return items.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def inserted(skeleton: DataFrame, extras: DataFrame, board: str = "board", rank: str = "rank", key: str = "id") -> DataFrame:
    """(board, key, position): the skeleton (with place: 1, 2, ... in a board) keeps its order; each extra stands after as many of its items as have a rank up to its own.

    One running count over both by rank, dealt out by ranges (ordering), gives all positions: an extra stands behind those skeleton items and the extras before it; the skeleton's
    item at place p stands behind all extras of a rank before the p-th skeleton item by rank, which is found by an equi-join of place and that number. No board is ordered in one task.
    """
    one = skeleton.select(board, key, rank, F.col("place").cast("long").alias("_place"), F.lit(0).alias("_extra"))
    two = extras.select(board, key, rank, F.lit(None).cast("long").alias("_place"), F.lit(1).alias("_extra"))
    order = [F.col(rank).asc_nulls_last(), F.col("_extra").asc(), F.col(key).asc()]
    both = running_totals(one.unionByName(two), [board], order, {"_fixed": 1 - F.col("_extra"), "_extras": F.col("_extra")})
    moved = both.where("_extra = 1").select(board, key, (F.col("_fixed") + F.col("_extras") + 1).alias("position"))
    nth = both.where("_extra = 0").select(F.col(board).alias("_board"), (F.col("_fixed") + 1).alias("_nth"), F.col("_extras").alias("_before"))
    at = F.col(board).eqNullSafe(F.col("_board")) & (F.col("_place") == F.col("_nth"))
    kept = one.join(nth, at).select(board, key, (F.col("_place") + F.col("_before")).alias("position"))
    return kept.union(moved).withColumn("position", F.col("position").cast("int"))


def page_breaks(articles: DataFrame, board: str = "board", ord_: str = "ord") -> DataFrame:
    """Adds page_break: each article but a board's first begins a page. ord_ is unique within a board; one aggregate row for each board is joined back."""
    first = articles.groupBy(board).agg(F.min(ord_).alias("_first")).withColumnRenamed(board, "_board")
    return articles.join(first, F.col(board).eqNullSafe(F.col("_board"))).select(*articles.columns, (F.col(ord_) > F.col("_first")).alias("page_break"))


#: Kinds of items that are left out, in the order of the rule (fixed values: what they are), and patterns for each (ours: keywords aren't given). Patterns are the default of a parameter.
EXCLUSIONS = (
    ("local", "福建|本省"),
    ("international", "国际|海外|联合国"),
    ("popular science and maps", "科普|版图宣传|版图意识"),
    ("party building", "党建|主题党日|党支部"),
    ("promotion", "推广|宣传周|宣传活动"),
    ("training and lectures", "培训|讲座"),
    ("acceptance reviews", "验收|评审"),
    ("prefecture level", "市局|地市|县级"),
    ("not text", "视频|图集|组图"),
)


def excluded_by(items: DataFrame, text: str, rules: DataFrame, key: str) -> DataFrame:
    """(key, kinds): items that meet an exclusion rule of rules (ord, kind, pattern; any number), and the kinds in the order of ord. The rest is an anti join away; null texts meet none. Rules are looked up by what their matches must hold (ruling)."""
    kinds = F.array_sort(F.collect_set(F.struct("ord", "kind")))
    return rules_met(items, text, rules, key).groupBy(key).agg(F.array_join(F.transform(kinds, lambda x: x["kind"]), ",").alias("kinds"))
