"""Secret scans with trigram queries derived from the rules, with DataFrame functions only."""

from __future__ import annotations

import re._constants as ops
import re._parser as parser
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.llm.common import dropped, heavy_keys, hidden, hidden_name, joined_evenly, written

#: Strings that a part of a pattern can be followed up to, and characters of a class that are spelled out, when trigrams are derived.
MOST_STRINGS = 32


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a pattern that Java and Python read alike; the least characters of one of its groups (0: the match)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The base rules, in their order; fixed patterns and bounds.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: Further kinds of the production scan.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("git_host", r"gh[pousr]_[A-Za-z0-9]{36,255}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("chat_hook", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)


# A Boolean query over trigrams of the lower-cased text: True (any text), a trigram, ("and", ...) or ("or", ...).
def _both(parts) -> object:
    parts = list(dict.fromkeys(p for p in parts if p is not True))
    return True if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def _either(parts) -> object:
    parts = list(dict.fromkeys(parts))
    if True not in parts:  # a part that asks for more than another one adds nothing
        asked = {p: {p} if isinstance(p, str) else set(p[1:]) if p[0] == "and" else {p} for p in parts}
        parts = [p for p in parts if not any(asked[q] < asked[p] for q in parts)]
    return True if not parts or True in parts else parts[0] if len(parts) == 1 else ("or", *parts)


def _needed(strings: set[str]) -> object:
    """What a text needs that holds one of strings."""
    return _either(_both(s[i : i + 3] for i in range(len(s) - 2)) for s in sorted(strings))


def _strings(tree) -> set[str] | None:
    """All strings that a parsed pattern stands for, lower-cased, if they are few."""
    out = {""}
    for op, arg in tree:
        if op is ops.LITERAL:
            part = {chr(arg).lower()}
        elif op is ops.IN:
            part = set()
            for o, a in arg:
                part |= {chr(a).lower()} if o is ops.LITERAL else {chr(c).lower() for c in range(a[0], a[1] + 1)} if o is ops.RANGE and a[1] - a[0] < MOST_STRINGS else {None}
            if None in part:
                return None
        elif op is ops.SUBPATTERN:
            part = _strings(arg[3])
        elif op is ops.BRANCH:
            found = [_strings(x) for x in arg[1]]
            part = None if None in found else set().union(*found)
        elif op in (ops.MAX_REPEAT, ops.MIN_REPEAT) and arg[1] <= 3:
            inner = _strings(arg[2])
            part = None if inner is None else {"".join(p) for n in range(arg[0], arg[1] + 1) for p in _products(inner, n)}
        else:
            return None
        if part is None or len(out) * len(part) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in part}
    return out


def _products(strings: set[str], n: int) -> list[list[str]]:
    out = [[]]
    for _ in range(n):
        out = [[*x, s] for x in out for s in strings]
    return out


def trigram_query(pattern: str) -> object:
    """The Boolean query over trigrams that the lower-cased text of every match meets: True where none is mandatory."""
    return _query(parser.parse(pattern))


def _query(tree) -> object:
    parts, run = [], []
    for item in [*tree, None]:
        if item is not None and (found := _strings([*run, item])) is not None:
            run.append(item)
            continue
        parts.append(_needed(_strings(run)))
        run = []
        if item is None:
            break
        if _strings([item]) is not None:
            run = [item]
            continue
        op, arg = item
        if op is ops.SUBPATTERN:
            parts.append(_query(arg[3]))
        elif op is ops.BRANCH:
            parts.append(_either(_query(x) for x in arg[1]))
        elif op in (ops.MAX_REPEAT, ops.MIN_REPEAT) and arg[0] > 0:
            parts.append(_query(arg[2]))
    return _both(parts)


def trigrams(query: object) -> list[str]:
    """The trigrams of a query, in its order."""
    return [] if query is True else [query] if isinstance(query, str) else list(dict.fromkeys(t for q in query[1:] for t in trigrams(q)))


def postings(texts: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """The inverted index of texts (_id, _text): (trigram: its number in vocabulary, _id), one row for each text that holds it; equal texts are one."""
    low = texts.select("_id", F.lower("_text").alias("_low"))
    held = F.array_compact(F.array(*[F.when(F.contains("_low", F.lit(t)), F.lit(i)) for i, t in enumerate(vocabulary)]))
    return low.select(F.explode(held).alias("trigram"), "_id").distinct()


def candidates(index: DataFrame, queries: Sequence[object], vocabulary: Sequence[str]) -> DataFrame:
    """(_id, rules): the texts whose postings meet any of the queries, and the ranks of these. The lists of all trigrams are merged by text, which intersects and unites them at once."""
    words = [F.bit_or(F.when(F.floor(F.col("trigram") / 62) == k, F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("trigram") % 62).cast("int"))).otherwise(F.lit(0).cast("long"))).alias(f"held_{k}") for k in range((len(vocabulary) + 61) // 62)]
    merged = index.groupBy("_id").agg(*words)
    held = [F.col(f"held_{k}") for k in range(len(words))]
    met = F.array_compact(F.array(*[F.when(meets(q, held, vocabulary), F.lit(rank)) for rank, q in enumerate(queries) if q is not True]))
    return merged.select("_id", met.alias("rules")).where(F.size("rules") > 0)


def meets(query: object, index: Sequence[Column], vocabulary: Sequence[str]) -> Column:
    """Whether a document's bits meet a query."""
    if query is True:
        return F.lit(True)
    if isinstance(query, str):
        at = list(vocabulary).index(query)
        return index[at // 62].bitwiseAND(F.lit(1 << at % 62)) != 0
    parts = [meets(q, index, vocabulary) for q in query[1:]]
    out = parts[0]
    for p in parts[1:]:
        out = out & p if query[0] == "and" else out | p
    return out


def pieces(text: Column, rule: Rule, rank: int) -> Column:
    """Leftmost matches of a rule, apart: an array of (rank, pos, gap, n, measured), with the code points between the match and the one before, its own, and those that count."""
    found, between = F.regexp_extract_all(text, F.lit(f"({rule.pattern})"), F.lit(1)), F.split(text, rule.pattern, -1)
    # text before each match, and its length; what is between the matches and the matches themselves make up the text
    both = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda gap, hit: F.struct(F.length(gap).alias("gap"), F.length(hit).alias("n"), _measured(hit, rule).alias("measured")))
    made = F.transform(both, lambda x, i: F.struct(F.lit(rank).alias("rank"), i.alias("pos"), x["gap"].alias("gap"), x["n"].alias("n"), x["measured"].alias("measured")))
    return F.when(F.regexp_like(text, F.lit(rule.pattern)), made.cast(PIECES)).otherwise(F.array().cast(PIECES))


PIECES = "array<struct<rank:int,pos:int,gap:int,n:int,measured:int>>"
SECRETS = "array<struct<start:int,rank:int,end:int,kind:string>>"


def _measured(hit: Column, rule: Rule) -> Column:
    return F.length(F.regexp_extract(hit, rule.pattern, rule.group)) if rule.group else F.length(hit)


def _digest() -> Column:
    return F.unhex(F.sha2(F.col("_text").cast("binary"), 256)).alias("_sha")


def _listed(texts: DataFrame) -> DataFrame:
    """(_id, _sha, ...): a row for each of _pieces. The digest is taken before, once for a text."""
    return texts.select("_id", _digest(), "_pieces").select("_id", "_sha", F.inline("_pieces"))


def find_secrets(df: DataFrame, text: str = "text", rules: Sequence[Rule] = (*BASE_RULES, *MORE_RULES)) -> DataFrame:
    """All rows and columns of df, and secrets: an array of (start, rank, end, kind), by start, then the order of rules.

    start and end (exclusive) count code points. An inverted index of the trigrams that any rule needs is built over all texts and written to the shared
    folder; each rule's Boolean query is answered by intersecting its posting lists, and only candidates are matched. Rules without mandatory trigrams
    are matched against all texts. Equal texts are told by a 64-bit hash in the index, where a clash only adds a candidate, and by their SHA-256
    besides where spans are joined. Positions are running sums over the matches of a text, so that many matches cost no more each than few. Texts that a
    large share of the rows repeats are salted where rows are joined. Null and empty texts have no secrets. A column secrets of df is replaced.
    """
    kept = df.drop("secrets")
    given = hidden(kept).withColumn("_text", F.coalesce(F.col(hidden_name(kept, text)), F.lit("")))
    given = given.withColumn("_id", F.xxhash64("_text"))
    queries = [trigram_query(r.pattern) for r in rules]
    vocabulary = list(dict.fromkeys(t for q in queries for t in trigrams(q)))
    heavy = written(heavy_keys(given.groupBy("_id").count(), "_id", "count", given.count()), "heavy")
    spread = F.spark_partition_id() + F.xxhash64(*[c for c in given.columns if c.startswith("in_") and c != hidden_name(kept, text)]) if len(kept.columns) > 1 else F.spark_partition_id()

    found = []
    if any(q is True for q in queries):
        every = F.flatten(F.array(*[pieces(F.col("_text"), r, i) for i, (r, q) in enumerate(zip(rules, queries, strict=True)) if q is True]))
        found.append(_listed(given.select("_id", "_text", every.alias("_pieces"))))
    if vocabulary:
        index = written(postings(given, vocabulary), "postings")
        chosen = written(candidates(index, queries, vocabulary), "candidates")
        asked = F.flatten(F.array(*[F.when(F.array_contains("rules", i), pieces(F.col("_text"), r, i)).otherwise(F.array().cast(PIECES)) for i, (r, q) in enumerate(zip(rules, queries, strict=True)) if q is not True]))
        texts = joined_evenly(given.select("_id", "_text", spread.alias("_spread")), chosen, "_id", heavy, F.col("_spread"))
        found.append(_listed(texts.select("_id", "_text", asked.alias("_pieces"))))
    walked = Window.partitionBy("_id", "_sha", "rank").orderBy("pos")
    every = (found[0].union(found[1]) if len(found) > 1 else found[0]).distinct().withColumn("_end", F.sum(F.col("gap") + F.col("n")).over(walked).cast("int"))
    least, kinds = (F.element_at(F.array(*map(F.lit, x)), F.col("rank") + 1) for x in ([r.least for r in rules], [r.kind for r in rules]))
    span = F.struct((F.col("_end") - F.col("n")).alias("start"), "rank", F.col("_end").alias("end"), kinds.alias("kind"))
    spans = written(every.where(F.col("measured") >= least).groupBy("_id", "_sha").agg(F.array_sort(F.collect_list(span)).cast(SECRETS).alias("secrets")), "spans")
    if vocabulary:
        dropped(df.sparkSession, index, chosen)

    rows = joined_evenly(given.select("*", _digest(), spread.alias("_spread")), spans, "_id", heavy, F.col("_spread"), "left", ("_sha",))
    own = [F.col(hidden_name(kept, c)).alias(c) for c in kept.columns]
    return rows.select(*own, F.coalesce("secrets", F.array().cast(SECRETS)).alias("secrets"))


def joined_spans(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def of_kinds(spans: Column, kinds: Sequence[str]) -> Column:
    return F.filter(spans, lambda x: x["kind"].isin(*kinds))
