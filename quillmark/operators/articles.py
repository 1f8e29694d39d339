"""Articles as ordered paragraphs: where they end, and what was lost or changed on the way into an issue."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from itertools import repeat
from operator import add

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.functions import text as X

#: White space and Han characters, for Python.
SPACE = re.compile("[\t-\r\x1c-\x20\x85\xa0  -     　]+")
TOKEN = re.compile("[㐀-䶿一-鿿]|[^\t-\r\x1c-\x20\x85\xa0  -     　㐀-䶿一-鿿]+")
HAN = re.compile("[㐀-䶿一-鿿]")
#: Articles whose paragraphs are Python strings at once.
STEP_ARTICLES = 64
#: Pairs of texts, for each text, that are compared without being looked up.
DIRECT_PAIRS = 16
SAME, MOVED, EDITED, SPLIT, MERGED, LOST = "same", "moved", "edited", "split", "merged", "lost"


def with_ends(paragraphs: DataFrame, key: str, pos: str = "pos", paragraph: str = "paragraph") -> DataFrame:
    """Adds sign_off and is_last: whether a paragraph is a sign-off behind the end of its article, and whether it is the article's last of another kind.

    An article ends with its last paragraph that is neither blank nor looks like a sign-off; only what follows that is one, so a credit or caption within
    the text stays. Paragraphs are judged once, then dealt out by article. Articles of sign-offs alone have no last paragraph and are all sign-offs; null paragraphs count as blank.
    """
    text = F.col(paragraph)
    looks = F.coalesce(X.is_sign_off(text), F.lit(False))
    marked = paragraphs.withColumn("_looks", looks).withColumn("_text", ~F.col("_looks") & ~X.is_blank(text))
    article = Window.partitionBy(key)
    ended = marked.withColumn("_end", F.max(F.when(F.col("_text"), F.col(pos))).over(article))
    behind = F.coalesce(F.col(pos) > F.col("_end"), F.lit(True))
    return ended.select(*paragraphs.columns, (behind & F.col("_looks")).alias("sign_off"), F.coalesce(F.col(pos) == F.col("_end"), F.lit(False)).alias("is_last"))


def without_sign_offs(paragraphs: DataFrame, key: str, pos: str = "pos", paragraph: str = "paragraph") -> DataFrame:
    """The paragraphs without the sign-offs behind each article's end, and without a name or unit in brackets behind the last sentence of its last paragraph."""
    ends = with_ends(paragraphs, key, pos, paragraph).where(~F.col("sign_off"))
    text = F.when(F.col("is_last"), X.strip_sign_off(F.col(paragraph))).otherwise(F.col(paragraph))
    return ends.withColumn(paragraph, text).select(*paragraphs.columns)


def heaviest_chain(pairs: list[tuple[int, int, float]]) -> list[tuple[int, int]]:
    """Of (i, j, weight), those of a chain that increases in i and j and weighs most; by dynamic programming over the pairs in order, with running maxima by j."""
    columns = sorted({j for _, j, _ in pairs})
    tree: list[tuple[float, int]] = [(0.0, -1)] * (len(columns) + 1)
    ordered = sorted(pairs, key=lambda p: (p[0], -p[1]))  # of one i, larger j first: none follows another
    before, total = [], []
    for n, (_, j, weight) in enumerate(ordered):
        k, best = bisect_left(columns, j), (0.0, -1)
        while k:
            best = max(best, tree[k])
            k &= k - 1
        before.append(best[1])
        total.append(best[0] + weight)
        k = bisect_left(columns, j) + 1
        while k < len(tree):
            tree[k] = max(tree[k], (total[n], n))
            k += k & -k
    n = max(range(len(total)), key=total.__getitem__, default=-1)
    out = []
    while n >= 0:
        out.append(ordered[n][:2])
        n = before[n]
    return out[::-1]


def grams(text: str) -> set[tuple[str, int]]:
    """Pairs of neighbouring characters of a text, told apart by how often they came before; a single character is one."""
    seen: Counter = Counter()
    out = set()
    for k in range(max(1, len(text) - 1)):
        g = text[k : k + 2]
        out.add((g, seen[g]))
        seen[g] += 1
    return out


def similar_pairs(one: dict[int, str], two: dict[int, str], percent: int) -> list[tuple[int, int, float]]:
    """(i, j, similarity) of all texts of one and two with a similarity of percent / 100 or more: twice the common grams over all grams.

    Few pairs are compared directly, by how often either has each pair of characters. Of many, such texts share percent / (200 - percent) of either's grams, so with grams in one order, rare ones first, they share one of the first that are left over by this: only those are looked up.
    """
    if len(one) * len(two) <= DIRECT_PAIRS * (len(one) + len(two)):
        return _compared(one, two, percent)
    first, second = {i: grams(t) for i, t in one.items()}, {j: grams(t) for j, t in two.items()}
    often = Counter(g for own in (*first.values(), *second.values()) for g in own)

    def rare(own: set) -> list:
        shared = -(-len(own) * percent // (200 - percent))
        return sorted(own, key=lambda g: (often[g], g))[: len(own) - shared + 1]

    where = defaultdict(list)
    for j, own in second.items():
        for g in rare(own):
            where[g].append(j)
    out = []
    for i, own in first.items():
        for j in {j for g in rare(own) for j in where.get(g, ())}:
            common, both = len(own & second[j]), len(own) + len(second[j])
            if 200 * common >= percent * both:
                out.append((i, j, 2 * common / both))
    return out


def _compared(one: dict[int, str], two: dict[int, str], percent: int) -> list[tuple[int, int, float]]:
    """similar_pairs of all pairs; what two texts have in common is the sum of the smaller counts of each pair of characters, so those of long texts are few."""
    counted = lambda t: Counter(map(add, t, t[1:]) if len(t) > 1 else [t])
    first, second = ([(k, max(1, len(t) - 1), counted(t)) for k, t in side.items()] for side in (one, two))
    out = []
    for i, n, own in first:
        for j, m, other in second:
            if 200 * min(n, m) >= percent * (n + m):
                common = sum(map(min, own.values(), map(other.get, own, repeat(0))))
                if 200 * common >= percent * (n + m):
                    out.append((i, j, 2 * common / (n + m)))
    return out


def _runs(wholes: dict[int, str], parts: dict[int, str]) -> list[tuple[int, list[int]]]:
    """(i, [j, ...]): texts of wholes that are the neighbouring texts j, j + 1, ... of parts, two or more, put together."""
    starts = defaultdict(list)
    for j in sorted(parts):
        if j + 1 in parts:
            starts[parts[j][:8]].append(j)
    out, used = [], set()
    for i in sorted(wholes):
        text = wholes[i]
        for j in sorted({j for n in range(1, 9) for j in starts.get(text[:n], ())}):
            k, at = j, 0
            while k in parts and k not in used and at < len(text) and text.startswith(parts[k], at):
                at += len(parts[k])
                k += 1
            if at == len(text) and k - j > 1:
                out.append((i, list(range(j, k))))
                used.update(range(j, k))
                break
    return out


def aligned(original: Sequence[str], issue: Sequence[str], percent: int = 60) -> list[tuple[str, int | None, float]]:
    """For each original paragraph: (verdict, index in the issue, similarity). Texts are without white space; blank ones aren't compared and are the same.

    Anchors are texts that stand as often on either side, the first with the first and so on, and of these the longest chain in one order, of equally long ones that with most characters; other equal texts between two anchors are matched in order.
    What is left: equal texts elsewhere have moved; a text that neighbouring ones of the issue make up was split, and several that make
    up one of the issue were merged; then, between anchors, texts similar enough are edited ones, by the heaviest chain; others are lost.
    """
    match: dict[int, tuple[str, int, float]] = {}
    ours, theirs = ({k: t for k, t in enumerate(side) if t} for side in (original, issue))
    held, theirs_held = defaultdict(list), defaultdict(list)
    for side, places in ((ours, held), (theirs, theirs_held)):
        for k, t in side.items():
            places[t].append(k)
    alike = [(t, pair) for t, places in held.items() if len(places) == len(theirs_held.get(t, ())) for pair in zip(places, theirs_held[t], strict=True)]
    anchors = heaviest_chain([(i, j, (1 << 40) + len(t)) for t, (i, j) in alike])
    edges = [(-1, -1), *anchors, (len(original), len(issue))]
    for i, j in anchors:
        match[i] = (SAME, j, 1.0)
    free = set(theirs) - {j for _, j in anchors}

    def gaps() -> Iterator[tuple[dict[int, str], dict[int, str]]]:
        for (a, b), (c, d) in zip(edges, edges[1:], strict=False):
            one = {i: ours[i] for i in range(a + 1, c) if i in ours and i not in match}
            two = {j: theirs[j] for j in range(b + 1, d) if j in free}
            if one and two:
                yield one, two

    def take(i: int, verdict: str, js: Sequence[int], share: float) -> None:
        match[i] = (verdict, js[0], share)
        free.difference_update(js)

    for one, two in gaps():
        held = defaultdict(list)
        for j, t in two.items():
            held[t].append(j)
        equal = [(i, j, 1.0) for i, t in one.items() for j in held.get(t, ())] if len(one) * max(map(len, held.values())) <= 4096 else _in_turn(one, held)
        for i, j in heaviest_chain(equal):
            take(i, SAME, [j], 1.0)
    edges[:] = [(-1, -1), *sorted((i, j) for i, (_, j, _) in match.items()), (len(original), len(issue))]
    elsewhere = defaultdict(list)
    for j in sorted(free, reverse=True):
        elsewhere[theirs[j]].append(j)
    for i, t in ours.items():
        if i not in match and elsewhere.get(t):
            take(i, MOVED, [elsewhere[t].pop()], 1.0)
    for one, two in gaps():
        for i, js in _runs(one, two):
            take(i, SPLIT, js, 1.0)
    for one, two in gaps():
        for j, run in _runs(two, one):
            for i in run:
                take(i, MERGED, [j], 1.0)
    for one, two in gaps():
        shares = similar_pairs(one, two, percent)
        known = {(i, j): s for i, j, s in shares}
        for i, j in heaviest_chain(shares):
            take(i, EDITED, [j], known[i, j])
    return [match.get(i, (LOST, None, 0.0) if t else (SAME, None, 1.0)) for i, t in enumerate(original)]


def _in_turn(one: dict[int, str], held: dict[str, list[int]]) -> list[tuple[int, int, float]]:
    """The k-th of equal texts with the k-th on the other side: for texts that stand there very often, in place of all pairs."""
    turn: Counter = Counter()
    out = []
    for i, t in one.items():
        if turn[t] < len(held.get(t, ())):
            out.append((i, held[t][turn[t]], 1.0))
            turn[t] += 1
    return out


def _articles(rows: pa.ListArray) -> Iterator[tuple[list, list[str]]]:
    """(places, texts without white space) of each list of (pos, paragraph), in order; null is an article without paragraphs."""
    for first in range(0, len(rows), STEP_ARTICLES):
        part = rows.slice(first, STEP_ARTICLES)
        values, at = part.flatten(), 0
        places, texts = values.field("pos").to_pylist(), values.field("paragraph").to_pylist()
        for n in pc.fill_null(pc.list_value_length(part), 0).to_pylist():
            own = list(zip(places[at : at + n], texts[at : at + n], strict=True))
            own.sort(key=lambda x: (x[0] is None, x[0] if x[0] is not None else 0, x[1] is None, x[1] or ""))
            yield [p for p, _ in own], ["".join((t or "").split()) for _, t in own]
            at += n


def paragraph_verdicts(originals: DataFrame, issue: DataFrame, key: str, pos: str = "pos", paragraph: str = "paragraph", percent: int = 60) -> DataFrame:
    """(key, pos, verdict, issue_pos, similarity) for each original paragraph that isn't blank: same, edited, split, merged, moved or lost (issue_pos null).

    originals and issue have (key, pos, paragraph); white space doesn't count. Articles are put together by key, a row each with its paragraphs on either side, and each is aligned as a whole in one task (aligned); none is
    compared with another. An article that the issue lacks is lost; rows without key are left out; of rows that repeat key and pos the order is that of their text.
    """
    kinds = {f.name: f.dataType.simpleString() for f in originals.schema}

    def lists(df: DataFrame, name: str) -> DataFrame:
        return df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.collect_list(F.struct(F.col(pos).alias("pos"), F.col(paragraph).alias("paragraph"))).alias(name))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, rows, found = batch.column(1).type.value_type.field("pos").type, [], []
            for i, ((own, texts), (places, issued)) in enumerate(zip(_articles(batch.column(1)), _articles(batch.column(2)), strict=True)):
                for p, t, (verdict, j, share) in zip(own, texts, aligned(texts, issued, percent), strict=True):
                    if t:
                        rows.append(i)
                        found.append((p, verdict, None if j is None else places[j], share))
            made = [pa.array([f[k] for f in found], t) for k, t in enumerate((kind, pa.string(), kind, pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *made], names=[key, "pos", "verdict", "issue_pos", "similarity"])

    schema = f"`{key}` {kinds[key]}, pos {kinds[pos]}, verdict string, issue_pos {kinds[pos]}, similarity double"
    return lists(originals, "one").join(lists(issue, "two"), "_key", "left").select("_key", "one", "two").mapInArrow(align, schema)


def lost_spans(one: Sequence[str], two: Sequence[str]) -> list[tuple[int, int, bool]]:
    """(start, end, replaced): spans of one's tokens (end exclusive) that a longest common run of one and two leaves out, and whether other tokens stand in their place.

    Equal ends are cut off first. Then the furthest reach of each diagonal is followed, for one token left out or put in more at a time (Myers 1986): with d such tokens no alignment leaves the
    diagonals -d to d, so the band is as wide as proven necessary and never cut.
    """
    a, b, start = 0, min(len(one), len(two)), 0
    while start < b and one[start] == two[start]:
        start += 1
    n, m = len(one), len(two)
    while n > start and m > start and one[n - 1] == two[m - 1]:
        n, m = n - 1, m - 1
    reach, trace = {1: start}, []
    for d in range(n + m - 2 * start + 1):
        trace.append(dict(reach))
        for k in range(-d, d + 1, 2):
            x = reach[k + 1] if k == -d or k != d and reach.get(k - 1, -1) < reach.get(k + 1, -1) else reach[k - 1] + 1
            y = x - k
            while x < n and y < m and one[x] == two[y]:
                x, y = x + 1, y + 1
            reach[k] = x
            if x >= n and y >= m:
                break
        else:
            continue
        break
    gone, added, x, y = [], set(), n, m
    for d in range(len(trace) - 1, 0, -1):
        k, before = x - y, trace[d]
        down = k == -d or k != d and before.get(k - 1, -1) < before.get(k + 1, -1)
        a = before[k + 1] if down else before[k - 1] + 1
        x = a if down else a - 1
        y = x - (k + 1 if down else k - 1)
        if down:
            added.add(x)
        else:
            gone.append(x)
    spans: list[list[int]] = []
    for i in sorted(gone):
        if spans and spans[-1][1] == i:
            spans[-1][1] = i + 1
        else:
            spans.append([i, i + 1])
    return [(s, e, any(s <= i <= e for i in added)) for s, e in spans]


def _alike(a: str, b: str) -> int:
    """How many characters a and b have in common in front, found by halves, so that slices are compared and not characters."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        half = (low + high + 1) // 2
        low, high = (half, high) if a[low:half] == b[low:half] else (low, half - 1)
    return low


def _unlike(a: str, b: str) -> tuple[str, str, str]:
    """(what a and b have in common in front, up to white space; what of a and b stands between that and what they have in common behind): whole tokens, as white space parts them.

    The end is cut off only if the first tokens behind the front differ: else more belongs to the front.
    """
    cut = _alike(a, b)
    while cut and not a[cut - 1].isspace():
        cut -= 1
    same, a, b = a[:cut], a[cut:], b[cut:]
    one, two = TOKEN.search(a), TOKEN.search(b)
    if one and two and one[0] != two[0]:
        end = _alike(a[::-1], b[::-1])
        while end and not a[-end].isspace():
            end -= 1
        a, b = a[: len(a) - end], b[: len(b) - end]
    return same, a, b


def omitted_spans(pairs: DataFrame, key: Sequence[str], original: str = "original", issue: str = "issue") -> DataFrame:
    """(key, start, end, lost, replaced) for each span of original that issue lacks: tokens from start to end (exclusive, from 0), their text in between, and whether other tokens stand in their place.

    pairs has key, and an original paragraph and the one of the issue that was paired with it. Tokens are single Han characters, and runs of other characters between white space. A null issue has no tokens, a null original no spans.
    """
    kinds = {f.name: f.dataType.simpleString() for f in pairs.schema}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for i, (a, b) in enumerate(zip(batch.column(len(key)), batch.column(len(key) + 1), strict=True)):
                a, b = a.as_py() or "", b.as_py() or ""
                if a != b:
                    same, a, b = _unlike(a, b)
                    places = [x.span() for x in TOKEN.finditer(a)]
                    before = len(TOKEN.findall(same) if not same.isascii() and HAN.search(same) else same.split())
                    for s, e, replaced in lost_spans([a[x:y] for x, y in places], TOKEN.findall(b)):
                        rows.append(i)
                        found.append((s + before, e + before, a[places[s][0] : places[e - 1][1]], replaced))
            made = [pa.array([f[k] for f in found], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.string(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*[batch.column(k).take(pa.array(rows, pa.int64())) for k in range(len(key))], *made], names=[*key, "start", "end", "lost", "replaced"])

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in key) + ", start int, end int, lost string, replaced boolean"
    return pairs.select(*key, original, issue).mapInArrow(scan, schema)


def removed_or_lost(verdicts: DataFrame, on_purpose: Column) -> DataFrame:
    """Verdicts, with lost paragraphs told apart: removed where on_purpose says so, else omitted."""
    gone = F.when(F.coalesce(on_purpose, F.lit(False)), F.lit("removed")).otherwise(F.lit("omitted"))
    return verdicts.withColumn("verdict", F.when(F.col("verdict") == LOST, gone).otherwise(F.col("verdict")))
