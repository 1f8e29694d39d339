"""Benchmark decontamination with a generalised suffix automaton of the normalised test items."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.llm.common import hidden, hidden_name, new_table, shown, written

#: Bytes that belong to words, A-Z turned to a-z; all others become spaces.
TO_WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: runs of ASCII letters and digits and of all other characters beyond ASCII; null has none."""
    return text.encode("utf-8", "surrogatepass").translate(TO_WORDS).split() if text else []


#: No state, no word, no length that a match could have.
NONE, NO_WORD, NEVER = -1, -2, (1 << 31) - 1


class SuffixAutomaton:
    """Of several items' words, in arrays of 32-bit numbers: some 40 bytes for each word, and the distinct words themselves.

    A state's first transition is in word and to; only states with more have a dictionary in more. need[s]: the shortest match in state s
    that ends a window; named[s]: where in names the items are whose windows end there (longer states point to the one of `window` words).
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int) -> None:
        self.window, self.words = window, {}
        self.word, self.to, self.link, self.length = array("i", [NO_WORD]), array("i", [NONE]), array("i", [NONE]), array("i", [0])
        self.more: dict[int, dict[int, int]] = {}
        ends: dict[int, set[str | None]] = {}
        short: dict[int, list[tuple[int, str | None]]] = {}
        for name, words in items:
            last = 0
            for w in words:
                last = self._extend(last, self.words.setdefault(w, len(self.words)))
                ends.setdefault(last, set()).add(name)
            if 0 < len(words) < window:
                short.setdefault(last, []).append((len(words), name))
        link, length = self.link, self.length
        by_length = sorted(range(1, len(link)), key=length.__getitem__)
        # items that contain a state's strings: those of the states below it in the link tree; kept where a window can end
        self.names: list[tuple] = [()]
        self.named = array("i", bytes(4 * len(link)))
        numbers: dict[tuple, int] = {(): 0}
        for s in reversed(by_length):
            own = ends.pop(s, ())
            if length[s] >= window:
                if length[link[s]] < window:
                    own = tuple(sorted(own, key=lambda x: (x is None, x or "")))
                    self.named[s] = numbers.setdefault(own, len(self.names))
                    if self.named[s] == len(self.names):
                        self.names.append(own)
                else:
                    ends.setdefault(link[s], set()).update(own)
        self.need, self.short = array("i", [NEVER]) * len(link), {}
        for s in by_length:
            up = link[s]
            if s in short or up in self.short:
                self.short[s] = (*short.get(s, ()), *self.short.get(up, ()))
            if length[up] >= window:
                self.named[s] = self.named[up]
            self.need[s] = min([*(m for m, _ in self.short.get(s, ())), *([window] if length[s] >= window else [])], default=NEVER)

    def _new(self, length: int, link: int) -> int:
        for numbers, n in ((self.word, NO_WORD), (self.to, NONE), (self.link, link), (self.length, length)):
            numbers.append(n)
        return len(self.link) - 1

    def _next(self, s: int, w: int) -> int:
        if self.word[s] == w:
            return self.to[s]
        return self.more[s].get(w, NONE) if s in self.more else NONE

    def _lead(self, s: int, w: int, to: int) -> None:
        if self.word[s] in (w, NO_WORD):
            self.word[s], self.to[s] = w, to
        else:
            self.more.setdefault(s, {})[w] = to

    def _split(self, p: int, w: int, q: int) -> int:
        """A copy of q for its strings that also follow p."""
        copy = self._new(self.length[p] + 1, self.link[q])
        self.word[copy], self.to[copy] = self.word[q], self.to[q]
        if q in self.more:
            self.more[copy] = dict(self.more[q])
        self.link[q] = copy
        while p != NONE and self._next(p, w) == q:
            self._lead(p, w, copy)
            p = self.link[p]
        return copy

    def _extend(self, last: int, w: int) -> int:
        q = self._next(last, w)
        if q != NONE:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
        new, p = self._new(self.length[last] + 1, 0), last
        while p != NONE and (q := self._next(p, w)) == NONE:
            self._lead(p, w, new)
            p = self.link[p]
        if p != NONE:
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return new

    def matches(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of words (end exclusive, in order, apart) inside occurrences of windows, and the items with an id that have these."""
        word, to, more, link, length, need, window = self.word, self.to, self.more, self.link, self.length, self.need, self.window
        known, none = self.words.get, {}
        found: list[tuple[int, int]] = []
        states: set[tuple[int, int]] = set()
        state = matched = 0
        for i, w in enumerate(words):
            w = known(w, NONE)
            if w == NONE:
                state = matched = 0
                continue
            at = to[state] if word[state] == w else more.get(state, none).get(w, NONE)
            if at == NONE:  # the root has all words, so that this ends
                while at == NONE:
                    state = link[state]
                    at = to[state] if word[state] == w else more.get(state, none).get(w, NONE)
                matched = length[state]
            state = at
            matched += 1
            if matched >= need[state]:
                found.append((i + 1 - max(window * (matched >= window and length[state] >= window), max((m for m, _ in self.short.get(state, ()) if m <= matched), default=0)), i + 1))
                states.add((state, min(matched, window)))
        items: set[str | None] = set()
        for s, n in states:
            if n >= window:
                items.update(self.names[self.named[s]])
            items.update(name for m, name in self.short.get(s, ()) if m <= n)
        items.discard(None)
        return merged(found), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def item_blocks(benchmark: DataFrame, item_id: str, text: str, most_words: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The items with words, in blocks of most_words words at most (or of one longer item)."""
    block, size = [], 0
    for row in benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t")).toLocalIterator():
        words = words_of(row["t"])
        if words:
            if size and size + len(words) > most_words:
                yield block
                block, size = [], 0
            block.append((row["i"], words))
            size += len(words)
    if block:
        yield block


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 13, most_words: int = 500_000) -> DataFrame:
    """All rows and columns of docs, and n_words, hit_spans, hit_items.

    A window is `window` consecutive words of an item; an item of fewer words is one window. hit_spans: spans of
    words inside occurrences of windows (start, end exclusive; apart and in order). hit_items: ids of the items with
    occurring windows (distinct, sorted as strings). Longest matches against a suffix automaton give both in one pass over a text.
    Items go to the executors in blocks of most_words words (or one longer item), one block after another, so that driver and workers hold one block's automaton at a time, however
    large the benchmark is. With several blocks, docs are numbered and written once, each block's pass writes the hits of its rows alone, and these are joined back at the end. Null and empty texts have no words; items without words are left out; repeated item ids count once.
    Items with a null id have windows like the others, but hit_items doesn't name them.
    Columns of docs by the names of new ones are replaced.
    """
    return _found(docs, benchmark, text, item_id, item_text, window, most_words)


SPANS = "array<struct<start:long,end:long>>"
SPAN_LIST, ITEM_LIST = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.list_(pa.string())


def _found(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 13, most_words: int = 500_000, longest: int | None = None) -> DataFrame:
    """contaminated_spans; with longest, spans of so many words or more are cut out of the texts."""
    spark = docs.sparkSession
    own = docs.drop("n_words", "hit_spans", "hit_items")
    filled = own.withColumns({"n_words": F.lit(None).cast("long"), "hit_spans": F.lit(None).cast(SPANS), "hit_items": F.lit(None).cast("array<string>")})
    blocks = item_blocks(benchmark, item_id, item_text, most_words)
    block, following = next(blocks, []), next(blocks, None)
    if following is None:
        automaton = spark.sparkContext.broadcast(SuffixAutomaton(block, window))
        return filled.mapInArrow(_scan(automaton, text, longest), filled.schema)
    numbered = written(own.select(F.monotonically_increasing_id().alias("_row"), *own.columns), "numbered")
    place = new_table(spark, "hits")
    for block in chain([block, following], blocks):
        automaton = spark.sparkContext.broadcast(SuffixAutomaton(block, window))
        hits = numbered.select("_row", text).mapInArrow(_hits(automaton), f"_row long, hit_spans {SPANS}, hit_items array<string>")
        hits.write.mode("append").parquet(place)
        automaton.unpersist()
    hits = spark.read.schema(hits.schema).parquet(place)
    each = hits.groupBy("_row").agg(F.flatten(F.collect_list("hit_spans")).alias("hit_spans"), F.flatten(F.collect_list("hit_items")).alias("hit_items"))
    joined = numbered.join(each, "_row", "left").select(*own.columns, F.lit(None).cast("long").alias("n_words"), "hit_spans", "hit_items")
    return joined.mapInArrow(_scan(None, text, longest), filled.schema)


def _hits(automaton):
    """For mapInArrow over (row, text): (row, hit_spans, hit_items) of the rows that have hits of one block's automaton."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = automaton.value.matches
        for batch in batches:
            found = [(row, *match(words_of(value.as_py()))) for row, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)]
            found = [x for x in found if x[1]]
            spans = [[{"start": a, "end": b} for a, b in hit] for _, hit, _ in found]
            columns = [pa.array([x[0] for x in found], pa.int64()), pa.array(spans, SPAN_LIST), pa.array([sorted(x[2]) for x in found], ITEM_LIST)]
            yield pa.RecordBatch.from_arrays(columns, names=["_row", "hit_spans", "hit_items"])

    return scan


def _scan(automaton, text: str, longest: int | None):
    """For mapInArrow: fills in n_words, hit_spans and hit_items from an automaton, or, without one, from the hits that the rows carry; cuts spans of longest words or more."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            column = batch.column(names.index(text))
            counts, spans, items, texts = [], [], [], {}
            carried = zip(batch.column(names.index("hit_spans")), batch.column(names.index("hit_items")), strict=True)
            for i, (value, (old_spans, old_items)) in enumerate(zip(column, carried, strict=True)):
                words = words_of(value.as_py())
                if automaton is None:
                    hit, named = merged([(x["start"], x["end"]) for x in old_spans.as_py() or ()]), set(old_items.as_py() or ())
                else:
                    hit, named = automaton.value.matches(words)
                if longest is not None and (long_ := [x for x in hit if x[1] - x[0] >= longest]):
                    texts[i] = without_spans(value.as_py(), long_)
                counts.append(len(words))
                spans.append([{"start": a, "end": b} for a, b in hit])
                items.append(sorted(named))
            made = {"n_words": pa.array(counts, pa.int64()), "hit_spans": pa.array(spans, SPAN_LIST), "hit_items": pa.array(items, ITEM_LIST)}
            if texts:
                made[text] = pa.array([texts.get(i, x) for i, x in enumerate(column.to_pylist())], column.type)
            yield pa.RecordBatch.from_arrays([made.get(n, c) for n, c in zip(names, batch.columns, strict=True)], names=names)

    return scan


def hit_words() -> Column:
    """Words inside hit_spans."""
    return F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])


def is_contaminated(most_words: int = 0, coverage: int = 20) -> Column:
    """Whether a document's hit words exceed most_words and make up one in `coverage` of its words at least."""
    return (hit_words() > most_words) & (hit_words() * coverage >= F.col("n_words"))


def items_digest() -> Column:
    return F.sha2(F.array_join("hit_items", ",").cast("binary"), 256)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", longest: int | None = None, **options) -> DataFrame:
    """The documents of docs within the coverage limit (is_contaminated), with the columns of docs.

    longest: from those that stay, spans of hits of so many words or more are cut out (None: texts stay as they are). Null and empty texts stay; repeated rows are judged alike.
    """
    found = _found(hidden(docs), benchmark, hidden_name(docs, text), longest=longest, **options)
    return shown(found.where(~is_contaminated()), docs)


def without_spans(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """A text without the given spans of words, and without what stands between the words of a span."""
    if not text or not spans:
        return text
    raw = text.encode("utf-8", "surrogatepass")
    places, at = [], 0
    clear = raw.translate(TO_WORDS)
    for w in clear.split():
        at = clear.index(w, at)
        places.append((at, at + len(w)))
        at += len(w)
    out, done = [], 0
    for a, b in spans:
        out.append(raw[done : places[a][0]])
        done = places[b - 1][1]
    return b"".join([*out, raw[done:]]).decode("utf-8", "surrogatepass")


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", longest: int = 13, **options) -> DataFrame:
    """All rows and columns of docs; spans of hits of `longest` words or more are cut out of the texts. Null and empty texts stay as they are."""
    return shown(_found(hidden(docs), benchmark, hidden_name(docs, text), longest=longest, **options), docs)


def brute_force(docs: list[str | None], items: list[tuple[str, str | None]], window: int = 13) -> list[tuple[int, int, list[str]]]:
    """n_words, n_hit and items of each document by comparing all windows; for tests."""
    out = []
    split = [(i, words_of(t)) for i, t in items]
    for doc in docs:
        words, hit, named = words_of(doc), set(), set()
        for i, item in split:
            n = min(window, len(item))
            for w in {tuple(item[k : k + n]) for k in range(len(item) - n + 1)} if n else ():
                for k in range(len(words) - n + 1):
                    if tuple(words[k : k + n]) == w:
                        hit.update(range(k, k + n))
                        named.add(i)
        out.append((len(words), len(hit), sorted(named)))
    return out


def sha256_of(names: list[str]) -> str:
    return hashlib.sha256(",".join(names).encode()).hexdigest()
