"""How filters interact: what each of them removes, alone and in every order, by vectorised scans of Arrow buffers."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.llm.common import dropped, written

LETTERS = "ABCDE"
#: Bytes that one step scans at most; longer documents go in pieces, cut at white space.
STEP_BYTES = 1 << 20
#: Documents that one step scans at most: their numbers and the word hashes share 64 bits.
STEP_DOCS = 1 << 16
SPACE, CAPITAL, SYMBOL, INSIDE = 1, 2, 4, 8
#: An odd multiplier of the rolling word hash, and that of the finaliser: fixed values.
BASE, MIX = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)
WHITE = re.compile(rb"[\x20\x09-\x0D]")


@lru_cache(maxsize=4)
def byte_classes(symbols: str) -> np.ndarray:
    """For each byte: white space, capital, symbol, or inside a code point; UTF-8 has no byte of an ASCII character elsewhere."""
    out = np.zeros(256, np.uint8)
    out[[0x20, *range(0x09, 0x0E)]] |= SPACE
    out[0x41:0x5B] |= CAPITAL
    out[list(symbols.encode("ascii"))] |= SYMBOL
    out[0x80:0xC0] |= INSIDE
    return out


@lru_cache(maxsize=1)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse, modulo 2**64."""
    both = []
    for base in (BASE, pow(BASE, -1, 2**64)):
        out = np.full(n, base, np.uint64)
        out[0] = 1
        both.append(np.cumprod(out, dtype=np.uint64))
    return both[0], both[1]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, from one prefix sum over all bytes."""
    up, down = powers(1 << max(20, int(len(data)).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * up[: len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    h = (h ^ (h >> np.uint64(32))) * MIX
    return h ^ (h >> np.uint64(29))


def same_words(data: np.ndarray, one: np.ndarray, two: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the words of these sizes at one and two have the same bytes."""
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if len(ends) else 0)
    equal = data[at + np.repeat(one - (ends - sizes), sizes)] == data[at + np.repeat(two - (ends - sizes), sizes)]
    return np.add.reduceat(equal, ends - sizes, dtype=np.int64) == sizes if len(ends) else np.empty(0, bool)


def measures(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of documents that lie one after the other in data: (5, documents) counts of words, distinct words, capitals, symbols and code points;
    and start and end of one word for each distinct one of each document.

    A document's words are sorted by their hashes; neighbours of one hash are compared byte by byte, and if any differ, the document's words
    are sorted as such.
    """
    n = len(offsets) - 1
    kinds = classes[data]
    first, last = offsets[:-1], offsets[1:]
    word = (kinds & SPACE) == 0
    begins, stops = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    stops[:-1] &= ~word[1:]
    full = first < last
    begins[first[full]] = word[first[full]]
    stops[last[full] - 1] = word[last[full] - 1]
    sums = np.zeros(len(data) + 1, np.int64)

    def counted(marks: np.ndarray) -> np.ndarray:
        np.cumsum(marks, out=sums[1:])
        return sums[last] - sums[first]

    n_words, capitals, symbols = counted(begins), counted((kinds & CAPITAL) != 0), counted((kinds & SYMBOL) != 0)
    points = (last - first) - counted((kinds & INSIDE) != 0)
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    owner = np.repeat(np.arange(n), n_words)
    key = (owner.astype(np.uint64) << np.uint64(48)) | (word_hashes(data, starts, ends) >> np.uint64(16))
    order = np.argsort(key, kind="stable")
    equal = key[order][1:] == key[order][:-1]
    left, right = order[:-1][equal], order[1:][equal]
    sizes = ends - starts
    verified = sizes[left] == sizes[right]
    verified[verified] = same_words(data, starts[left[verified]], starts[right[verified]], sizes[left[verified]])
    new = np.ones(len(order), bool)
    new[1:] = ~equal
    for doc in np.unique(owner[left[~verified]]):  # words that share a hash
        of = np.flatnonzero(owner[order] == doc)
        raw = [data[starts[w] : ends[w]].tobytes() for w in order[of]]
        new[of] = [w not in raw[:i] for i, w in enumerate(raw)] if len(raw) < 100 else _firsts(raw)
    kept = order[new]
    distinct = np.bincount(owner[kept], minlength=n)
    return np.stack([n_words, distinct, capitals, symbols, points]), starts[kept], ends[kept]


def _firsts(words: list[bytes]) -> list[bool]:
    seen: set[bytes] = set()
    return [not (w in seen or seen.add(w)) for w in words]


def long_measures(data: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The five counts of one document, in pieces cut at white space; memory beyond a piece is that of its distinct words.

    A word that is longer than a piece is a piece, and not hashed.
    """
    total, seen, at = np.zeros(5, np.int64), set(), 0
    buffer = memoryview(data)
    while at < len(data):
        end = min(at + STEP_BYTES, len(data))
        space = np.flatnonzero(classes[data[at:end]] & SPACE)
        if end < len(data) and len(space):
            end = at + int(space[-1]) + 1
        if end == len(data) or len(space):
            counts, starts, ends = measures(data[at:end], np.array([0, end - at]), classes)
            total += counts[:, 0]
            seen.update(data[at + a : at + b].tobytes() for a, b in zip(starts, ends, strict=True))
        else:
            found = WHITE.search(buffer, end)
            end = found.start() if found else len(data)
            seen.add(data[at:end].tobytes())
            total[0] += 1
            for i in range(at, end, STEP_BYTES):
                kinds = classes[data[i : min(i + STEP_BYTES, end)]]
                total[2:] += [np.count_nonzero(kinds & CAPITAL), np.count_nonzero(kinds & SYMBOL), np.count_nonzero((kinds & INSIDE) == 0)]
        at = end
    total[1] = len(seen)
    return total


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts, and where each begins, with the end of the last; null is empty. Nothing is decoded or copied but where there are nulls."""
    column = column.cast(pa.binary()) if pa.types.is_string(column.type) else column
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def batch_measures(column: pa.Array, classes: np.ndarray) -> np.ndarray:
    """(5, rows) counts of a column of texts: words, distinct words, capitals, symbols, code points."""
    if not len(column):
        return np.empty((5, 0), np.int64)
    data, at = text_buffers(column)
    out, i, n = [], 0, len(column)
    while i < n:
        j = int(np.searchsorted(at, at[i] + STEP_BYTES, side="right")) - 1  # the last row that still ends within a step
        if j <= i:
            out.append(long_measures(data[at[i] : at[i + 1]], classes)[:, None])
            i += 1
            continue
        j = min(j, i + STEP_DOCS, n)
        out.append(measures(data[at[i] : at[j]], at[i : j + 1] - at[i], classes)[0])
        i = j
    return np.concatenate(out, axis=1)


def _scan(symbols: str, least_words: int, distinct_percent: int, capital_percent: int):
    """For mapInArrow over (doc, part, text): (doc, part, mask of A to D, digest of the text)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = byte_classes(symbols)
        for batch in batches:
            words, distinct, capitals, found, points = batch_measures(batch.column(2), classes)
            tests = (words < least_words, 100 * distinct < distinct_percent * words, 100 * capitals > capital_percent * points, found > 0)
            mask = sum((test.astype(np.int32) << i for i, test in enumerate(tests)), np.zeros(len(words), np.int32))
            data, at = text_buffers(batch.column(2)) if len(batch) else (np.empty(0, np.uint8), np.zeros(1, np.int64))
            digests = [hashlib.sha256(data[a:b]).digest() for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(mask), pa.array(digests, pa.binary())], names=["doc", "part", "mask", "digest"]
            )

    return scan


def _bit(letter: Column) -> Column:
    return F.element_at(F.array(*[F.lit(1 << i) for i in range(5)]), F.ascii(letter) - 64)


def filter_audit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    part: str = "source",
    least_words: int = 200,
    distinct_percent: int = 50,
    capital_percent: int = 2,
    symbols: str = "#$%&*|",
) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley): 600 rows for each part.

    Filters, by what fails: A under least_words words (between white space); B fewer distinct words than distinct_percent of them; C more
    capitals A to Z than capital_percent of the code points; D any of symbols; E a text that a row with a smaller key has anywhere in docs,
    whether other filters remove that or not. Each order of the five is applied from left to right; counts are of rows: kept
    after the step, removed by it, redundant (failing its filter, but gone before), unique_fails (failing that filter alone), good_lost and toxic_lost
    (removed, with quality or toxic 1 in labels), shapley (removed by that filter, summed over all orders).

    Texts are scanned once. Each row becomes a mask of the filters it fails; masks are summed up by part, and all orders follow from these 32
    numbers: of the letters of a mask any is first in 120 / their number of the orders. Texts are equal if their SHA-256 are. Of each digest's rows, those with the smallest key pass E;
    the smallest key is a partial aggregate, and the join back is on digest and key, so a large group of copies is spread by its keys.

    Null texts are empty: no words, equal to each other. A null part is the part ''. A row with a null key has no labels, passes E and is no copy's first. Of a key's labels one with the value 1 is enough; rows that repeat
    key and text all pass E if their key is the smallest. An empty docs gives no rows. Longer texts than a step are scanned in pieces.
    """
    given = docs.select(F.col(key).alias("doc"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).alias("text"))
    kind = given.schema["doc"].dataType.simpleString()
    scan = _scan(symbols, least_words, distinct_percent, capital_percent)
    facts = written(given.mapInArrow(scan, f"doc {kind}, part string, mask int, digest binary"), "facts")
    one = lambda c: F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0)))
    known = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("doc")).agg(one("quality").alias("good"), one("toxic").alias("toxic"))
    marked = facts.join(known, "doc", "left").fillna(0, ["good", "toxic"])
    firsts = facts.where("doc IS NOT NULL").groupBy("digest").agg(F.min("doc").alias("doc"))
    stay = marked.join(firsts, ["digest", "doc"], "left_semi")
    copy = F.col("mask").bitwiseOR(F.lit(16))
    row = lambda df, mask, n: df.select("part", mask.alias("mask"), "good", "toxic", F.lit(n).cast("long").alias("n"))
    # each row with a key counts as a copy, and those that are first are moved back
    all_rows = row(marked, F.when(F.col("doc").isNotNull(), copy).otherwise(F.col("mask")), 1)
    each = all_rows.union(row(stay, copy, -1)).union(row(stay, F.col("mask"), 1))
    sums = each.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("bad"))
    sums = written(sums.where("n > 0"), "masks")
    dropped(docs.sparkSession, facts)
    parts = sums.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "bad")).alias("masks"))  # 32 at most
    orders = F.array(*[F.lit("".join(p)) for p in permutations(LETTERS)])
    steps = parts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(5))))
    earlier = sum((F.when(F.col("step") > j, _bit(F.substring("filter_order", j, 1))).otherwise(0) for j in range(1, 5)), F.lit(0))
    steps = steps.withColumns({"own": _bit(F.expr("substring(filter_order, step, 1)")), "earlier": earlier})

    def total(value: str, test) -> Column:
        return F.aggregate("masks", F.lit(0).cast("long"), lambda s, m: s + F.when(test(m["mask"]), m[value]).otherwise(0))

    fails = lambda m: m.bitwiseAND(F.col("own")) != 0
    here = lambda m: fails(m) & (m.bitwiseAND(F.col("earlier")) == 0)
    share = F.aggregate("masks", F.lit(0).cast("long"), lambda s, m: s + F.when(fails(m["mask"]), (m["n"] * F.lit(120) / F.bit_count(m["mask"])).cast("long")).otherwise(0))
    return steps.select(
        "part",
        "filter_order",
        "step",
        total("n", lambda m: m.bitwiseAND(F.col("own").bitwiseOR(F.col("earlier"))) == 0).alias("kept"),
        total("n", here).alias("removed"),
        total("n", lambda m: fails(m) & (m.bitwiseAND(F.col("earlier")) != 0)).alias("redundant"),
        total("n", lambda m: m == F.col("own")).alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("bad", here).alias("toxic_lost"),
        share.alias("shapley"),
    )
