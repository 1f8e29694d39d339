"""How the sources of a language differ in their words: exact shares of terms, compared once for each distinct vector of counts."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.llm.common import dropped, written

#: Terms are runs of ASCII letters and of all characters beyond ASCII: other bytes become spaces, capitals small letters.
FOLDED = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
#: Bytes that are split into terms at once; terms that a task holds before it hands on their counts.
PIECE, HELD = 1 << 22, 200_000
#: Distinct vectors of a part, sources of a block, and counts that a part turns into shares at once.
PART, BLOCK, DENSE = 2_000, 256, 1 << 21
SCALE, PRIOR = 1_000_000_000, 5


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded size."""
    folded, at = text.translate(FOLDED), 0
    while len(folded) - at > PIECE:
        end = folded.rfind(b" ", at + 1, at + PIECE)
        end = end if end >= 0 else folded.find(b" ", at + PIECE)
        if end < 0:
            break
        yield folded[at:end].split()
        at = end
    yield folded[at:].split()


def term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (lang, source, text): (lang, source, term, n, docs), summed up within a task as far as memory allows; a null term for each group that occurs."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def flush():
        for (lang, source), (counts, docs) in held.items():
            n = len(counts) + 1
            names = pa.array([*counts, None], pa.binary()).view(pa.string())
            numbers = [pa.array([*counts.values(), 0], pa.int64()), pa.array([*map(docs.__getitem__, counts), 0], pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), names, *numbers], names=["lang", "source", "term", "n", "docs"])
        held.clear()

    for batch in batches:
        texts = pc.fill_null(batch.column(2).cast(pa.binary()), b"")
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, strict=True):
            counts, docs = held.setdefault((lang, source), (Counter(), Counter()))
            own: set[bytes] = set()
            for some in terms(text.as_py()):
                counts.update(some)
                own.update(some)
            docs.update(own)
        if sum(len(c) for c, _ in held.values()) > HELD:
            yield from flush()
    yield from flush()


def shares(counts: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (counts + PRIOR) / whole) in whole numbers: a thousand at a time, so that no product passes 64 bits."""
    x = counts + PRIOR
    out = x // whole
    for _ in range(3):
        x = x % whole * 1000
        out = out * 1000 + x // whole
    return out + 1


def pair_sums(vectors: pa.Table, sizes: pa.Table) -> pa.Table:
    """For a cogroup by (lang, part, block): (lang, a, b, value) of the sources a of the block with each later one b: the absolute differences of their shares, each
    distinct vector of counts taken as often as terms have it."""
    if not len(vectors) or not len(sizes):
        return pa.table({"lang": pa.array([], pa.string()), "a": pa.array([], pa.int32()), "b": pa.array([], pa.int32()), "value": pa.array([], pa.int64())})
    whole = np.array(sizes["whole"][0].as_py(), np.int64)
    block, n = sizes["block"][0].as_py(), len(whole)
    own = np.arange(block * BLOCK, min(n, (block + 1) * BLOCK))
    at, counts, times = (vectors[c].combine_chunks() for c in ("at", "n", "times"))
    lengths = np.diff(at.offsets.to_numpy())
    at, counts, times = at.flatten().to_numpy(), counts.flatten().to_numpy(), times.to_numpy()
    starts = np.concatenate(([0], np.cumsum(lengths)))
    sums = np.zeros((len(own), n), np.int64)
    step = max(1, DENSE // n)
    for i in range(0, len(lengths), step):
        j = min(i + step, len(lengths))
        dense = np.zeros((j - i, n), np.int64)
        dense[np.repeat(np.arange(j - i), lengths[i:j]), at[starts[i] : starts[j]]] = counts[starts[i] : starts[j]]
        share = shares(dense, whole)
        for k, a in enumerate(own):
            sums[k, a + 1 :] += times[i:j] @ np.abs(share[:, a + 1 :] - share[:, a : a + 1])
    a, b = np.nonzero(np.arange(n) > own[:, None])
    lang = pa.array([sizes["lang"][0].as_py()] * len(a), pa.string())
    return pa.table({"lang": lang, "a": pa.array(own[a].astype(np.int32)), "b": pa.array(b.astype(np.int32)), "value": pa.array(sums[a, b])})


def _share(n: Column, whole: Column) -> Column:
    """shares, as a Column; decimals hold the product."""
    product = (n + PRIOR).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", product, whole.cast("decimal(20,0)")).cast("long") + 1


def source_divergence(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = 30, top: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank): how each source of a language differs from the others, and by which terms.

    Terms are runs of ASCII letters, lower-cased, and characters beyond ASCII; each language keeps those in least_docs of its documents
    or more. A group (language and source) and a language give each kept term p = 1 + floor(10**9 * (count + 5) / (N + 5 * V)), V kept terms, N the sum of the group's or language's counts of
    them. Part 'pair': item is each other source of the language, value the sum of |p - q| over the kept terms, all ranks. Part 'term': item is each kept term that the group has
    and gives more than the language does, value p - q, ranks up to top. Ranks by value, largest first, then item.

    Counts are summed up within tasks before they are dealt out by language, source and term. A term's counts by source are a sparse vector; equal vectors
    are taken together, and each pair of sources is compared once for each distinct vector, times the number of its terms. Vectors are dealt out in parts of bounded size, and sources in blocks, so neither a language with most of the terms
    nor one with very many sources lands in one task. A term has one count for each source, a language one size for each source; the result has a row for each pair of sources.

    Null lang, source and text are ''. Every group that occurs has its pairs, with value 0 where the language keeps no term. Repeated rows count as often as they stand; an empty docs gives no rows; long texts are split in pieces.
    """
    column = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    given = docs.select(column(lang).alias("lang"), column(source).alias("source"), F.col(text).alias("text"))
    raw = given.mapInArrow(term_counts, "lang string, source string, term string, n long, docs long")
    counts = written(raw.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term_counts")
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = written(counts.where("term IS NULL").select("lang", "source", number.alias("at")), "groups")
    each = counts.where("term IS NOT NULL").join(groups, ["lang", "source"])
    vector = F.array_sort(F.collect_list(F.struct("at", "n"))).alias("v")
    kept = each.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("whole_n"), vector).where(F.col("docs") >= least_docs)
    kept = written(kept.select("lang", "term", "whole_n", F.col("v.at").alias("at"), F.col("v.n").alias("n")), "kept")

    entries = kept.select("lang", "term", "whole_n", F.explode(F.arrays_zip("at", "n")).alias("e")).select("lang", "term", "whole_n", "e.*")
    of_lang = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("whole_n").alias("lang_n"))
    of_group = entries.groupBy("lang", "at").agg(F.sum("n").alias("group_n"))
    sizes = groups.join(of_lang, "lang", "left").join(of_group, ["lang", "at"], "left").fillna(0, ["terms", "lang_n", "group_n"])
    smoothed = lambda c: (F.col(c) + PRIOR * F.col("terms")).alias(c.replace("_n", "_whole"))
    sizes = written(sizes.select("lang", "source", "at", smoothed("group_n"), smoothed("lang_n")), "sizes")

    vectors = written(kept.groupBy("lang", "at", "n").agg(F.count("*").alias("times")), "vectors")
    parts = max(1, math.ceil(vectors.count() / PART))
    whole = sizes.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "group_whole"))).alias("w")).select("lang", F.col("w.group_whole").alias("whole"))
    blocks = F.sequence(F.lit(0), F.ceil(F.size("whole") / BLOCK).cast("int") - 1)
    dealt = vectors.withColumn("part", F.pmod(F.xxhash64("at", "n"), F.lit(parts))).join(whole.select("lang", blocks.alias("blocks")), "lang")
    dealt = dealt.select("lang", "at", "n", "times", "part", F.explode("blocks").alias("block"))
    spread = whole.withColumn("block", F.explode(blocks)).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    by = ["lang", "part", "block"]
    partial = dealt.groupBy(*by).cogroup(spread.groupBy(*by)).applyInArrow(pair_sums, "lang string, a int, b int, value long")
    sums = partial.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = sums.select("lang", F.explode(F.array(F.struct(F.col("a").alias("at"), F.col("b").alias("other")), F.struct(F.col("b").alias("at"), F.col("a").alias("other")))).alias("p"), "value")
    both = both.select("lang", "p.at", "p.other", "value")
    name = groups.select("lang", F.col("source").alias("item"), F.col("at").alias("other"))
    pairs = groups.join(name, "lang").where("at <> other").join(both, ["lang", "at", "other"], "left")  # the result's rows
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))

    gain = _share(F.col("n"), F.col("group_whole")) - _share(F.col("whole_n"), F.col("lang_whole"))
    told = entries.join(sizes, ["lang", "at"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gain.alias("value")).where("value > 0")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")).alias("rank")
    out = written(pairs.select("*", rank).union(told.select("*", rank).where(F.col("rank") <= top)), "divergence")
    dropped(docs.sparkSession, counts, groups, kept, sizes, vectors)
    return out
