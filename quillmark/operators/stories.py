"""Stories: items that tell the same, by their texts, and the one of each that is picked."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.operators.selecting import preferred
from quillmark.sources.sinks import kept

#: Odd multipliers of the 64-bit finaliser, and one for the places of words: fixed values.
MIX_A, MIX_B, GOLDEN = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), 0x9E3779B97F4A7C15
#: Words that one step over a batch holds at most (or one longer text), for bounded memory.
STEP_WORDS = 1_000_000
#: Runs are counted in so many slots (a power of two) by their first bits: a table of fixed size, whose levels (8 for each doubling) every task gets. It only orders the runs of a set.
SLOT_BITS, BLOCKS = 22, 64
#: Bits of a set's sketch for each run, at least, and the fewest. Each run turns one bit over, so that no more bits differ between two sets than runs do.
SKETCH_BITS, LEAST_BITS = 4, 512
#: Of the rarest runs of a set, those by which it meets others before all are tried.
FIRST_RUNS = 8


def word_numbers(text: Column) -> Column:
    """A 64-bit number for each word of a text, in order; null texts have none."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda x: x != ""), lambda x: F.xxhash64(x))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * MIX_A
    h = (h ^ (h >> np.uint64(33))) * MIX_B
    return h ^ (h >> np.uint64(33))


def _steps(column: pa.ListArray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row behind, values, rows' lengths) of pieces of a column of arrays of 64-bit numbers, none of them null: STEP_WORDS each or one row."""
    ends = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).view(np.uint64)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + STEP_WORDS, side="right")) - 1)
        yield at, to, values[ends[at] : ends[to]], np.diff(ends[at : to + 1]).astype(np.int64)
        at = to


def _inside(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The row of each of so many values in a row, and the value's place in it."""
    return np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def runs_of(words: np.ndarray, n: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct runs of `size` words of texts of n words each, sorted within a text, and how many each text has; a text of fewer words is one run, one without words none."""
    row, place = _inside(np.where(n > 0, np.maximum(n - size + 1, 1), 0))
    first, length = (np.cumsum(n) - n)[row] + place, np.minimum(n, size)[row]
    total = length.astype(np.uint64)
    for k in range(size):
        word = words[np.minimum(first + k, len(words) - 1)]
        total += np.where(k < length, _mixed(word * np.uint64((GOLDEN * (2 * k + 1)) % 2**64 | 1) + np.uint64(k)), np.uint64(0))
    runs = _mixed(total)
    ends = np.searchsorted(row, np.arange(len(n) + 1))
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        runs[a:b].sort()
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:] != runs[:-1]) | (row[1:] != row[:-1])
    return runs[new], np.bincount(row[new], minlength=len(n))


def _lists(values: np.ndarray, n: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32)), pa.array(values.view(np.int64)))


def _run_rows(size: int):
    """For mapInArrow over (key, words): (key, _h1, _h2, grams): a text's runs, and two numbers that tell its set of them; texts without words are left out."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, words, n in _steps(batch.column(1)):
                runs, held = runs_of(words, n, size)
                some = np.flatnonzero(held)
                if not len(some):
                    continue
                starts = (np.cumsum(held) - held)[some]
                marks = [pa.array(_mixed(np.add.reduceat(_mixed(runs ^ salt), starts)).view(np.int64)) for salt in (MIX_A, MIX_B)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at).take(pa.array(some)), *marks, _lists(runs, held[some])], names=["_key", "_h1", "_h2", "grams"])

    return scan


def rarest(runs: np.ndarray, n: np.ndarray, levels: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Of sets of n sorted runs each: the first ones by level, then number, as many as a similar set can lack and one; and how many each set has of these."""
    most, ends = np.minimum(n, n - (n * percent + 99) // 100 + 1), np.cumsum(n)
    level = levels[(runs >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
    order = [a + np.argsort(level[a:b], kind="stable")[:m] for a, b, m in zip((ends - n).tolist(), ends.tolist(), most.tolist())]
    return runs[np.concatenate(order)], most


def sketches(runs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sets of n runs each: whether an even number of runs falls to a bit, in numbers of 64 bits; and how many numbers each set has, a power of two."""
    out, ends = [], np.cumsum(n)
    for a, b in zip((ends - n).tolist(), ends.tolist()):
        bits = 1 << (max(SKETCH_BITS * (b - a), LEAST_BITS) - 1).bit_length()
        odd = np.bincount((runs[a:b] & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
        out.append(np.packbits(odd.astype(np.uint8)).view(np.uint64))
    return np.concatenate(out), np.fromiter(map(len, out), np.int64, len(out))


def fewest_differences(one: np.ndarray, two: np.ndarray) -> int:
    """How many runs two sets differ in at least, by their sketches: the larger is folded to the size of the smaller."""
    one, two = sorted((one, two), key=len)
    return int(np.bitwise_count(one ^ np.bitwise_xor.reduce(two.reshape(-1, len(one)), axis=0)).sum())


def _near_rows(percent: int):
    """For mapInArrow over (a, b, n_a, n_b, bits_a, bits_b): (a, b) of pairs that may be similar, by sizes and sketches."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = (batch.column(k).to_numpy().astype(np.int64) for k in (2, 3))
            near = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
            ones, twos = ((c.offsets.to_numpy(), c.values.to_numpy(zero_copy_only=False).view(np.uint64)) for c in (batch.column(4), batch.column(5)))
            for i in np.flatnonzero(near).tolist():
                one, two = (v[e[i] : e[i + 1]] for e, v in (ones, twos))
                near[i] = (100 + percent) * fewest_differences(one, two) <= (100 - percent) * int(n_a[i] + n_b[i])
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(near)) for k in (0, 1)], names=["a", "b"])

    return scan


def _rare_rows(levels, percent: int):
    """For mapInArrow over (id, grams): (id, n, keys, bits): how many runs a set has, the rarest of them in order, and its sketch."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, runs, n in _steps(batch.column(1)):
                keys, most = rarest(runs, n, levels.value, percent)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), pa.array(n.astype(np.int32)), _lists(keys, most), _lists(*sketches(runs, n))], names=["id", "n", "keys", "bits"])

    return scan


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (grams): (block, counts): a task's runs by slot, in blocks of slots."""
    counts, any_ = np.zeros(1 << SLOT_BITS, np.uint32), False
    for batch in batches:
        for _, _, runs, _ in _steps(batch.column(0)):
            np.add.at(counts, (runs >> np.uint64(64 - SLOT_BITS)).astype(np.int64), np.uint32(1))
            any_ = True
    if any_:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BLOCKS, dtype=np.int32)), pa.array([c.tobytes() for c in np.split(counts, BLOCKS)], pa.binary())], names=["block", "counts"])


def _levelled(rows: pa.Table) -> pa.Table:
    """The counts of a block, summed up over tasks, as levels."""
    total = sum(np.frombuffer(x.as_py(), np.uint32).astype(np.float64) for x in rows.column("counts"))
    levels = np.minimum(np.log2(np.maximum(total, 1)) * 8, 255).astype(np.uint8)
    return pa.table({"block": rows.column("block")[:1], "levels": pa.array([levels.tobytes()], pa.binary())})


def _levels(marked: DataFrame) -> np.ndarray:
    """How frequent the runs of a slot are together: a byte for each slot, 8 to a doubling."""
    blocks = marked.select("grams").mapInArrow(_counted, "block int, counts binary").groupBy("block").applyInArrow(_levelled, "block int, levels binary")
    return np.frombuffer(b"".join(x["levels"] for x in sorted(blocks.collect(), key=lambda x: x["block"])) or bytes(1 << SLOT_BITS), np.uint8)


def closure(edges: DataFrame) -> DataFrame:
    """(id, root) for each vertex of edges (a, b): the smallest vertex that edges lead to.

    Each round, every vertex takes the smallest label of itself and its neighbours, then its label's label; a round is a table, and only sums tell whether another is needed. Labels reach twice as far with each round or so.
    """
    both = kept(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    now = kept(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root")).withColumnRenamed("a", "id"), "labels")
    while True:
        told = both.join(now.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("root").alias("least"))
        near = now.join(told, "id", "left").select("id", F.least("root", F.coalesce("least", "root")).alias("root"))
        far = near.select(F.col("id").alias("root"), F.col("root").alias("further"))
        then = kept(near.join(far, "root", "left").select("id", F.least("root", F.coalesce("further", "root")).alias("root")), "labels")
        changed = not now.join(then.withColumnRenamed("root", "new"), "id").where("root <> new").isEmpty()
        now = then
        if not changed:
            return now


def _verified(pairs: DataFrame, rare: DataFrame, marked: DataFrame, percent: int) -> DataFrame:
    """Those of pairs (a, b) that are similar: sketches tell most others, the full sets of what they leave tell the rest."""
    one, two = (rare.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}")) for c in "ab")
    each = kept(pairs, "pairs").join(one, "a").join(two, "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
    near = kept(each.mapInArrow(_near_rows(percent), "a long, b long"), "near")
    wanted = kept(near.select(F.col("a").alias("id")).union(near.select("b")).distinct(), "wanted")
    sets = marked.select("id", "grams").join(wanted, "id", "left_semi")
    one, two = (sets.select(F.col("id").alias(c), F.col("grams").alias(f"of_{c}")) for c in "ab")
    common, sizes = F.size(F.array_intersect("of_a", "of_b")), F.size("of_a") + F.size("of_b")
    return kept(near.join(one, "a").join(two, "b").where(100 * common >= percent * (sizes - common)).select("a", "b"), "links")


def _ordered(one: Column, two: Column) -> list[Column]:
    return [F.least(one, two).alias("a"), F.greatest(one, two).alias("b")]


def _to_leaders(rare: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of the smallest set of each of the first runs and the others that have it among theirs."""
    few = rare.select("id", F.slice("keys", 1, FIRST_RUNS).alias("few")).join(sets.select("id"), "id", "left_semi")
    few = kept(few.select("id", F.explode("few").alias("gram")), "few")
    leaders = kept(few.groupBy("gram").agg(F.min("id").alias("leader"), F.max("id").alias("last")).where("leader <> last").select("gram", "leader"), "leaders")
    return few.join(leaders, "gram").where("id <> leader").select(*_ordered(F.col("id"), F.col("leader"))).distinct()


def _across(rare: DataFrame, rooted: DataFrame, percent: int) -> DataFrame:
    """Pairs in different chains that share one of their rarest runs, with enough behind the first that they share."""
    own = rare.join(rooted.select("id", "root"), "id").select("id", "root", F.posexplode("keys").alias("at", "gram"))
    mixed = kept(own.groupBy("gram").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("gram"), "mixed")
    each = rare.join(rooted.select("id"), "id", "left_semi").select("id", F.posexplode("keys").alias("at", "gram"))
    open_ = kept(each.join(mixed, "gram", "left_semi").select("gram", "id", "at"), "open")
    open_ = kept(open_.join(rare.select("id", "n").join(rooted.select("id", "root"), "id"), "id"), "open")
    one, two = open_.alias("a"), open_.alias("b")
    # of either set, what is left from the first shared run on must be as much as the two would have to share
    enough = [(100 + percent) * (F.col(f"{x}.n") - F.col(f"{x}.at")) >= percent * (F.col("a.n") + F.col("b.n")) for x in "ab"]
    return one.join(two, (F.col("a.gram") == F.col("b.gram")) & (F.col("a.root") < F.col("b.root")) & enough[0] & enough[1]).select(*_ordered(F.col("a.id"), F.col("b.id"))).distinct()


def with_stories(items: DataFrame, key: str, text: str, size: int = 3, percent: int = 60) -> DataFrame:
    """Adds story: the smallest key of the items whose texts a chain of similar ones joins; similar: of the runs of `size` words that either has, percent or more are in both.

    Equal sets are one vertex. With runs in one order for all, two similar sets share one of the first of each (as many as can be missing, and one): which order that is decides nothing, and rare runs first bring few sets together. So sets are
    brought together by these alone: first by the very first ones, with one set of each run, then, where a run still joins sets of different chains, all pairs of these that have enough runs behind it. Every pair is verified on the full sets, and none that is
    similar is lost. Runs are shuffled to be counted, by slots; sets themselves only to be verified. Null texts and those without words are stories of their own, and so are items without key; rows that repeat a key are one item, with the smallest of their stories.
    """
    spark = items.sparkSession
    given = items.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), word_numbers(F.col(text)).alias("words"))
    kind = given.schema["_key"].dataType.simpleString()
    found = given.mapInArrow(_run_rows(size), f"_key {kind}, _h1 long, _h2 long, grams array<long>")
    marked = kept(found.withColumn("id", F.monotonically_increasing_id()), "marked")
    sets = kept(marked.groupBy("_h1", "_h2").agg(F.min("_key").alias("least"), F.min("id").alias("id")), "sets")
    levels = spark.sparkContext.broadcast(_levels(marked))
    rare = kept(marked.select("id", "grams").mapInArrow(_rare_rows(levels, percent), "id long, n int, keys array<long>, bits array<long>"), "rare")
    near = _verified(_to_leaders(rare, sets), rare, marked, percent)
    roots = closure(near)
    rooted = kept(sets.join(roots, "id", "left").select("id", F.coalesce("root", "id").alias("root")), "rooted")
    more = _verified(_across(rare, rooted, percent), rare, marked, percent)
    if not more.isEmpty():
        roots = closure(near.union(more))
    chained = sets.join(roots, "id", "left").select("_h1", "_h2", "least", F.coalesce("root", "id").alias("root"))
    told = chained.groupBy("root").agg(F.min("least").alias("_story"))
    story = marked.select("_key", "_h1", "_h2").join(chained.join(told, "root"), ["_h1", "_h2"]).groupBy("_key").agg(F.min("_story").alias("_story"))
    return items.join(story, F.col(key) == F.col("_key"), "left").select(*items.columns, F.coalesce("_story", F.col(key)).alias("story"))


def story_picks(items: DataFrame, key: str, text: str, priority: str, size: int = 3, percent: int = 60) -> DataFrame:
    """One item of each story (with_stories): that of the lowest priority number, then key; all columns, and story. Items without key are left out."""
    return preferred(with_stories(items.where(F.col(key).isNotNull()), key, text, size, percent), "story", priority, key)
