"""Mixing sources to target weights by weighted fair queueing, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.llm.common import buckets_for, prefix_sums, shown, unit_hash, written

WORD = r"[^\x20\x09-\x0D]+"
#: Words of a document that are queued at once, and a virtual time that no budget reaches: later entries are one range.
QUANTUM, LATEST = 64, 64.0


def word_count(text: Column) -> Column:
    """Words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, source: str, weights: Sequence[float], repeats: int) -> DataFrame:
    """Adds target to (source, source_size, ...): the sources share the sum of all sizes by weight; none gets over repeats times its own.

    Sources by code point, null last, take the weights in turn. What a source can't take is shared out among
    the others by weight until none is above its limit: with sources sorted by limit over weight, the level
    (what is left over the weights left) decides where the limited ones end. One row for each source.
    """
    by_name = Window.orderBy(F.col(source).asc_nulls_last())
    ranked = sizes.withColumn("_rank", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumns({"_weight": weight, "_cap": F.col("source_size") * F.lit(repeats)})
    filled = Window.orderBy(F.col("_cap") / F.col("_weight"), "_rank")
    before, rest, everywhere = filled.rowsBetween(Window.unboundedPreceding, -1), filled.rowsBetween(0, Window.unboundedFollowing), filled.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everywhere) - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    stepped = ranked.withColumns({"_left": left, "_rest": F.sum("_weight").over(rest), "_at": F.row_number().over(filled)})
    free = F.col("_cap") >= F.col("_left") * F.col("_weight") / F.col("_rest")
    opened = stepped.withColumn("_level", F.min(F.when(free, F.struct("_at", "_left", "_rest"))).over(everywhere))
    share = F.col("_level._left") * F.col("_weight") / F.col("_level._rest")
    return opened.select(*sizes.columns, F.when(F.col("_at") < F.col("_level._at"), F.col("_cap").cast("double")).otherwise(share).alias("target"))


def fair_queue(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = (5.0, 2.0, 1.0), repeats: int = 3) -> DataFrame:
    """All rows and columns of df, and size, source_size, target, words_before, virtual_finish.

    The documents of a source queue up in a shuffled order, by the hash of key, MD5 and size. words_before: the
    source's words before the document. virtual_finish: (words_before + size) over the target, when the first copy is
    served; the next copies follow one source_size later each. Null texts have no words; a null source is a source; an empty df gives no rows.
    Columns of df by the names of new ones are replaced.
    """
    new = ["size", "source_size", "target", "words_before", "virtual_finish"]
    kept = [(f"in_{i}", c) for i, c in enumerate(df.columns) if c not in new]
    queued = measured(df, key, text, source, [c for _, c in kept])
    return _queue(queued, weights, repeats).select(*[F.col(i).alias(c) for i, (_, c) in zip((f"in_{n}" for n in range(len(kept))), kept, strict=True)], *new)


def measured(df: DataFrame, key: str, text: str, source: str, kept: Sequence[str]) -> DataFrame:
    """What the queue needs of each row: in_0, in_1, ... (kept), _key, _source, _group (of the source, not null), _digest, size, _position."""
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    given = df.select(*[F.col(c).alias(f"in_{i}") for i, c in enumerate(kept)], F.col(key).alias("_key"), F.col(source).alias("_source"), F.md5(raw).alias("_digest"), word_count(F.col(text)).alias("size"))
    group = F.coalesce(F.concat(F.lit("="), F.col("_source").cast("string")), F.lit(""))
    return given.withColumns({"_group": group, "_position": _position()})


def _position(*more: Column) -> Column:
    """A row's place in the shuffled queue of its source."""
    return unit_hash(F.col("_key"), F.col("_digest"), F.col("size"), *more)


def _queue(rows: DataFrame, weights: Sequence[float], repeats: int) -> DataFrame:
    sizes = rows.groupBy("_source", "_group").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, "_source", weights, repeats).drop("_source")
    queued = prefix_sums(rows, "_group", "_position", ["_key", "_digest"], "size", "words_before", buckets_for(rows.count()))
    finish = F.when(F.col("target") > 0, (F.col("words_before") + F.col("size")) / F.col("target"))
    return queued.join(targets, "_group").withColumn("virtual_finish", finish)


def served(rows: DataFrame, weights: Sequence[float], repeats: int, quantum: int = QUANTUM) -> DataFrame:
    """Of rows (_row, _key, _digest, _source, _group, size, _position): each _row with source_size, target, words_before, virtual_finish, and served: for each copy the
    words that the mix takes (array of repeats longs).

    Every copy of a document joins the queue in entries of quantum words, so that a long document doesn't hold up its source; an entry's virtual
    finish is the source's words up to its end over the target. All entries of all sources are sorted by it, and what is beyond the total budget is cut
    off, inside an entry if need be. The sort is by ranges of virtual time: words in each range are summed up, ranges that begin beyond
    the budget are dropped, and the others are sorted and summed up inside.
    """
    queue = _queue(rows, weights, repeats)
    sums = rows.agg(F.sum("size").alias("words"), F.sum(F.ceil(F.col("size") / quantum)).alias("entries")).first()
    budget, ranges = sums["words"] or 0, buckets_for((sums["entries"] or 0) * repeats)
    copies = queue.where((F.col("size") > 0) & (F.col("target") > 0)).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    cut = copies.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.call_function("div", F.col("size") - 1, F.lit(quantum)))))
    upto = F.least(F.col("size"), (F.col("piece") + 1) * quantum)
    ends = (F.col("words_before") + F.col("copy") * F.col("source_size") + upto) / F.col("target")
    entries = cut.select("_row", "_key", "_digest", "_source", "copy", "piece", (upto - F.col("piece") * quantum).alias("words"), ends.alias("ends"))
    entries = entries.withColumn("_range", F.floor(F.least("ends", F.lit(LATEST)) * ranges))
    totals = entries.groupBy("_range").agg(F.sum("words").alias("total"))
    upto_range = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_range", F.coalesce(F.sum("total").over(upto_range), F.lit(0)).alias("start")).where(F.col("start") < budget)
    earlier = Window.partitionBy("_range").orderBy("ends", F.col("_source").asc_nulls_last(), "_key", "_digest", "copy", "piece").rowsBetween(Window.unboundedPreceding, -1)
    place = F.col("start") + F.coalesce(F.sum("words").over(earlier), F.lit(0))
    taken = entries.join(starts, "_range").withColumn("taken", F.greatest(F.lit(0).cast("long"), F.least("words", F.lit(budget) - place)))
    by_copy = [F.coalesce(F.sum(F.when(F.col("copy") == c, F.col("taken"))), F.lit(0).cast("long")) for c in range(repeats)]
    found = taken.groupBy("_row").agg(F.array(*by_copy).alias("served"))
    none = F.array(*[F.lit(0).cast("long")] * repeats)
    return queue.join(found, "_row", "left").withColumn("served", F.coalesce("served", none))


def mix_words(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = (5.0, 2.0, 1.0), repeats: int = 3) -> DataFrame:
    """(key, source, size, source_size, target, taken, words_before, virtual_finish) of the queue, sorted by virtual_finish, without the texts.

    taken: the words of all copies that the queue serves before the budget is used up (long); documents that the mix leaves out have 0. The texts are read once.
    Rows that repeat key, source and text are counted, and shuffled as so many different ones, so that none of the tasks gets all of them.
    """
    alike = measured(df, key, text, source, [key, source]).groupBy("in_0", "in_1", "_key", "_source", "_group", "_digest", "size").agg(F.count("*").alias("n"))
    rows = alike.withColumn("_nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).drop("n")
    rows = rows.withColumn("_position", F.when(F.col("_nth") == 1, _position()).otherwise(_position(F.col("_nth"))))
    rows = written(rows.withColumn("_row", F.struct("_key", "_source", "_digest", "_nth")), "measured")
    taken = F.aggregate("served", F.lit(0).cast("long"), lambda a, b: a + b)
    queue = served(rows, weights, repeats).withColumn("taken", taken).orderBy(F.col("virtual_finish").asc_nulls_last(), "_key")
    return queue.select(F.col("in_0").alias(key), F.col("in_1").alias(source), "size", "source_size", "target", "taken", "words_before", "virtual_finish")


def mix_documents(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = (5.0, 2.0, 1.0), repeats: int = 3) -> DataFrame:
    """The mix itself: rows and columns of df, once for each copy taken, in order of virtual finish time.

    Whole documents only: a copy across the budget stays if half of its words or more are served before that is used up, so each
    source's words are off its target by about half a document at most. A document without words has no weight and stays once: null, empty and blank texts do.
    A null source is a source; ties of virtual finish go by key. Rows that repeat key, text and source are as many documents. An empty df gives no rows.
    """
    rows = written(measured(df, key, text, source, df.columns).withColumn("_row", F.monotonically_increasing_id()), "measured")
    queue = served(rows.select("_row", "_key", "_digest", "_source", "_group", "size", "_position"), weights, repeats)
    copies = queue.select("_row", "virtual_finish", "source_size", "target", "size", F.posexplode("served").alias("copy", "taken"))
    whole = F.when(F.col("size") == 0, F.col("copy") == 0).otherwise(2 * F.col("taken") >= F.col("size"))
    finish = F.coalesce(F.col("virtual_finish") + F.col("copy") * F.col("source_size") / F.when(F.col("target") > 0, F.col("target")), F.lit(0.0))
    kept = copies.where(whole).select("_row", finish.alias("finish"))
    return shown(rows.join(kept, "_row").orderBy("finish", "_key"), df)
