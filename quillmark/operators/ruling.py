"""Many rules against many texts: postings of what a rule's matches must hold, equality joins with the texts' n-grams, patterns tried on candidates alone."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of the n-grams by which rules are looked up, longest first; a number holds an n-gram and, above it, its size.
SIZES = (6, 3, 2, 1)
#: Bits of the places of a filter that tells n-grams which no rule has; bytes of text and rows that are looked at at once; bits of an n-gram's number.
FILTER_BITS, STEP_BYTES, STEP_ROWS, GRAM_BITS = 20, 1 << 18, 1 << 12, 51
#: ASCII capitals as small letters; an odd multiplier that spreads n-grams over the filter.
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def mandatory(pattern: str) -> set[str] | None:
    """Strings, ASCII letters in lower case, one of which every match holds; None if there are none to be told (the pattern may match without any, or can't be read)."""
    try:
        parsed = re._parser.parse(pattern)  # the standard library's own reading of the pattern
    except (re.error, OverflowError, RecursionError):
        return None
    return _of_sequence(parsed)


def _of_sequence(items) -> set[str] | None:
    """The best of what the items of a sequence must hold: that with the longest shortest string."""
    runs, found = [""], []
    for op, value in items:
        name = str(op)
        if name == "LITERAL":
            runs[-1] += chr(value)
            continue
        if name == "SUBPATTERN":
            inner = list(value[3])
            if all(str(o) == "LITERAL" for o, _ in inner):
                runs[-1] += "".join(chr(v) for _, v in inner)
                continue
            found.append(_of_sequence(inner))
        elif name == "BRANCH":
            each = [_of_sequence(branch) for branch in value[1]]
            found.append(None if None in each else set().union(*each))
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and value[0] > 0:
            found.append(_of_sequence(value[2]))
        if name != "AT":
            runs.append("")
    found += [{run.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")} for run in runs if run]
    found = [x for x in found if x and all(x)]
    return max(found, key=lambda x: (min(map(len, x)), -len(x)), default=None)


def numbers(data: np.ndarray, size: int) -> np.ndarray:
    """The n-grams of so many bytes of lower-cased bytes, as numbers."""
    out = np.full(max(0, len(data) - size + 1), size, np.uint64)
    for k in range(size):
        out = (out << np.uint64(8)) | data[k : k + len(out)]
    return out


def probe(literal: str) -> int:
    """The n-gram of a literal by which it is looked up: its last bytes, as many as SIZES has at most."""
    raw = literal.encode("utf-8", "surrogatepass")
    size = next(n for n in SIZES if n <= len(raw))
    return int(numbers(np.frombuffer(raw[-size:], np.uint8), size)[0])


def postings(rules: DataFrame, pattern: str = "pattern") -> DataFrame:
    """rules with probe (long): a row for each n-gram of which a text must have one for the rule to match; rules without any have 0, which every text has. Null patterns have none."""
    schema = rules.select("*", F.lit(0).cast("long").alias("probe")).schema
    names = rules.columns
    at = names.index(pattern)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({probe(x) for x in mandatory(p) or ()} or {0}) if p is not None else [] for p in batch.column(at).to_pylist()]
            rows = pa.array([i for i, x in enumerate(found) for _ in x], pa.int64())
            yield pa.RecordBatch.from_arrays([*[c.take(rows) for c in batch.columns], pa.array([g for x in found for g in x], pa.int64())], names=[*names, "probe"])

    return rules.mapInArrow(scan, schema)


def _slot(grams: np.ndarray) -> np.ndarray:
    return (grams * SPREAD) >> np.uint64(64 - FILTER_BITS)


def _found(table: np.ndarray, at: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, n-gram), once each and in order of rows, of the n-grams whose places in the filter are known; at: where the STEP_ROWS rows at most begin and end. What is held at once follows STEP_BYTES."""
    pairs = [np.empty(0, np.uint64)]
    for start in range(int(at[0]), int(at[-1]), STEP_BYTES):
        part = LOWER[whole[start : min(start + STEP_BYTES + SIZES[0] - 1, int(at[-1]))]]
        for size in SIZES:
            own = numbers(part, size)[:STEP_BYTES]
            hit = np.flatnonzero(table[_slot(own)])
            row = np.searchsorted(at, hit + start, side="right") - 1
            inside = hit + start + size <= at[row + 1]
            pairs.append(np.unique(row[inside].astype(np.uint64) << np.uint64(GRAM_BITS) | own[hit[inside]]))
    both = np.unique(np.concatenate(pairs))
    return (both >> np.uint64(GRAM_BITS)).astype(np.int64), (both & np.uint64((1 << GRAM_BITS) - 1)).astype(np.int64)


def _looked_up(known: np.ndarray, every: bool):
    """For mapInArrow over (key, text): (key, text, probes) of the texts that have n-grams whose places in the filter are known (all texts, if every rule needn't have any).

    Rows are taken together up to STEP_BYTES (or one longer text) and STEP_ROWS, and handed on before the next ones are looked at.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << FILTER_BITS, bool)
        table[known] = True
        for batch in batches:
            texts = pc.fill_null(batch.column(1).cast(pa.binary()).cast(pa.large_binary()), b"")
            _, offsets, data = texts.buffers()
            at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
            whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
            valid, low = np.asarray(batch.column(1).is_valid()), 0
            while low < len(batch):
                high = max(low + 1, min(int(np.searchsorted(at, at[low] + STEP_BYTES, side="right")) - 1, low + STEP_ROWS, len(batch)))
                row, gram = _found(table, at[low : high + 1], whole)
                if every:
                    row, gram = np.concatenate([row, np.arange(high - low)]), np.concatenate([gram, np.zeros(high - low, np.int64)])
                    order = np.argsort(row, kind="stable")
                    row, gram = row[order], gram[order]
                stays = valid[low:high][row]
                row, counts = np.unique(row[stays], return_counts=True)
                probes = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(gram[stays]))
                taken = pa.array(row + low)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(taken), batch.column(1).take(taken), probes], names=["_key", "_text", "probes"])
                low = high

    return scan


def rules_met(items: DataFrame, text: str, rules: DataFrame, key: str, pattern: str = "pattern", broadcast_bytes: int = 16_000_000) -> DataFrame:
    """(key, and the columns of rules) for each rule that an item's text meets (once for each key; a null text or pattern meets nothing).

    A rule is tried on those texts alone that share an n-gram with its postings, which an equality join finds; so the work follows the candidates, not the number of rules times that of texts. N-grams that no rule
    has are left out where the texts are read, by a filter of fixed size. Postings of up to broadcast_bytes, which is checked, are broadcast, so that texts aren't moved. Rules without a mandatory string are tried on every text. Patterns are those of Spark's rlike.
    """
    posted = postings(rules, pattern)
    slots = posted.select("probe").distinct().mapInArrow(_slots, "slot int").distinct().toArrow()["slot"].to_numpy()  # 2 ** FILTER_BITS at most
    held = posted.agg(F.sum(F.length(pattern) + 100).alias("bytes"), F.max(F.col("probe") == 0).alias("every")).first()
    every = bool(held["every"])
    posted = F.broadcast(posted) if (held["bytes"] or 0) <= broadcast_bytes else posted
    given = items.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    looked = given.mapInArrow(_looked_up(slots, every), given.withColumn("probes", F.array(F.lit(0).cast("long"))).schema)
    looked = looked.select("_key", "_text", F.explode("probes").alias("probe"))
    tried = looked.join(posted, "probe").where(F.expr(f"_text rlike `{pattern}`"))
    return tried.select(F.col("_key").alias(key), *rules.columns).distinct()


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grams = batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(_slot(grams[grams > 0]).astype(np.int32))], names=["slot"])


def classified_by(items: DataFrame, text: str, rules: DataFrame, key: str, fallback: str) -> DataFrame:
    """(key, board, tags) for each item: rules (ord, board, tag, pattern) may be many. The board has most rules that are met, of equally many the one whose first rule comes first; the fallback without any. tags are those of the rules met, in their order, once each."""
    first = rules.groupBy("board").agg(F.min("ord").alias("_first"))
    met = rules_met(items, text, rules, key)
    scores = met.groupBy(key, "board").agg(F.count("*").alias("_n"), F.collect_list(F.struct("ord", "tag")).alias("_tags")).join(first, "board")
    best = scores.groupBy(key).agg(F.max_by("board", F.struct("_n", -F.col("_first"))).alias("board"), F.array_sort(F.flatten(F.collect_list("_tags"))).alias("_tags"))
    tags = F.array_distinct(F.transform("_tags", lambda x: x["tag"]))
    told = best.select(F.col(key).alias("_key"), F.col("board").alias("_board"), tags.alias("_found"))
    out = items.join(told, F.col(key).eqNullSafe(F.col("_key")), "left")
    return out.select(key, F.coalesce("_board", F.lit(fallback)).alias("board"), F.coalesce("_found", F.array().cast("array<string>")).alias("tags"))
