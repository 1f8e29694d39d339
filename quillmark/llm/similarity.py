"""N-gram Jaccard join by parity sketches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quillmark.llm.common import dropped, heavy_keys, hidden, hidden_name, joined_evenly, shown, written
from quillmark.llm.components import components

LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: Odd multipliers for the words of a shingle, and those of the 64-bit finaliser: fixed values.
MIX_A, MIX_B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
GOLDEN = 0x9E3779B97F4A7C15
#: Shingles that one step over a batch of documents holds at most (or one longer document), for bounded memory.
STEP_SHINGLES = 1_000_000
#: Most candidate documents whose ids are broadcast (8 bytes each) to pick their texts; beyond, a shuffled join does. The default of a parameter.
BROADCAST_IDS = 2_000_000


class WordHashes(dict):
    """64-bit hashes of words, kept for reuse up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * MIX_A
    h = (h ^ (h >> np.uint64(33))) * MIX_B
    return h ^ (h >> np.uint64(33))


def shingle_set(text: str | None, n: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's n-word shingles; fewer words are one shingle, no words none."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else ()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    m = min(n, len(w))
    total = np.full(len(w) - m + 1, m, np.uint64)
    for j in range(m):
        total += mixed(w[j : len(w) - m + 1 + j] * np.uint64((GOLDEN * (2 * j + 1)) % 2**64 | 1) + np.uint64(j))
    return np.unique(mixed(total))


@lru_cache
def bands(percent: int, most: int = 1 << 40) -> tuple[tuple[int, ...], tuple[int, ...], tuple[int, ...]]:
    """Size bands for a similarity of percent / 100: the least size of each; for each, segments and spare segments.

    Two sets that link are in the same band or in neighbouring ones. Keys of band j serve pairs whose smaller set is in band j.
    Their symmetric difference is d at most, so of d + 1 + spare segments at least 1 + spare hold the same shingles.
    """
    lows = [1, 2]
    while lows[-1] < most:
        lows.append(max(lows[-1] + 1, 100 * (lows[-1] - 1) // percent + 1))
    segments, spares = [], []
    for j in range(len(lows) - 1):
        a = lows[j + 1] - 1
        d = (100 - percent) * (a + 100 * a // percent) // (100 + percent)
        spares.append(-(-6 * d * d // (5 * a)))  # about as many as have a shingle or none
        segments.append(d + 1 + spares[-1] if d else 0)
    return tuple(lows), tuple(segments), tuple(spares)


def segment_keys(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the parity sketch of a shingle set: one for each segment that the pigeonhole join needs.

    A sketch has k segments of 64 bits; each shingle XORs its hash into one of them, so that the segments that differ, like the bits
    that differ, are no more than the symmetric difference. Segments of few shingles tell little, and common shingles make them
    frequent, so each set leaves out as many segments as are spare: the first ones by number of shingles, then value, then place. Two sets that link agree
    in one segment more than that, and none of the two leaves out the last of these in that order.
    """
    lows, segments, spares = bands(percent)
    own = int(np.searchsorted(lows, len(shingles), side="right")) - 1
    values, high, out = None, None, []
    for j in (own, own - 1):
        k = segments[j] if j >= 0 else 0
        if not k:
            continue
        if values is None:
            values, high = mixed(shingles ^ np.uint64(GOLDEN)), shingles >> np.uint64(32)
        at = ((high * np.uint64(k)) >> np.uint64(32)).astype(np.int64)  # sorted, as the shingles are
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        value, held = np.zeros(k, np.uint64), np.bincount(at, minlength=k)
        value[at[first]] = np.bitwise_xor.reduceat(values, first)
        stay = np.lexsort((value, held))[spares[j] :]
        out.append(mixed(value[stay] + mixed(stay.astype(np.uint64) * np.uint64(GOLDEN) + np.uint64(j + 1))))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def fingerprint(shingles: np.ndarray, round_: int = 0) -> tuple[int, int]:
    """Of a shingle set: its identifier and a second number to verify that by, 64 bits each; equal sets have equal ones. Another round has other identifiers."""
    if not len(shingles):
        return 0, 0
    xor, total = np.bitwise_xor.reduce(shingles), np.sum(mixed(shingles), dtype=np.uint64)
    both = np.array([xor, total], np.uint64)
    turned = mixed(both[1:] + np.uint64(round_) * MIX_B) * np.uint64(GOLDEN)
    return int(mixed(mixed(both[:1]) + turned)[0]), int(mixed(mixed(both[:1] + MIX_A) ^ mixed(both[1:] + MIX_B))[0])


SET, LINK, DOC, CHECK = 0, 1, 2, 3
#: From the shingles of a set, the keys under which it meets candidates.
Keys = Callable[[np.ndarray], np.ndarray]


def sketch_rows(shingle: int, keys_of: Keys, round_: int = 0):
    """For mapInArrow over (doc, text): (kind, key, id, other, doc).

    DOC rows have the set (id), its size (other) and doc, CHECK rows the set and its second number (key); SET rows key and set, the first of
    each key in a step over a batch; LINK rows key, set and that first set (other) for the other ones, so that no key has more SET rows than there are steps.
    """

    def table(kind, key, id, other, doc):  # noqa: A002
        n = len(id)
        as_long = [pa.array(x if isinstance(x, np.ndarray) and x.dtype == np.int64 else np.asarray(x, np.uint64).view(np.int64)) for x in (key, id, other)]
        doc = pa.nulls(n, doc) if isinstance(doc, pa.DataType) else doc
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int8)), *as_long, doc], names=["kind", "key", "id", "other", "doc"])

    def step(sets: dict[int, np.ndarray], none: pa.DataType):
        found = [keys_of(s) for s in sets.values()]
        keys = np.concatenate(found) if found else np.empty(0, np.uint64)
        if not len(keys):
            return
        ids = np.repeat(np.fromiter(sets, np.uint64, len(sets)), [len(x) for x in found])
        order = np.argsort(keys, kind="stable")
        sorted_keys = keys[order]
        new = np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1]))
        lead = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
        firsts = np.sort(order[new])
        yield table(SET, keys[firsts], ids[firsts], np.zeros(len(firsts), np.uint64), none)
        rest = ~new & (ids[order] != ids[lead])
        if rest.any():
            yield table(LINK, sorted_keys[rest], ids[order][rest], ids[lead][rest], none)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sizes, marks, sets, checks, held = [], [], {}, {}, 0
            none = batch.column(0).type
            for text in batch.column(1):
                s = shingle_set(text.as_py(), shingle, hashes)
                f, check = fingerprint(s, round_)
                sizes.append(len(s))
                marks.append(f)
                checks[f, check] = None
                if len(s) and f not in sets:
                    sets[f] = s
                    held += len(s)
                if held > STEP_SHINGLES:
                    yield from step(sets, none)
                    sets, held = {}, 0
            yield from step(sets, none)
            if marks:
                yield table(DOC, np.zeros(len(marks), np.int64), np.array(marks, np.uint64), np.array(sizes, np.int64), batch.column(0))
                yield table(CHECK, np.array([c for _, c in checks], np.uint64), np.array([f for f, _ in checks], np.uint64), np.zeros(len(checks), np.uint64), none)

    return scan


def set_rows(shingle: int, round_: int = 0):
    """For mapInArrow over (id, text): (set, shingles)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found, marks = [], []
            for text in batch.column(1):
                s = shingle_set(text.as_py(), shingle, hashes)
                marks.append(fingerprint(s, round_)[0])
                found.append(s.view(np.int64))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.array(marks, np.uint64).view(np.int64)), pa.array(found, pa.list_(pa.int64()))], names=["id", "shingles"])

    return scan


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of pairs (u, v) whose sets link: 100 * intersection >= percent * union."""
    one, two = (sets.select(F.col("id").alias(c), F.col("shingles").alias(f"of_{c}")) for c in "uv")
    sizes = F.size("of_u") + F.size("of_v")
    near = 100 * F.least(F.size("of_u"), F.size("of_v")) >= percent * F.greatest(F.size("of_u"), F.size("of_v"))
    common = F.size(F.array_intersect("of_u", "of_v"))
    return pairs.join(one, "u").join(two, "v").where(near).where(100 * common >= percent * (sizes - common)).select("u", "v")


def _pairs(u, v) -> list:
    return [F.least(u, v).alias("u"), F.greatest(u, v).alias("v")]


def _open_members(members: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, id, root) of the keys whose sets are in several components."""
    rooted = members.join(classes.withColumnRenamed("component", "root"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    several = rooted.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("key")
    several = written(several, "several")  # plain tables on both sides, so that the join can split a key of many sets
    return written(rooted.join(several, "key", "left_semi").select("key", "id", "root"), "open")


def _to_leaders(open_: DataFrame) -> DataFrame:
    """Pairs of each key's set that has most keys, the one with the fewest differences, and the sets in other components."""
    shared = open_.groupBy("id").agg(F.count("*").alias("shared"))
    leaders = written(open_.join(shared, "id").groupBy("key").agg(F.max_by(F.struct("id", "root"), F.struct("shared", "id")).alias("leader")), "leaders")
    return open_.join(leaders, "key").where("root <> leader.root").select(*_pairs("id", "leader.id")).distinct()


def _sharing_rare(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs in different components that share one of their rarest shingles.

    Two sets that link share percent / 100 of either's shingles at least. So with shingles in one order for all, by frequency, then
    hash, they share one of each set's first n - ceil(percent * n / 100) + 1. Shingles that one set alone has come first.
    """
    own = sets.join(open_.select("id", "root").distinct(), "id")
    each = own.select("id", "root", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    counts = each.groupBy("shingle").agg(F.count("*").alias("count")).where("count > 1")
    common = each.join(counts, "shingle")
    unique = common.groupBy("id").agg((F.first("n") - F.count("*")).alias("unique"))
    first = F.col("n") - F.floor((F.col("n") * percent + 99) / 100) + 1
    near = common.join(unique, "id").where(F.col("unique") < first)
    rank = F.row_number().over(Window.partitionBy("id").orderBy("count", "shingle")) + F.col("unique")
    rare = written(near.withColumn("at", rank).where(F.col("at") <= first).select("id", "root", "shingle", "n", "at"), "rare")
    one, two = rare.alias("a"), rare.alias("b")
    # what is left of either set from the first shared shingle on must be as much as the two would have to share
    enough = [(100 + percent) * (F.col(f"{x}.n") - F.col(f"{x}.at") + 1) >= percent * (F.col("a.n") + F.col("b.n")) for x in "ab"]
    across = one.join(two, (F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.root") < F.col("b.root")) & enough[0] & enough[1])
    return across.select(*_pairs("a.id", "b.id")).distinct()


def _joined(classes: DataFrame, links: DataFrame, more: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Components and links with more links."""
    if more.isEmpty():
        return classes, links
    links = links.union(more)
    return written(components(links), "components"), links


def _marked(at: int, shingle: int, round_: int):
    """For mapInArrow: all columns, and the set of the text in column at."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            marks = [fingerprint(shingle_set(t.as_py(), shingle, hashes), round_)[0] for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.array(marks, np.uint64).view(np.int64))], names=[*batch.schema.names, "id"])

    return scan


def _sketches(given: DataFrame, shingle: int, keys_of: Keys, round_: int) -> DataFrame:
    """The rows of sketch_rows; but of each key's SET rows, the least set is the first, and the others are linked with it.

    A key in every step has a row for each step, so the first ones are a partial aggregate and joined back: no task holds all rows of a key.
    """
    rows = f"kind byte, key long, id long, other long, doc {given.schema['doc'].dataType.simpleString()}"
    raw = written(given.mapInArrow(sketch_rows(shingle, keys_of, round_), rows), "raw")
    sets = raw.where(F.col("kind") == SET)
    firsts = sets.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first <> last")
    firsts = written(firsts.select("key", "first"), "firsts")
    linked = sets.join(firsts, "key").where("id <> first").select("kind", "key", "id", F.col("first").alias("other"), "doc")
    out = written(linked.union(raw.where(F.col("kind") != SET)), "sketches")
    dropped(given.sparkSession, raw, firsts)
    return out


def similarity_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80, broadcast_ids: int = BROADCAST_IDS, keys_of: Keys | None = None) -> DataFrame:
    """(key, n_shingles, component) for each row of docs: the smallest key that links lead to, its own included.

    Two documents link when 100 * intersection >= percent * union of their sets of word shingles (64-bit hashes of lower-cased words
    between white space). Null and empty texts, and those without words, have no shingles and link with nothing; equal texts and repeated rows link.

    Equal sets are one vertex. Keys of parity sketches bring sets together; every set is checked against the first one of
    its key, then, where a key still has several components, against the set of that key that shares most keys. Of the pairs that share a key and are still in
    different components, those can link alone that also share one of their rarest shingles; all these are checked. So no link
    between components is lost, and pairs inside a component needn't be made. Keys are of any type with an order; a row with a null key has null
    n_shingles and component and links with nothing. keys_of: another way to bring sets together, in place of parity sketches; sets that share none of its keys aren't compared.
    """
    return _classes(docs, key, text, shingle, percent, broadcast_ids, keys_of)[0].select(F.col("doc").alias(key), "n_shingles", "component")


def _classes(docs: DataFrame, key: str, text: str, shingle: int, percent: int, broadcast_ids: int, keys_of: Keys | None = None) -> tuple[DataFrame, int]:
    """similarity_classes with doc for the key, and for each row its set (id), and stays: whether that is the set of its class that is to stay.

    Of a class, that is the set of the smallest key (of several such sets, the smallest); texts without shingles all stay.
    And the round of identifiers that was used: sets of one identifier are verified to have one second number too, else all are taken anew.
    """
    spark = docs.sparkSession
    keys_of = keys_of or partial(segment_keys, percent=percent)
    every = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    kind = every.schema["doc"].dataType
    given = every.where("doc IS NOT NULL")
    table, round_ = _sketches(given, shingle, keys_of, 0), 0
    while not table.where(F.col("kind") == CHECK).groupBy("id").agg(F.min("key").alias("a"), F.max("key").alias("b")).where("a <> b").isEmpty():
        dropped(spark, table)
        round_ += 1
        table = _sketches(given, shingle, keys_of, round_)
    links, rows = table.where(F.col("kind") < DOC).select("key", "id", "other"), table.where(F.col("kind") == DOC).select("doc", "id", F.col("other").alias("n"))
    vertices = rows.where("n > 0").groupBy("id").agg(F.min("doc").alias("doc"))

    ids = links.select("id").union(links.select("other")).distinct()
    wanted = written(vertices.join(ids, "id", "left_semi").select("doc"), "candidates")
    few = isinstance(kind, T.NumericType) and wanted.count() <= broadcast_ids  # keys of a fixed size alone
    texts = given.join(F.broadcast(wanted) if few else wanted.hint("merge"), "doc", "left_semi")
    sets = written(texts.mapInArrow(set_rows(shingle, round_), "id long, shingles array<long>").dropDuplicates(["id"]), "sets")

    pairs = written(links.select(*_pairs("id", "other")).distinct(), "pairs")
    checked = written(_linked(pairs, sets, percent), "links")
    dropped(spark, pairs)
    found = written(components(checked), "components")

    members = written(links.select("key", "id").union(links.select("key", F.col("other").alias("id"))).distinct(), "members")
    open_ = _open_members(members, found)
    tried = written(_linked(_to_leaders(open_), sets, percent), "links")
    classes, checked = _joined(found, checked, tried)
    open_ = _open_members(members, classes)
    more = written(_linked(_sharing_rare(open_, sets, percent).join(checked, ["u", "v"], "left_anti"), sets, percent), "links")
    classes, checked = _joined(classes, checked, more)

    rooted = vertices.join(classes, "id", "left").select("id", "doc", F.coalesce("component", "id").alias("root"))
    smallest = written(rooted.groupBy("root").agg(F.min(F.struct("doc", "id")).alias("least"), F.count("*").alias("n")), "smallest")
    n_sets = smallest.agg(F.sum("n")).first()[0] or 0
    by_set = joined_evenly(rooted, smallest.drop("n"), "root", heavy_keys(smallest, "root", "n", n_sets), F.xxhash64("id"))
    by_set = written(by_set.select("id", F.col("least.doc").alias("component"), (F.col("id") == F.col("least.id")).alias("first")), "by_set")
    copies = rows.groupBy("id").count()
    shingled, spread = F.col("n") > 0, F.xxhash64("doc") + F.spark_partition_id()
    out = joined_evenly(rows, by_set, "id", written(heavy_keys(copies, "id", "count", rows.count()), "heavy"), spread, "left")
    out = out.select("doc", F.col("n").alias("n_shingles"), F.coalesce(F.when(shingled, F.col("component")), F.col("doc")).alias("component"), "id", (~shingled | (F.col("first") & (F.col("doc") == F.col("component")))).alias("stays"))
    keyless = every.where("doc IS NULL").select("doc", *[F.lit(None).cast(t).alias(c) for c, t in (("n_shingles", "long"), ("component", kind), ("id", "long"), ("stays", "boolean"))])
    result = written(out.union(keyless), "classes")
    dropped(spark, table, wanted, sets, members, tried, more, smallest, by_set, open_, found, classes, checked)
    return result, round_


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """One row of docs for each class, of its smallest key, and the rows without key or shingles, with the columns of docs.

    Keys of one row decide for it. Where a key has several rows, they are told apart by their sets; of rows with the key and the set
    that stay, one with the smallest text does.
    """
    own, own_text = hidden_name(docs, key), hidden_name(docs, text)
    classes, round_ = _classes(docs, key, text, shingle, percent, broadcast_ids)
    classes = classes.where("doc IS NOT NULL")
    by_doc = written(classes.groupBy("doc").agg(F.count("*").alias("n_rows"), F.max("stays").alias("stays")).where("stays"), "stay")
    single, several = (by_doc.where(c).select("doc") for c in ("n_rows = 1", "n_rows > 1"))
    given, at = hidden(docs), F.col(own) == F.col("doc")
    numbers = isinstance(given.schema[own].dataType, T.NumericType)
    out = given.join(single, at, "left_semi").union(given.where(F.col(own).isNull()))
    n = several.count()
    if n:
        schema = given.withColumn("id", F.lit(0).cast("long")).schema
        texts = given.join(F.broadcast(several) if numbers and n <= broadcast_ids else several.hint("merge"), at, "left_semi")
        rows = texts.mapInArrow(_marked(given.columns.index(own_text), shingle, round_), schema)
        stay = classes.where("stays").join(several, "doc", "left_semi").groupBy("doc", "id").agg(F.max(F.col("n_shingles") > 0).alias("shingled"))
        stay = stay.select("doc", F.col("id").alias("set"), "shingled")
        rows = rows.join(stay, at & (F.col("id") == F.col("set")))
        one = rows.where("shingled").groupBy("doc", "set").agg(F.min_by(F.struct(*given.columns), F.col(own_text)).alias("row")).select("row.*")
        out = out.union(one).union(rows.where(~F.col("shingled")).select(*given.columns))
    return shown(out, docs)


def brute_force(texts: dict[int, str | None], shingle: int, percent: int) -> dict[int, tuple[int, int]]:
    """n_shingles and component of each document by comparing all pairs; for tests."""
    sets = {}
    for i, t in texts.items():
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        for c in "\t\n\v\f\r":
            w = w.replace(c, " ")
        w = [x for x in w.split(" ") if x]
        sets[i] = {tuple(w[k : k + shingle]) for k in range(len(w) - shingle + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}
