"""Exact deduplication with content-defined chunk recipes."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.common import heavy_keys, hidden, hidden_name, joined_evenly, shown, written

#: White space as spaces; and what of it becomes one space.
TO_SPACE = bytes(0x20 if 0x09 <= b <= 0x0D else b for b in range(256))
SPACES = re.compile(rb"\x20{2,}")
#: Bytes of a chunk: at least, on average (a power of 2, beyond the least), at most.
LEAST, AVERAGE, MOST = 1 << 11, 1 << 12, 1 << 16
PRIME = 0x9E3779B1


def normalised(text: str | None) -> bytes:
    """UTF-8 of a text with each run of white space turned into one space; null counts as empty."""
    data = text.encode("utf-8", "surrogatepass").translate(TO_SPACE) if text else b""
    return SPACES.sub(b" ", data) if b"  " in data else data


def chunks(data: bytes) -> list[bytes]:
    """data, cut where a hash of the last 16 bytes has its high bits clear: the same passages are cut alike wherever they stand."""
    if len(data) <= LEAST:
        return [data] if data else []
    h, width, factor = np.frombuffer(data, np.uint8).astype(np.uint32), 1, PRIME
    h = (h + np.uint32(1)) * np.uint32(0x85EBCA6B)
    while width < 16:  # of 2 windows, that of twice the width
        h = h[:-width] * np.uint32(factor) + h[width:]
        factor, width = factor * factor & 0xFFFFFFFF, 2 * width
    ends = np.flatnonzero(h >> np.uint32(20) == 0) + 16 if len(h) else ()
    out, start = [], 0
    for end in [*ends, len(data)]:
        while end - start > MOST:
            out.append(data[start : start + MOST])
            start += MOST
        if end - start >= LEAST or end == len(data) and end > start:
            out.append(data[start:end])
            start = end
    return out


def chunk_id(chunk: bytes, round_: int) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16, salt=round_.to_bytes(8, "little")).digest()


def _scan(round_: int, contents: bool):
    """For mapInArrow over (doc, text): (doc, sha256, recipe), or the distinct (id, content) of each batch's chunks."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shas, recipes, found, held = [], [], {}, 0
            for text in batch.column(1):
                data = normalised(text.as_py())
                parts = chunks(data)
                ids = [chunk_id(c, round_) for c in parts]
                if contents:
                    found.update(zip(ids, parts, strict=True))
                    held += len(data)
                    if held > 1 << 24:
                        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.binary())], names=["id", "content"])
                        found, held = {}, 0
                else:
                    shas.append(hashlib.sha256(data).hexdigest())
                    recipes.append(b"".join(ids))
            if contents:
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.binary())], names=["id", "content"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shas, pa.string()), pa.array(recipes, pa.binary())], names=["doc", "sha", "recipe"])

    return scan


def exact_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, keep_id, group_size, kept, text_sha256) for each row of docs.

    Texts are equal when identical after each run of white space became one space; null counts as empty. The row with the smallest key
    of equal texts stays: keep_id; of rows that repeat that key and text, one has kept. An empty table gives no rows. Keys are of any type with an order; a null key
    comes after all others, so it stays only where equal texts have no other (keep_id is null then).

    Each text is cut into chunks where its content says so; a recipe is the ordered list of its chunks' 128-bit identifiers.
    Identifiers are verified: chunks are dealt out by identifier and compared byte by byte (each task sends each
    content once), and if two contents shared one, all would be taken anew under another salt. Then recipes alone are compared,
    so no long document is moved again. Groups are summed up before they are dealt out, and the rows of large groups are salted.
    """
    given = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    kind = given.schema["doc"].dataType.simpleString()
    round_ = 0
    while True:
        contents = given.select("doc", "text").mapInArrow(_scan(round_, True), "id binary, content binary").groupBy("id", "content").agg(F.lit(1).alias("one"))
        if contents.groupBy("id").count().where("count > 1").isEmpty():
            break
        round_ += 1
    recipes = given.mapInArrow(_scan(round_, False), f"doc {kind}, sha string, recipe binary")
    recipes = written(recipes.withColumns({"list": F.sha2("recipe", 256), "row": F.monotonically_increasing_id()}), "recipes")
    # lists are compared as such; their digest only keeps the keys that are dealt out short
    groups = written(recipes.groupBy("list", "recipe").agg(F.min(F.struct(F.col("doc").isNull().alias("no_key"), "doc", "row")).alias("keep"), F.count("*").alias("group_size")), "groups")
    heavy = heavy_keys(groups.groupBy("list").agg(F.sum("group_size").alias("n")), "list", "n", recipes.count())
    spread = F.xxhash64("doc") + F.spark_partition_id()
    joined = joined_evenly(recipes, groups, "list", heavy, spread, also=("recipe",))
    return joined.select(F.col("doc").alias(key), F.col("keep.doc").alias("keep_id"), "group_size", (F.col("row") == F.col("keep.row")).alias("kept"), F.col("sha").alias("text_sha256"))


def without_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that stay, with the columns of docs: one of each group of equal texts. Rows are numbered and written first, so that each is told from all others."""
    own, own_text = hidden_name(docs, key), hidden_name(docs, text)
    rows = written(hidden(docs).withColumn("_n", F.monotonically_increasing_id()), "numbered")
    told = rows.select(F.struct(F.col(own).isNull().alias("none"), F.col(own).alias("key"), "_n").alias("_key"), F.col(own_text).alias("_text"))
    stay = exact_copies(told, "_key", "_text").where("kept").select(F.col("_key._n").alias("_n"))
    return shown(rows.join(stay, "_n", "left_semi"), docs)
