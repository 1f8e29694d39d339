"""Words of texts as numbers: an index that grows, their character n-grams in hashed buckets, and bounded samples of labelled texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmark.llm.common import unit_hash, written

#: Words: a letter, and the letters and marks behind it. Signs for numbers (fractions, circled and Roman ones) are no letters.
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: Words that a table keeps between batches at most.
MOST_WORDS = 400_000
PRIME = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def ngram_buckets(words: Sequence[str], sizes: Sequence[int], buckets: int, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashed buckets of the words' character n-grams (and of whole words), with marks at their ends; and the word of each, sorted."""
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes = np.frombuffer(("<" + "><".join(words) + ">").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    of = np.repeat(np.arange(len(words)), lengths)
    found, owners = [], []
    h = np.zeros(len(codes), np.uint64)
    for n in range(1, max(sizes) + 1):
        h = h[: len(codes) - n + 1] * PRIME + codes[n - 1 :]
        if n in sizes:
            inside = of[: len(h)] == of[n - 1 :]
            found.append(mixed(h[inside] + np.uint64(n)))
            owners.append(of[: len(h)][inside])
    if whole:
        starts = np.cumsum(lengths) - lengths
        place = (np.arange(len(codes)) - np.repeat(starts, lengths)).astype(np.uint64)
        found.append(mixed(np.add.reduceat(mixed(codes + place * PRIME), starts)))
        owners.append(np.arange(len(words)))
    all_of = np.concatenate(owners)
    order = np.argsort(all_of, kind="stable")
    return (np.concatenate(found)[order] % np.uint64(buckets)).astype(np.int64), all_of[order]


class WordTable(dict):
    """Numbers of words in order of appearance, and a row of values for each, made in bulk by make(words)."""

    def __init__(self, make: Callable[[list[str]], np.ndarray], most: int = MOST_WORDS) -> None:
        super().__init__()
        self.make, self.most, self.new, self.values = make, most, [], None

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n

    def numbers(self, words: Sequence[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def rows(self) -> np.ndarray:
        """Values of all words so far."""
        if self.new or self.values is None:
            made = self.make(self.new)
            self.values = made if self.values is None else np.concatenate([self.values, made])
            self.new = []
        return self.values

    def trim(self) -> None:
        """Forgets all words if there are more than the bound."""
        if len(self) > self.most:
            self.clear()
            self.new, self.values = [], None


def by_steps(batches: Iterator[pa.RecordBatch], most_chars: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Batches, cut so that a part holds most_chars bytes of data at most (or one longer row)."""
    for batch in batches:
        start = 0
        while start < len(batch):
            n = len(batch) - start
            while n > 1 and batch.slice(start, n).nbytes > most_chars:
                n //= 2
            yield batch.slice(start, n)
            start += n


def crc_remainder(key: Column, n: int) -> Column:
    """CRC-32 of the key as text, mod n."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def sampled(df: DataFrame, key: str, label: str, size: Column, most_docs: int, most_bytes: int, broadcast_keys: int = 1_000_000) -> DataFrame:
    """Rows of df by label (not null), chosen by the hash of key: most_docs rows and most_bytes of size for each label, give or take chance.

    Labels may be many: their shares are an aggregate, written, so that Spark knows its size and moves no rows of a frequent label if it is small, and joined with keys and labels alone. The keys that are chosen pick the rows; numeric ones up to broadcast_keys are broadcast, so that no text is moved.
    """
    sizes = df.groupBy(F.col(label).alias("_label")).agg(F.count("*").alias("_n"), F.sum(size).alias("_b"))
    share = F.least(F.lit(1.0), F.lit(float(most_docs)) / F.col("_n"), F.lit(float(most_bytes)) / F.greatest(F.lit(1), F.col("_b")))
    told = df.select(F.col(key).alias("_key"), F.col(label).alias("_of"), unit_hash(F.col(key), F.lit("sample")).alias("_at"))
    shares = written(sizes.select("_label", share.alias("_share")), "shares")
    joined = told.join(shares, F.col("_of") == F.col("_label"))
    chosen = written(joined.where(F.col("_at") < F.col("_share")).select("_key", "_of").distinct(), "chosen")
    few = isinstance(chosen.schema["_key"].dataType, T.NumericType) and chosen.count() <= broadcast_keys
    at = F.col(key).eqNullSafe(F.col("_key")) & (F.col(label) == F.col("_of"))
    return df.join(F.broadcast(chosen) if few else chosen, at, "left_semi")
