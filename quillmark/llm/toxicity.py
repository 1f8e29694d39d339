"""Toxicity: averaged subword embeddings under a linear softmax, trained jointly in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.words import WordTable, by_steps, ngram_buckets, sampled

#: Words: runs of letters, digits and signs that stand in for letters in misspellings.
TOKEN = re.compile(r"[^\W_](?:[\w@$*!+-]*[^\W_])?")
SIZES, BUCKETS, DIMENSIONS = (3, 4, 5), 1 << 17, 4


@dataclass(frozen=True)
class ToxicityModel:
    """Embeddings of subword buckets, the softmax weights of the two classes, their biases."""

    embeddings: np.ndarray
    weights: np.ndarray
    biases: np.ndarray

    def word_parts(self, words: list[str]) -> np.ndarray:
        """For each word the sum of its subwords' logit differences, and their number: averages need no more."""
        bucket, of = ngram_buckets(words, SIZES, BUCKETS, whole=True)
        logits = self.embeddings @ (self.weights[:, 1] - self.weights[:, 0])
        return np.stack([np.bincount(of, logits[bucket], len(words)), np.bincount(of, minlength=len(words))], axis=1) if words else np.zeros((0, 2))

    def probability(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(logit + self.biases[1] - self.biases[0], -60, 60)))


def subword_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (label, text): (y, size, buckets, counts): a document's number of subwords, its buckets (int32) and how often it has each (int64)."""
    for batch in by_steps(batches, 2_000_000):
        sizes, buckets, counts = [], [], []
        for text in batch.column(1):
            words, n = np.unique(np.array(TOKEN.findall(text.as_py().lower()), dtype=object), return_counts=True)
            bucket, of = ngram_buckets(words.tolist(), SIZES, BUCKETS, whole=True)
            total = np.bincount(bucket, n[of], BUCKETS) if len(bucket) else np.zeros(BUCKETS)
            at = np.flatnonzero(total)
            sizes.append(int(total.sum()))
            buckets.append(at.astype(np.int32).tobytes())
            counts.append(total[at].astype(np.int64).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(buckets, pa.binary()), pa.array(counts, pa.binary())], names=["y", "size", "buckets", "counts"])


def train(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, most_docs: int = 1500, most_bytes: int = 5_000_000, least_seen: int = 5, epochs: int = 80, rate: float = 0.3, seed: int = 7) -> ToxicityModel:
    """From a sample of rows that labels marks 0 or 1: most_docs documents and most_bytes of text for each label.

    A document is the average of its subwords' embeddings; cross-entropy of the softmax, each class weighed by its share among all labelled
    rows (to a power of 0.7), however many were sampled. Steps follow the gradient over the square root of a subword's frequency; those that occur fewer than least_seen times
    stay out, as they tell documents apart, not classes. Repeated labels of a key: the highest counts; of its rows, that of the least text does. Null keys have no label. With only one class, or none, known, all scores are that class's share.
    """
    marks = labels.where(F.col(label).isin(0, 1)).groupBy(key).agg(F.max(label).cast("int").alias("_y"))
    texts = docs.where(F.col(text).isNotNull()).select(key, text)
    known = texts.groupBy(key).agg(F.max(F.octet_length(text)).alias("_size")).join(marks, key)
    in_all = dict(known.groupBy("_y").count().collect())
    if len(in_all) == 2:
        chosen = sampled(known, key, "_y", F.col("_size"), most_docs, most_bytes).select(key, "_y")  # few enough to go to all executors, by most_docs
        sample = texts.join(F.broadcast(chosen), key).groupBy(key, "_y").agg(F.min(text).alias("_text")).select("_y", "_text").mapInArrow(subword_counts, "y int, size long, buckets binary, counts binary").where("size > 0").toArrow().sort_by([("y", "ascending"), ("size", "ascending"), ("buckets", "ascending"), ("counts", "ascending")])
        y = sample["y"].to_numpy().astype(int)
    else:
        y = np.array(list(in_all), int)
    if len(set(y.tolist())) < 2:
        share = (y.mean() if len(y) else 0.0) * 0.98 + 0.01
        return ToxicityModel(np.zeros((BUCKETS, 1)), np.zeros((1, 2)), np.array([0.0, np.log(share / (1 - share))]))
    rows = [(np.frombuffer(b.as_py(), np.int32), (np.frombuffer(c.as_py(), np.int64) / s).astype(np.float32)) for b, c, s in zip(sample["buckets"], sample["counts"], sample["size"].to_numpy(), strict=True)]
    frequency = sum(np.bincount(b, v * s, BUCKETS) for (b, v), s in zip(rows, sample["size"].to_numpy(), strict=True))
    del sample
    step = np.where(frequency >= least_seen, 1 / np.sqrt(np.maximum(1, frequency)), 0)[:, None]
    weight = np.where(y == 1, *((in_all[k] / (y == k).sum()) ** 0.7 for k in (1, 0)))
    weight /= weight.sum()
    rng = np.random.default_rng(seed)
    e, w, b = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)) * step, rng.normal(0, 0.5, (DIMENSIONS, 2)), np.zeros(2)
    rows = [(b[step[b, 0] > 0], v[step[b, 0] > 0]) if (step[b, 0] > 0).any() else (b[:1], v[:1] * 0) for b, v in rows]  # the others add nothing
    parts = [range(i, min(i + 250, len(rows))) for i in range(0, len(rows), 250)]  # in turn, for memory
    parts = [(p, np.concatenate([rows[i][0] for i in p]), np.concatenate([rows[i][1] for i in p]), np.array([len(rows[i][0]) for i in p])) for p in parts]
    del rows
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (e, w, b)]
    for epoch in range(1, epochs + 1):
        ge, gw, gb = np.zeros_like(e), np.zeros_like(w), np.zeros_like(b)
        for p, bucket, share, lengths in parts:
            starts = np.cumsum(lengths) - lengths
            h = np.stack([np.add.reduceat(e[bucket, k] * share, starts) for k in range(DIMENSIONS)], axis=1)
            z = h @ w + b
            z = np.exp(z - z.max(axis=1, keepdims=True))
            g = z / z.sum(axis=1, keepdims=True)
            g[np.arange(len(p)), y[p.start : p.stop]] -= 1
            g *= weight[p.start : p.stop, None]
            gh = g @ w.T
            for k in range(DIMENSIONS):
                ge[:, k] += np.bincount(bucket, share * np.repeat(gh[:, k], lengths), BUCKETS)
            gw += h.T @ g
            gb += g.sum(axis=0)
        for x, grad, (m, v) in zip((e, w, b), (ge * step, gw, gb), state, strict=True):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad**2 - v)
            scale = v.max() if x is e else v  # one for all embeddings
            x -= (rate if x is e else 0.1) * (m / (1 - 0.9**epoch)) / (np.sqrt(scale / (1 - 0.99**epoch)) + 1e-12)
    return ToxicityModel(e.astype(np.float32), w.astype(np.float32), b)


def score_toxicity(docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of each row of docs: the softmax probability of class 1; null and empty texts get that of the biases. Repeated rows are scored alike, an empty docs gives no rows, and a very long text is one task's work."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        table = WordTable(model.word_parts)
        for batch in by_steps(batches):
            table.trim()
            numbers = [table.numbers(TOKEN.findall((value.as_py() or "").lower())) for value in batch.column(1)]
            values = table.rows()
            sums = np.array([values[x].sum(axis=0) for x in numbers]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.probability(sums[:, 0] / np.maximum(1, sums[:, 1])), pa.float64())], names=[key, "score"])

    own = docs.select(key, text)
    return own.mapInArrow(scan, f"`{key}` {own.schema[0].dataType.simpleString()}, score double")
