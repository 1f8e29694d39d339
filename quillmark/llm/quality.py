"""Quality: expectation-maximisation over overlapping heuristic labellers, and a hashed linear scorer trained on its posteriors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.common import hidden, hidden_name, shown, unit_hash
from quillmark.llm.words import PRIME, WordTable, by_steps, mixed

#: What a labeller says: no opinion, good, bad.
ABSTAINS, GOOD, BAD = 0, 1, 2
#: Fixed bounds of the labellers: the measure, the most that is good, the least that is bad.
LABELLERS = (
    ("repeats", 0.10, 0.20),  # words equal to the one before
    ("few_words", 0.60, 0.85),  # share of words that occurred before, in the same part of a long text
    ("capitals", 0.15, 0.35),  # upper-case letters of all letters
    ("shouts", 0.02, 0.15),  # words in capitals, of three letters or more
    ("sign_runs", 0.02, 0.10),  # words with a sign twice in a row
    ("no_letters", 0.06, 0.15),  # words without letter or digit
    ("signs", 0.06, 0.09),  # signs of all characters
    ("no_short_words", 0.90, 0.96),  # words of letters and digits that have more than 3 characters
    ("long_words", 0.02, 0.20),  # words of more than 40 characters
)
#: Buckets of the shapes of words and of the measures by steps; of words themselves.
FEATURES, WORD_FEATURES = 1 << 12, 1 << 18
ALL_FEATURES = FEATURES + WORD_FEATURES
#: Words of a part within which words that occurred before are counted: all words fill up a vocabulary in the end.
PART_WORDS = 20_000
#: What is known of code points, looked up when they first occur: letter, capital, digit, letter or digit.
LETTER, CAPITAL, DIGIT, ALNUM, UNSEEN = 1, 2, 4, 8, 255
KINDS = np.full(0x110000, UNSEEN, np.uint8)


def char_kinds(codes: np.ndarray) -> np.ndarray:
    kinds = KINDS[codes]
    if (new := kinds == UNSEEN).any():
        for code in np.unique(codes[new]).tolist():
            c = chr(code)
            KINDS[code] = LETTER * c.isalpha() + CAPITAL * c.isupper() + DIGIT * c.isdigit() + ALNUM * c.isalnum()
        kinds = KINDS[codes]
    return kinds


def word_measures(words: list[str]) -> np.ndarray:
    """For each word: letters, capitals, in capitals, sign run, no letter or digit, signs, characters, long, short; then the buckets of its shape and of itself.

    A shape is the classes of all characters of a word, runs of capitals, of other letters and of digits made one, and the word's length by powers of 2.
    """
    if not words:
        return np.zeros((0, 11))
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    chars = np.fromiter(map(len, words), np.int64, len(words))
    starts, kinds = np.cumsum(chars) - chars, char_kinds(codes)
    total = lambda on: np.add.reduceat(on, starts, dtype=np.int64)
    has = lambda kind: kinds & kind != 0
    letters, capitals, signs = total(has(LETTER)), total(has(CAPITAL)), total(~has(ALNUM))
    first = np.zeros(len(codes), bool)
    first[starts] = True
    twice = np.concatenate(([False], codes[1:] == codes[:-1])) & ~first & ~has(ALNUM) & (codes != ord("_"))
    kind = np.where(has(CAPITAL), 1, np.where(has(LETTER), 2, np.where(has(DIGIT), 3, codes.astype(np.uint64) + np.uint64(16)))).astype(np.uint64)
    kept = np.concatenate(([True], kind[1:] != kind[:-1])) | first | (kind >= 16)
    at = np.cumsum(kept)
    place = (at - np.repeat(at[starts], chars)).astype(np.uint64)
    shape = np.add.reduceat(np.where(kept, mixed(kind + place * PRIME), np.uint64(0)), starts) + np.frexp(chars)[1].astype(np.uint64)
    place = (np.arange(len(codes)) - np.repeat(starts, chars)).astype(np.uint64)
    own = np.add.reduceat(mixed(codes + place * PRIME), starts)
    columns = (letters, capitals, (letters > 2) & (capitals == letters), total(twice) > 0, signs == chars, signs, chars, chars > 40, (chars - signs < 4) & (signs < chars))
    return np.column_stack([*columns, mixed(shape) % np.uint64(FEATURES), FEATURES + (mixed(own) % np.uint64(WORD_FEATURES)).astype(np.int64)]).astype(float)


def _bucket(name: str) -> int:
    return xxhash.xxh32_intdigest(name) % FEATURES


#: Buckets of the measures by steps of 1/20, for each labeller.
STEPS = np.array([[_bucket(f"{name}:{k}") for k in range(21)] for name, _, _ in LABELLERS])


def measures(rows: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The labellers' measures of a text from its words' rows and numbers."""
    n = len(numbers)
    if not n:
        return np.zeros(len(LABELLERS))
    distinct = sum(len(np.unique(numbers[k : k + PART_WORDS])) for k in range(0, n, PART_WORDS))
    letters, capitals, shouts, runs, no_letters, signs, chars, long_, short = rows[:, :9].sum(axis=0)
    return np.array([(numbers[1:] == numbers[:-1]).sum() / n, 1 - distinct / n, capitals / max(1, letters), shouts / n, runs / n, no_letters / n, signs / max(1, chars), 1 - short / max(1, n - no_letters), long_ / n])


def votes(measured: np.ndarray, n: int, least_words: int = 8) -> np.ndarray:
    """What the labellers say; of texts of few words, they say nothing bad, and of none nothing at all."""
    good, bad = (np.array([x[k] for x in LABELLERS]) for k in (1, 2))
    out = np.where(measured <= good, GOOD, np.where(measured >= bad, BAD, ABSTAINS))
    return np.full(len(LABELLERS), ABSTAINS) if n == 0 else np.where(out == BAD, ABSTAINS, out) if n < least_words else out


def steps_of(measured: np.ndarray) -> np.ndarray:
    """The buckets of a text's measures."""
    return STEPS[np.arange(len(LABELLERS)), np.minimum(20, (measured * 20).astype(int))]


def features(measured: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a text: the shares of each shape and of each word among its words, and its measures by steps of 1/20."""
    if not n:
        return np.empty(0, np.int64), np.empty(0)
    bucket, count = np.unique(rows[:, 9:].astype(np.int64), return_counts=True)
    return np.concatenate([bucket, steps_of(measured)]), np.concatenate([count / n, np.ones(len(LABELLERS))])


@dataclass(frozen=True)
class QualityModel:
    """For each labeller the chance that it says bad of good and of bad texts, given that it says something; the share of good texts; the linear scorer."""

    says_bad: np.ndarray
    good_share: float
    weights: np.ndarray
    bias: float

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """The chance that texts with these votes are good."""
        return _posterior(patterns, self.says_bad, self.good_share)


def _posterior(patterns: np.ndarray, says_bad: np.ndarray, good_share: float) -> np.ndarray:
    log = np.array([[np.zeros(len(LABELLERS)), np.log(1 - p), np.log(p)] for p in says_bad])
    at = np.arange(len(LABELLERS))
    good, bad = (log[c][patterns, at].sum(axis=1) + np.log(s) for c, s in ((0, good_share), (1, 1 - good_share)))
    return 1 / (1 + np.exp(np.clip(bad - good, -60, 60)))


def fit_labellers(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, float]:
    """Expectation-maximisation over distinct vote patterns and their numbers of texts.

    A text is bad to begin with if any labeller says so. The chances are kept from 0 and 1 by a text each way, and a
    labeller counts as no worse than chance: saying bad is at least as likely of bad texts.
    """
    if not counts.sum():
        return np.tile([[0.01], [0.5]], (1, len(LABELLERS))), 0.9
    good = np.where((patterns == BAD).any(axis=1), 0.05, 0.95)
    for _ in range(rounds):
        says_bad = np.empty((2, len(LABELLERS)))
        for c, weight in enumerate((good * counts, (1 - good) * counts)):
            bad, spoke = ((weight[:, None] * x).sum(axis=0) for x in (patterns == BAD, patterns != ABSTAINS))
            says_bad[c] = (bad + (0.1, 0.5)[c]) / (spoke + 1)
        says_bad[1] = np.maximum(says_bad[1], says_bad[0])
        share = float(np.clip((good * counts).sum() / counts.sum(), 0.01, 0.99))
        good = _posterior(patterns, says_bad, share)
    return says_bad, share


VOTES = ", ".join(f"v{i} int" for i in range(len(LABELLERS)))


def _scan(text_at: int, values, judge, make):
    """For mapInArrow: make(batch, for each text what judge makes of its words' rows and numbers); values(words): the rows, from word_measures on."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(values)
        for batch in by_steps(batches):
            table.trim()
            numbers = [table.numbers((value.as_py() or "").split()) for value in batch.column(text_at)]
            rows = table.rows()
            yield make(batch, [judge(rows[x], x) for x in numbers])

    return scan


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", most_docs: int = 6000, most_bytes: int = 64_000_000, least_docs: int = 5, epochs: int = 300, rate: float = 0.05) -> QualityModel:
    """No labels are needed. Votes are counted by pattern over all rows of docs; the scorer learns the posteriors of most_docs rows, of most_bytes of text together, give or take chance, chosen by the hash of the key.

    The scorer sees what the labellers don't: the words of a text and their shapes. Features of fewer than least_docs of its rows stay out, as they tell documents apart, not classes. A null key counts as the empty one; an empty docs gives the prior alone.
    """

    def vote(rows, numbers):
        return votes(measures(rows, numbers), len(numbers))

    def counted_votes(batch, found):
        columns = np.ascontiguousarray(np.array(found, np.int32).reshape(-1, len(LABELLERS)).T)
        sizes = pc.fill_null(pc.binary_length(batch.column(0)), 0).cast(pa.int64())
        return pa.RecordBatch.from_arrays([*[pa.array(c) for c in columns], sizes], names=[*names, "bytes"])

    plain = lambda words: word_measures(words)[:, :9].astype(np.float32)
    names = [f"v{i}" for i in range(len(LABELLERS))]
    voted = docs.select(text).mapInArrow(_scan(0, plain, vote, counted_votes), f"{VOTES}, bytes long")
    counted = voted.groupBy(*names).agg(F.count("*").alias("count"), F.sum("bytes").alias("bytes")).toPandas().sort_values(names)
    patterns, counts, held = counted[names].to_numpy(np.int64), counted["count"].to_numpy(float), float(counted["bytes"].sum())
    says_bad, good_share = fit_labellers(patterns, counts)

    def described(rows, numbers):
        m, n = measures(rows, numbers), len(numbers)
        bucket, value = features(m, rows, n)
        return votes(m, n).astype(np.int8).tobytes(), bucket.astype(np.int32).tobytes(), value.astype(np.float32).tobytes()

    def sample(batch, found):
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.binary()) for k in range(3)], names=["votes", "bucket", "value"])

    share = min(1.0, most_docs / max(1.0, counts.sum()), most_bytes / max(1.0, held))
    chosen = docs.where(unit_hash(F.col(key), F.lit("quality")) < share).select(text)
    rows = chosen.mapInArrow(_scan(0, word_measures, described, sample), "votes binary, bucket binary, value binary").toArrow().to_pydict()
    rows = [(np.frombuffer(v, np.int8), np.frombuffer(b, np.int32), np.frombuffer(x, np.float32)) for v, b, x in zip(rows["votes"], rows["bucket"], rows["value"], strict=True) if b]
    rows.sort(key=lambda x: [c.tobytes() for c in x])  # sums don't depend on the order in which tasks end
    weights, bias = np.zeros(ALL_FEATURES), float(np.log(good_share / (1 - good_share)))
    if rows:
        y = _posterior(np.array([v for v, _, _ in rows]), says_bad, good_share)
        of, bucket, value = np.repeat(np.arange(len(rows)), [len(b) for _, b, _ in rows]), np.concatenate([b for _, b, _ in rows]), np.concatenate([x for _, _, x in rows])
        del rows
        often = np.bincount(bucket, minlength=ALL_FEATURES)[bucket] >= least_docs
        of, value = of[often], value[often]
        used, bucket = np.unique(bucket[often], return_inverse=True)
        w, m, v, mb, vb = np.zeros(len(used)), np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
        for epoch in range(1, epochs + 1):  # logistic regression on soft labels, Adam, a little decay
            g = (1 / (1 + np.exp(-np.clip(np.bincount(of, w[bucket] * value, len(y)) + bias, -60, 60))) - y) / len(y)
            gw, gb = np.bincount(bucket, g[of] * value, len(used)) + 1e-6 * w, g.sum()
            m, v, mb, vb = m + 0.1 * (gw - m), v + 0.01 * (gw**2 - v), mb + 0.1 * (gb - mb), vb + 0.01 * (gb**2 - vb)
            w -= rate * m / (1 - 0.9**epoch) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-9)
            bias -= rate * mb / (1 - 0.9**epoch) / (np.sqrt(vb / (1 - 0.99**epoch)) + 1e-9)
        weights[used] = w
    return QualityModel(says_bad, good_share, weights, bias)


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """All rows and columns of docs, and quality: the scorer's chance that a text is good (double).

    Null and empty texts, and those of white space alone, have 0. A column quality of docs is replaced. Repeated rows are scored alike, an empty docs gives no rows, and a very long text is one task's work.
    """
    sent, own = docs.sparkSession.sparkContext.broadcast(model), docs.drop("quality")
    at = own.columns.index(text)

    def weighed(words):
        """The labellers' measures of words, and what a word adds to the score of a text that is made of it alone."""
        made, weights = word_measures(words), sent.value.weights
        return np.column_stack([made[:, :9], weights[made[:, 9:].astype(np.int64)].sum(axis=1)])

    def score(rows, numbers):
        n = len(numbers)
        if not n:
            return 0.0
        z = rows[:, 9].sum() / n + sent.value.weights[steps_of(measures(rows, numbers))].sum() + sent.value.bias
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))

    def scored(batch, found):
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, "quality"])

    schema = own.withColumn("quality", F.lit(0.0).cast("double")).schema
    return own.mapInArrow(_scan(at, weighed, score, scored), schema)


def good_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.5, **options) -> DataFrame:
    """The rows of docs with a quality of `least` or more, with the columns of docs."""
    scored = score_quality(hidden(docs), train(docs, key, text, **options), hidden_name(docs, text))
    return shown(scored.where(F.col("quality") >= least), docs)
