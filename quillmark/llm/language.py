"""Language identification: script ranges, word scores, and Viterbi with a switching penalty over the words of a text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.words import LETTERS, WordTable, by_steps, ngram_buckets, sampled

#: First code points of ranges of scripts, and the scripts.
SCRIPT_RANGES = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B80, "tamil"), (0x0C00, "telugu"),
    (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"),
    (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0x20000, "han"), (0x32000, "other"),
)
SCRIPTS = tuple(dict.fromkeys(s for _, s in SCRIPT_RANGES))
STARTS = np.array([a for a, _ in SCRIPT_RANGES], np.uint32)
SCRIPT_AT = np.array([SCRIPTS.index(s) for _, s in SCRIPT_RANGES], np.int8)
SIZES, BUCKETS = (1, 2, 3, 4), 1 << 16
#: What a word costs in a language that isn't written in its script.
WRONG_SCRIPT = 50.0


def scripts_of(words: list[str]) -> np.ndarray:
    """The script of most letters of each word; of equally many, the one that comes first in SCRIPTS."""
    out = np.zeros(len(words), np.int8)
    for k in range(0, len(words), 50_000):  # a table of words by scripts, in parts
        part = words[k : k + 50_000]
        codes = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32)
        script = SCRIPT_AT[np.searchsorted(STARTS, codes, side="right") - 1]
        of = np.repeat(np.arange(len(part)), np.fromiter(map(len, part), np.int64, len(part)))
        out[k : k + len(part)] = np.bincount(of * len(SCRIPTS) + script, minlength=len(part) * len(SCRIPTS)).reshape(len(part), -1).argmax(axis=1)
    return out


@dataclass(frozen=True)
class LanguageModel:
    """languages; log probabilities of n-gram buckets in each; whether each is written in each script."""

    languages: tuple[str, ...]
    log_p: np.ndarray
    written_in: np.ndarray
    penalty: float

    def word_rows(self, words: list[str]) -> np.ndarray:
        """word_scores, and in a last column whether any language is written in the word's script."""
        fits = self.written_in[:, scripts_of(words)].any(axis=0) if words else np.empty(0)
        return np.column_stack([self.word_scores(words), fits.astype(np.float32)])

    def word_scores(self, words: list[str]) -> np.ndarray:
        """A row for each word, a column for each language: n-gram log likelihoods, less the best one's."""
        out = np.zeros((len(words), len(self.languages)), np.float32)
        if not words:
            return out
        bucket, of = ngram_buckets(words, SIZES, BUCKETS)
        first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
        for k in range(len(self.languages)):
            out[:, k] = np.add.reduceat(self.log_p[k][bucket], first) / 2  # n-grams overlap
        fits = self.written_in[:, scripts_of(words)].T
        out = np.where(fits, out, out - WRONG_SCRIPT)
        out[~fits.any(axis=1)] = 0
        return out - out.max(axis=1, keepdims=True)


def bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (lang, text): (lang, bucket, n) for the n-gram buckets of each part's words; buckets from BUCKETS on count scripts."""
    for batch in by_steps(batches):
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            by_lang.setdefault(lang, []).extend(LETTERS.findall(text.as_py().lower()))
        for lang, words in by_lang.items():
            if words:
                distinct, n = np.unique(np.array(words, dtype=object), return_counts=True)
                bucket, of = ngram_buckets(distinct.tolist(), SIZES, BUCKETS)
                counts = np.concatenate([np.bincount(bucket, n[of], BUCKETS), np.bincount(scripts_of(distinct.tolist()), n, len(SCRIPTS))])
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(counts[at].astype(np.int64))], names=["lang", "bucket", "n"])


def train(docs: DataFrame, key: str, lang: str, text: str, most_docs: int = 600, most_bytes: int = 2_000_000, penalty: float = 8.0) -> LanguageModel:
    """From a sample of rows with a language: most_docs documents and most_bytes of text for each language. The driver gets counts by bucket alone."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(key, lang, text)
    counted = sampled(known, key, lang, F.octet_length(text), most_docs, most_bytes).select(lang, text).mapInArrow(bucket_counts, "lang string, bucket long, n long")
    counts = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = np.array(counts["lang"].to_pylist(), dtype=object)
    bucket, n = counts["bucket"].to_numpy(), counts["n"].to_numpy()
    languages = tuple(sorted(set(names.tolist())))
    log_p, written_in = np.zeros((len(languages), BUCKETS), np.float32), np.zeros((len(languages), len(SCRIPTS)), bool)
    for k, name in enumerate(languages):
        own = np.bincount(bucket[names == name], n[names == name], BUCKETS + len(SCRIPTS))
        total, by_script = own[:BUCKETS] + 0.1, own[BUCKETS:]
        log_p[k] = np.log(total / total.sum())
        written_in[k] = by_script >= 0.01 * by_script.sum()
    return LanguageModel(languages, log_p, written_in, penalty)


def viterbi(scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of each row of scores; texts are rows starts .. starts + lengths, and each change of label in one costs penalty.

    All texts go forward together, a word at a time: the longest first, so that those that go on are a prefix.
    """
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    label, longest = np.zeros(len(scores), np.int32), int(lengths.max(initial=0))
    going = np.searchsorted(-lengths, -np.arange(longest), side="left")  # how many texts have a word t
    best_at, stays = np.zeros(len(scores), np.int32), np.zeros(scores.shape, bool)
    v = np.zeros((len(starts), scores.shape[1]), np.float32)
    for t in range(longest):
        n = going[t]
        rows, now = starts[:n] + t, v[:n]
        if t:
            best = now.argmax(axis=1)
            switched = now[np.arange(n), best][:, None] - np.float32(penalty)
            stay = now >= switched
            best_at[rows], stays[rows] = best, stay
            now[...] = np.where(stay, now, switched)
        now += scores[rows]
        now -= now.max(axis=1, keepdims=True)
    at = v.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        n = going[t]
        rows = starts[:n] + t
        label[rows] = at[:n]
        if t:
            at[:n] = np.where(stays[rows, at[:n]], at[:n], best_at[rows])
    return label


SPANS = "lang_spans array<struct<start:long,end:long,lang:string>>, lang_pred string, score double"


def label_languages(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_spans, lang_pred, score) of each row of docs.

    lang_spans: spans of words (letters with their marks; start, end exclusive, language) of the best labelling. lang_pred: the language
    with the most letters in words of a script that any language is written in; score: their share of all letters, so 0 where no language fits.
    und, with score 0 and no spans, if the text is null or has no letter (signs for numbers are none), or nothing was learned. Repeated rows are labelled alike, an empty
    docs gives no rows, and a very long text is one task's work, a step for each of its words.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        table, names = WordTable(model.word_rows), np.array(model.languages, dtype=object)
        for batch in by_steps(batches):
            table.trim()
            numbers, letters = [], []
            for value in batch.column(1):
                words = LETTERS.findall((value.as_py() or "").lower()) if len(names) else []
                numbers.append(table.numbers(words))
                letters.append(np.fromiter(map(len, words), np.int64, len(words)))
            lengths = np.fromiter(map(len, numbers), np.int64, len(numbers))
            starts = np.cumsum(lengths) - lengths
            all_numbers, all_letters = np.concatenate(numbers), np.concatenate(letters)
            rows = table.rows()[all_numbers] if len(all_numbers) else np.empty((0, len(names) + 1), np.float32)
            label, told = viterbi(rows[:, :-1], starts, lengths, model.penalty), all_letters * rows[:, -1]
            spans, preds, scores = [], [], []
            for a, n in zip(starts.tolist(), lengths.tolist(), strict=True):
                if not n:
                    spans.append([])
                    preds.append("und")
                    scores.append(0.0)
                    continue
                own = label[a : a + n]
                weight, every = (np.bincount(own, x[a : a + n], len(names)) for x in (told, all_letters))
                top = int(weight.argmax() if weight.any() else every.argmax())
                preds.append(names[top])
                scores.append(float(weight[top] / every.sum()))
                cuts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))).tolist()
                spans.append([{"start": s, "end": e, "lang": names[own[s]]} for s, e in zip(cuts, [*cuts[1:], n], strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind), pa.array(preds, pa.string()), pa.array(scores, pa.float64())], names=[key, "lang_spans", "lang_pred", "score"])

    own = docs.select(key, text)
    return own.mapInArrow(scan, f"`{key}` {own.schema[0].dataType.simpleString()}, {SPANS}")


def brute_viterbi(scores: np.ndarray, penalty: float) -> float:
    """The best total by plain recursion over labels; for tests."""
    best = list(map(float, scores[0]))
    for row in scores[1:]:
        best = [max(b - penalty * (j != k) for j, b in enumerate(best)) + float(row[k]) for k in range(len(best))]
    return max(best)

