"""Fast similarity sketches, filter interactions and source divergence: against plain versions, and odd input."""

import random
import re
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from quillmark.llm import divergence, interactions, minhash, similarity
from tests.llm.test_llm import DOCS, ODD, documents, mixed_texts, table

LABELS = "doc_id long, quality int, toxic int"


@pytest.mark.parametrize("length", [1, 8, 64])
def test_sketch_is_the_plain_one_and_full(length):
    r = np.random.default_rng(length)
    for n in (1, 2, 5, 40, 300):
        e = np.unique(r.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
        got = minhash.sketch(e, length).tolist()
        assert got == minhash.plain_sketch(e.tolist(), length) and len(got) == length
    assert len(minhash.sketch(np.empty(0, np.uint64), length)) == 0


def test_sketch_passes_do_not_change_it(monkeypatch):
    e = np.random.default_rng(3).integers(0, 2**63, 50, dtype=np.uint64)
    whole = minhash.sketch(e, 128).tolist()
    monkeypatch.setattr(minhash, "PASS_HASHES", 60)
    assert minhash.sketch(e, 128).tolist() == whole


@pytest.mark.parametrize("n", [20, 300, 5000])
def test_equal_coordinates_estimate_the_similarity(n):
    r = np.random.default_rng(n)
    found = []
    for _ in range(40):
        pool = np.unique(r.integers(0, 2**63, 2 * n, dtype=np.uint64))
        a, b = np.sort(pool[:n]), np.sort(pool[n // 10 : n + n // 10])
        found.append((minhash.sketch(a, 384) == minhash.sketch(b, 384)).mean())
    want = (n - n // 10) / (n + n // 10)
    assert abs(np.mean(found) - want) < 0.015 and np.std(found) < 1.3 * np.sqrt(want * (1 - want) / 384)
    assert minhash.missed(0.8) < 1e-8


def test_near_duplicates_equal_all_pairs(spark):
    r = random.Random(8)
    texts = mixed_texts(9, 60, vocabulary=400, most=200)
    for t in list(texts):
        for _ in range(3):
            words = t.split()
            for _ in range(r.randint(0, max(1, len(words) // 12))):
                if words:
                    words[r.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
    texts += [None, "", " \t", "one", "ONE", "one two", "two one"]
    want = similarity.brute_force(dict(enumerate(texts)), 2, 80)
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: x for x in minhash.near_duplicates(d, shingle=2).collect()}
    assert {i: (x["n_shingles"], x["component"]) for i, x in got.items()} == want
    assert all(x["kept"] == (i == x["component"]) for i, x in got.items())
    named = d.selectExpr("concat('k', lpad(doc_id, 4, '0')) AS doc_id", "text")
    for found in (minhash.near_duplicates(named, shingle=2), similarity.similarity_classes(named, shingle=2)):
        assert {x["doc_id"]: (x["n_shingles"], x["component"]) for x in found.collect()} == {f"k{i:04}": (n, f"k{c:04}") for i, (n, c) in want.items()}
    assert {x["doc_id"] for x in similarity.one_of_each(named, shingle=2).collect()} == {f"k{i:04}" for i, (n, c) in want.items() if i == c}


def test_new_operators_take_odd_and_empty_tables(spark):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (4, None, None), (None, 1, 1)], LABELS)
    for rows in (ODD, []):
        d = documents(spark, rows, clashing=True)
        found = minhash.near_duplicates(d).collect()
        assert len(found) == len(rows) and all(x["kept"] for x in found if x["doc_id"] in (None, 2, 3, 5))
        assert interactions.filter_audit(d, labels).count() == 600 * len({r[3] or "" for r in rows})
        assert divergence.source_divergence(d).columns == ["lang", "source", "part", "item", "value", "rank"]
    pairs = {(r["lang"], r["source"], r["item"]): r["value"] for r in divergence.source_divergence(documents(spark, ODD)).collect()}
    assert pairs == {("en", "", "a"): 0, ("en", "", "b"): 0, ("en", "a", ""): 0, ("en", "a", "b"): 0, ("en", "b", ""): 0, ("en", "b", "a"): 0}


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return [len(words), len(set(words)), sum("A" <= c <= "Z" for c in text or ""), sum(c in "#$%&*|" for c in text or ""), len(text or "")]


@pytest.mark.parametrize("step", [1 << 20, 64, 7])
def test_scans_equal_plain_counts(monkeypatch, step):
    r = random.Random(step)
    texts = [None, "", " ", "a", "a a A #é漢 a", "x" * 300, "é" * 100 + " y"]
    texts += ["".join(r.choice("ab A#é漢\t\n\x1c　") for _ in range(r.randint(0, 80))) for _ in range(300)]
    monkeypatch.setattr(interactions, "STEP_BYTES", step)
    classes, want = interactions.byte_classes("#$%&*|"), [plain_counts(t) for t in texts]
    column = pa.array(texts, pa.string())
    assert interactions.batch_measures(column, classes).T.tolist() == want
    assert interactions.batch_measures(column.slice(50, 200), classes).T.tolist() == want[50:250]
    assert interactions.batch_measures(column.cast(pa.large_string()), classes).T.tolist() == want
    monkeypatch.setattr(interactions, "word_hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    assert interactions.batch_measures(column, classes).T.tolist() == want  # all hashes alike: words are compared as such


def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    bad = {i for i, _, t in labels if t == 1 and i is not None}
    docs = []
    for i, text, part in rows:
        words, distinct, capitals, symbols, points = plain_counts(text)
        fails = {k for k, x in zip("ABCD", (words < 200, 100 * distinct < 50 * words, 100 * capitals > 2 * points, symbols > 0), strict=True) if x}
        if i is not None and any(j is not None and j < i and (t or "") == (text or "") for j, t, _ in rows):
            fails.add("E")
        docs.append((part or "", fails, i in good, i in bad))
    out = {}
    for part in {d[0] for d in docs}:
        own, total = [d for d in docs if d[0] == part], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                stay = [d for d in left if f not in d[1]]
                fail, alone = sum(f in d[1] for d in own), sum(d[1] == {f} for d in own)
                total[f] += len(gone)
                out[part, "".join(order), step] = [len(stay), len(gone), fail - len(gone), alone, sum(d[2] for d in gone), sum(d[3] for d in gone)]
                left = stay
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {(*k, *v) for k, v in out.items()}


def test_filter_audit_equals_applying_all_orders(spark):
    r = random.Random(4)
    rows = [(r.choice([None, *range(60)]), r.choice([None, "", " ".join(r.choice(["ab", "C", "d&", f"w{r.randint(0, 400)}"]) for _ in range(r.choice([5, 220, 400])))]), r.choice([None, "", "a", "b"])) for _ in range(120)]
    rows += [(200 + k, rows[5][1], "c") for k in range(40)] + [rows[6]] * 5
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1])) for i in range(60)] * 2 + [(None, 1, 1)]
    got = interactions.filter_audit(spark.createDataFrame(rows, "doc_id long, text string, source string"), spark.createDataFrame(labels, LABELS))
    assert {tuple(x) for x in got.collect()} == plain_audit(rows, labels)


def plain_divergence(rows, least, top):
    docs = [(lang or "", source or "", [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for lang, source, text in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        kept = sorted(t for t in {w for d in own for w in d[2]} if sum(t in d[2] for d in own) >= least)
        sources = sorted({d[1] for d in own})

        def shares(some, kept=kept):
            counts = [sum(d[2].count(t) for d in some) for t in kept]
            whole = sum(counts) + 5 * len(kept)
            return counts, [1 + 10**9 * (c + 5) // whole for c in counts]

        of = {s: shares([d for d in own if d[1] == s]) for s in sources}
        q = shares(own)[1]
        for s in sources:
            pairs = [(-sum(abs(x - y) for x, y in zip(of[s][1], of[b][1], strict=True)), b.encode(), "pair") for b in sources if b != s]
            told = [(y - x, t.encode(), "term") for t, n, x, y in zip(kept, *of[s], q, strict=True) if n and x > y]
            for listed in (sorted(pairs), sorted(told)[:top]):
                out |= {(lang, s, part, item.decode(), -v, rank) for rank, (v, item, part) in enumerate(listed, 1)}
    return out


@pytest.mark.parametrize("block", [2, 256])
def test_source_divergence_equals_plain_sums(spark, monkeypatch, block):
    r = random.Random(block)
    names = ["A", "b_c", "é", "漢字", "Z9z", "w", "it's", "\x7f", *(f"t{chr(97 + i)}" for i in range(20))]
    rows = [(r.choice(["en", "de", "de", None]), r.choice([None, *"abcde"]), r.choice([None, "", " ".join(r.choice(names[: r.randint(1, 28)]) for _ in range(r.randint(0, 30)))])) for _ in range(250)]
    rows += [("en", "a", "hot common words")] * 100 + [("fr", "x", "few"), ("fr", "y", None)]
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "PART", 7)
    if block == 2:  # functions that go to workers carry the module's own values: call them here
        shares = divergence.shares(np.array([0, 3, 10**13]), np.array([10, 8, 10**15]))
        assert shares.tolist() == [1 + 10**9 * 5 // 10, 1 + 10**9, 1 + 10**9 * (10**13 + 5) // 10**15]
        monkeypatch.setattr(divergence, "BLOCK", 256)
    got = divergence.source_divergence(spark.createDataFrame(rows, "lang string, source string, text string"), least_docs=20, top=5)
    assert set(table(got)) == plain_divergence(rows, 20, 5)


def test_pair_sums_by_block(monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 2)
    r = np.random.default_rng(1)
    counts, times = r.integers(0, 5, (30, 5)), r.integers(1, 4, 30)
    whole = counts.T @ times + 5 * times.sum()
    vectors = pa.table({"at": [np.flatnonzero(c).tolist() for c in counts], "n": [c[c > 0].tolist() for c in counts], "times": times})
    share = divergence.shares(counts, whole)
    for block in range(3):
        out = divergence.pair_sums(vectors.slice(3), pa.table({"lang": ["en"], "whole": [whole.tolist()], "block": [block]})).to_pylist()
        assert [(x["a"], x["b"]) for x in out] == [(a, b) for a in range(2 * block, min(5, 2 * block + 2)) for b in range(a + 1, 5)]
        assert all(x["value"] == int((times[3:] * np.abs(share[3:, x["a"]] - share[3:, x["b"]])).sum()) for x in out)


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 10)
    text = ("Ab cd-" * 50 + "x" * 40 + " é9é").encode()
    assert [t for some in divergence.terms(text) for t in some] == [b"ab", b"cd"] * 50 + [b"x" * 40, "é".encode(), "é".encode()]


def test_documents_schema_is_the_tables(spark):
    assert spark.createDataFrame([], DOCS).columns == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").columns
