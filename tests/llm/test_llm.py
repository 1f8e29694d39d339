"""Operators for training data: against brute force, and null, empty, long, repeated and clashing input."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmark.llm import contamination, dedup, language, mixing, pages, quality, secrets, sharding, similarity, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "long words go on and on " * 4000
#: Null in each column, empty and long texts, ties and repeated rows.
ODD = [(1, "one two three", "en", "a", 13), (1, "one two three", "en", "a", 13), (2, None, "en", None, None), (3, "", None, "b", 0), (None, "no key here", "en", "b", 11), (4, LONG, "de", "a", len(LONG)), (5, " \t\n", "fr", None, 3), (6, "one  two\nthree", None, "b", 14)]
#: Names that operators use themselves.
CLASHES = ["id", "size", "shard", "slot", "target", "taken", "copy", "n_words", "hit_spans", "quality", "secrets", "component", "in_0", "key", "kind", "score", "position", "bucket", "secret", "doc"]


def documents(spark, rows, clashing=False):
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHES}) if clashing else df


def table(df):
    return sorted(map(tuple, df.collect()), key=repr)


def mixed_texts(seed, n, vocabulary=30, most=40):
    r = random.Random(seed)
    return [" ".join(f"w{r.randint(0, vocabulary)}" for _ in range(r.randint(0, most))) for _ in range(n)]


def test_every_operator_takes_odd_and_empty_tables(spark):
    bench = spark.createDataFrame([(1, "one two"), (2, None), (None, "three"), (3, "")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (4, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    web = "page_id long, url string, html string"
    for rows in (ODD, []):
        d = documents(spark, rows, clashing=True)
        n = len(rows)
        assert sharding.shard_records(d).count() == n
        assert mixing.mix_words(d).count() == n
        assert set(mixing.mix_documents(d).columns) == set(d.columns)
        assert contamination.contaminated_spans(d, bench).count() == n
        assert contamination.decontaminate(d, bench.limit(0)).count() == n
        assert dedup.exact_copies(d).count() == n
        assert similarity.similarity_classes(d).count() == n
        assert similarity.one_of_each(d).columns == d.columns
        assert secrets.find_secrets(d).count() == n
        assert language.label_languages(d, language.train(d, "doc_id", "lang", "text")).count() == n
        assert toxicity.score_toxicity(d, toxicity.train(d, labels, "doc_id", "text", "toxic")).count() == n
        assert quality.score_quality(d, quality.train(d)).count() == n
        assert quality.good_documents(d).columns == d.columns
        p = spark.createDataFrame([(i, None, r[1]) for i, r in enumerate(rows)], web)
        assert pages.extract_pages(p).count() == n


def test_filters_return_own_columns_unchanged(spark):
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(mixed_texts(5, 40))]
    d = documents(spark, rows, clashing=True)
    own = {tuple(r) for r in d.collect()}
    for out in (mixing.mix_documents(d), contamination.decontaminate(d, spark.createDataFrame([(1, "w1 w2")], "item_id long, text string")), similarity.one_of_each(d), dedup.without_copies(d), quality.good_documents(d)):
        assert out.columns == d.columns and {tuple(r) for r in out.collect()} <= own


def test_sharding_moves_rows_only_into_the_new_shard(spark):
    d = documents(spark, [(i, f"text {i}", "en", "a", 6) for i in range(3000)])
    few, more = (dict(sharding.shard_records(d, weights=(1.0,) * n).select("doc_id", "shard").collect()) for n in (7, 8))
    grown = dict(sharding.shard_records(d, weights=(1.0,) * 7).select("doc_id", "grown_shard").collect())
    assert grown == more
    assert all(more[i] in (few[i], 7) for i in few) and 250 < sum(more[i] == 7 for i in more) < 500
    weighted = [r[0] for r in sharding.shard_records(d, weights=(1.0, 0.0, 3.0)).select("shard").collect()]
    assert 1 not in weighted and 2.6 < weighted.count(2) / weighted.count(0) < 3.4


def test_slots_are_gapless_with_repeated_rows(spark):
    d = documents(spark, [(i % 50, "same" if i % 3 else f"t{i}", "en", "a", 4) for i in range(600)])
    rows = sharding.shard_records(d, weights=(1.0,) * 5).collect()
    for shard in range(5):
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert all(r["text_crc32"] == zlib.crc32(r["text"].encode()) and r["size"] == len(r["text"]) + 8 for r in rows)


def water_fill(sizes, weights, repeats):
    """Targets by sharing out again and again; the plain way."""
    total, fixed = sum(sizes), {}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        left, w = total - sum(fixed.values()), sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / w > repeats * sizes[i]]
        if not over:
            return [fixed.get(i, left * weights[i] / w if w else 0.0) for i in range(len(sizes))]
        fixed |= {i: repeats * sizes[i] for i in over}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mix_meets_targets(spark, seed):
    r = random.Random(seed)
    names = [None, "b", "é", "a", "z", "𝒳", "￮"]
    rows = [(i, " ".join("w" for _ in range(r.randint(0, 30))) if r.random() < 0.9 else None, "en", s, 0) for i, s in enumerate(s for s in names for _ in range(r.choice([1, 3, 60])))]
    out = mixing.mix_words(documents(spark, rows)).collect()
    order = sorted(names, key=lambda s: (s is None, s or ""))
    sizes = [sum(len((t or "").split()) for _, t, _, s, _ in rows if s == name) for name in order]
    targets = water_fill(sizes, [(5, 2, 1)[k % 3] for k in range(len(order))], 3)
    for name, size, target in zip(order, sizes, targets, strict=True):
        own = [x for x in out if x["source"] == name]
        assert {x["source_size"] for x in own} == {size} and all(abs(x["target"] - target) < 1e-6 for x in own)
        assert abs(sum(x["taken"] for x in own) - target) <= 60 and all(x["taken"] <= 3 * x["size"] for x in own)
    again = mixing.mix_words(documents(spark, rows[::-1]).repartition(3)).collect()
    assert {(x["doc_id"], x["taken"]) for x in out} == {(x["doc_id"], x["taken"]) for x in again}


def test_mixed_documents_are_whole_and_near_targets(spark):
    rows = [(i, " ".join("w" for _ in range(1 + i % 17)), "en", f"s{i % 4}", 0) for i in range(400)]
    d = documents(spark, rows)
    queue = {r["source"]: (r["target"], r["source_size"]) for r in mixing.fair_queue(d).collect()}
    got = mixing.mix_documents(d).collect()
    assert {tuple(r) for r in got} <= set(rows)
    for name, (target, _) in queue.items():
        assert abs(sum(len(r["text"].split()) for r in got if r["source"] == name) - target) <= 34


@pytest.mark.parametrize("seed", range(30))
def test_automaton_finds_what_all_windows_find(seed):
    r = random.Random(seed)
    letters = "abcde"[: r.randint(1, 5)]
    for _ in range(30):
        items = [(str(i), " ".join(r.choice(letters) for _ in range(r.randint(0, 9)))) for i in range(r.randint(0, 5))]
        docs = [" ".join(r.choice(letters + "z") for _ in range(r.randint(0, 25))) for _ in range(3)]
        window = r.randint(1, 4)
        a = contamination.SuffixAutomaton([(i, contamination.words_of(t)) for i, t in items if contamination.words_of(t)], window)
        for doc, want in zip(docs, contamination.brute_force(docs, items, window), strict=True):
            words = contamination.words_of(doc)
            spans, found = a.matches(words)
            assert (len(words), sum(b - x for x, b in spans), sorted(found)) == want


def test_contamination_in_blocks_equals_one_pass(spark):
    texts, items = mixed_texts(1, 60, vocabulary=3), [(i, t) for i, t in enumerate(mixed_texts(2, 12, vocabulary=3, most=9))]
    d, b = documents(spark, [(i, t, "en", "a", 0) for i, t in enumerate(texts)]), spark.createDataFrame(items, "item_id long, text string")
    one, many = (table(contamination.contaminated_spans(d, b, window=4, most_words=n).select("doc_id", "n_words", contamination.hit_words().alias("n"), "hit_items")) for n in (500_000, 10))
    want = contamination.brute_force(texts, [(str(i), t) for i, t in items], 4)
    assert one == many == sorted(((i, n, h, items) for i, (n, h, items) in enumerate(want)), key=repr)
    cut = {r["doc_id"]: r["text"] for r in contamination.remove_spans(d, b, window=4, longest=1).collect()}
    assert all(len(contamination.words_of(cut[i])) == n - h for i, (n, h, _) in enumerate(want))


def test_words_are_ascii_letters_digits_and_all_else_beyond():
    assert contamination.words_of("Ab-9z_É x\x7fq") == [b"ab", b"9z", "É x".encode(), b"q"]


def test_chunks_follow_content():
    r = random.Random(1)
    text = bytes(r.choice(b"abcdefgh ") for _ in range(60_000))
    a, b = dedup.chunks(text), dedup.chunks(b"something in front " + text)
    assert b"".join(a) == text and len(a) > 5 and len(set(a) & set(b)) >= len(a) - 2 and max(map(len, a)) <= dedup.MOST
    assert dedup.chunks(b"") == [] and dedup.chunks(b"x") == [b"x"] and b"".join(dedup.chunks(b"x" * 200_000)) == b"x" * 200_000


def test_exact_copies(spark):
    r = random.Random(2)
    base = [None, "", "a b", LONG, *mixed_texts(3, 20)]
    texts = [re.sub(" ", lambda _: r.choice([" ", "  ", "\n", "\t\x0b"]), t) if t and r.random() < 0.7 else t for t in (r.choice(base) for _ in range(200))]
    got = {x["doc_id"]: x for x in dedup.exact_copies(documents(spark, [(i, t, "en", "a", 0) for i, t in enumerate(texts)])).collect()}
    plain = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in texts]
    for i, p in enumerate(plain):
        assert (got[i]["keep_id"], got[i]["group_size"], got[i]["kept"]) == (plain.index(p), plain.count(p), plain.index(p) == i)
        assert got[i]["text_sha256"] == hashlib.sha256(p.encode()).hexdigest()


@pytest.mark.parametrize(("seed", "shingle", "percent"), [(1, 4, 85), (2, 5, 80), (3, 1, 80)])
def test_similarity_classes_lose_no_link(spark, seed, shingle, percent):
    r, texts = random.Random(seed), {}
    for size in (6, 20, 60, 150):
        base = [f"w{r.randint(0, 400)}" for _ in range(size)]
        for _ in range(30):
            x = list(base)
            for _ in range(r.randint(0, r.choice([1, 2, 4, 8]))):
                i, k = r.randrange(len(x)), r.random()
                if k < 0.4:
                    x[i] = f"n{r.randint(0, 9 if k < 0.2 else 10**6)}"
                elif k < 0.7:
                    x.insert(i, f"n{r.randint(0, 10**6)}")
                elif len(x) > 1:
                    del x[i]
            texts[len(texts)] = " ".join(x)
    for t in ("", None, "  \n", "a", "A", "a b", "b", "É", "é"):
        texts[len(texts)] = t
    d = documents(spark, [(i, t, "en", "a", 0) for i, t in texts.items()]).repartition(5)
    got = {x["doc_id"]: (x["n_shingles"], x["component"]) for x in similarity.similarity_classes(d, shingle=shingle, percent=percent).collect()}
    assert got == similarity.brute_force(texts, shingle, percent)


@pytest.mark.parametrize("percent", [50, 80, 85, 95])
def test_linked_sets_share_a_segment_key(percent):
    r = np.random.default_rng(percent)
    lows, _, _ = similarity.bands(percent)
    assert all(100 * (low - 1) // percent < lows[j + 1] for j, low in enumerate(lows[1:-1], 1))  # a link leads to the next band at most
    for n in (1, 2, 5, 8, 30, 200):
        for _ in range(60):
            a = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
            b = np.unique(np.concatenate([a[r.random(len(a)) > r.random() * 0.2], r.integers(0, 2**63, int(r.integers(0, max(2, n // 8)))).astype(np.uint64)]))
            common, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
            if len(b) and 100 * common >= percent * union and common < union:
                assert len(np.intersect1d(similarity.segment_keys(a, percent), similarity.segment_keys(b, percent)))


def python_secrets(text):
    out = []
    for rank, rule in enumerate(secrets.BASE_RULES):
        for m in re.finditer(rule.pattern, text or ""):
            if len(m[rule.group]) >= rule.least:
                out.append((m.start(), rank, m.end(), rule.kind))
    return sorted(out)


def test_secrets_equal_a_plain_scan(spark):
    r = random.Random(4)
    parts = ["password=", "PassWd : ", "token=token:", "api_key='", "APIKEY\" = \"", "secret", "AKIA", "AKIAAKIA", "abcdef0123456789", "deadbeef" * 3, "XYZ", "=", "é𝒳 ", "\n", " ", "x1", "-----BEGIN RSA PRIVATE KEY-----"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(400)] + [None, "", LONG]
    got = {x["doc_id"]: [(s["start"], s["rank"], s["end"], s["kind"]) for s in x["secrets"] if s["kind"] in ("assign", "access", "hex")] for x in secrets.find_secrets(documents(spark, [(i, t, "en", "a", 0) for i, t in enumerate(texts)])).collect()}
    assert got == {i: python_secrets(t) for i, t in enumerate(texts)}


def test_trigram_queries_are_mandatory():
    assert secrets.trigram_query(r"[0-9a-f]{24,}") is True and secrets.trigram_query(r"(?:abcd)?x") is True
    assert secrets.trigram_query(r"AKIA[A-Z0-9]+") == ("and", "aki", "kia")
    assert secrets.trigram_query(r"foo(?:bar|[0-9]+)") == "foo" or "foo" in secrets.trigrams(secrets.trigram_query(r"foo(?:bar|[0-9]+)"))


def test_viterbi_is_best():
    r = np.random.default_rng(1)
    lengths = np.array([0, 1, 7, 30, 3])
    starts = np.cumsum(lengths) - lengths
    scores = r.normal(0, 3, (lengths.sum(), 3)).astype(np.float32)
    label = language.viterbi(scores, starts, lengths, 2.0)
    for a, n in zip(starts, lengths, strict=True):
        if n:
            own, s = label[a : a + n], scores[a : a + n]
            total = s[np.arange(n), own].sum() - 2.0 * (own[1:] != own[:-1]).sum()
            assert abs(total - language.brute_viterbi(s, 2.0)) < 1e-3


def test_language_spans_and_scripts(spark):
    en, ru = "the house of the king and the sea ", "дом у моря и старый король спит "
    de = "das haus und der könig schläft nicht mehr "
    rows = [(i, t * 3, lang, "a", 0) for i, (t, lang) in enumerate([(en, "en"), (ru, "ru"), (de, "de")] * 6)]
    model = language.train(documents(spark, rows), "doc_id", "lang", "text")
    asked = documents(spark, [(0, en * 2 + ru * 2 + de, None, None, 0), (1, "12 !?", None, None, 0), (2, None, None, None, 0), (3, "könig der nicht", None, None, 0), (4, "漢字", None, None, 0)])
    got = {r["doc_id"]: r for r in language.label_languages(asked, model).collect()}
    assert [s["lang"] for s in got[0]["lang_spans"]] == ["en", "ru", "de"] and got[0]["lang_pred"] in ("en", "ru")
    assert got[1]["lang_pred"] == got[2]["lang_pred"] == "und" and got[1]["score"] == 0 and got[3]["lang_pred"] == "de" and got[4]["lang_pred"] in ("en", "ru", "de")


def test_toxicity_learns_subwords(spark):
    r = random.Random(6)
    plain = ["river", "stone", "garden", "window", "letter", "market", "summer", "winter", "paper", "silver"]
    bad = ["blorptastic", "zugmuffin", "kranketron"]
    rows, labels = [], []
    for i in range(400):
        words, toxic = [r.choice(plain) + r.choice("abcdef") for _ in range(40)], i % 4 == 0
        if toxic:
            words[5] = words[20] = r.choice(bad)
        rows.append((i, " ".join(words), "en", "a", 0))
        labels.append((i, 1, int(toxic)))
    model = toxicity.train(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), "doc_id", "text", "toxic")
    asked = [" ".join([r.choice(plain) + "e" for _ in range(38)] + [w, w]) for w in ("blorptastik", "zugmufin", "kranketronn", "harbour", "meadow")]
    got = {x["doc_id"]: x["score"] for x in toxicity.score_toxicity(documents(spark, [(i, t, "en", "a", 0) for i, t in enumerate([*asked, None, ""])]), model).collect()}
    assert min(got[i] for i in (0, 1, 2)) > 0.5 > max(got[i] for i in (3, 4)) and got[5] == got[6] and 0 <= got[5] <= 1


def test_labellers_are_weighed_by_agreement():
    patterns = np.array([[1] * 9, [2, 2, 1, 1, 1, 1, 1, 1, 1], [1, 1, 2, 2, 2, 1, 2, 1, 1], [1, 1, 1, 1, 1, 1, 1, 1, 2]])
    says_bad, share = quality.fit_labellers(patterns, np.array([900.0, 60, 40, 2]))
    good = quality._posterior(patterns, says_bad, share)
    assert good[0] > 0.95 and max(good[1], good[2]) < 0.1 and 0.85 < share < 0.95


def test_quality_rejects_junk(spark):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghilmnoprstu") for _ in range(r.randint(1, 9)))
    prose = lambda: ". ".join(" ".join(word() for _ in range(r.randint(4, 12))).capitalize() for _ in range(8)) + "."
    junk = [lambda: " ".join(w for w in prose().split()[:6] for _ in range(30)), lambda: " ".join(w.upper() + "!!" for w in prose().split()), lambda: " | ".join(w for w in (prose() + prose()).split() if len(w) > 3), lambda: " ".join(w + "***" for w in prose().split())]
    rows = [(i, junk[i // 10 % 4]() if i % 10 == 0 else prose(), "en", "a", 0) for i in range(600)]
    kept = {x["doc_id"] for x in quality.good_documents(documents(spark, rows)).collect()}
    assert sum(i % 10 == 0 for i in kept) <= 4 and sum(i % 10 != 0 for i in kept) >= 535


def test_pages():
    page = """<html><head><title>T</title><style>p{}</style></head><body><!-- <p>no</p> --><nav><a href="/">Home</a><a>More</a></nav><div class="cookie-notice"><p>We use cookies.</p><button>OK</button></div>
    <article><h1>Big &amp;
    small</h1><p>One <b>bold</b>word.<br>Next&nbsp;line<p>Second paragraph, unclosed: 1 &lt; 2.<script>var x = "</p><p>bad";</script><div class="ad">Buy this now.</div><ul><li>first item<li>second item</ul>
    <section id="comments"><p>Nice post</p><p>I agree with the writer here.</p></section></article><aside><p>Related things to read.</p></aside><form><label>Your name here</label><input></form><footer>&copy; all of it</footer></body>"""
    assert pages.main_text(page, pages.trained()) == "Big & small One boldword. Next line Second paragraph, unclosed: 1 < 2. first item second item"
    assert pages.main_text(None, pages.trained()) == pages.main_text("", pages.trained()) == pages.main_text("<br></p><i>", pages.trained()) == ""
    assert isinstance(pages.main_text("<<>\"<p a='", pages.trained()), str)


def test_field_labels_unseen_pages():
    r, model = random.Random(99), pages.trained()
    wrong = total = 0
    for _ in range(150):
        page, label = pages.labelled_page(r)
        found = pages.blocks(page)
        assert len(found) == len(label)
        wrong += sum(a != b for a, b in zip(model.decode(pages.block_features(found)), label, strict=True))
        total += len(label)
    assert wrong <= 0.02 * total


def test_field_gradient_and_decoding():
    r = random.Random(3)
    data = [([[f"f{r.randint(0, 3)}"] for _ in range(n)], [bool(r.randint(0, 1)) for _ in range(n)]) for n in (1, 4, 6)]
    model = pages.train_crf(data, epochs=20)
    for found, _ in data:
        score = lambda y: model.first[y[0]] + sum(model.weights.get(f[0], 0) * b for f, b in zip(found, y, strict=True)) + sum(model.steps[a][b] for a, b in zip(y, y[1:], strict=False))  # noqa: B023, E731
        every = [[i >> k & 1 for k in range(len(found))] for i in range(1 << len(found))]
        assert abs(score([int(b) for b in model.decode(found)]) - max(map(score, every))) < 1e-9
