"""What once was capped or held to one side: many languages, counts, blocks, joins, heavy keys, many hits, pages with misleading names."""

import pickle
import random
import re
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quillmark.llm import common, contamination, dedup, language, mixing, pages, quality, queries, secrets, similarity, toxicity

SMALL = "/root/testdata/sf0.001"


def test_two_hundred_languages():
    r = np.random.default_rng(1)
    scores = r.normal(0, 1, (40, 200)).astype(np.float32)
    scores[:20, 150], scores[20:, 199] = 50, 50
    label = language.viterbi(scores, np.array([0]), np.array([40]), 2.0)
    assert label.tolist() == [150] * 20 + [199] * 20


def test_script_of_most_letters():
    names = [language.SCRIPTS[k] for k in language.scripts_of(["aпривет", "helloд", "漢字かな", "é"])]
    assert names[:2] == ["cyrillic", "latin"] and names[3] == "latin"


def test_languages_equal_plain_viterbi(spark):
    """Each whole text of the small table, decoded word by word in plain Python."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    held_out = queries.crc_remainder(F.col("doc_id"), 4) == 2
    model = language.train(docs.where(~held_out), "doc_id", "lang", "text")
    got = {x["doc_id"]: x for x in queries.op3_language_spans(spark, SMALL).collect()}
    for doc in docs.collect():
        words = language.LETTERS.findall((doc["text"] or "").lower())
        if not words:
            assert (got[doc["doc_id"]]["lang_pred"], got[doc["doc_id"]]["score"]) == ("und", 0.0)
            continue
        scores = model.word_scores(words).astype(float)
        best, back = scores[0].copy(), []
        for row in scores[1:]:
            top = int(best.argmax())
            back.append([k if best[k] >= best[top] - model.penalty else top for k in range(len(best))])
            best = np.maximum(best, best[top] - model.penalty) + row
        at = int(best.argmax())
        path = [at]
        for step in reversed(back):
            path.append(at := step[at])
        weight = {}
        for w, k in zip(words, reversed(path), strict=True):
            weight[model.languages[k]] = weight.get(model.languages[k], 0) + len(w)
        own = got[doc["doc_id"]]
        assert abs(own["score"] - weight.get(own["lang_pred"], 0) / sum(weight.values())) < 1e-3 and weight[own["lang_pred"]] == max(weight.values())


def test_counts_beyond_sixteen_bits():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([1], pa.int32()), pa.array(["aa " * 70_000])], names=["_y", "_text"])
    found = next(toxicity.subword_counts(iter([batch])))
    counts = np.frombuffer(found["counts"][0].as_py(), np.int64)
    assert counts.max() >= 70_000 and counts.sum() == found["size"][0].as_py()


def test_toxicity_equals_plain_averages(spark):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{SMALL}/labels.parquet")
    held_out = queries.crc_remainder(F.col("doc_id"), 5) == 0
    model = toxicity.train(docs.where(~held_out), labels.where(~held_out), "doc_id", "text", "toxic")
    got = {x["doc_id"]: x["score"] for x in queries.op9_subword_toxicity(spark, SMALL).collect()}
    for doc in docs.collect():
        total = np.zeros(2)
        n = 0
        for w in toxicity.TOKEN.findall((doc["text"] or "").lower()):
            bucket, _ = toxicity.ngram_buckets([w], toxicity.SIZES, toxicity.BUCKETS, whole=True)
            total += (model.embeddings[bucket] @ model.weights).sum(axis=0)
            n += len(bucket)
        z = total / max(1, n) + model.biases
        assert abs(got[doc["doc_id"]] - 1 / (1 + np.exp(z[0] - z[1]))) < 1e-4


def test_word_measures_equal_plain_ones():
    words = ["Hello", "ÉCOLE", "a--b", "__", "x!!", "123", "A1b2", "…", "日本語", "ß", "a" * 50, "!?", "don't", "\ud800x"]
    rows = quality.word_measures(words)
    for w, row in zip(words, rows, strict=True):
        letters, capitals, signs = (sum(f(c) for c in w) for f in (str.isalpha, str.isupper, lambda c: not c.isalnum()))
        run = re.search(r"([^\w\s])\1", w) is not None
        assert row[:9].tolist() == [letters, capitals, letters > 2 and capitals == letters, run, signs == len(w), signs, len(w), len(w) > 40, len(w) - signs < 4 and signs < len(w)]
    same = quality.word_measures(["abc", "xyz", "abcd", "a" * 30, "ab1", "xy22"])
    assert same[0, 9] == same[1, 9] and same[0, 9] != same[3, 9] and same[4, 9] != same[0, 9] and same[0, 10] != same[1, 10]
    tail = quality.word_measures(["!a!b!c!d!e!f!1", "!a!b!c!d!e!f!g"])  # shapes that differ behind the twelfth place
    assert tail[0, 9] != tail[1, 9]


def test_scores_of_quality_equal_plain_ones(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    model = quality.train(docs)
    got = {x["doc_id"]: x["score"] for x in queries.op10_weak_label_quality(spark, SMALL).collect()}
    for doc in docs.collect():
        words = (doc["text"] or "").split()
        numbers = np.array([words.index(w) for w in words]) if len(words) < 3000 else None
        if numbers is None:
            continue
        rows = quality.word_measures(words)
        bucket, value = quality.features(quality.measures(rows, numbers), rows, len(words))
        want = 1 / (1 + np.exp(-np.clip(model.weights[bucket] @ value + model.bias, -60, 60))) if words else 0.0
        assert abs(got[doc["doc_id"]] - want) < 1e-3


def test_automaton_is_compact():
    r = random.Random(1)
    words = [b"w%d" % i for i in range(5000)]
    items = [(str(i), [r.choice(words) for _ in range(100)]) for i in range(500)]
    a = contamination.SuffixAutomaton(items, 13)
    assert len(pickle.dumps(a)) < 60 * 50_000


def test_documents_stay_without_long_spans(spark):
    item = " ".join(f"b{i}" for i in range(20))
    rest = " ".join(f"w{i}" for i in range(500))
    rows = [(1, f"{rest} {item} {rest}", 7), (2, f"x {item}", 7), (3, rest, 7), (4, None, None), (5, "", 0), (1, f"{rest} {item} {rest}", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hit_items int")
    bench = spark.createDataFrame([("q", item), ("r", "b3 b4"), (None, "w400 w401")], "item_id string, text string")
    for block in (500_000, 5):
        got = sorted(((x["doc_id"], x["text"], x["hit_items"]) for x in contamination.decontaminate(docs, bench, longest=13, most_words=block).collect()), key=repr)
        assert got == sorted([(1, f"{rest}  {rest}", 7), (1, f"{rest}  {rest}", 7), (3, rest, 7), (4, None, None), (5, "", 0)], key=repr)


@pytest.mark.parametrize("ids", [0, 2_000_000])
def test_both_joins_of_candidates(spark, ids):
    r = random.Random(3)
    base = [[f"w{r.randrange(200)}" for _ in range(60)] for _ in range(8)]
    rows = [(i, " ".join(base[i % 8][: 60 - i % 3]), "x") for i in range(60)] + [(3, "another text of five words", "y"), (4, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted(map(tuple, similarity.one_of_each(docs, broadcast_ids=ids).collect()), key=repr)
    assert got == sorted(map(tuple, similarity.one_of_each(docs).collect()), key=repr) and len(got) < 15


def test_half_of_all_rows_in_one_group(spark):
    rows = [(f"k{i}", "the same text again" if i % 2 else f"text number {i}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    got = dedup.exact_copies(docs)
    assert got.count() == 2000 and {(x["keep_id"], x["group_size"]) for x in got.where("group_size > 1").collect()} == {("k1", 1000)}
    keyed = docs.selectExpr("cast(substr(doc_id, 2) as long) as doc_id", "text")
    classes = similarity.similarity_classes(keyed)
    assert classes.where("component = 1").count() == 1000 and classes.where("component <> doc_id").count() == 999


def test_heavy_keys_are_few(spark):
    counts = spark.createDataFrame([(i, 1 + 10_000 * (i % 50 == 0)) for i in range(5000)], "k int, n long")
    total = counts.agg(F.sum("n")).first()[0]
    assert common.heavy_keys(counts, "k", "n", total).count() < common.HEAVY


def test_identifiers_that_clash_are_taken_anew(spark, monkeypatch):
    real = similarity.fingerprint
    monkeypatch.setattr(similarity, "fingerprint", lambda s, round_=0: (1, real(s)[1]) if round_ == 0 and len(s) else real(s, round_))
    table = similarity._sketches(spark.createDataFrame([(1, "a b c d e f"), (2, "g h i j k l")], "doc long, text string"), 5, lambda s: similarity.segment_keys(s, 80), 0)
    assert table.where(F.col("kind") == similarity.CHECK).count() >= 2
    assert real(np.array([1, 2], np.uint64))[0] != real(np.array([1, 2], np.uint64), 1)[0]


def test_sixty_thousand_secrets_in_one_text(spark):
    run = "0123456789abcdef01234567"
    docs = spark.createDataFrame([(1, f"{run} " * 64_000), (2, f"{run} AKIA{'Z' * 20}"), (3, None), (2, f"{run} AKIA{'Z' * 20}")], "doc_id long, text string")
    start = time.time()
    got = secrets.find_secrets(docs).select("doc_id", F.size("secrets").alias("n"), F.try_element_at("secrets", F.lit(-1)).alias("last")).collect()
    found = sorted((x["doc_id"], x["n"], (x["last"]["start"], x["last"]["end"], x["last"]["kind"]) if x["n"] > 0 else None) for x in got)
    assert found == [(1, 64_000, (63_999 * 25, 64_000 * 25 - 1, "hex")), (2, 2, (25, 49, "access")), (2, 2, (25, 49, "access")), (3, 0, None)]
    assert time.time() - start < 90


def test_only_candidates_are_matched(spark):
    """Without the posting lists of a rule's trigrams, its matches are lost: results come through the index."""
    docs = spark.createDataFrame([(1, "password=abcdefgh"), (2, "nothing here")], "_id long, _text string")
    query = secrets.trigram_query(secrets.BASE_RULES[0].pattern)
    vocabulary = secrets.trigrams(query)
    index = secrets.postings(docs, vocabulary)
    assert [tuple(x) for x in secrets.candidates(index, [query], vocabulary).collect()] == [(1, [0])]
    assert secrets.candidates(index.where(F.col("trigram") == -1), [query], vocabulary).count() == 0


def cut_queue(rows, budget, order):
    """Words taken of each document if all entries of all copies are served in this order up to the budget."""
    entries = []
    for x in rows:
        for copy in range(3):
            for k in range(0, x["size"], mixing.QUANTUM):
                upto = min(x["size"], k + mixing.QUANTUM)
                entries.append((order(x, copy, upto), x["source"], x["doc_id"], copy, k, upto - k))
    taken = {}
    for *_, i, _, _, words in sorted(entries):
        taken[i] = taken.get(i, 0) + min(words, budget)
        budget -= min(words, budget)
    return taken


def test_mix_is_the_global_sort_cut_at_the_budget(spark, monkeypatch):
    r = random.Random(5)
    rows = [(i, " ".join("w" for _ in range(r.choice([3, 40, 400]))), r.choice("abcd")) for i in range(120)]
    monkeypatch.setattr(mixing, "buckets_for", lambda n: 37)
    out = mixing.mix_words(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    got, budget = {x["doc_id"]: x["taken"] for x in out}, sum(x["size"] for x in out)
    by_finish = cut_queue(out, budget, lambda x, copy, upto: (x["words_before"] + copy * x["source_size"] + upto) / x["target"])
    assert got == {i: by_finish.get(i, 0) for i in got} and sum(got.values()) == budget
    assert got != cut_queue(out, budget, lambda x, copy, upto: x["doc_id"])  # the order decides


def test_mix_of_one_row_repeated(spark):
    rows = [(7, "one two three four", "a")] * 3000 + [(i, "five six", "b") for i in range(500)]
    out = mixing.mix_words(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken = {s: sum(x["taken"] for x in out if x["source"] == s) for s in "ab"}
    assert len(out) == 3500 and sum(taken.values()) == 13000 and abs(taken["b"] - 3000) <= 4
    assert len({x["words_before"] for x in out if x["source"] == "a"}) == 3000


def test_blocks_write_hits_alone(spark, tmp_path, monkeypatch):
    """Three blocks of items: the documents are written once, and each block adds its hits."""
    import os

    words = [f"w{i}" for i in range(60)]
    filler = " ".join(f"x{i}" for i in range(20_000))
    docs = spark.createDataFrame([(i, f"{filler} {' '.join(words[i : i + 20])}" if i < 30 else filler + str(i)) for i in range(40)], "doc_id long, text string")
    items = spark.createDataFrame([(k, " ".join(words[20 * k : 20 * k + 20])) for k in range(3)], "item_id long, text string")

    def size(folder, name):
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files if f"/{name}-" in d and f.endswith(".parquet"))

    monkeypatch.setattr(common, "shared_dir", lambda _: str(tmp_path))
    found = contamination.contaminated_spans(docs, items, most_words=20)
    got = {x["doc_id"]: (x["n_words"], x["n"], x["hit_items"]) for x in found.select("doc_id", "n_words", contamination.hit_words().alias("n"), "hit_items").collect()}
    one = contamination.contaminated_spans(docs, items)
    assert got == {x["doc_id"]: (x["n_words"], x["n"], x["hit_items"]) for x in one.select("doc_id", "n_words", contamination.hit_words().alias("n"), "hit_items").collect()}
    written = [size(str(tmp_path), name) for name in ("numbered", "hits", "contaminated")]
    assert written[0] > 0 and 0 < written[1] < written[0] / 4 and written[2] == 0
    cut = contamination.remove_spans(docs, items, longest=13, most_words=20).collect()
    assert {x["doc_id"]: x["text"] for x in cut} == {x["doc_id"]: x["text"] for x in contamination.remove_spans(docs, items, longest=13).collect()}


def test_quality_sample_is_bounded_in_bytes(spark, monkeypatch):
    rows = [(i, " ".join(f"w{(i * 7 + k) % 997}" for k in range(200))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    learned = []
    fit = quality._posterior
    monkeypatch.setattr(quality, "_posterior", lambda votes, *a: learned.append(len(votes)) or fit(votes, *a))
    quality.train(docs, most_bytes=sum(len(t) for _, t in rows) // 8, epochs=1)
    assert 20 <= learned[-1] <= 90


PROSE = ["The council met on Tuesday to discuss the new bridge over the river.", "Members voted eleven to four in favour of the plan.", "Work is to begin in the spring of next year."]
H, P = "<h1>Bridge approved</h1>", "".join(f"<p>{x}</p>" for x in PROSE)
WHOLE = " ".join(["Bridge approved", *PROSE])
HAND_MADE = {
    "body of a layout with a sidebar": (f'<html><body class="right-sidebar"><article>{H}{P}</article></body></html>', WHOLE),
    "body that has a sidebar": (f'<body class="has-sidebar"><div class="content">{H}{P}</div></body>', WHOLE),
    "wrapper with a menu": (f'<div class="page-with-menu"><div class="content">{H}{P}</div></div>', WHOLE),
    "article on related work": (f'<article class="related-work">{H}{P}</article>', WHOLE),
    "a sentence": ("<article><p>One short sentence.</p></article>", "One short sentence."),
    "no names": (f'<html><body><div><a href="/">Home</a> <a href="/about">About us</a></div><div>{H}{P}</div><p><a href="/about">About us</a></p><p>Copyright 2020 Example Ltd</p></body></html>', WHOLE),
    "by-line in the article's footer": (f"<article>{H}{P}<footer><p>By Jane Doe</p></footer></article>", WHOLE),
    "free of promotion": (f'<article>{H}<p class="promo-free">Our review is free of any paid content.</p>{P}</article>', "Bridge approved Our review is free of any paid content. " + " ".join(PROSE)),
    "formula": ("<article><h1>Sums</h1><p>We know that <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds here.</p></article>", "Sums We know that x=2 holds here."),
    "scripts asked for": (f"<body><noscript>Please enable JavaScript to use this site.</noscript><article>{H}{P}</article></body>", WHOLE),
    "comments that are articles": (f'<body><article>{H}{P}<div id="comments" class="comments-area"><ol class="comment-list"><li class="comment"><article class="comment-body"><p>I think this is a great idea.</p></article></li></ol></div></article></body>', WHOLE),
    "more comments than text": (f'<body><div class="post">{H}{P}</div><section class="comments"><h3>Comments</h3>' + "".join(f'<div class="comment"><p>Sam</p><p>This is comment number {i} and it goes on for a good while.</p></div>' for i in range(12)) + "</section></body>", WHOLE),
    "rights in the article": (f"<body><article>{H}{P}<p>All rights reserved.</p></article><footer><p>&copy; Example</p></footer></body>", WHOLE + " All rights reserved."),
    "a form around the page": (f'<html><body><form id="aspnetForm"><div id="nav"><a href="/">Home</a> <a href="/n">News</a></div>{H}{P}</form></body></html>', WHOLE),
    "a form and the article": (f"<body><form><article>{H}{P}</article></form></body>", WHOLE),
    "a form without a main heading": (f'<html><body><form id="aspnetForm"><h2>Bridge approved</h2>{P}</form></body></html>', WHOLE),
    "a menu that never ends": (f'<body><nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul><article>{H}{P}</article></body>', WHOLE),
    "an article named search": (f'<body><article class="search">{H}{P}</article></body>', WHOLE),
    "a sidebar in main": (f'<body><main>{H}{P}<div class="sidebar"><p>Popular: read this next story today.</p></div></main></body>', WHOLE),
    "a dialog": (f"<body><dialog open><p>Sign up for our newsletter today and never miss a story.</p></dialog><article>{H}{P}</article></body>", WHOLE),
    "a table that lays out the page": (f"<body><table><tr><td>Home News</td><td>{H}{P}</td></tr></table></body>", WHOLE),
    "such a table with links": (f'<body><table><tr><td><a href="/">Home</a> <a href="/n">News</a></td><td>{H}{P}</td></tr></table></body>', WHOLE),
    "text that isn't shown": (f'<body><article>{H}{P}<div style="color: red; display : none"><p>This text is not shown to anyone.</p></div><p hidden>Nor this one here.</p></article></body>', WHOLE),
    "a class named hidden": (f'<body><article>{H}<div class="hidden md:block">{P}</div></article></body>', WHOLE),
}


@pytest.mark.parametrize("name", HAND_MADE)
def test_pages_made_by_hand(name):
    html, want = HAND_MADE[name]
    assert pages.main_text(html, pages.trained()) == want


def test_pages_equal_brute_force_decoding(spark):
    """Labels of whole pages against the best of a plain recursion, and the query against these blocks."""
    model = pages.trained()
    got = queries.op6_page_text(spark, SMALL).toPandas().set_index("page_id")
    for page in pd.read_parquet(f"{SMALL}/pages.parquet").itertuples():
        found = pages.blocks(page.html)
        score = [sum(model.weights.get(f, 0.0) for f in own) for own in pages.block_features(found)]
        best = {y: (model.first[y] + score[0] * y, [y]) for y in (0, 1)}
        for x in score[1:]:
            best = {y: max(((v + model.steps[p][y] + x * y, [*path, y]) for p, (v, path) in best.items()), key=lambda z: z[0]) for y in (0, 1)}
        label = max(best.values(), key=lambda z: z[0])[1]
        assert got.loc[page.page_id].text == " ".join(b.text for b, y in zip(found, label, strict=True) if y)


def test_pages_with_clashing_and_repeated_rows(spark):
    rows = [(1, "u", f"<article>{H}{P}</article>", "own", 5), (1, "u", f"<article>{H}{P}</article>", "own", 5), (2, None, None, None, None), (None, "v", "", "x", 1)]
    out = pages.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string, text string, size int"))
    got = sorted(((x["page_id"], x["text"], x["n_chars"], x["size"]) for x in out.collect()), key=repr)
    assert got == sorted([(1, WHOLE, len(WHOLE), 5), (1, WHOLE, len(WHOLE), 5), (2, "", 0, None), (None, "", 0, 1)], key=repr)


@pytest.mark.parametrize("page", [lambda n: "<div><p>x</p>" * n, lambda n: "<a><div>" * n + "</a>" * n + "x", lambda n: "<b>" * n + "<p>x" * n, lambda n: "<div>" * n + "<p>x</p></span>" * n])
def test_deep_pages_take_linear_time(page):
    start = time.perf_counter()
    assert isinstance(pages.main_text(page(50_000), pages.trained()), str)
    assert time.perf_counter() - start < 20  # quadratic, this would be hours


def test_fitting_gives_the_kept_weights_again():
    model, kept = pages.fitted(), pages.trained()
    assert model.weights.keys() == kept.weights.keys() and all(abs(w - kept.weights[f]) < 0.01 for f, w in model.weights.items())
    assert np.allclose(model.steps, kept.steps, atol=0.01)


def test_letters_are_letters_and_marks_belong_to_them():
    assert [language.LETTERS.findall(x) for x in ("½ ² ① Ⅷ", "हिन्दी भाषा", "ภาษาไทย", "漢字", "a1b_c")] == [[], ["हिन्दी", "भाषा"], ["ภาษาไทย"], ["漢字"], ["a", "b", "c"]]


def test_languages_of_numbers_and_unknown_scripts(spark):
    known = [(i, t, x) for i, (t, x) in enumerate([("the house and the garden", "en"), ("das haus und der garten", "de")] * 20)]
    model = language.train(spark.createDataFrame(known, "doc_id long, text string, lang string"), "doc_id", "lang", "text")
    rows = [(1, "½ ² ① Ⅷ 12"), (2, "漢字"), (3, "the house 漢字"), (4, "हिन्दी"), (5, None), (6, "das haus")]
    got = {x["doc_id"]: (x["lang_pred"], round(x["score"], 3)) for x in language.label_languages(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got[1] == got[5] == ("und", 0.0) and got[6] == ("de", 1.0)
    assert got[2][0] in ("de", "en") and got[2][1] == got[4][1] == 0.0 and got[3] == ("en", 0.8)


def test_one_row_of_equal_texts_stays(spark):
    rows = [(1, "a b"), (1, "a  b"), (2, "a b"), (1, "c"), (3, "c"), (None, "c"), (None, "d"), (None, "d")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    found = dedup.exact_copies(d).collect()
    by_text = {}
    for x in found:
        by_text.setdefault(x["text_sha256"], []).append((x["doc_id"], x["keep_id"], x["group_size"], x["kept"]))
    assert len(found) == 8 and all(sum(x[3] for x in g) == 1 for g in by_text.values())
    assert sorted(len(g) for g in by_text.values()) == [2, 3, 3] and {g[0][1] for g in by_text.values()} == {1, None}
    assert sorted((x["doc_id"], " ".join(x["text"].split())) for x in dedup.without_copies(d).collect() if x["doc_id"]) == [(1, "a b"), (1, "c")]
    assert dedup.without_copies(d).count() == 3


def test_one_call_clears_the_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_dir", lambda _: str(tmp_path))
    rows = spark.createDataFrame([(1, "a b c"), (2, "a b c")], "doc_id long, text string")
    assert dedup.exact_copies(rows).count() == 2 and list(tmp_path.rglob("*.parquet"))
    common.clear_tables(spark)
    assert not list(tmp_path.rglob("*.parquet"))
