"""Rows, items, elements and lengths that stages once left out or judged by less than the whole."""

import random

from quillmark.llm import contamination, pages, quality, similarity


def test_one_of_each_decides_by_row(spark):
    r = random.Random(5)
    a, b, c, d = (" ".join(f"w{r.randrange(10**6)}" for _ in range(60)) for _ in range(4))
    near = f"{a} more"
    rows = [(1, a, "x"), (2, near, "x"), (2, b, "y"), (3, c, "x"), (3, c, "x"), (3, c.upper(), "x"), (4, d, "x"), (4, f"{d} more", "x"), (5, b, "x"), (6, None, "x"), (6, "", "y"), (6, " ", "z"), (None, a, "x"), (None, a, "x"), (7, "one of a kind", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = similarity.one_of_each(frame)
    got = sorted(((x["doc_id"], x["text"], x["source"]) for x in found.collect()), key=repr)
    one_of_four = [x for x in got if x[0] == 4]
    want = [(1, a, "x"), (2, b, "y"), (3, c.upper(), "x"), *one_of_four, (6, None, "x"), (6, "", "y"), (6, " ", "z"), (None, a, "x"), (None, a, "x"), (7, "one of a kind", "x")]
    assert found.columns == frame.columns and len(one_of_four) == 1 and got == sorted(want, key=repr)


def test_items_without_id_contaminate(spark):
    docs = spark.createDataFrame([(1, "x a b c y"), (2, "x d e f y"), (3, "z z z")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "a b c"), ("7", "d e f"), (None, "d e f")], "item_id string, text string")
    got = {x["doc_id"]: (x["n"], x["hit_items"]) for x in contamination.contaminated_spans(docs, items).select("doc_id", contamination.hit_words().alias("n"), "hit_items").collect()}
    assert got == {1: (3, []), 2: (3, ["7"]), 3: (0, [])}
    assert [x["doc_id"] for x in contamination.decontaminate(docs, items).collect()] == [3]


def test_hidden_elements_end_with_themselves_or_their_parent():
    texts = lambda html: [b.text for b in pages.blocks(html)]
    assert texts('<p>One</p><svg class="icon"/><p>two</p><math/><p>three</p><svg><path d="M0"/><text>no</text></svg><p>four</p>') == ["One", "two", "three", "four"]
    assert texts("<p>So <math><semantics><mi>x</mi><mo>=</mo><mn>2</mn><mspace/><annotation>x=2</annotation></semantics></math> holds.</p>") == ["So x=2 holds."]
    for tag in ("svg", "object", "select", "template"):
        assert texts(f"<div>a<{tag}>no<b>no</b></div><p>b</p><div>c<{tag}>no</{tag}>d</div>") == ["a", "b", "c", "d"]
        assert texts(f'<p>a <a href="/"><{tag} x=1></a> b</p><p>c</p>')[-1] == "c"
    assert texts("<ul><li>a<svg>no<li>b</ul><p>c<p>d") == ["a", "b", "c", "d"]
    assert texts("<svg class=icon/>no</svg>a") == ["a"]


def test_few_words_does_not_grow_with_length():
    r, few = random.Random(6), [name for name, _, _ in quality.LABELLERS].index("few_words")

    def measured(n):
        words = [int(60_000 * r.random() ** 3) for _ in range(n)]
        numbers = quality.np.array(words)
        return quality.measures(quality.np.zeros((n, 10)), numbers)[few], 1 - len(set(words)) / n

    short, whole = measured(quality.PART_WORDS)
    assert short == whole and short < 0.85
    long, whole = measured(50 * quality.PART_WORDS)
    assert whole > 0.85 and abs(long - short) < 0.02
    assert quality.measures(quality.np.zeros((90_000, 10)), quality.np.arange(90_000) % 30)[few] > 0.99
