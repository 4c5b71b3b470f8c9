import random

import numpy as np
import pytest

from scarp.llm import html_extract as he


def invented_pages(n=60, seed=1):
    rng = random.Random(seed)
    words = [a + b for a in ("an", "the", "or", "in", "re") for b in ("tion", "ing", "er", "ly", "o")]

    def sentence(k):
        return " ".join(rng.choice(words) for _ in range(k)).capitalize() + "."
    pages, wanted = [], []
    for k in range(n):
        title, paragraphs = sentence(6), [sentence(rng.randint(3, 60)) for _ in range(rng.randint(1, 9))]
        menu = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in rng.sample(words, 4))
        body = "".join(f"<p>{p}</p>" if rng.random() < 0.7 else f"<p><b>{p}<br>" for p in paragraphs)
        pages.append(f'<html><head><title>{title}</title><style>p{{}}</style><script>var t="</p>";</script></head><body><nav><ul>{menu}'
                     f'</ul></nav><!-- ad --><div class="ad">{sentence(4)}</div><article><h1>{title}</h1>{body}</article>'
                     f"<footer>&copy; {sentence(5)}</footer>" + ("</body></html>" if k % 3 else ""))
        wanted.append("\n\n".join([title, *paragraphs]))
    return pages, wanted


@pytest.fixture(scope="module")
def model():
    return he.fit(invented_pages()[0])


def test_blocks_paths_and_references():
    page = ('<div class="Post  body" id=x1><p>a &amp; b&nbsp;c<br>d <b>e</b><p>f<ul><li>1<li>2</ul></div><!-- <p>no</p> -->'
            '<script>x("<p>")</script><a href="/">l&quot;</a> t &am <textarea>n</textarea><p>cut <a')
    got = [(b.text, b.path[-1] if b.path else "") for b in he.blocks_of(page)]
    assert got == [("a & b c d e", "p"), ("f", "p"), ("1", "li"), ("2", "li"), ('l" t &am', ""), ("cut <a", "p")]
    assert he.blocks_of(page)[0].path[0] == "div post body x"
    assert he.blocks_of("") == [] and he.blocks_of("<!-- open") == [] and he.blocks_of("<script>open") == []


def test_held_out_pages_and_designs(model):
    pages, wanted = invented_pages(40, seed=9)
    parsed = [he.blocks_of(p) for p in pages]
    hits = he.label(model, parsed, he.Words(), {})
    got = ["\n\n".join(b.text for b, h in zip(bs, hs) if h) for bs, hs in zip(parsed, hits)]
    assert np.mean([g == w for g, w in zip(got, wanted)]) >= 0.97
    rng, right, total = random.Random(5), 0, 0
    for page, want in zip(pages, wanted):
        blocks, labels = he.design(want.split("\n\n"), ["Some other text here.", "Sign up now"], rng)
        right += int((he.label(model, [blocks], he.Words(), {})[0] == np.array(labels).astype(bool)).sum())
        total += len(labels)
    assert right / total > 0.95


def test_labels_do_not_depend_on_the_batch(model):
    parsed = [he.blocks_of(p) for p in invented_pages(12, seed=3)[0]]
    together = he.label(model, parsed, he.Words(), {})
    for blocks, hit in zip(parsed, together):
        assert (he.label(model, [blocks], he.Words(), {})[0] == hit).all()


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    p = he.Labeller.fresh().p
    x, mask = rng.normal(size=(2, 4, he.PATH_DIM + he.WORD_DIM + he.NUMBERS)), np.array([[1, 1, 1, 1], [1, 1, 0, 0.0]])
    up = rng.normal(size=(2, 4, he.HIDDEN))
    for way in "fb":
        grads = {}
        out, kept = he.lstm(x, mask, p, way)
        dx = he.lstm_back(up, x, kept, p, way, grads)
        for name, at in ((f"{way}_rec", (3, 5)), (f"{way}_in", (7, 40)), (f"{way}_b", (20,))):
            old = p[name][at]
            p[name][at] = old + 1e-5
            more = (he.lstm(x, mask, p, way)[0] * up).sum()
            p[name][at] = old - 1e-5
            less = (he.lstm(x, mask, p, way)[0] * up).sum()
            p[name][at] = old
            assert grads[name][at] == pytest.approx((more - less) / 2e-5, rel=1e-4, abs=1e-7)
        assert dx.shape == x.shape and (dx[1, 2:] == 0).all()


def test_nulls_repeats_long_pages_and_no_rows(spark, model):
    pages, wanted = invented_pages(2, seed=7)
    long = "<body><article><h1>T t t.</h1>" + "<p>One sentence of a long page.</p>" * 30_000 + "</article></body>"
    rows = [(1, "u", pages[0], "x"), (1, "u", pages[0], "x"), (None, None, pages[1], None), (3, "v", None, "x"), (4, "w", "", "x"), (5, "l", long, "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = he.extract(df, model)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    by_id = {}
    for r in got.collect():
        assert r.n_chars == len(r.text)
        by_id.setdefault(r.page_id, []).append(r.text)
    assert by_id[1] == [wanted[0]] * 2 and by_id[None] == [wanted[1]] and by_id[3] == by_id[4] == [""]
    assert by_id[5][0].count("One sentence") > 29_000
    assert he.extract(df.limit(0), he.fit_on(df.limit(0))).count() == 0


def test_broken_pages_take_linear_time():
    import time
    import tracemalloc
    for page in ("<div>x" * 200_000, "<svg>x" * 100_000, "<a>x" * 100_000 + "</b>" * 100_000, "<li><b>" * 50_000 + "<p>y" * 50_000):
        start = time.perf_counter()
        assert he.blocks_of(page)
        assert time.perf_counter() - start < 8
    tracemalloc.start()
    he.blocks_of("<div>x" * 20_000)
    assert tracemalloc.get_traced_memory()[1] < 60 * 2 ** 20
    tracemalloc.stop()


def test_formulas_are_text_and_unclosed_pictures_hide_nothing():
    page = "<article><p>area <math><mi>a</mi><mo>=</mo><msup><mi>r</mi><mn>2</mn></msup></math> holds</p><svg><p>kept</p><object><p>too</p></article><svg>gone</svg>"
    assert [b.text for b in he.blocks_of(page)][0] == "area a=r2 holds"
    assert [b.text for b in he.blocks_of("<p>a</p><object><p>kept</p><noscript>b")] == ["a", "kept", "b"]
    assert [b.text for b in he.blocks_of("<p>a</p><script>var x = 1; <p>no")] == ["a"]
