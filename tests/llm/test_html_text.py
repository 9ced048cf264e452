import re

import numpy as np
import pytest

from reviewgrain.llm import html_text

SF = "/root/testdata/sf0.001"


def test_blocks():
    page = (
        "<!doctype html><head><title>T</title><script>x='</p>'</script></head><body><!-- <p>no</p> --><p>One &amp; <b>two\n three</b><br>four<p>Five"
        "<ul><li><a href=x>six</a><li>seven</ul></body> tail <p"
    )
    cut = html_text.parts(page)
    assert [p.text for p in cut] == ["T", "One & two three four", "Five", "six", "seven", "tail"]
    assert cut[3].linked == 1 and cut[0].path[-1][0] == "title"
    assert html_text.parts(None) == html_text.parts("") == html_text.parts("<div></div>") == []


def test_custom_and_unclosed_elements_keep_the_rest_of_the_page():
    texts = lambda page: [p.text for p in html_text.parts(page)]
    assert texts('<p>one</p><svg-icon name="x"></svg-icon><p>two</p><article>three</article>') == ["one", "two", "three"]
    for name in ("video-player", "audio-player", "template-x", "math-field", "script-x"):
        assert texts(f"<p>one</p><{name}>in</{name}><p>two") == ["one", "in", "two"]
    for name in html_text.SKIPPED:
        assert texts(f"<p>one<{name} a='b'><p>two<{name.upper()}>no</{name} ><p>three<{name}/><p>four<{name}><{name}><p>five") == ["one", "three", "four", "five"]
        assert texts(f"<p>one<{name}><p>two") == ["one", "two"]
    assert texts("<p>one<script>x<p>two") == texts("<p>one<style>x<p>two") == texts("<p>one<textarea>x<p>two") == ["one"]


def test_gradients():
    rng = np.random.default_rng(0)
    one = html_text.Direction(3, 2, rng)
    one.w = one.w.astype(np.float64)
    x, weight = rng.standard_normal((4, 2, 3)), rng.standard_normal((4, 2, 2))
    out, memory = one.forward(x, True)
    dw, _ = one.backward(x, memory, weight)
    for at in [(0, 0), (2, 3), (4, 7), (3, 5)]:
        keep = one.w[at]
        one.w[at] = keep + 1e-3
        up = (one.forward(x) * weight).sum()
        one.w[at] = keep - 1e-3
        down = (one.forward(x) * weight).sum()
        one.w[at] = keep
        assert abs((up - down) / 2e-3 - dw[at]) < 2e-2


@pytest.fixture(scope="module")
def net(spark):
    return html_text.fit(spark.read.parquet(f"{SF}/pages.parquet"))


def test_given_pages(spark, net):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for row in html_text.extract(pages, net, keep=["page_id", "url", "html"]).collect():
        body = re.search(r"<article>(.*?)(</article>|\Z)", row.html, re.S)[1]
        assert row.text == "\n".join(p.text for p in html_text.parts(f"<article>{body}</article>")) and row.n_chars == len(row.text)


def test_composed_pages(net):
    rng, vectors = np.random.default_rng(77), html_text.Vectors()
    texts = ["Some longer sentence about things, and more of it." * 2, "Another part of the story that goes on."]
    wrong = total = 0
    for _ in range(100):
        cut = html_text.parts(html_text.compose(rng, texts, ["Buy now, only today at your shop."], ["Home", "More", "About us"]))
        found = net.scores([vectors.page(cut)])[0] >= 0.5
        wrong, total = wrong + sum(bool(f) != html_text.kept_by_mark(b) for f, b in zip(found, cut, strict=True)), total + len(cut)
    assert wrong <= 0.06 * total


def kept(net, page):
    cut = html_text.parts(page)
    return [b.text for b, p in zip(cut, net.scores([html_text.Vectors().page(cut)])[0], strict=True) if p >= 0.5]


def test_pages_without_telling_names(net):
    river = lambda n: [f"The river {i} rises in the hills, runs past old mills and meets the sea near a small town." for i in range(n)]
    block = lambda n: "".join(f"<p>{t}</p>" for t in river(n))
    title, links, notice = "The river of the north", '<a href="/a">Home</a> <a href="/b">About</a> <a href="/c">News</a>', "Copyright 2021 The River Company"
    for n in (3, 6, 12):
        whole = [title, *river(n)]
        assert kept(net, f"<body>{block(n)}</body>") == river(n)
        assert kept(net, f"<body><h1>{title}</h1>{block(n)}</body>") == whole
        assert kept(net, f'<body><div class="js-r7 col-8"><h1>{title}</h1>{block(n)}</div></body>') == whole
        assert kept(net, f'<div class="x1">{links}</div><div class="x2"><h1>{title}</h1>{block(n)}</div><div class="x3">{notice}</div>') == whole
    first = "The first words of the text, which goes on for a while here.<br>The second line of it, also long enough to read."
    assert len(kept(net, f"<body><div>{first}</div><p>The third part of the text is a paragraph of its own.</p></body>")) == 2


def test_structures_that_training_never_sees(net):
    """Containers, texts and notices that no training page has: precision and recall of blocks."""
    rng = np.random.default_rng(3)
    pick = lambda values: values[rng.integers(len(values))]
    nouns, verbs = "harbour winter engine violin orchard parliament glacier market kettle lantern".split(), "carries remembers follows opens leaves measures".split()
    sentence = lambda: f"The {pick(nouns)} {pick(verbs)} the {pick(nouns)}, while a {pick(nouns)} {pick(verbs)} another {pick(nouns)}."
    text = lambda: " ".join(sentence() for _ in range(rng.integers(1, 5)))
    right = found = wanted = 0
    for _ in range(200):
        body = [text() for _ in range(rng.integers(3, 15))]
        links = "".join(f'<dd><a href="/{pick(nouns)}">{pick(nouns)}</a></dd>' for _ in range(rng.integers(3, 8)))
        notice = pick((f"© {rng.integers(1990, 2030)} {pick(nouns)} works", "All rights reserved.", "Read our privacy policy.", "Log in or register here"))
        form = rng.integers(3)
        inner = "".join(f"<p>{t}</p>" for t in body) if form else "".join(f'<div class="ln">{t}</div>' for t in body)
        page = (
            f'<table id="q0"><tr><td class="zz"><dl>{links}</dl></td><td class="yy">{inner}</td></tr></table><center>{notice}</center>' if form == 1
            else f'<div id="root"><div class="css-1x9"><dl>{links}</dl></div><div class="css-8hh"><div>{inner}</div></div><div class="css-0a">{notice}</div></div>'
        )
        got = kept(net, page)
        right, found, wanted = right + len(set(got) & set(body)), found + len(set(got)), wanted + len(set(body))
    assert right >= 0.95 * found and right >= 0.95 * wanted, (right, found, wanted)


def test_odd_rows(spark, net):
    rows = [(1, "u", None, "x"), (None, None, "", "x"), (2, "u", "<p", "x"), (3, "u", "a" * 100_000, "x"), (3, "u", "a" * 100_000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = html_text.extract(pages, net).collect()
    assert len(out) == 5 and [r.text for r in out if r.page_id in (1, None)] == ["", ""]
    assert html_text.extract(pages.limit(0), html_text.fit(pages.limit(0))).count() == 0
