import numpy as np
import pytest

from shoplark.llm import html_text
from shoplark.llm.boosting import fit
from shoplark.llm.html_text import decode, extract, extract_main_text, features, parse, train


@pytest.fixture(scope="module")
def model():
    return train()


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    found = fit(x[:3000], y[:3000], trees=30, depth=3)
    assert ((found.probability(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95


def test_held_out_pages(model):
    maker, wrong, total = html_text.PageMaker(77), 0, 0
    for _ in range(150):
        nodes, kept = maker.page()
        got = decode(nodes, np.clip(model.margin(features(nodes)), -6, 6))
        wrong += sum(n.own for n, a, b in zip(nodes, kept, got) if a != b)
        total += sum(n.own for n in nodes)
    assert wrong / total < 0.03


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></ul></nav>
<div class="ad">Buy now, it is cheap.</div><article><h1>Head &amp; more</h1><p><b>First <i>par</i>t.<br>Next&nbsp;line<p>a &lt; b &copy; &#8364;<!-- note --> 1 < 2</p>
<aside class="related"><h3>Related</h3><ul><li><a href=x>One</a><li><a href=y>Two</a></ul></aside><p>Last pa<span>ra</span>graph here.</article>
<section id="comments"><h3>Comments</h3><div class="comment"><p>I disagree with all of this.</p></div></section><form><label>Mail</label><input name=q></form><footer>&copy; us</footer></body></html>"""


def test_a_page_with_everything(model):
    assert extract([PAGE], model) == ["Head & more First part. Next line a < b © € 1 < 2 Last paragraph here."]


def test_decoding_has_no_contradictions_on_a_path():
    nodes, _ = parse("<div>" * 7 + "<p>x</p>")
    assert decode(nodes, np.array([-6, 6, -3, 6, 6, 6, 6, 6, -6.0]))[1:] == [True] * 7 + [False]
    rng = np.random.default_rng(0)
    for _ in range(200):
        taken = decode(nodes, rng.normal(size=len(nodes)) * 4)
        assert np.abs(np.diff(np.array([0, *taken, 0], int))).sum() in (0, 2)


def test_forgiving_parser():
    for page in ("", "plain", "<p>cut <b", "<p>cut <", "<div", "<<p>x", "</p></x>", "<script>never closed", "<p a='>'>q</p>", "<!-- open", "<a><div></a>x</div>", "<p title=\"it's\">y", "\x00<p>z", "<li>" * 500, "<div>" * 3000 + "deep"):
        nodes, texts = parse(page)
        assert all(0 <= n.parent < n.order for n in nodes[1:]) and all(0 <= i < len(nodes) for i, _ in texts)


def test_rows(spark, model):
    rows = [(1, "u", PAGE, "c"), (2, None, None, "c"), (3, "u", "", "c"), (1, "u", PAGE, "c"), (4, "u", "<body><article><p>" + "word " * 200_000 + "</article>", "c")]
    got = {r.page_id: r for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()}
    assert got[2].text == got[3].text == "" and got[2].n_chars == 0 and got[2].url is None
    assert got[1].n_chars == len(got[1].text) == 70
    assert got[4].n_chars == 5 * 200_000 - 1
    assert extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize(
    "begin",
    ['<svg viewBox="0 0 1 1"/>', "<math/>", "<svg><path d=x/>", "<svg><style/><g>", "<math><mrow>", "<object data=x>", "<noscript>", "<select><option>one", "<template>", "<svg><path/></svg>", "<object><object>in</object>", "<svg><foreignObject><p>in</p></foreignObject></svg>", "<!-- <svg> --><script>'<svg>'</script>"],
)
@pytest.mark.parametrize("more", ["", "<svg><text>label</text></svg><object>in</object><noscript>in</noscript><select><option>in</select><template>in</template><math><mi>in</mi></math>"])
def test_no_prefix_is_cut(begin, more):
    said = "".join(t for _, t in parse(f"<body>{begin}<p>The article.</p>{more}<div>Its end.</div></body>")[1]).split()
    assert [w for w in said if w not in ("one", "in")] == ["The", "article.", "Its", "end."]


def test_closed_elements_are_left_out():
    page = "<p>a<svg><svg>x</svg><title>x</title>x</svg>b<object>x<object>x</object>x</object>c<noscript><img src=x>x</noscript>d<template><svg>x</template>e<math><mtext><p>x</p></mtext></math>f<select><option>x</select>g<script>'</svg>'</script>h"
    assert "".join(t for _, t in parse(page)[1]).split() == ["abcdefgh"]


def test_many_unclosed_elements_take_linear_time():
    assert "".join(t for _, t in parse("<object>" * 30_000 + "end")[1]) == "end"
