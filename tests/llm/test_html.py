import html
import re

import numpy as np
import pytest

from lumbre.llm import html_labeller as H
from lumbre.llm.html_blocks import blocks
from lumbre.llm.query_html import op10_html
from tests.llm.conftest import SF


def texts(page):
    return [b.text for b in blocks(page)]


@pytest.mark.parametrize(
    "page, expected",
    [
        (None, []),
        ("", []),
        ("plain &amp; simple", ["plain & simple"]),
        ("<p>a&nbsp;b\n c <b>d</b>e</p>", ["a b c de"]),
        ("<p>one<p>two<br>three", ["one", "two", "three"]),
        ("<ul><li>a<li>b</ul>c", ["a", "b", "c"]),
        ("<script>if(a<b){x='</p>'}</script>y<style>p{}</style>", ["y"]),
        ("<head><title>t</title></head><body>b", ["b"]),
        ("a<!-- <p>x</p> -->b", ["ab"]),
        ("<a title='x>y'>link</a> &lt;tag&gt;", ["link <tag>"]),
        ("<div><p>x</div></p></div>y</span>", ["x", "y"]),
        ("text < 5 and <", ["text < 5 and <"]),
        ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]),
        ("x<unfinished", ["x"]),
        ("<noscript>no</noscript><textarea>no</textarea>yes", ["yes"]),
    ],
)
def test_blocks(page, expected):
    assert texts(page) == expected


@pytest.mark.parametrize(
    "page, expected",
    [
        ("<html><head><title>t</title><meta charset=utf-8><p>a<p>b", ["a", "b"]),
        ("<head><title>t</title><style>p{}</style> text <b>c</b>", ["text c"]),
        ("<head><title>t <p>x</title></head><p>a", ["a"]),
        ("<head><title>t</title><script>'<p>'</script><body><p>a", ["a"]),
        ("<p>a<select><option>x<option>y<p>b</p>c", ["a", "b", "c"]),
        ("<div>a<svg><path d=''><text>x</text></div>b", ["a", "b"]),
        ("<svg><svg>x</svg>y</svg>z", ["z"]),
        ("<video src=v>old<div>a</div><video>no<p>no</p></video>b", ["a", "b"]),
        ("<object><p>no</p></object><canvas>x<h1>t</h1>", ["t"]),
        ("<audio>x<script>'<p>'</script>y<p>a", ["a"]),
        ("<!-- </svg> --><svg>x<p>a</p>", ["a"]),
        ("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> holds", ["so x=2 holds"]),
    ],
)
def test_unclosed_elements_do_not_take_the_page(page, expected):
    assert texts(page) == expected


def test_many_unclosed_elements():
    assert len(texts("<svg>x<p>y" * 20_000)) == 20_000


def test_paths_name_the_elements_around():
    (block,) = blocks('<div class="post Body" id=x1><section><p>t <em>u</em></p></section></div>')
    assert block.path == ("div", ".post", ".body", ".x", "section", "p")
    assert blocks("<nav><a>ab</a>cd</nav>")[0].linked == 0.5


def test_very_long_page_is_read_whole():
    assert len(texts("<p>x</p>" * 20_000)) == 20_000
    assert texts("<div>" * 20_000 + "deep") == ["deep"]


@pytest.fixture(scope="module")
def model():
    sentences = [f"Sentence number {k} has a few words in it." for k in range(200)]
    made, labels = H.templates(sentences, 500)
    return H.fit_pages([*map(blocks, made)], labels)


def test_templates_not_seen_in_the_fit(model):
    sentences = [f"Quite other text stands here, part {k} of many." for k in range(100)]
    made, labels = H.templates(sentences, 150, seed=77)
    found = model.probabilities(H.features([*map(blocks, made)]))
    right = np.concatenate([(p >= 0.5) == np.array(y) for p, y in zip(found, labels, strict=True)])
    assert right.mean() > 0.97


def test_gradients_as_by_differences():
    model = H.Labeller(1)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    rng = np.random.default_rng(0)
    pages = [rng.standard_normal((n, H.INPUTS)).astype(np.float32) for n in (3, 5)]
    labels = [np.array([1.0, 0, 1]), np.array([0.0, 1, 1, 0, 1])]

    def loss():
        p = np.concatenate(model.probabilities(pages))
        y = np.concatenate(labels)
        return -np.where(y == 1, np.log(p), np.log(1 - p)).mean()

    for name, grad in model.gradients(pages, labels).items():
        flat, g = model.weights[name].reshape(-1), grad.reshape(-1)
        for k in rng.choice(len(flat), min(8, len(flat)), replace=False):
            keep = flat[k]
            flat[k] = keep + 1e-2
            up = loss()
            flat[k] = keep - 1e-2
            down = loss()
            flat[k] = keep
            assert abs((up - down) / 2e-2 - g[k]) < 1e-3 + 0.03 * abs(g[k]), (name, k)


def article(page):
    """The article of the given pages, the plain way."""
    inner = re.search("<article>(.*)</article>", page, re.S)[1]
    parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in re.split(r"</?(?:p|h1|br)\b[^>]*>", inner)]
    return " ".join(p for p in parts if p)


def test_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = op10_html(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert (r.url, r.text) == (pages[r.page_id].url, article(pages[r.page_id].html))
        assert r.n_chars == len(r.text)


def test_odd_and_empty_tables(spark, model):
    schema = "page_id long, url string, html string, text int, id string"
    rows = [(1, "u", None, 1, ""), (None, None, "", 2, ""), (2, "u", "<nav><a>menu</a></nav>", 3, "")] * 2
    got = H.extract(spark.createDataFrame(rows, schema), model).collect()
    assert len(got) == 6 and all(r.text == "" for r in got)
    assert H.extract(spark.createDataFrame([], schema), model).count() == 0
    H.fit(spark.createDataFrame([], schema))
