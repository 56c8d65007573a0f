"""Main-text extraction: parsing, held-out accuracy, the test pages."""

import html
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.llm import html_main

PAGES = "/root/testdata/sf0.001/pages.parquet"


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ("", []),
        ("just text &amp; more\n here", ["just text & more here"]),
        ("<p>a<p>b<div>c</div>d", ["a", "b", "c", "d"]),
        ("<p>x <b>bold</b>, <a href='/y'>link</a><br>next&nbsp;one</p>", ["x bold, link next one"]),
        ("<style>p{margin:0}</style><script>var t='</p><p>no</p>';</script><p>yes<!-- <p>no</p> -->", ["yes"]),
        ('<p title="a>b">t</p><p class=x>1 < 2 &lt; 3</p>', ["t", "1 < 2 < 3"]),
        ("<p>cut off &am", ["cut off &am"]),
        ("<p>cut</p><p cla", ["cut"]),
        ("<p>cut</p><script>never ends <p>no", ["cut"]),
        ('<p>q</p><a href="never ends <p>no', ["q"]),
        ("<ul><li>1<li>2</ul></div></nope>3", ["1", "2", "3"]),
        ("<P>É&eacute;&#x65E5;</P>", ["Éé日"]),
    ],
)
def test_leaves(page, texts):
    assert [t for t, _, _ in html_main.leaves(page)] == texts


def test_paths():
    found = html_main.leaves('<div class="Post main-text"><p>a<a href=x>bc</a></p></div><li>d')
    assert found == [("abc", ("div", "post", "main", "text", "p"), 2), ("d", ("li",), 0)]


def test_deep_and_long_pages_end():
    assert len(html_main.leaves("<div>" * 3000 + "x" + "</div>" * 3000)) == 1
    assert html_main.leaves("<a " + "x='" * 20_000) == [] and html_main.leaves("<" * 20_000) != []
    assert len(html_main.main_text(["<p>word word</p>" * 5000], html_main.labeller())) == 1


def test_parts_of_a_long_page_carry_the_states():
    own = html_main.labeller()
    rng = random.Random(5)
    pages = [html_main.made_page(rng)[0] * 3 for _ in range(20)]
    assert html_main.main_text(pages, own, part=4) == html_main.main_text(pages, own)
    assert html_main.main_text(["<p>word word</p>" * 25_000], own)[0].count("word word") > 20_000


def test_every_class_word_is_read():
    page = '<div class="col-xs col-sm hidden-print widget-area a b c sidebar">x</div>'
    assert html_main.leaves(page)[0][1][-1] == "sidebar"


def test_gradients():
    rng, own = np.random.default_rng(0), html_main.Labeller()
    own.p = {k: v.astype(np.float64) for k, v in own.p.items()}
    x, mask = rng.standard_normal((4, 3, html_main.WIDTH)), np.ones((4, 3))
    mask[2:, 1] = 0
    y = (rng.random((4, 3)) < 0.5).astype(float)

    def loss():
        z = own.logits(x, mask)
        return float(((np.log1p(np.exp(z)) - y * z) * mask).sum() / mask.sum())

    grads = own.gradients(x, mask, y)
    for k, g in grads.items():
        at = np.unravel_index(int(np.argmax(np.abs(g))), g.shape)
        old = own.p[k][at]
        own.p[k][at] = old + 1e-3
        up = loss()
        own.p[k][at] = old - 1e-3
        assert (up - loss()) / 2e-3 == pytest.approx(g[at], rel=0.02)
        own.p[k][at] = old


def test_held_out_made_pages():
    rng, own, wrong, total = random.Random(12345), html_main.labeller(), 0, 0
    for _ in range(150):
        page, labels = html_main.made_page(rng)
        got = own.label([html_main.features(html_main.leaves(page))])[0]
        wrong += int((got != np.array(labels, bool)).sum())
        total += len(labels)
    assert wrong / total < 0.04


def article(page):
    m = re.search(r"<article>(.*?)(</article>|\Z)", page or "", re.S)
    body = re.sub(r"<[^>]*\Z", "", m[1]) if m else ""
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:h1|p)>", body)]
    return "\n".join(b for b in blocks if b)


def test_pages(spark):
    pages = spark.read.parquet(PAGES).withColumn("text", F.lit("clash")).withColumn("id", F.lit(0))
    got = html_main.extract(pages).collect()
    want = {r.page_id: article(r.html) for r in pages.collect()}
    assert len(got) == len(want)
    for r in got:
        assert r.text == want[r.page_id] and r.n_chars == len(r.text) and r.url


def test_edges(spark):
    rows = [(1, None, None), (None, "u", ""), (2, "u", "<nav><a href=x>menu</a></nav>"), (2, "u", "<nav><a href=x>menu</a></nav>")]
    got = html_main.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert len(got) == 4 and all(r.text == "" and r.n_chars == 0 for r in got)
    assert html_main.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0
