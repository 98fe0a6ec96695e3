from __future__ import annotations

import numpy as np
import pytest

from lodestone.llm import gbdt
from lodestone.llm import html_extraction as hx
from lodestone.llm.html_pages import PageMaker

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav><!-- ad --><div class="ad">Buy this now.</div>
<article><h1>Title &amp; more</h1><p><b>First  paragraph,
with&nbsp;text.<br><p>Second paragraph, with a <a href="/x">link</a> in it. It goes on for some words.</p></article>
<section class="comments"><div class="comment"><p>I liked it a lot, thanks.</p></div></section><footer>&copy; me</footer></body></html>"""


def test_a_page():
    assert hx.extract_batch([PAGE], hx.default_model()) == ["Title & more\nFirst paragraph, with text.\nSecond paragraph, with a link in it. It goes on for some words."]


def test_held_out_pages():
    maker, right, total, whole = PageMaker(4242), 0, 0, 0
    for _ in range(120):
        blocks, _ = hx.parse(maker.page(), labelled=True)
        kept = hx.decode(blocks, hx.default_model().raw(np.array(hx.node_features(blocks))))
        truth = [True] * len(blocks)
        for i in range(1, len(blocks)):
            truth[i] = truth[blocks[i].parent] and blocks[i].keep != 0
        right += sum(a == b for a, b in zip(kept, truth, strict=True))
        total += len(blocks)
        whole += kept == truth
    assert right / total > 0.99 and whole > 100


def test_given_pages(medium):
    import html
    import re

    for r in medium("pages").collect():
        inside = r.html[r.html.find("<article>") + 9 : r.html.find("</article>")]
        parts = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x))).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
        assert hx.extract_batch([r.html], hx.default_model()) == ["\n".join(x for x in parts if x)]


ARTICLE = "<article><h1>Title here</h1>" + "".join(f"<p>Sentence number {i} of the story, with some words in it. It goes on.</p>" for i in range(6)) + "</article>"


@pytest.mark.parametrize(
    "before",
    [
        "<datalist><option value=a><option value=b></datalist>",
        "<select><option>One<option>Two</select>",
        "<select><optgroup label=x><option>One<optgroup label=y><option>Two</select>",
        "<option value=a>",
        "<button>",
        "<button><button>Stop</button>",
        "<svg/>",
        "<svg><path d=x /><title>drawn</title></svg>",
        "<iframe src=x />",
        "<textarea>",
        "<noscript><p>Please switch it on.</p></noscript>",
        "<template><div>unused</div></template>",
        '<div data-keep="true"></div>',
        '<div data-keep=""></div>',
        "<a href='x>y'></a>",
    ],
)
def test_controls_hide_nothing_after_them(before):
    whole = "<html><body>%s" + ARTICLE + "</body></html>"
    expected = hx.extract_batch([whole % ""], hx.default_model())
    assert len(expected[0]) > 300 and hx.extract_batch([whole % before], hx.default_model()) == expected


def test_text_without_blocks():
    assert hx.extract_batch(["Just <b>inline</b> text &amp; more."], hx.default_model()) == ["Just inline text & more."]


@pytest.mark.parametrize("piece", ["<a ", '<a "', "<b>", "</b>", "<b></i>", "<div></x>", "<option>", "<button>", "<script", "<li>x", "< ", "<!--", "<svg>", "<p><b>", "<select><option>"])
def test_time_in_proportion(piece):
    import time

    def seconds(n):
        began = time.perf_counter()
        hx.parse(piece * n)
        return time.perf_counter() - began

    seconds(1000)
    assert seconds(40_000) < 32 * max(seconds(5000), 0.005)  # 8 times as long; 64 if it were quadratic


def test_long_page(spark):
    page = "<html><body>" + ARTICLE * 2000 + "</body></html>"
    df = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    assert len(hx.extract_pages(df).first().text) > 600_000


def test_no_kept_block_under_a_dropped_one():
    rng = np.random.default_rng(0)
    maker = PageMaker(3)
    for _ in range(30):
        blocks, _ = hx.parse(maker.page())
        raw = rng.normal(0, 3, len(blocks))
        kept = hx.decode(blocks, raw)
        assert all(kept[b.parent] or not kept[i] for i, b in enumerate(blocks) if i)
        if len(blocks) <= 14:  # the best of all consistent labellings
            free = [i for i in range(1, len(blocks)) if blocks[i].tag not in ("html", "body")]
            best = -np.inf
            for mask in range(1 << len(free)):
                label = [True] * len(blocks)
                for k, i in enumerate(free):
                    label[i] = bool(mask >> k & 1)
                if all(label[b.parent] or not label[i] for i, b in enumerate(blocks) if i):
                    best = max(best, sum(-np.logaddexp(0, -raw[i] if label[i] else raw[i]) for i in range(1, len(blocks))))
            assert sum(-np.logaddexp(0, -raw[i] if kept[i] else raw[i]) for i in range(1, len(blocks))) == pytest.approx(best)


@pytest.mark.parametrize("page", [None, "", "<", "<p", '<a href="x>y', "</p></div>", "<p>a<p>b</p></p>", "<!-- open", "<script>x", "&#x110000; &amp &bogus;", "<div>" * 3000 + "deep", "<table><tr><td>a<td>b<tr><td>c</table>"])
def test_broken_pages_do_not_fail(page):
    assert len(hx.extract_batch([page], hx.default_model())) == 1


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars int"
    df = spark.createDataFrame([(1, "u", PAGE, "x", 1), (1, "u", PAGE, "x", 1), (2, None, None, None, None), (None, "v", "", None, None)], schema)
    rows = hx.extract_pages(df).collect()
    assert [len(r.text) for r in rows] == [len(rows[0].text)] * 2 + [0, 0] and len(rows[0].text) > 50
    assert hx.extract_pages(df.limit(0)).count() == 0


def test_boosted_trees_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    model = gbdt.fit_boosted(x[:2000], y[:2000], rounds=30)
    assert ((model.raw(x[2000:]) > 0) == (y[2000:] > 0)).mean() > 0.95
