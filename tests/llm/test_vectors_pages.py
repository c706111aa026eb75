"""Top-k search and page extraction."""

from __future__ import annotations

import math

import numpy as np
import pytest

from indicator_engine.llm import top_k as bsi
from indicator_engine.llm.html_extract import Extractor, extract_text, parse, training_pages
from indicator_engine.llm.queries import QUERIES
from indicator_engine.llm.top_k import Slices, top_k

# ---- top-k -------------------------------------------------------------------


def brute_top_k(rows, k):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in good:
        if i % 50 == 0:
            queries[i] = min(queries.get(i, v), v)
    out = []
    for q, v in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("segment_rows", [16_384, 40])
def test_top_k_of_awkward_vectors(spark, monkeypatch, segment_rows):
    monkeypatch.setattr(bsi, "SEGMENT_ROWS", segment_rows)
    monkeypatch.setattr(bsi, "BLOCK", 2)
    monkeypatch.setattr(bsi, "SPAN", 3)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 6).round(1)]) for i in range(201)]
    rows += [(300, None), (350, [1.0, None]), (400, [float("nan")]), (450, [float("inf"), 1.0]), (None, [1.0] * 6)]
    rows += [(500 + i, rows[0][1]) for i in range(8)] + [(700, []), (750, [0.0] * 6), (800, [-3.0, 2.0]), (3, rows[3][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    from pyspark.sql import functions as F

    frame = frame.withColumn("_id", F.lit("x")).withColumn("score", F.lit("y"))
    single = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = top_k(frame, frame.where("vec_id % 50 = 0"))
    assert sorted(map(tuple, got.collect())) == brute_top_k(single, 5)
    assert top_k(frame.where("false"), frame.where("false")).count() == 0
    few = frame.where("vec_id in (0, 1, 2)")
    assert top_k(few, few.where("vec_id = 0")).count() == 2


def test_bitmap_sums_are_inner_products():
    rng = np.random.default_rng(2)
    values, query = rng.integers(-300, 300, (130, 9)), rng.integers(-40, 40, 9)
    part = Slices(np.arange(130), values)
    total = sum(
        (np.unpackbits(s.view(np.uint8), bitorder="little")[:130].astype(np.int64) << b) for b, s in enumerate(part.sums(query))
    )
    assert len(set(total - values @ query)) == 1


# ---- pages -------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header class="site-header"><h1>My site</h1><p>Slogan of the site</p></header>
<nav><ul><li><a href="/">Home</a></li><li><a href="/b">About us</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies, accept them.</p></div>
<div class="sidebar"><h3>Popular</h3><ul><li><a href="/x">Another story here</a></li></ul></div>
<article><h1>Fish &amp; chips</h1><p>First   paragraph,
 with <b>bold</b> text &copy; here.<p>Second paragraph: 1 &lt; 2. It is longer than the first one, with commas, and full stops.
<div class="advert">Buy now, cheap.</div><p>Third paragraph closes the story, and it is long enough to be one.</p></article>
<section id="comments"><h2>Comments</h2><div class="comment"><p>I do not agree with this story at all.</p></div></section>
<form><label>Your mail</label><input><button>Send</button></form><footer>&copy; 2020 Someone</footer></body></html>"""


@pytest.fixture(scope="module")
def extractor():
    return Extractor(training_pages())


def test_page(extractor):
    assert extractor.texts([PAGE]) == [
        "Fish & chips\n\nFirst paragraph, with bold text © here.\n\n"
        "Second paragraph: 1 < 2. It is longer than the first one, with commas, and full stops.\n\n"
        "Third paragraph closes the story, and it is long enough to be one."
    ]


def test_held_out_layouts(extractor):
    pages = training_pages(200, seed=99)
    right = 0
    for page in pages:
        expected = "\n\n".join(n.text for n in parse(page) if n.text is not None and n.main)
        right += extractor.texts([page.replace("data-main", "data-x")])[0] == expected
    assert right / len(pages) >= 0.93


def test_cut_pages_are_read_as_far_as_they_go(extractor):
    for end in range(0, len(PAGE), 7):
        parse(PAGE[:end])
    whole = extractor.texts([PAGE])[0]
    for end in range(PAGE.index("Third"), len(PAGE), 29):
        assert "cookies" not in extractor.texts([PAGE[:end]])[0]
        assert extractor.texts([PAGE[:end]])[0].startswith(whole[:60])


def test_markup_oddities():
    text = lambda page: [n.text for n in parse(page) if n.text is not None]
    assert text("<p>a<!-- <p>no --> b<p title='x > y'>c<br>d</p>e") == ["a b", "c d", "e"]
    assert text("a < b &amp c <3 <unknown>d</unknown> </ x>") == ["a < b & c <3 d"]
    assert text("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == ["a", "b", "c", "d"]
    assert text("<script>if (a<b) '</p>'</script><textarea>t</textarea>x<style>y") == ["x"]
    assert text("<p class='a' id=\"b>unclosed") == []
    assert text("") == [] and text("\x00 &#233;&nbsp;x") == ["\x00 é x"]


def test_pages_table(spark, extractor, small):
    rows = [(1, "u", PAGE), (2, None, None), (None, "v", ""), (3, "w", "<p>" * 3000 + "deep " * 20_000), (1, "u", PAGE)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "'y' AS _html")
    got = sorted(map(tuple, extract_text(frame, extractor).collect()), key=str)
    assert len(got) == 5 and all(len(t) == n for _, _, t, n in got)
    assert {(i, t) for i, _, t, _ in got if i in (2, None)} == {(2, ""), (None, "")}
    assert extract_text(frame.where("false"), extractor).count() == 0
    pages = spark.read.parquet(f"{small}/pages.parquet").select("page_id", "html").collect()
    found = {r.page_id: r.text for r in QUERIES["op6_html_extract"](spark, small).collect()}
    assert len(found) == len(pages)
    for r in pages:  # every page there has one article element
        inside = r.html.partition("<article>")[2].partition("</article>")[0]
        leaves = [n.text for n in parse(f"<article>{inside}") if n.text is not None]
        if "</article>" in r.html:
            assert found[r.page_id] == "\n\n".join(leaves)
