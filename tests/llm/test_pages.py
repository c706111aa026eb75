"""Main text of pages written by hand, and what workers keep."""

from __future__ import annotations

import pytest

from indicator_engine.llm import common
from indicator_engine.llm.html_extract import extract_text

FIRST = "The harbour was rebuilt after the storm, and the ferries returned in the spring with new crews and a new timetable."
LAST = "Visitors now arrive by train as well, which the council had asked for since the line was surveyed many years ago."
PAGE = """<html><head><title>Harbour</title></head><body>
<nav class="menu"><ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li></ul></nav>
<article class="content"><h1>A harbour comes back</h1><p>{}</p>{}<p>{}</p></article>
<footer class="footer"><p>Copyright. <a href="/terms">Terms</a></p></footer></body></html>"""

MARKUP = {
    "empty drawing": ("<p>Turn left and see <svg width='1'/> here, where the old crane stands above the quay.</p>",
                      "Turn left and see here, where the old crane stands above the quay."),
    "drawing": ("<p>The signal <svg><title>x</title><path d='M0'></path></svg> tells ships to wait outside the bar.</p>",
                "The signal tells ships to wait outside the bar."),
    "drawing without end": ("<p>The signal <svg width='2'> tells ships to wait outside the bar.</p>",
                            "The signal tells ships to wait outside the bar."),
    "quote in a value": ("<p>Read the <a title=Bob's href=/>link</a> that the harbour master left for the pilots.</p>",
                         "Read the link that the harbour master left for the pilots."),
    "stray quote": ("<p class=\"a\"\">The pilots met on the quay and wrote down what each of them had seen.</p>",
                    "The pilots met on the quay and wrote down what each of them had seen."),
    "formula": ("<p>The depth is <math><mi>d</mi><mo>=</mo><mn>7</mn></math> metres at low water, says the chart.</p>",
                "The depth is d=7 metres at low water, says the chart."),
    "greater sign in a value": ("<p title=\"a > b\">The chart was drawn by hand, and nobody has found a fault in it yet.</p>",
                                "The chart was drawn by hand, and nobody has found a fault in it yet."),
}


@pytest.mark.parametrize("kind", MARKUP)
def test_no_text_is_lost_to_markup(spark, kind):
    source, text = MARKUP[kind]
    page = PAGE.format(FIRST, source, LAST)
    rows = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    (row,) = extract_text(rows).collect()
    assert row.text == "\n\n".join(["A harbour comes back", FIRST, text, LAST])
    assert row.n_chars == len(row.text)


def test_a_worker_keeps_the_values_of_one_group():
    made = []
    value = lambda group: common.worker_wide("v", lambda: made.append(group) or group, group)
    assert [value("a"), value("a"), value("b"), value("a")] == ["a", "a", "b", "a"]
    assert made == ["a", "b", "a"]
    common.release_worker_values()
    assert value("a") == "a" and made == ["a", "b", "a", "a"]
