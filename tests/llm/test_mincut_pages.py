"""Extraction by a cut that matters: names in parts, pages without marks, deep pages, fitted prices."""

import collections
import time

import pytest

from postmill.llm import html_mincut as cut


@pytest.mark.parametrize(
    "page,text",
    [
        ("<article><section class='related-work'><p>Prior systems were slow.</p></section><p>x y.</p></article>", "Prior systems were slow.\n\nx y."),
        ("<article><div class='main widget-body'><p>Body here.</p></div></article>", "Body here."),
        ("<div><p>Hi</p></div>", "Hi"),
        ("<p>Short title</p>", "Short title"),
        ("<article><p>One.</p><div class='comments'><p>Nice article, thanks a lot for all of it.</p></div><aside>Also</aside></article>", "One."),
        ("<div class='comment-list'><article><p>A reader says a lot of things here.</p></article></div><article><p>Ours.</p></article>", "Ours."),
        ("<ul><li><a href=x>Home</a></li><li><a href=y>News</a></li></ul><p>Text of the page.</p>", "Text of the page."),
        ("<article><p><a href=x>A link alone</a></p><p>Text.</p></article>", "A link alone\n\nText."),
        ("<div class='ad-slot-3'><div><div><p>" + "A long sentence with many words in it. " * 9 + "</p></div></div></div><article>Text.</article>", "Text."),
    ],
)
def test_cases(page, text):
    assert cut.main_text(page) == text


@pytest.mark.parametrize("opening,kept", [("<div>x.", True), ("<div class=ad>x.", False), ("<section class='related-work'>x.", False), ("<b>x.", True)])
def test_50_000_nested_elements(opening, kept):
    start = time.time()
    text = cut.main_text(opening * 50_000)
    assert bool(text) == kept and time.time() - start < 60


def test_the_cut_changes_labels(spark, sf_dir):
    """On the given pages many blocks are not decided by their own text, and many get another label from what stands around them."""
    total = collections.Counter()
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    weights = cut.fit(pages)
    for row in pages.select("html").collect():
        total.update(cut.labels(row.html, weights)[2])
    assert total["undecided"] > 0.05 * total["blocks"] and total["changed"] > 0.01 * total["blocks"], total


def test_flow_decides_where_nothing_is_sure():
    page = "<div class='main'>" + "".join(f"<p>{'A sentence of some length with words. ' * (n % 3)}<a href=x>{'link ' * (n % 5)}</a>.</p>" for n in range(60)) + "</div>"
    assert cut.labels(page)[2]["in_flow"] > 0


def test_fitted_prices(spark):
    pages = [(n, "u", "<nav><a href=x>Menu entry</a></nav><article><p>A sentence with a number of words that makes up a paragraph.</p></article>") for n in range(30)]
    df = spark.createDataFrame([*pages, (90, "u", None), (91, "u", "")], "page_id long, url string, html string")
    weights = dict(zip(cut.FEATURES, cut.fit(df), strict=True))
    assert weights["links"] < -0.5 and weights["length"] + weights["sentence"] > 0.5
    assert cut.fit(df.where("page_id >= 90")) == cut.WEIGHTS and cut.fit(df.limit(0)) == cut.WEIGHTS
    assert cut.fit(spark.createDataFrame([(1, "u", "<nav>only</nav>")], "page_id long, url string, html string")) == cut.WEIGHTS
