"""Lines of pages: what stays within an article, and the longest common subsequence against a plain table."""

from __future__ import annotations

import random

from tallyloom.llm import pages

RANDOM = random.Random(2)


def test_an_article_keeps_its_heading_and_unlucky_names():
    html = (
        "<div class='site-header'>Site</div><article><div class='article-header'><h1>Heading</h1></div><p class='market-share'>Shares rose.</p>"
        "<div class='ad'>Buy</div><div class='cookie-notice'>Cookies</div><p hidden>More</p><div class='search results'>Find</div>"
        "<form>Name</form><aside>Side</aside><section id=comments>Nice!</section></article><p class='market-share'>outside</p>"
    )
    assert [text for text, marked in pages.lines_of(html) if marked] == ["Heading", "Shares rose.", "More"]
    assert pages.lines_of("<article>" + "<p>long line " * 20_000)[-1] == ("long line", True)


def test_shared_lines_equal_a_plain_table():
    for _ in range(300):
        one, two = ([RANDOM.choice("abcde") for _ in range(RANDOM.randint(0, 12))] for _ in range(2))
        best = [[0] * (len(two) + 1) for _ in range(len(one) + 1)]
        for i, a in enumerate(one):
            for j, b in enumerate(two):
                best[i + 1][j + 1] = best[i][j] + 1 if a == b else max(best[i][j + 1], best[i + 1][j])
        places = sorted(pages.shared_lines(one, two))
        assert len(places) == best[-1][-1]
        rest = iter(two)
        assert all(one[p] in rest for p in places)  # in order within the other page


def test_pages_with_marks_are_differenced_part_by_part(spark):
    teaser = "<article><h2>Most read</h2><p>Seven tips</p></article>"
    story = "<nav>Menu</nav><main><p>Site line</p><article><h1>Title {0}</h1><p>Same words.</p><p>Body {0}.</p></article>{1}</main><p>Outside {0}</p>"
    rows = [(i, f"http://a.b/{i}", story.format(i, teaser)) for i in range(4)]
    rows += [(10 + i, f"http://c.d/{i}", f"<article><h1>Copy</h1><p>of one text</p></article><p>Outside {i}</p>") for i in range(2)]
    rows += [(20, "http://e.f/", story.format(20, teaser)), (30, None, story.format(30, teaser))]
    got = {r.page_id: r.text for r in pages.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = {i: f"Title {i} Same words. Body {i}." for i in range(4)} | {10: "Copy of one text", 11: "Copy of one text"}
    whole = "Site line Title {0} Same words. Body {0}. Most read Seven tips"
    assert got == want | {i: whole.format(i) for i in (20, 30)}  # no neighbour
