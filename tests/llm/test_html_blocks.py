import re
import time
from html import unescape

import numpy as np
import pytest

from crewlens.llm.html_blocks import extract_main_text, main_text, regions

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li><li><a href='/x'>X > y</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><!-- <p>no</p> -->
<article><h1>Title &amp; more</h1><p>First  one&nbsp;here.<br>Same block.<p>Second &lt;b&gt; <b>bold</b>&#33;
<div class="ad">Buy <div>now</div></div><p>Third.</p><form><label>Mail</label><input name=a></form>
<section id="comments"><p>Nice!</p></section></article><aside>More</aside><footer>&copy; 2020</footer></body></html>"""


def brute(page):
    """The article of the given tables' pages, by plain cuts."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = [" ".join(unescape(re.sub(r"<[^>]*>", " " if "<br>" in b else "", b.replace("<br>", " "))).split()) for b in re.split(r"</?p>|</?h1>", body)]
    return "\n\n".join(b for b in blocks if b)


def test_a_page_with_everything():
    assert main_text(PAGE) == "Title & more\n\nFirst one here. Same block.\n\nSecond <b> bold!\n\nThird."


def test_without_an_article_the_heaviest_region_stays():
    text = "<p>" + "</p><p>".join("A long paragraph of prose, number %d." % i for i in range(5)) + "</p>"
    page = f"<div><a>one</a></div><div><a>two</a></div><hr><hr><hr><hr><div>{text}</div><hr><hr><hr><hr><div>tail</div>"
    assert main_text(page) == "\n\n".join("A long paragraph of prose, number %d." % i for i in range(5))


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain", "plain"),
        ("<p>To.</p>", "To."),
        ("<nav>a<article><p>b", "b"),
        ("<article><p>a &am", "a &am"),
        ("<article>x</article><article class=comment>y</article>", "x"),
        ("<main><article><p>a</p></article><div class='related'>r</div></main>", "a"),
        ("<article><p title=\"it's\">a</p><p title='>'>b</p><p x=\">c</p></article>", None),
        ("<script>" + "<" * 50000, ""),
        ("<body><p class=ad>x<p>y", "y"),
        ("a < b <i>c</i>", "a < b c"),
    ],
)
def test_edges(page, text):
    assert text is None or main_text(page) == text
    assert isinstance(main_text(page), str)


def test_regions_are_surges_and_dives():
    assert regions(np.array([0, 5, 0, 0, 7, 0, 0, 0, 3]), 3) == [(1, 5), (8, 9)]
    assert regions(np.array([], np.int64), 3) == []


def test_query_equals_brute_force(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    out = {r["page_id"]: r for r in extract_main_text(pages).collect()}
    rows = pages.collect()
    assert len(out) == len(rows)
    for r in rows:
        got = out[r["page_id"]]
        assert got["text"] == brute(r["html"]) and got["n_chars"] == len(got["text"]) and got["url"] == r["url"]


def test_clashing_columns_repeated_rows_and_nulls(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a</p>", "x"), (1, "u", "<p>a</p>", "x"), (None, None, None, None)], "page_id long, url string, html string, text string")
    assert sorted((r["text"], r["n_chars"]) for r in extract_main_text(pages).collect()) == [("", 0), ("a", 1), ("a", 1)]
    assert extract_main_text(pages.limit(0)).collect() == []


LONG = " ".join(["Prose of some length."] * 10)


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<div>{'<div><a>menu</a></div>' * 5}</div><article><a>Read</a> on.</article><div><p>{LONG}</p><p>{LONG}</p></div>", f"{LONG}\n\n{LONG}"),
        (f"<article><p>{LONG}</p><ul>{'<li><a>link</a></li>' * 4}</ul></article>", LONG),
        (f"<div>Aside.</div><article><h1><a>Title</a></h1><p>{LONG}</p></article><div>{LONG[:60]}</div>", f"Title\n\n{LONG}"),
        (f"<article><p>{LONG}</p><nav>{'<li>x</li>' * 5}</nav><p>End.</p></article>", f"{LONG}\n\nEnd."),
    ],
)
def test_density_decides_inside_and_outside_articles(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<body><div><p>{LONG}</p></div><div><p>Short.</p></div></body>", f"{LONG}\n\nShort."),
        (f"<div><div><h1>Title</h1></div></div><div><div><p>{LONG}</p></div></div>", f"Title\n\n{LONG}"),
        (f"<div><p>{LONG}</p></div><table><tbody><tr><td>a</td><td>b</td></tr></tbody></table><ul><li>c</li></ul>", f"{LONG}\n\na\n\nb\n\nc"),
        (f"<p>{LONG}</p>{'<hr>' * 4}<p>Between.</p>{'<hr>' * 4}<p>{LONG}</p>", f"{LONG}\n\nBetween.\n\n{LONG}"),
    ],
)
def test_wrapped_blocks_stay_without_an_article(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        (f'<div class="layout with-sidebar"><article><p>{LONG}</p></article><div class="sidebar">s</div></div>', LONG),
        (f'<div class="ad-free content"><p>{LONG}</p></div>', LONG),
        (f'<form id="aspnetForm"><nav><a>x</a></nav><article><p>{LONG}</p></article><input></form>', LONG),
        (f'<article><p>{LONG}</p><p class="share-price">Up by two.</p><section id="related-work"><p>Others.</p></section></article>', f"{LONG}\n\nUp by two.\n\nOthers."),
        (f'<article><p>{LONG}</p><div class="cookie-notice">c</div><div class="ad-slot-2">a</div><div class="related-posts">r</div><ul class="share-buttons">s</ul></article>', LONG),
        (f'<div class="site-footer">f</div><div id="left-sidebar">l</div><div role="navigation">n</div><article>{LONG}</article>', LONG),
        (f'<article><p title="a < b > c" data-x=\'<b>"x"</b>\'>{LONG}</p></article>', LONG),
        (f"<p>{LONG}</p><!-- <p>never closed", LONG),
        (f"<p>{LONG}</p> 1 <!-- x --> < 2 <", f"{LONG}\n\n1 < 2 <"),
    ],
)
def test_names_that_only_hold_a_word_of_the_list_are_kept(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("unit", ["<a ", '<a"', '<a ">', "<a '", '<a "x', "<!", "<!--", "</script", "<script", "<p class=", "&", "<", '<a b="c>" d=\'', "<div>", "<style></style"])
@pytest.mark.parametrize("end", ["", ">", '"', "'>"])
def test_pages_of_a_megabyte_take_linear_time(unit, end):
    page = unit * ((1 << 20) // len(unit)) + end
    began = time.process_time()
    main_text(page)
    assert time.process_time() - began < 8
