import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemill.constants import DROPPED_TAGS
from pagemill.functions.html import decode_page, page_text, text_extractor

LONG = "word " * 40


def text(html, min_len=0):
    return page_text(html, min_len)[0]


def route(html, min_len=0):
    return page_text(html, min_len)[1]


@pytest.mark.parametrize(
    "tag, expected",
    [
        ("<article>", "article"),
        ("<main>", "main"),
        ("<MAIN>", "main"),
        ('<div role="main">', '[role="main"]'),
        ("<div class='a content b'>", ".content"),
        ("<div id=content>", "#content"),
        ('<div class="main-content">', ".main-content"),
        ('<div id="main-content">', "#main-content"),
        ('<div class="post-body">', ".post-body"),
        ('<div class="entry-content">', ".entry-content"),
        ('<div CLASS="article-body">', ".article-body"),
        ('<div class="contents">', "body"),
        ('<div class="Content">', "body"),
        ('<div role="main x">', "body"),
        ('<div id="content x">', "body"),
        ('<div data-class="content">', "body"),
        ('<div class="c&#111;ntent">', ".content"),
        ('<div class="x" class="content">', "body"),
        ('<div title="> class=content">', "body"),
        ("<div title=it's class=content>", ".content"),
    ],
)
def test_selectors(tag, expected):
    name = re.match(r"<(\w+)", tag)[1]
    assert page_text(f"<body>a{tag}b</{name}>c</body>", 0)[:2] == (
        "b" if expected != "body" else "a b c",
        expected,
    )


def test_first_selector_with_text_wins():
    assert route("<article> </article><main>x</main>") == "main"
    assert route("<main>x</main><article>y</article>") == "article"


def test_all_elements_in_document_order_and_nested_text_repeats():
    html = '<div class="content">a<div class="content">b</div>c</div><p class="content">d</p>'
    assert page_text(html, 0) == ("a b c b d", ".content", 3)


def test_body_or_html_can_be_the_content():
    assert page_text('<title>T</title><body class="content">x</body>', 0)[:2] == ("x", ".content")
    assert page_text('<html id="content"><title>T</title><body>x', 0)[:2] == ("T x", "#content")


@pytest.mark.parametrize("tag", sorted(DROPPED_TAGS - {"meta", "link", "input", "embed"}))
def test_dropped_tags(tag):
    assert text(f"<body>a<{tag} x=1>hidden</{tag}>b") == "a b"


@pytest.mark.parametrize("tag", ["meta", "link", "input", "embed"])
def test_dropped_void_tags_hide_nothing(tag):
    assert text(f"<body>a<{tag}>b") == "a b"


def test_dropped_elements_are_no_content():
    assert page_text('<aside class="content">x</aside><p>y</p>', 0)[:2] == ("y", "p")
    assert text("<article><header>h</header>x</article>") == "x"
    assert text("<body><form><p>all in here</p></form></body>") == ""
    assert route("<body><form><p>all in here</p></form></body>") == "none"


def test_raw_text_elements():
    assert text('<body>a<script>var t="<p>x</p>";</script>b') == "a b"
    assert text("<body>a<style>p{}</style >b<SCRIPT>x</ScRiPt>c") == "a b c"
    assert text("<body>a<textarea><b>x</textarea>b") == "a b"
    assert text("<body>a<script src=x />b") == "a b"
    assert text("<body>a<script>never closed <p>b") == "a"
    assert text("<title>a <b> &amp; c</title>") == "a <b> & c"


def test_comments_and_declarations():
    assert text("<!DOCTYPE html><body>a<!-- x > <p>y</p> -->b<!-->c<!--->d<?php x ?>e") == "a b c d e"
    assert text("<body>a<!-- never closed") == "a"
    assert text("<body>a<![CDATA[x]]>b") == "a b"


def test_paragraph_route_and_implied_ends():
    assert page_text("<p>a<p>b<div>c</div><p>d", 0) == ("a b d", "p", 3)
    assert page_text("<p>a<b>b<p>c</b>d", 0) == ("a b c d", "p", 2)
    assert page_text("<p>a<ul><li>x<li>y</ul>", 0) == ("a", "p", 1)
    assert page_text("<p>a<button><div>x</div></button>b</p>", 0) == ("a b", "p", 1)
    assert page_text("<p> </p><p></p><div>x", 0)[:2] == ("x", "body")


def test_short_content_adds_the_body():
    short = "x" * 24
    assert page_text(f"<body><article>{short}</article>y", 100) == (
        f"{short} {short} y",
        "article+body",
        2,
    )
    assert page_text(f"<body><article>{short}z</article>y", 100)[1:] == ("article", 1)
    assert page_text(f"<body><p>{short}</p>y", 100)[1] == "p+body"
    # lengths are those before white space is collapsed, without the joining space
    spaced = "x" + " " * 23 + "y"
    assert page_text(f"<body><article>{spaced}</article>z", 100)[:2] == ("x y", "article")
    assert page_text("<body><p>" + "x" * 12 + "</p><p>" + "y" * 13 + "</p>", 100)[1] == "p"
    assert page_text("<body><p>" + "x" * 12 + "</p><p>" + "y" * 12 + "</p>", 100)[1] == "p+body"


def test_body_and_whole_document():
    assert text("<html><head><title>T</title></head><body>x</body></html>y") == "x y"
    assert text("<title>T</title><div>x</div>") == "T x"
    assert page_text("", 0) == ("", "none", 0)
    assert page_text("plain words", 100) == ("plain words", "body", 1)


def test_text_nodes_are_joined_by_spaces():
    assert text("<article>f<b>oo</b>bar&nbsp;<i> baz </i></article>") == "f oo bar baz"
    assert text("<article>a<br>b<br/>c</x>d</article>") == "a b c d"
    assert text("<article>a < b & c &lt;p&gt; &copy &#233; &amp;amp;</article>") == "a < b & c <p> © é &amp;"


def test_text_can_always_be_written_as_utf8():
    assert text("<p>&#xD800;&#0;&#x110000;x</p>") == "\ufffd\ufffd\ufffdx"
    assert text(decode_page(b"<p>\xed\xa0\x80x")).encode("utf-8")


def test_scope_of_end_tags():
    assert text("<article><span>a</article>b</span>") == "a"
    assert text("<article>a</span>b</div>c</p>d</article>e") == "a b c d"
    assert text('<div class="content"><table><tr><td>a</div>b</table>c</div>d') == "a b c"
    assert text('<b class="content">a<p>b</b>c</p>d') == "a b"
    assert text("<table><tr><td class=content>a<td>b<tr><td>c</table>") == "a"
    assert text("<ul><li class=content>a<li>b</ul>") == "a"
    assert text("<canvas><div>x</canvas>y") == "y"


def test_ruby_and_template_text_is_left_out():
    assert text("<article>漢<rp>(</rp><rt>kan</rt><rp>)</rp>字<template>x</template></article>") == "漢 字"
    assert text("<article><ruby>a<rt>x<rp>y</ruby>b</article>") == "a b"


def test_decoding():
    assert decode_page("é".encode()) == "é"
    assert decode_page("é".encode("latin-1")) == "é"
    assert decode_page(b"\x80\x81") == "\x80\x81"
    assert decode_page(b"") == ""
    assert decode_page("﻿x".encode()) == "﻿x"


@pytest.mark.parametrize(
    "piece",
    ["<div>", "<a ", '<a x="', "<!--", "<script>", "</b>", "<b><p>", "<p><li>", "<td><tr>", "&#", "<", "</",
     "<table><td><p>", "<div class='content'>", "<title>", "<a b='\"", "<svg><path>"],
)
def test_cost_is_linear(piece):
    start = time.perf_counter()
    page_text(piece * 20_000)
    assert time.perf_counter() - start < 5


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.sampled_from(
            ["<p>", "</p>", "<div class=content>", "</div>", "<b>", "</b>", "<article>", "</article>",
             "<table>", "<td>", "</table>", "<form>", "</form>", "<script>", "</script>", "x", " y ", "&amp;",
             "<!--", "-->", "<li>", "</li>", "<body>", "</body>", "<", ">", "<br/>", "<ul>", "</ul>"]
        ),
        max_size=40,
    )
)
def test_any_markup(pieces):
    result, where, count = page_text("".join(pieces), 10)
    assert result == " ".join(result.split())
    assert (where == "none") == (count == 0) == (result == "")


def test_column_function(spark):
    rows = [(1, b"<article>\xe9t\xe9</article>"), (2, None), (3, b"")]
    pages = spark.createDataFrame(rows, "id INT, html BINARY")
    got = pages.select("id", text_extractor(0)("html").alias("t")).orderBy("id").collect()
    assert [tuple(r.t) if r.t else None for r in got] == [
        ("été", "article", 1),
        (None, None, None),
        ("", "none", 0),
    ]
    as_text = spark.createDataFrame([("<p>a",)], "html STRING").select(text_extractor(0)("html").alias("t"))
    assert as_text.select("t.text").first()[0] == "a"


def test_pages_are_parsed_once(spark, plan_of):
    pages = spark.createDataFrame([("<p>a",)], "html STRING")
    plan = plan_of(pages.select(text_extractor()("html").alias("t")).where(F.length("t.text") >= 1), "simple")
    assert plan.count("ArrowEvalPython") == 1


def test_depth_does_not_matter():
    """What nav hides ends with nav, however many elements were left open in it."""
    article = "<article><p>" + "words of the article " * 10 + "</p></article><p>after</p>"
    for n in (10, 600, 5000):
        deep = f"<body><nav>{'<span>' * n}menu</nav>{article}"
        inside = f"<body><article>{'<span>' * n}inner text of it</article><p>after</p>"
        assert page_text(deep)[0] == page_text(f"<body><nav>menu</nav>{article}")[0]
        assert page_text(inside, 1)[0] == "inner text of it"


def test_formatting_that_ends_below_others():
    assert page_text("<body><article><b><p>one</b> two</p></article> three", 1)[0] == "one two"
    assert page_text("<body><article><b><i><div>x</b></i></div>y</article>z", 1)[0] == "x y"
