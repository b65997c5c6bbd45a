from __future__ import annotations

import re

import pytest

from tongues.functions import html as H

INCLUDE = ("p", "div.article", "section.content")
EXCLUDE = ("footer", "nav", "header", "aside", "script", "style", '[class*="menu"]')


def texts(html):
    return list(H.paragraphs(html, INCLUDE, EXCLUDE))


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<p>one</p><p> two </p>", ["one", "two"]),
        ("<p>outer <p>inner", ["outer inner", "inner"]),  # nothing closes an open paragraph
        ("<p><b>x<br><p>y</p>z", ["xyz", "y"]),
        ("</p><p>a</p></p>", ["a"]),  # stray end tags
        ("<div><p>a</div>b</p>", ["a"]),  # closing the div closes the paragraph
        ("<div class='article big'><p>in</p> rest</div>", ["in", "in rest"]),
        ("<div class='articles'>no</div>", []),
        ("<p>a<span class='top-menu x'>hidden</span>b</p>", ["ab"]),
        ("<article><header>h <p>gone</p></header><p>kept</p></article>", ["kept"]),
        ("<p>a<script>var x = '</p>';</script>b</p>", ["ab"]),
        ("<p>&lt;5 &amp; &quot;x&quot; &eacute;&#233; &unknown;</p>", ['<5 & "x" éé &unknown']),
        ("<p>a<!-- <p>no</p> -->b</p>", ["ab"]),
        ("<html><body><p>no end", ["no end"]),
        ("<p>a<template>t</template>b</p>", ["ab"]),
        ("<p> \n </p><p/>", []),
        ("<P CLASS='x'>upper</P>", ["upper"]),
        ("<section class=content>s</section><p>p</p>", ["p", "s"]),  # selector order first
        ("<p>a<br/>b<img src=x>c</p>", ["abc"]),
    ],
)
def test_paragraph_rules(html, expected):
    assert texts(html) == expected


def test_links():
    html = (
        '<a href="/x">One <b>Two</b></a><a name=n>no</a><a href=bare>B</a>'
        "<a HREF='/y?a=1&amp;b=2'>Y</a><!-- <a href='/no'>c</a> --><a href>empty</a><a href='/open'>Open<a href='/in'>In"
    )
    assert H.page_links(html) == [
        ("/x", "one two"),
        ("bare", "b"),
        ("/y?a=1&b=2", "y"),
        ("", "empty"),
        ("/open", "openin"),
        ("/in", "in"),
    ]


def test_bad_selector():
    with pytest.raises(ValueError):
        list(H.paragraphs("<p>a</p>", ("p > b",), ()))


def brute(html, limit):
    """Split every paragraph on its own and keep distinct, usable sentences."""
    out = set()
    for text in texts(html):
        for piece in re.split(r"(?<=[.!?])\s+", text):
            piece = " ".join(piece.split())
            if len(piece) <= limit:
                out.add(piece)
    return out


@pytest.mark.parametrize(
    "html",
    [
        "<p>One here. Two there!  Three? Four",
        "<p>a b. c d. <p>e f. g h! <p>i j. k",
        "<div class=article>Lead. <p>In one. In two.</p> Tail one. Tail two</div>",
        "<p>x. <b>y.</b> z.<p>. q. ! r",
        "<p>" + "word " * 200 + "<p>end. " + "z " * 150 + "<p>short one. last",
        "<p>   </p><p>  .  a. </p>",
    ],
)
def test_shared_sentences_equal_brute_force(html):
    assert set(H.sentence_pieces(html, INCLUDE, EXCLUDE, 60)) == brute(html, 60)


def test_unclosed_paragraphs_stay_linear():
    html = "".join(f"<p>Sentence number {i} stands here. It has a second part" for i in range(3000))
    pieces = list(H.sentence_pieces(html, INCLUDE, EXCLUDE, 200))
    assert len(pieces) <= 3 * 3000
    endless = "<p>nostop " * 3000
    assert all(len(p) <= 200 for p in H.sentence_pieces(endless, INCLUDE, EXCLUDE, 200))
