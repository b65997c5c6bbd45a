"""The one-pass page reader against a parse per purpose, and the plans of what works on its records."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tongues.functions import html as H
from tongues.operators import links as L
from tongues.operators import pages as O
from tongues.operators.paragraphs import page_sentences
from tongues.operators.sentences import clean_sentences
from tongues.plans.build import collect_sentences
from tongues.plans.queries import PATTERNS
from tongues.sources import dims
from tongues.sources.tables import read_pages, with_url_language

DIRECTORY = "/root/testdata/sf0.001"
RULES = [
    (("p", "div.article"), ("nav", "script")),
    (("p",), ("nav", "script")),
    (("section.text", "p"), ("aside", '[class*="menu"]')),
    (("p",), ()),
    ((), ("p",)),
]


def random_page(rng):
    tags = ["<p>", "</p>", "<nav>", "</nav>", "<div class='article x'>", "</div>", "<section class=text>", "</section>", "<aside>", "</aside>",
            "<span class='top-menu'>", "</span>", "<a href='/x'>", "<a href=/y>", "<a>", "</a>", "<br>", "<img class=menu>", "<script>", "</script>", "<b>", "</b>"]
    return "".join(rng.choice([*tags, "Some words here. ", "And more! ", "é&amp;ß ", "short ", "\n"]) for _ in range(rng.randint(0, 60)))


def test_one_pass_equals_a_pass_for_each_purpose():
    rng = random.Random(7)
    selection = H.Selection(RULES)
    for _ in range(3000):
        html = random_page(rng)
        anchors, links, sentences = H.read_page(html, selection, 200)
        assert [(href, anchors[start:start + size].lower()) for href, start, size in links] == H.page_links(html)
        for r, (include, exclude) in enumerate(RULES):
            alone = set(H.sentence_pieces(html, include, exclude, 200))
            assert {s for s, rules in sentences.items() if rules >> r & 1} == alone, (html, r)


def test_hidden_parts_are_cut_out_of_paragraphs():
    html = "<p>one <nav>two <p>three</p></nav> four <aside>five</aside> six</p>"
    assert list(H.paragraphs(html, ("p",), ("nav",))) == ["one  four five six"]
    assert list(H.paragraphs(html, ("p",), ("aside",))) == ["one two three four  six", "three"]
    assert list(H.paragraphs(html, ("p",), ())) == ["one two three four five six", "three"]


def test_open_links_share_their_text():
    html = "<a href=/a>word " * 2000
    anchors, links, _ = H.read_page(html, H.Selection(), 200)
    assert len(anchors) == 2000 * 5 and len(links) == 2000 and links[1999] == ("/a", 1999 * 5, 5)


def test_records_equal_rows(spark):
    pages = with_url_language(read_pages(spark, DIRECTORY)).select("page_id", "language", "url", "html")
    distinct, bits = O.rule_bits(dims.rule_dim(spark))
    records = O.page_records(pages, distinct, keep=("page_id", "language", "url")).cache()
    rows = clean_sentences(page_sentences(pages, dims.rule_dim(spark))).select("page_id", "language", "text").distinct()
    assert sorted(O.record_sentences(records, bits).distinct().collect()) == sorted(rows.collect())
    rules = dims.link_rule_dim(spark, PATTERNS)
    found = L.article_links(L.resolve_links(L.page_links(pages, "page_id", "language", "url")), rules)
    assert sorted(L.first_targets(L.article_targets(records, rules), limit=3).collect()) == sorted(L.top_links(found, limit=3).collect())
    records.unpersist()


def test_flushed_slices_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(O, "FLUSH_CHARS", 1)
    pages = spark.createDataFrame([(i, f"u{i}", f"<a href=/{i}>t</a><p>Sentence number {i} of the page.</p>" * (i % 3)) for i in range(50)] + [(50, None, None), (51, "u", "")],
                                  "page_id long, url string, html string")
    rows = O.page_records(pages.coalesce(1), RULES).collect()
    assert [r["page_id"] for r in rows] == list(range(52))
    assert [len(r["links"]) for r in rows] == [i % 3 for i in range(50)] + [0, 0]
    assert all(r["anchors"] == "t" * (r["page_id"] % 3) for r in rows[:50])


def test_unknown_languages_and_too_many_rules(spark):
    pages = spark.createDataFrame([(1, "u", "<p>A sentence that is long enough.</p>", "dutch")], "page_id long, url string, html string, language string")
    distinct, bits = O.rule_bits(dims.rule_dim(spark))
    records = O.page_records(pages, distinct, keep=("page_id", "language"))
    assert O.record_sentences(records, bits).count() == 0 and O.record_sentences(records, {}).count() == 0
    many = {f"l{i}": (f"div.c{i}",) for i in range(64)}
    with pytest.raises(ValueError):
        O.rule_bits(dims.rule_dim(spark, many))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_links_are_picked_without_an_exchange(spark):
    pages = spark.read.parquet(f"{DIRECTORY}/pages.parquet").withColumn("language", F.lit("english"))
    records = O.page_records(pages, keep=("page_id", "language", "url"))
    text = plan(L.first_targets(L.article_targets(records, dims.link_rule_dim(spark, PATTERNS))))
    assert text.count("MapInArrow") == 1 and not re.search(r"(?<!Broadcast)Exchange", text)


def test_collecting_moves_no_page_body(spark, monkeypatch):
    """With broadcasts off, one parse makes the page table and every later plan reads that table."""
    plans = []

    def seen(df, name, path=None):
        plans.append(plan(df))
        return stored(df, name, path)

    from tongues.plans import build
    stored = build.stored
    monkeypatch.setattr(build, "stored", seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pages = spark.read.parquet(f"{DIRECTORY}/pages.parquet").select("page_id", "url", "html")
        sources = with_url_language(pages).select("language", F.col("page_id").alias("source_rank"), "url")
        found = collect_sentences(pages, sources, link_rules=dims.link_rule_dim(spark, PATTERNS))
        assert found.count() > 0
        plans.append(plan(found))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(plans) == 2 and [p.count("MapInArrow") for p in plans] == [1, 0]
    assert not re.search(r"(?<!Broadcast)Exchange", plans[0]) and "html#" in plans[0]
    assert "html#" not in plans[1] and "SortMergeJoin" in plans[1]
