"""From source pages to the pages worth reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tongues.config import CorpusConfig
from tongues.operators.pages import anchor, page_records

DEFAULT = CorpusConfig()


def page_links(pages: DataFrame, *keep: str) -> DataFrame:
    """One row per link with a ``href``: position, href and lower-cased text.

    Pages without the start of a link never leave the JVM. Links leave the page's record one by one, so links
    that are never closed do not multiply the page.
    """
    keep = keep or ("page_id",)
    records = page_records(pages.filter(F.col("html").rlike(r"(?i)<a[\s/]")), keep=keep)
    rows = records.select(*keep, "anchors", F.posexplode("links").alias("pos", "_link"))
    return rows.select(*keep, F.col("pos").cast("long").alias("pos"), F.col("_link.href").alias("href"), anchor(F.col("_link")).alias("anchor"))


def netloc(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def absolute(href: Column, base: Column) -> Column:
    """Address that a link on the page ``base`` leads to, null when it is neither rooted nor http."""
    return F.when(href.startswith("/"), F.concat(F.lit("https://"), netloc(base), href)).when(href.startswith("http"), href)


def is_article(target: Column, text: Column, patterns: Column, base: Column) -> Column:
    """Whether a link stays on its page's host and its address or text holds one of the patterns."""
    hit = F.exists(patterns, lambda p: F.contains(F.lower(target), p) | F.contains(text, p))
    return hit & F.contains(target, netloc(base))


def resolve_links(links: DataFrame, base: str = "url") -> DataFrame:
    """Absolute ``target`` of each link; links that are neither rooted nor http are dropped."""
    return links.withColumn("target", absolute(F.col("href"), F.col(base))).filter(F.col("target").isNotNull())


def article_links(links: DataFrame, rules: DataFrame, base: str = "url") -> DataFrame:
    """Links of the page's own host whose address or text holds one of its language's patterns.

    ``rules`` is the link-pattern dimension, one row per configured language.
    """
    hit = is_article(F.col("target"), F.col("anchor"), F.col("patterns"), F.col(base))
    return links.join(F.broadcast(rules), "language").filter(hit).drop("patterns")


def article_targets(records: DataFrame, rules: DataFrame, base: str = "url") -> DataFrame:
    """``records`` with ``targets``: the addresses of ``article_links``, in document order, as an array of each page's own.

    The same as resolving and filtering rows of links, within the row that holds them. ``records`` have a ``language``.
    """
    url = F.col(base)
    resolved = F.transform("links", lambda link: F.struct(absolute(link["href"], url).alias("target"), anchor(link).alias("anchor")))
    # a condition on null is no hit, so links that resolve to nothing go as well
    kept = F.filter(resolved, lambda link: is_article(link["target"], link["anchor"], F.col("patterns"), url))
    return records.join(F.broadcast(rules), "language").withColumn("targets", F.transform(kept, lambda link: link["target"])).drop("patterns")


def first_targets(pages: DataFrame, *page: str, limit: int = DEFAULT.max_links_per_page) -> DataFrame:
    """First ``limit`` different ``targets`` of each row, numbered from 1. Nothing leaves its row, so nothing is shuffled."""
    page = page or ("page_id",)
    best = F.slice(F.array_distinct("targets"), 1, limit)
    return pages.select(*page, F.posexplode(best)).select(*page, (F.col("pos") + 1).cast("long").alias("link_rank"), F.col("col").alias("target"))


def top_links(links: DataFrame, *page: str, limit: int = DEFAULT.max_links_per_page) -> DataFrame:
    """``first_targets`` of links that come as rows, with ``pos`` and ``target``: those of a page meet in one shuffle first.

    Links that are still in their page's record need no shuffle; see ``article_targets``.
    """
    page = page or ("page_id",)
    ordered = F.array_sort(F.collect_list(F.struct("pos", "target")))
    listed = links.groupBy(*page).agg(ordered.alias("_all"))
    return first_targets(listed.withColumn("targets", F.transform("_all", lambda link: link["target"])), *page, limit=limit)


def page_candidates(sources: DataFrame, links: DataFrame, per_source: int = DEFAULT.max_pages_per_source) -> DataFrame:
    """Addresses to read per source: the source itself (rank 0), then its first links."""
    own = sources.select("language", "source_rank", F.lit(0).cast("long").alias("page_rank"), "url")
    linked = links.filter(F.col("link_rank") <= per_source).select(
        "language", "source_rank", F.col("link_rank").alias("page_rank"), F.col("target").alias("url")
    )
    return own.unionByName(linked)


def page_frontier(candidates: DataFrame, pages: DataFrame) -> DataFrame:
    """Candidates that were fetched, with the page that answers their address.

    Only addresses and ids are joined, never page bodies. One snapshot per address keeps the page side unique, so
    a popular address is skewed on one side only, which adaptive execution splits.
    """
    known = pages.groupBy("url").agg(F.min("page_id").alias("page_id"))
    return candidates.join(known, "url").select("language", "source_rank", "page_rank", "url", "page_id")


def reading_order(frontier: DataFrame, config: CorpusConfig = DEFAULT) -> DataFrame:
    """``(language, page_id, page_order)``: sources in their order, each followed by its links; later repeats of a page are dropped."""
    order = F.col("source_rank") * (config.max_links_per_page + 1) + F.col("page_rank")
    return frontier.groupBy("language", "page_id").agg(F.min(order).alias("page_order"))
