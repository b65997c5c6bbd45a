"""From source pages to an augmented, written corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tongues.config import CorpusConfig, TopUpConfig
from tongues.operators import links as L
from tongues.operators import pages as P
from tongues.operators.augment import augment
from tongues.operators.sets import capped_corpus, hybrid_topup
from tongues.sources import dims
from tongues.sources.corpus import read_seed, write_corpus, write_stats
from tongues.sources.scratch import stored

MODES = ("web", "seed", "hybrid")
MAX_HOSTS = 1000  # host names that are tried on the address of every page


def page_table(pages: DataFrame, rules: DataFrame, sources: DataFrame | None = None, config: CorpusConfig = CorpusConfig()) -> tuple[DataFrame, dict[str, int]]:
    """Records of ``pages``, each parsed once, in a stored table that all later joins work on, and the rule of each language.

    With ``sources`` only pages that they can lead to are parsed: a link counts if its address holds the host of its source,
    so the address of every page that is read holds the host of some source.
    """
    distinct, bits = P.rule_bits(rules)
    if sources is not None:
        pages = _reachable(pages, sources)
    return stored(P.page_records(pages, distinct, config=config), "page-table"), bits


def _reachable(pages: DataFrame, sources: DataFrame) -> DataFrame:
    """Pages whose address holds the host of a source, if there are at most ``MAX_HOSTS`` hosts to try; else all."""
    hosts = [r["host"] for r in sources.select(L.netloc(F.col("url")).alias("host")).distinct().limit(MAX_HOSTS + 1).collect()]
    if len(hosts) > MAX_HOSTS or not all(hosts):
        return pages
    return pages.filter(F.exists(F.lit(hosts).cast("array<string>"), lambda host: F.contains(F.col("url"), host)))


def pages_to_read(records: DataFrame, sources: DataFrame, link_rules: DataFrame, config: CorpusConfig = CorpusConfig()) -> DataFrame:
    """``(language, page_id, page_order)`` of the source pages and what they link to, from the records of all pages."""
    own = sources.select("language", "source_rank", F.lit(0).cast("long").alias("page_rank"), "url")
    known = records.select("page_id", "url")
    fetched = L.page_frontier(own, known)
    linking = fetched.join(records.select("page_id", "anchors", "links"), "page_id")
    best = L.first_targets(L.article_targets(linking, link_rules), "language", "source_rank", limit=config.max_links_per_page)
    candidates = L.page_candidates(fetched, best, config.max_pages_per_source)
    return L.reading_order(L.page_frontier(candidates, known), config)


def collect_sentences(
    pages: DataFrame,
    sources: DataFrame | None = None,
    rules: DataFrame | None = None,
    link_rules: DataFrame | None = None,
    config: CorpusConfig = CorpusConfig(),
    languages=dims.CODES,
) -> DataFrame:
    """Distinct clean sentences of the pages each language needs to reach its cap."""
    spark = pages.sparkSession
    sources = dims.source_dim(spark) if sources is None else sources
    records, bits = page_table(pages, dims.rule_dim(spark) if rules is None else rules, sources, config)
    chosen = pages_to_read(records, sources, dims.link_rule_dim(spark) if link_rules is None else link_rules, config)
    bodies = records.select("page_id", "sentences").join(chosen, "page_id")
    clean = P.record_sentences(bodies, bits, ("language", "page_order"), config)
    return capped_corpus(clean, config.max_sentences_per_language, "page_order", languages)


def build_corpus(
    spark: SparkSession,
    mode: str,
    pages: DataFrame | None = None,
    sources: DataFrame | None = None,
    rules: DataFrame | None = None,
    link_rules: DataFrame | None = None,
    config: CorpusConfig = CorpusConfig(),
    topup: TopUpConfig = TopUpConfig(),
    languages=dims.CODES,
) -> DataFrame:
    """Augmented corpus ``(language, text, is_base)`` from pages, the seed, or both."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}, not {mode!r}")
    if mode == "seed":
        return augment(read_seed(spark))
    if pages is None:
        raise ValueError(f"mode {mode!r} needs pages")
    base = collect_sentences(pages, sources, rules, link_rules, config, languages)
    if mode == "hybrid":
        base = hybrid_topup(base, read_seed(spark), topup, languages)
    return augment(base)


def save_corpus(corpus: DataFrame, raw_dir: str, training_dir: str) -> None:
    """Write the raw and the training copy and, next to the raw one, its statistics.

    The second copy and the statistics are made from the first, not computed again.
    """
    write_corpus(corpus, f"{raw_dir}/sentences", training_dir)
    written = corpus.sparkSession.read.schema("value string, language string").text(f"{raw_dir}/sentences")
    write_stats(written, f"{raw_dir}/stats")
