from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tongues.config import CorpusConfig, TopUpConfig
from tongues.operators import links as L
from tongues.operators import sampling as B
from tongues.operators import sets as U
from tongues.operators.ranking import first_by_key, rank_by_key, top_k
from tongues.operators.summaries import corpus_counts, length_stats
from tongues.plans.build import build_corpus, collect_sentences, page_table, pages_to_read, save_corpus
from tongues.sources import dims
from tongues.sources.corpus import corpus_stats, read_corpus, read_seed, write_corpus, write_stats

S = "language string, text string"


def key(text, seed=42):
    return hashlib.md5(f"{seed}|{text}".encode()).hexdigest(), text


@pytest.fixture(scope="module")
def skewed(spark):
    """One language with most rows, one of ordinary size, one tiny."""
    rows = [("english", f"text {i}") for i in range(3000)]
    rows += [("german", f"satz {i}") for i in range(400)] + [("french", f"phrase {i}") for i in range(7)]
    return spark.createDataFrame(rows, S).repartition(6).cache()


def by_language(rows):
    out = defaultdict(list)
    for r in rows:
        out[r["language"]].append(r["text"])
    return out


@pytest.mark.parametrize("method", [B.balance, B.balance_distinct])
def test_balance_is_the_smallest_keys(skewed, method):
    got = by_language(method(skewed, 50).collect())
    for language, texts in by_language(skewed.collect()).items():
        assert sorted(got[language]) == sorted(sorted(texts, key=key)[:50])


def test_balance_distinct_with_a_hot_text(spark, skewed):
    first = sorted((f"text {i}" for i in range(3000)), key=key)[0]
    copies = spark.range(5000).select(F.lit("english").alias("language"), F.lit(first).alias("text"))
    mixed = skewed.unionByName(copies)
    got = by_language(B.balance_distinct(mixed, 50).collect())
    assert sorted(got["english"]) == sorted(sorted((f"text {i}" for i in range(3000)), key=key)[:50])
    plain = by_language(B.balance(mixed, 50).collect())["english"]
    assert plain == [first] * 50
    last = sorted((f"text {i}" for i in range(3000)), key=key)[39]
    copies = spark.range(5000).select(F.lit("english").alias("language"), F.lit(last).alias("text"))
    plain = by_language(B.balance(skewed.unionByName(copies), 50).collect())["english"]
    assert len(plain) == 50 and plain.count(last) == 11


def test_unlisted_label_is_an_error(spark):
    df = spark.createDataFrame([("klingon", "nuqneH"), ("english", "hi")], S)
    with pytest.raises(Exception, match="klingon"):
        B.class_weights(df).collect()


def test_split_folds_and_weights(skewed):
    rows = B.stratified_split(skewed, 0.2).collect()
    assert len(rows) == 3407
    tests = Counter(r["language"] for r in rows if r["is_test"])
    assert tests == {"english": 600, "german": 80, "french": 1}
    folds = B.stratified_folds(skewed, 5).collect()
    assert len(folds) == 3407
    for language, n in (("english", 600), ("german", 80)):
        assert set(Counter(r["fold"] for r in folds if r["language"] == language).values()) == {n}
    ranks = rank_by_key(skewed, "language", "text", 42).collect()
    ordered = sorted((r for r in ranks if r["language"] == "english"), key=lambda r: r["rank"])
    assert [r["text"] for r in ordered] == sorted((f"text {i}" for i in range(3000)), key=key)
    weights = {r["language"]: r["weight"] for r in B.class_weights(skewed).distinct().collect()}
    assert weights["german"] == pytest.approx(3407 / (3 * 400))


def test_top_k_keeps_everything_when_k_is_large(skewed):
    assert top_k(skewed, ["language"], ["text"], 10**6).count() == 3407
    assert first_by_key(skewed, "language", "text", 1, 5000).count() == 3407


def test_capped_corpus_follows_pages(spark):
    block = U.BLOCK
    pages = [0, 1, 2, 3, block + 1, block + 2, 3 * block]
    rows = []
    for i, page in enumerate(pages):
        rows += [("english", page, f"s{i}-{j}") for j in range(10)] + [("english", page, "s0-0")] * 3
        rows += [("german", page, f"g{i}")]
    df = spark.createDataFrame(rows, "language string, page_order long, text string")
    for cap in (1, 10, 11, 35, 45, 60, 1000):
        used, seen = set(), set()
        for page in pages:
            if len(seen) >= cap:
                break
            seen |= {t for lang, p, t in rows if lang == "english" and p == page}
        got = by_language(U.capped_corpus(df, cap).collect())
        assert set(got["english"]) == seen and len(got["english"]) == len(seen), cap
        assert len(got["german"]) == min(cap, len(pages))


def test_hybrid_topup(spark):
    seed = read_seed(spark)
    few = spark.createDataFrame([("english", f"own sentence {i}") for i in range(60)] + [("german", "eigener Satz")], S)
    got = Counter(r["language"] for r in U.hybrid_topup(few, seed).collect())
    # English has enough; German is filled; the rest found nothing and are filled too.
    assert got == {"english": 60, "german": 26, "spanish": 25, "french": 25, "italian": 25}
    enough = few.unionByName(spark.createDataFrame([("french", f"phrase {i}") for i in range(60)], S))
    assert U.hybrid_topup(enough, seed).count() == enough.count()
    capped = U.hybrid_topup(few, seed, TopUpConfig(limit=10), ("english", "german"))
    assert Counter(r["language"] for r in capped.collect()) == {"english": 60, "german": 10}


def test_new_and_union(spark):
    a = spark.createDataFrame([("english", "x"), ("english", "x"), ("german", "x"), ("english", "y")], S)
    known = spark.createDataFrame([("german", "x"), ("english", "y")], S)
    assert [tuple(r) for r in U.new_sentences(a, known).collect()] == [("english", "x")]
    assert U.new_sentences(a, known, ["text"]).count() == 0
    assert U.union_corpora(a, known).count() == 3


def test_corpus_files(spark, tmp_path):
    plain = tmp_path / "plain"
    plain.mkdir()
    (plain / "english.txt").write_text("  One line here. \n\n   \nOne line here.\n", encoding="utf-8")
    (plain / "german.txt").write_text(" Größe zählt. \n", encoding="utf-8")
    (plain / "dutch.txt").write_text("Niet ondersteund.\n", encoding="utf-8")
    got = sorted(tuple(r) for r in read_corpus(spark, str(plain)).collect())
    assert got == [("english", "One line here."), ("english", "One line here."), ("german", "Größe zählt.")]
    with pytest.raises(ValueError):
        read_corpus(spark, str(plain), ["italian"])

    seed = read_seed(spark)
    for options in ({}, {"files_per_language": 2}):
        raw, training = str(tmp_path / f"raw{len(options)}"), str(tmp_path / f"training{len(options)}")
        write_corpus(seed, raw, training, **options)
        expected = sorted(tuple(r) for r in seed.collect())
        assert sorted(tuple(r) for r in read_corpus(spark, raw).collect()) == expected
        assert sorted(tuple(r) for r in read_corpus(spark, training).collect()) == expected
    write_stats(seed, str(tmp_path / "stats"))
    stats = spark.read.json(str(tmp_path / "stats")).first()
    assert stats["total_sentences"] == 125 and stats["languages"]["italian"] == 25 and stats["timestamp"] > 1e9
    assert corpus_stats(seed.filter("false")).first()["total_sentences"] == 0


def test_seed_is_usable(spark):
    rows = read_seed(spark).collect()
    assert Counter(r["language"] for r in rows) == {code: 25 for code in dims.CODES}
    assert all(20 <= len(r["text"]) <= 200 and r["text"].endswith(".") for r in rows)
    assert length_stats(build_corpus(spark, "seed")).count() == 5
    assert corpus_counts(read_seed(spark)).filter("language is null").first()["sentences"] == 125


LINKS = (
    '<a href="/news/1">a</a><a href="/x">Top STORY</a><a href="//h/article">b</a><a href="#top">news</a>'
    '<a href="mailto:news@x">c</a><a href="https://other.org/news">d</a><a href="https://e.org:8080/news/2">e</a>'
    '<a href="/news/1">again</a><a href="/about">plain</a>'
)


def test_links(spark):
    pages = spark.createDataFrame([(1, "english", "https://e.org:8080/start", LINKS)], "page_id long, language string, url string, html string")
    links = L.resolve_links(L.page_links(pages, "page_id", "language", "url"))
    found = L.article_links(links, dims.link_rule_dim(spark))
    top = [r["target"] for r in L.top_links(found).orderBy("link_rank").collect()]
    assert top == [
        "https://e.org:8080/news/1", "https://e.org:8080/x", "https://e.org:8080//h/article", "https://e.org:8080/news/2",
    ]
    many = "".join(f'<a href="/news/{i % 30}">n</a>' for i in range(60))
    pages = spark.createDataFrame([(1, "english", "https://e.org/", many)], pages.schema)
    found = L.article_links(L.resolve_links(L.page_links(pages, "page_id", "language", "url")), dims.link_rule_dim(spark))
    assert [r["target"] for r in L.top_links(found).orderBy("link_rank").collect()] == [f"https://e.org/news/{i}" for i in range(20)]
    unknown = pages.withColumn("language", F.lit("dutch"))
    links = L.resolve_links(L.page_links(unknown, "page_id", "language", "url"))
    assert L.article_links(links, dims.link_rule_dim(spark)).count() == 0


def site(spark):
    def body(name):
        return "".join(f"<p>Page {name} says sentence number {w} right here. And {name} adds one more thing to {w}." for w in ("one", "two"))

    start = '<a href="/news/a">x</a><a href="/news/gone">x</a><a href="/news/b">x</a><a href="/news/c">x</a>'
    rows = [
        (1, "https://s.org/", start + body("start")),
        (2, "https://s.org/news/a", body("alpha")),
        (3, "https://s.org/news/b", body("beta")),
        (4, "https://s.org/news/c", body("gamma")),
        (5, "https://t.org/", body("other")),
        (6, "https://s.org/news/a", body("copy")),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    sources = spark.createDataFrame(
        [("english", 0, "https://s.org/"), ("english", 1, "https://none.org/"), ("english", 2, "https://t.org/")],
        "language string, source_rank long, url string",
    )
    return pages, sources


def test_collecting_pages(spark, monkeypatch, tmp_path):
    pages, sources = site(spark)
    rules = dims.link_rule_dim(spark)
    config = CorpusConfig(max_pages_per_source=3)
    for most, host_limit in (("10MB", 1000), ("-1", 1000), ("-1", 1)):
        monkeypatch.setattr("tongues.plans.build.MAX_HOSTS", host_limit)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
        try:
            records, _ = page_table(pages, dims.rule_dim(spark), sources)
            order = [r["page_id"] for r in pages_to_read(records, sources, rules, config).orderBy("page_order").collect()]
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert order == [1, 2, 3, 5]  # the third link is beyond the limit, a second snapshot is not read

    texts = by_language(collect_sentences(pages, sources, config=config).collect())["english"]
    assert any("alpha" in t for t in texts) and not any("gamma" in t for t in texts)
    two = by_language(collect_sentences(pages, sources, config=CorpusConfig(max_sentences_per_language=4)).collect())
    assert not any("alpha" in t for t in two["english"])

    with pytest.raises(ValueError):
        build_corpus(spark, "other")
    built = build_corpus(spark, "hybrid", pages, sources, config=config)
    save_corpus(built, str(tmp_path / "raw"), str(tmp_path / "training"))
    back = read_corpus(spark, str(tmp_path / "training"))
    assert set(dims.CODES) == {r["language"] for r in back.select("language").distinct().collect()}
    assert back.count() == spark.read.json(str(tmp_path / "raw" / "stats")).first()["total_sentences"]
