"""Small fixed dimensions. Everything here is configuration: pass your own to replace it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Supported languages with their two-letter code and family.
LANGUAGES = (
    ("english", "English", "Germanic", "en"),
    ("german", "German", "Germanic", "de"),
    ("spanish", "Spanish", "Romance", "es"),
    ("french", "French", "Romance", "fr"),
    ("italian", "Italian", "Romance", "it"),
)
CODES = tuple(code for code, *_ in LANGUAGES)
NAMES = {code: name for code, name, *_ in LANGUAGES}
FAMILIES = {code: family for code, _, family, _ in LANGUAGES}

# Start pages per language, in the order they are visited.
SOURCES = {
    "english": (
        "https://en.wikipedia.org/wiki/Main_Page",
        "https://www.bbc.com/news",
        "https://www.theguardian.com/international",
        "https://www.nytimes.com/",
        "https://www.nationalgeographic.com/",
        "https://www.scientificamerican.com/",
        "https://www.economist.com/",
    ),
    "german": (
        "https://de.wikipedia.org/wiki/Wikipedia:Hauptseite",
        "https://www.spiegel.de/",
        "https://www.zeit.de/index",
        "https://www.faz.net/aktuell/",
        "https://www.sueddeutsche.de/",
        "https://www.tagesschau.de/",
        "https://www.dw.com/de/themen/s-9077",
    ),
    "spanish": (
        "https://es.wikipedia.org/wiki/Wikipedia:Portada",
        "https://www.elmundo.es/",
        "https://www.elpais.com/",
        "https://www.abc.es/",
        "https://www.lavanguardia.com/",
        "https://www.20minutos.es/",
        "https://www.bbc.com/mundo",
    ),
    "french": (
        "https://fr.wikipedia.org/wiki/Wikip%C3%A9dia:Accueil_principal",
        "https://www.lemonde.fr/",
        "https://www.lefigaro.fr/",
        "https://www.liberation.fr/",
        "https://www.20minutes.fr/",
        "https://www.france24.com/fr/",
        "https://www.rtl.fr/",
    ),
    "italian": (
        "https://it.wikipedia.org/wiki/Pagina_principale",
        "https://www.corriere.it/",
        "https://www.repubblica.it/",
        "https://www.lastampa.it/",
        "https://www.ilsole24ore.com/",
        "https://www.ansa.it/",
        "https://www.rainews.it/",
    ),
}

# Elements that hold text, and elements that never do.
INCLUDE = {
    "english": ("p", "div.article-body", "div.story-body", "section.content"),
    "german": ("p", "div.article", "div.text", "section.content"),
    "spanish": ("p", "div.articulo", "div.texto", "section.contenido"),
    "french": ("p", "div.article", "div.texte", "section.contenu"),
    "italian": ("p", "div.articolo", "div.testo", "section.contenuto"),
}
EXCLUDE = ("footer", "nav", "header", "aside", "script", "style", '[class*="menu"]')

# Words that mark a link as an article.
LINK_PATTERNS = {
    "english": ("article", "story", "news", "feature"),
    "german": ("artikel", "nachricht", "news", "meldung"),
    "spanish": ("articulo", "noticia", "reportaje"),
    "french": ("article", "nouvelle", "actualite"),
    "italian": ("articolo", "notizia", "reportage"),
}


def language_dim(spark: SparkSession, languages=LANGUAGES) -> DataFrame:
    return spark.createDataFrame(list(languages), "code string, name string, family string, iso string")


def source_dim(spark: SparkSession, sources: dict[str, Sequence[str]] = SOURCES) -> DataFrame:
    rows = [(lang, i, url) for lang, urls in sources.items() for i, url in enumerate(urls)]
    return spark.createDataFrame(rows, "language string, source_rank long, url string")


def rule_dim(spark: SparkSession, include=INCLUDE, exclude=EXCLUDE) -> DataFrame:
    rows = [(lang, list(selectors), list(exclude)) for lang, selectors in include.items()]
    return spark.createDataFrame(rows, "language string, include array<string>, exclude array<string>")


def link_rule_dim(spark: SparkSession, patterns=LINK_PATTERNS) -> DataFrame:
    rows = [(lang, list(words)) for lang, words in patterns.items()]
    return spark.createDataFrame(rows, "language string, patterns array<string>")


def with_language(df: DataFrame, iso: str, languages=LANGUAGES) -> DataFrame:
    """Map a two-letter code column to ``language``; rows in other languages are dropped."""
    dim = language_dim(df.sparkSession, languages).select(F.col("iso").alias("_iso"), F.col("code").alias("language"))
    return df.join(F.broadcast(dim), F.col(iso) == F.col("_iso")).drop("_iso")


def language_lookup(df: DataFrame, code: str = "language", languages=LANGUAGES) -> DataFrame:
    """Add ``name`` and ``family``; an unknown code is its own name in family ``Unknown``."""
    dim = language_dim(df.sparkSession, languages).select(F.col("code").alias("_code"), "name", "family")
    return (
        df.join(F.broadcast(dim), F.col(code) == F.col("_code"), "left")
        .withColumn("name", F.coalesce("name", F.col(code)))
        .withColumn("family", F.coalesce("family", F.lit("Unknown")))
        .drop("_code")
    )
