"""The same queries in SQL, for checking results with another engine.

Written independently of the operators: only fixed values and query parameters are shared.
"""

from __future__ import annotations

from tongues.functions.report import LEVELS, LOWEST_LEVEL, NOTE_MIXED, WARN_SHORT, WARN_VERY_SHORT
from tongues.functions.report import ERROR_EMPTY, ERROR_SHORT
from tongues.functions.stats import ALL, CHAR_SETS, WORD_PATTERNS
from tongues.functions.text import DIGIT, WS
from tongues.functions.variants import PREFIXES, TYPOS
from tongues.plans.queries import CAP, LINKS_PER_PAGE, MODEL, PATTERNS, TOPUP
from tongues.sources.dims import LANGUAGES


def _quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_quote(v) for v in row) + ")" for row in rows)


def _sql(ctes: dict[str, str], body: str) -> str:
    head = ",\n".join(f"{name} AS ({text})" for name, text in ctes.items())
    return f"WITH {head}\n{body}" if head else body


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def _upper(x: str) -> str:
    return f"upper(replace({x}, 'ß', 'SS'))"


def _split(source: str, ids: str) -> str:
    """Sentences of ``text`` in ``source``: mark every end, then cut at the marks."""
    return (
        f"SELECT {ids}, unnest(range(len(l))) AS pos, unnest(l) AS text FROM ("
        f"SELECT {ids}, string_split(regexp_replace({_strip('text')}, '([.!?]){WS}+', '\\1' || chr(1), 'g'), chr(1)) AS l "
        f"FROM {source} WHERE {_strip('text')} <> '')"
    )


def _normal(source: str, rest: str) -> str:
    return f"SELECT {rest}, trim(regexp_replace(text, '{WS}+', ' ', 'g'), ' ') AS text FROM {source}"


LENGTH = "length(text) BETWEEN 20 AND 200"
MIN_WORDS = "len(list_filter(string_split(text, ' '), lambda w: w <> '')) >= 4"
DIGITS = f"length(text) - length(regexp_replace(text, '{DIGIT}', '', 'g')) <= 0.3::DOUBLE * length(text)"
URL = "NOT regexp_matches(lower(text), 'https?://')"
EMAIL = r"NOT regexp_matches(text, '@[^@]*\.[^@]*$')"
CAPITAL = rf"CASE WHEN regexp_matches(text, '^\p{{L}}') THEN {_upper('substr(text, 1, 1)')} || substr(text, 2) ELSE text END"


def _clean(source: str, rest: str) -> str:
    return f"SELECT {rest}, {CAPITAL} AS text FROM {source} WHERE {LENGTH} AND {MIN_WORDS} AND {DIGITS} AND {URL} AND {EMAIL}"


LANGS = {"langs": f"SELECT * FROM (VALUES {_values(LANGUAGES)}) t(code, name, family, iso)"}
DOCS = {
    **LANGS,
    "docs": "SELECT doc_id, code AS language, text FROM documents JOIN langs ON lang = iso WHERE text IS NOT NULL",
}
PIECES = {**DOCS, "pieces": _split("docs", "doc_id, language")}
NORMAL = {**PIECES, "normal": _normal("pieces", "doc_id, language, pos")}
CLEAN = {**NORMAL, "clean": _clean("normal", "doc_id, language, pos")}
CORPUS = {**CLEAN, "corpus": "SELECT DISTINCT language, text FROM clean"}
BENCH = {
    "bench_pieces": _split("(SELECT item_id, text FROM benchmark WHERE text IS NOT NULL)", "item_id"),
    "bench_normal": _normal("bench_pieces", "item_id, pos"),
    "bench": _clean("bench_normal", "item_id, pos"),
}
TURNS = {"turns": "SELECT conv_id, turn, text FROM conversations WHERE text IS NOT NULL"}

# Links

PAGES = {
    **LANGS,
    "found": "SELECT page_id, url, "
    r"""regexp_extract_all(html, '(?is)<a\b[^>]*\bhref="([^"]*)"[^>]*>(.*?)</a>', 1) AS h, """
    r"""regexp_extract_all(html, '(?is)<a\b[^>]*\bhref="([^"]*)"[^>]*>(.*?)</a>', 2) AS a FROM pages WHERE html <> ''""",
    "links": "SELECT page_id, url, unnest(range(len(h))) AS pos, unnest(h) AS href, lower(unnest(a)) AS anchor FROM found",
}
HOST = "regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)"
RESOLVED = {
    **PAGES,
    "resolved": f"SELECT page_id, code AS language, url, {HOST} AS host, pos, anchor, "
    f"CASE WHEN href LIKE '/%' THEN 'https://' || {HOST} || href ELSE href END AS target "
    "FROM links JOIN langs ON regexp_extract(url, '^[a-z]+://[^/]+/([a-z]{2})/', 1) = iso "
    "WHERE href LIKE '/%' OR href LIKE 'http%'",
}
ARTICLES = {
    **RESOLVED,
    "patterns": f"SELECT * FROM (VALUES {_values([(lang, p) for lang, ps in PATTERNS.items() for p in ps])}) t(language, pattern)",
    "articles": "SELECT DISTINCT r.* FROM resolved r JOIN patterns p ON r.language = p.language "
    "AND (contains(lower(target), pattern) OR contains(anchor, pattern)) WHERE contains(target, host)",
}
TOP = {
    **ARTICLES,
    "firsts": "SELECT page_id, language, target, min(pos) AS pos FROM articles GROUP BY ALL",
    "numbered": "SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS link_rank FROM firsts",
    "top": f"SELECT page_id, language, link_rank, target FROM numbered WHERE link_rank <= {LINKS_PER_PAGE}",
}
CANDIDATES = {
    **TOP,
    "candidates": "SELECT code AS language, page_id AS source_rank, 0::BIGINT AS page_rank, url FROM pages "
    "JOIN langs ON regexp_extract(url, '^[a-z]+://[^/]+/([a-z]{2})/', 1) = iso WHERE html <> '' "
    "UNION ALL SELECT language, page_id, link_rank, target FROM top WHERE link_rank <= 3",
}

_DECODED = "text"
for _entity, _sign in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
    _DECODED = f"replace({_DECODED}, '{_entity}', '{_sign}')"
# An unclosed paragraph holds all that follows it in its article.
PARAGRAPHS = {
    **LANGS,
    "articles_of": "SELECT page_id, code AS language, string_split(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<p>') AS ps "
    "FROM pages JOIN langs ON regexp_extract(url, '^[a-z]+://[^/]+/([a-z]{2})/', 1) = iso WHERE html <> ''",
    "pieces_of": "SELECT page_id, language, ps, unnest(range(2, len(ps) + 1)) AS i FROM articles_of",
    "marked": "SELECT page_id, language, i, CASE WHEN contains(ps[i], '</p>') THEN split_part(ps[i], '</p>', 1) "
    "ELSE array_to_string(ps[i:], '') END AS text FROM pieces_of",
    "bare": "SELECT page_id, language, i, regexp_replace(text, '<[^>]*>', '', 'g') AS text FROM marked",
    "decoded": f"SELECT page_id, language, i, {_strip(_DECODED)} AS text FROM bare",
    "paragraphs": "SELECT page_id, language, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS para_pos, text "
    "FROM decoded WHERE text <> ''",
}
PAGE_CLEAN = {
    **PARAGRAPHS,
    "page_pieces": _split("paragraphs", "page_id, language, para_pos"),
    "page_normal": _normal("page_pieces", "page_id, language, para_pos, pos"),
    "page_clean": _clean("page_normal", "page_id, language, para_pos, pos"),
}

# Augmentation


def _variants(*parts: str) -> dict[str, str]:
    return {**CORPUS, "made": " UNION ALL ".join(parts)}


BASE = "FROM corpus WHERE length(text) >= 10"
CASE = [f"SELECT language, lower(text) AS text {BASE}", f"SELECT language, {_upper('text')} AS text {BASE}"]
PUNCT = [
    f"SELECT language, left(text, length(text) - 1) || '{mark}' AS text {BASE} "
    f"AND right(text, 1) IN ('.', '!', '?') AND right(text, 1) <> '{mark}'"
    for mark in (".", "!", "?")
]
PREFIX = [f"SELECT language, '{prefix}' || text AS text {BASE}" for prefix in PREFIXES]
SPACING = [
    f"SELECT language, w[1] || w[2] || ' ' || array_to_string(w[3:], ' ') AS text FROM "
    f"(SELECT language, string_split(text, ' ') AS w {BASE}) WHERE len(w) > 3",
    f"SELECT language, array_to_string(w, '  ') AS text FROM (SELECT language, string_split(text, ' ') AS w {BASE}) WHERE len(w) > 3",
]


def _typo(word: str, typo: str) -> str:
    once = rf"(?i)(^|[^\p{{L}}\p{{N}}_]){word}($|[^\p{{L}}\p{{N}}_])"
    step = f"regexp_replace(text, '{once}', '\\1{typo}\\2', 'g')"
    twice = f"regexp_replace({step}, '{once}', '\\1{typo}\\2', 'g')"
    return f"SELECT language, {twice} AS text {BASE} AND contains(' ' || lower(text) || ' ', ' {word} ')"


TYPO = [_typo(*pair) for pair in TYPOS]
AUGMENTED = {
    **_variants(*CASE, *PUNCT, *PREFIX, *SPACING, *TYPO),
    "augmented": "SELECT language, text, bool_or(b) AS is_base FROM (SELECT language, text, true AS b FROM corpus "
    "UNION ALL SELECT language, text, false FROM made) GROUP BY language, text",
}

# Sampling

RANKED = {
    **CORPUS,
    "ranked": "SELECT language, text, row_number() OVER (PARTITION BY language ORDER BY md5('42|' || text), text) AS r, "
    "count(*) OVER (PARTITION BY language) AS n FROM corpus",
}
SPLIT = {**RANKED, "split": "SELECT language, text, r <= round(0.2::DOUBLE * n) AS is_test FROM ranked"}

# Features


def _count(x: str, part: str) -> str:
    return f"((length({x}) - length(replace({x}, {_quote(part)}, ''))) // {len(part)})"


def _ratio(part: str) -> str:
    return f"round(CASE WHEN length(text) = 0 THEN 0 ELSE ({part})::DOUBLE / length(text) END, 6)"


WORDS_OF = f"list_filter(regexp_split_to_array(text, '{WS}+'), lambda w: w <> '')"
BASIC_SQL = {
    "length": "length(text)",
    "word_count": f"len({WORDS_OF})",
    "avg_word_length": f"round(coalesce(list_avg(list_transform({WORDS_OF}, lambda w: length(w))), 0), 6)",
    "space_ratio": _ratio(_count("text", " ")),
    "digit_ratio": _ratio(f"length(text) - length(regexp_replace(text, '{DIGIT}', '', 'g'))"),
    "uppercase_ratio": _ratio(r"length(text) - length(regexp_replace(text, '\p{Lu}', '', 'g'))"),
    "punctuation_ratio": _ratio("length(text) - length(regexp_replace(text, '[.,;:!?]', '', 'g'))"),
}
CHAR_SQL = {
    name: f"length(text) - length(regexp_replace(text, {_quote('[' + chars + ']')}, '', 'g'))"
    for name, chars in CHAR_SETS.items()
}
WORD_SQL = {
    name: " + ".join(_count("lower(text)", phrase) for phrase in phrases) for name, phrases in WORD_PATTERNS.items()
}


def _columns(exprs: dict[str, str], kind: str = "") -> str:
    return ", ".join(f"({e}){kind} AS {name}" for name, e in exprs.items())


def _grams(source: str, ids: str) -> dict[str, str]:
    """Words of each text with their uses, and the n-grams of each padded word."""
    return {
        "split_words": f"SELECT {ids}, unnest(regexp_split_to_array(lower(text), '{WS}+')) AS word FROM {source}",
        "used": f"SELECT {ids}, ' ' || word || ' ' AS word, count(*) AS uses FROM split_words WHERE word <> '' GROUP BY ALL",
        "sized": f"SELECT {ids}, word, uses, n, unnest(range(1, length(word) - n + 2)) AS i "
        "FROM used JOIN (SELECT unnest([2, 3, 4, 5]) AS n) ON n <= length(word)",
        "postings": f"SELECT {ids}, substr(word, i, n) AS term, sum(uses)::BIGINT AS tf FROM sized GROUP BY ALL",
        "frequencies": "SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM postings GROUP BY term",
        "total": f"SELECT count(*) AS n FROM {source}",
    }


VOCABULARY = {
    "best": "SELECT term, df, cf FROM frequencies, total WHERE df >= 2 AND df <= 0.9::DOUBLE * n "
    "ORDER BY cf DESC, term LIMIT 1500",
    "vocabulary": "SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_index, df, cf FROM best",
}
DOC_GRAMS = {**DOCS, **_grams("docs", "doc_id")}
TFIDF = {
    **TURNS,
    **_grams("turns", "conv_id, turn"),
    **VOCABULARY,
    "weighted": "SELECT conv_id, turn, term_index, (1 + ln(tf)) * (ln((1.0::DOUBLE + n) / (1 + df)) + 1) AS w "
    "FROM postings JOIN vocabulary USING (term), total",
    "weights": "SELECT conv_id, turn, term_index, "
    "w / sqrt(sum(w * w) OVER (PARTITION BY conv_id, turn)) AS weight FROM weighted",
}
TFIDF_ROWS = _sql(TFIDF, "SELECT conv_id, turn, term_index, round(weight, 6) AS weight FROM weights")

# Stand-in predictions

STAND_IN = {
    "english": "the_english",
    "french": "et_french",
    "german": "und_german",
    "italian": "e_italian",
    "spanish": "y_spanish",
}


def _scores(source: str, ids: str) -> dict[str, str]:
    total = " + ".join(f"({name} + 1)" for name in STAND_IN.values())
    options = " UNION ALL ".join(
        f"SELECT {ids}, '{code}' AS code, ({name} + 1)::DOUBLE / ({total}) AS p FROM hits" for code, name in STAND_IN.items()
    )
    return {
        "hits": f"SELECT {ids}, {_columns(WORD_SQL)} FROM {source}",
        "options": options,
        "ranking": f"SELECT {ids}, o.code, coalesce(name, o.code) AS language, coalesce(family, 'Unknown') AS family, "
        f"p * 100 AS confidence, row_number() OVER (PARTITION BY {ids} ORDER BY p DESC, o.code) AS r "
        "FROM options o LEFT JOIN langs ON o.code = langs.code",
    }


RANKING = {**LANGS, **TURNS, **_scores("turns", "conv_id, turn")}
PAIRS = {
    **DOCS,
    **_scores("docs", "doc_id"),
    "pairs": "SELECT docs.language AS actual, code AS predicted, count(*) AS n "
    "FROM ranking JOIN docs USING (doc_id) WHERE r = 1 GROUP BY ALL",
    "labels_used": "SELECT actual AS label FROM pairs UNION SELECT predicted FROM pairs",
}
REPORT = {
    **PAIRS,
    "classes": "SELECT label, coalesce(sum(n) FILTER (actual = label AND predicted = label), 0) AS tp, "
    "coalesce(sum(n) FILTER (predicted = label), 0) AS claimed, coalesce(sum(n) FILTER (actual = label), 0) AS support "
    "FROM labels_used JOIN pairs ON actual = label OR predicted = label GROUP BY label",
    "scores": "SELECT label, support, CASE WHEN claimed = 0 THEN 0 ELSE tp::DOUBLE / claimed END AS precision, "
    "CASE WHEN support = 0 THEN 0 ELSE tp::DOUBLE / support END AS recall, "
    "CASE WHEN claimed + support = 0 THEN 0 ELSE 2.0::DOUBLE * tp / (claimed + support) END AS f1, tp FROM classes",
    "rows_all": "SELECT label, precision, recall, f1, support FROM scores "
    "UNION ALL SELECT 'accuracy', sum(tp)::DOUBLE / sum(support), sum(tp)::DOUBLE / sum(support), "
    "sum(tp)::DOUBLE / sum(support), sum(support) FROM scores "
    "UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM scores "
    "UNION ALL SELECT 'weighted avg', sum(precision * support)::DOUBLE / sum(support), "
    "sum(recall * support)::DOUBLE / sum(support), sum(f1 * support)::DOUBLE / sum(support), sum(support) FROM scores",
}

LEVEL = "CASE " + " ".join(f"WHEN confidence > {b} THEN '{name}'" for b, name in LEVELS) + f" ELSE '{LOWEST_LEVEL}' END"


def _preview(width: int) -> str:
    return f"CASE WHEN length(text) > {width} THEN left(text, {width}) || '...' ELSE text END"


def _kept(condition: str) -> str:
    return _sql(NORMAL, f"SELECT doc_id, pos, text FROM normal WHERE {condition}")


COLLECTED = {
    **{**CANDIDATES, **PAGE_CLEAN},
    "known": "SELECT url, min(page_id) AS page_id FROM pages WHERE html <> '' GROUP BY url",
    "reading": "SELECT c.language, k.page_id, min(c.source_rank * 21 + c.page_rank) AS page_order "
    "FROM candidates c JOIN known k ON c.url = k.url GROUP BY ALL",
    "first_seen": "SELECT r.language, text, min(page_order) AS page_order FROM page_clean p JOIN reading r ON p.page_id = r.page_id GROUP BY ALL",
    "fresh": "SELECT language, page_order, count(*) AS n FROM first_seen GROUP BY ALL",
    "running": "SELECT language, page_order, coalesce(sum(n) OVER (PARTITION BY language ORDER BY page_order "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM fresh",
}
COLLECT = (
    "SELECT f.language, f.text FROM first_seen f JOIN running r ON f.language = r.language AND f.page_order = r.page_order "
    f"WHERE before < {CAP}"
)

ORACLES: dict[str, str] = {
    "read_pages": "SELECT page_id, url, length(html) AS html_length FROM pages WHERE html <> ''",
    "read_write_corpus": _sql(CORPUS, "SELECT language, text FROM corpus"),
    "write_stats": _sql(
        CORPUS,
        "SELECT sum(count(*)) OVER ()::BIGINT AS total_sentences, language, count(*) AS sentences FROM corpus GROUP BY language",
    ),
    "language_lookup": _sql(
        {**LANGS, "coded": "SELECT doc_id, CASE WHEN lang IN ('en', 'fr') THEN code ELSE lang END AS language "
         "FROM documents LEFT JOIN langs ON lang = iso"},
        "SELECT doc_id, language, coalesce(name, language) AS name, coalesce(family, 'Unknown') AS family "
        "FROM coded LEFT JOIN langs ON language = code",
    ),
    "page_links": _sql(PAGES, "SELECT page_id, pos, href, anchor FROM links"),
    "resolve_links": _sql(RESOLVED, "SELECT page_id, pos, target FROM resolved"),
    "article_links": _sql(ARTICLES, "SELECT page_id, pos, target FROM articles"),
    "top_links": _sql(TOP, "SELECT page_id, link_rank, target FROM top"),
    "page_candidates": _sql(CANDIDATES, "SELECT * FROM candidates"),
    "page_frontier": _sql(
        CANDIDATES,
        "SELECT language, source_rank, page_rank, c.url, p.page_id FROM candidates c "
        "JOIN (SELECT url, min(page_id) AS page_id FROM pages WHERE html <> '' GROUP BY url) p ON c.url = p.url",
    ),
    "split_sentences": _sql(PIECES, "SELECT doc_id, language, pos, text FROM pieces"),
    "normalize_ws": _sql(NORMAL, "SELECT doc_id, pos, text FROM normal"),
    "filter_length": _kept(LENGTH),
    "filter_min_words": _kept(MIN_WORDS),
    "filter_digit_ratio": _kept(DIGITS),
    "filter_url": _kept(URL),
    "filter_email": _kept(EMAIL),
    "capitalize_first": _sql(NORMAL, f"SELECT doc_id, pos, {CAPITAL} AS text FROM normal"),
    "clean_sentences": _sql(CLEAN, "SELECT doc_id, language, pos, text FROM clean"),
    "distinct_sentences": _sql(CORPUS, "SELECT language, text FROM corpus"),
    "new_sentences": _sql(
        {**CORPUS, **BENCH}, "SELECT language, text FROM corpus WHERE text NOT IN (SELECT text FROM bench)"
    ),
    "capped_corpus": _sql(
        {
            **CLEAN,
            "firsts": "SELECT language, text, min(doc_id) AS doc FROM clean GROUP BY ALL",
            "fresh": "SELECT language, doc, count(*) AS n FROM firsts GROUP BY ALL",
            "running": "SELECT language, doc, coalesce(sum(n) OVER (PARTITION BY language ORDER BY doc "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM fresh",
        },
        f"SELECT f.language, f.text FROM firsts f JOIN running r ON f.language = r.language AND f.doc = r.doc WHERE before < {CAP}",
    ),
    "known_corpus": _sql(
        {**CORPUS, **BENCH}, "SELECT language, text FROM corpus WHERE text NOT IN (SELECT text FROM bench)"
    ),
    "stream_capped_corpus": _sql(
        {
            **CLEAN,
            "firsts": "SELECT language, text, min(doc_id) AS doc FROM clean GROUP BY ALL",
            "fresh": "SELECT language, doc, count(*) AS n FROM firsts GROUP BY ALL",
            "running": "SELECT language, doc, coalesce(sum(n) OVER (PARTITION BY language ORDER BY doc "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM fresh",
        },
        f"SELECT f.language, f.text FROM firsts f JOIN running r ON f.language = r.language AND f.doc = r.doc WHERE before < {CAP}",
    ),
    "hybrid_topup": _sql(
        {
            **CORPUS,
            "graded": "SELECT DISTINCT language, text FROM clean WHERE doc_id IN (SELECT doc_id FROM labels)",
            "sizes": f"SELECT l.language, count(text) AS n FROM (VALUES {_values([(p,) for p in PATTERNS])}) l(language) "
            "LEFT JOIN graded g ON g.language = l.language GROUP BY l.language",
            "needy": f"SELECT language FROM sizes WHERE n < {TOPUP.min_per_language} "
            f"AND (SELECT count(*) FROM graded) < {TOPUP.min_total}",
            "pool": "SELECT language, text FROM graded WHERE language IN (FROM needy) "
            "UNION SELECT language, text FROM corpus WHERE language IN (FROM needy)",
            "filled": "SELECT *, row_number() OVER (PARTITION BY language ORDER BY md5('42|' || text), text) AS r FROM pool",
        },
        "SELECT language, text FROM graded WHERE language NOT IN (FROM needy) "
        f"UNION ALL SELECT language, text FROM filled WHERE r <= {TOPUP.limit}",
    ),
    "union_corpora": _sql(
        {**CORPUS, **BENCH}, "SELECT language, text FROM corpus UNION SELECT 'english', text FROM bench"
    ),
    "aug_case": _sql(_variants(*CASE), "SELECT language, text FROM made"),
    "aug_punct": _sql(_variants(*PUNCT), "SELECT language, text FROM made"),
    "aug_prefix": _sql(_variants(*PREFIX), "SELECT language, text FROM made"),
    "aug_spacing": _sql(_variants(*SPACING), "SELECT language, text FROM made"),
    "aug_typo": _sql(_variants(*TYPO), "SELECT language, text FROM made"),
    "augment": _sql(AUGMENTED, "SELECT language, text, is_base FROM augmented"),
    "corpus_counts": _sql(CORPUS, "SELECT language, count(*) AS sentences FROM corpus GROUP BY ROLLUP (language)"),
    "augment_counts": _sql(
        AUGMENTED,
        "SELECT language, count(*) FILTER (is_base) AS before, count(*) AS after FROM augmented GROUP BY ROLLUP (language)",
    ),
    "length_stats": _sql(
        AUGMENTED,
        "SELECT language, count(*) AS sentences, round(avg(length(text)), 6) AS avg_length, "
        "count(*) FILTER (is_base) AS base_sentences, count(*) FILTER (NOT is_base) AS augmented FROM augmented GROUP BY language",
    ),
    "load_summary": _sql(
        CORPUS,
        "SELECT (SELECT count(*) FROM corpus) AS total, language, count(*) AS sentences, any_value(name) AS name "
        "FROM corpus JOIN langs ON language = code GROUP BY language",
    ),
    "balance": _sql(RANKED, "SELECT language, text FROM ranked WHERE r <= 300"),
    "stratified_split": _sql(SPLIT, "SELECT language, text, is_test FROM split"),
    "stratified_folds": _sql(RANKED, "SELECT language, text, (r - 1) % 5 AS fold FROM ranked"),
    "copy_folds": _sql(
        {**CLEAN, "turned": "SELECT language, text, row_number() OVER (PARTITION BY language ORDER BY md5('42|' || text), text) AS r FROM clean"},
        "SELECT language, text, (r - 1) % 5 AS fold, count(*) AS copies FROM turned GROUP BY ALL",
    ),
    "class_weights": _sql(
        {**RANKED, "k": "SELECT count(DISTINCT language) AS k, count(*) AS total FROM corpus"},
        "SELECT language, text, round(total::DOUBLE / (k * n), 6) AS weight FROM ranked, k",
    ),
    "split_summary": _sql(
        SPLIT,
        "SELECT count(*) FILTER (NOT is_test) AS train_rows, count(*) FILTER (is_test) AS test_rows, "
        f"{len(ALL)}::BIGINT AS features, count(DISTINCT language) AS labels FROM split",
    ),
    "feat_basic": _sql(DOCS, f"SELECT doc_id, {_columns(BASIC_SQL)} FROM docs"),
    "feat_chars": _sql(DOCS, f"SELECT doc_id, {_columns(CHAR_SQL)} FROM docs"),
    "feat_words": _sql(DOCS, f"SELECT doc_id, {_columns(WORD_SQL)} FROM docs"),
    "feat_vector": _sql(
        DOCS, f"SELECT doc_id, {_columns({**BASIC_SQL, **CHAR_SQL, **WORD_SQL}, '::DOUBLE')} FROM docs"
    ),
    "char_ngrams": _sql(DOC_GRAMS, "SELECT term, sum(tf)::BIGINT AS occurrences FROM postings GROUP BY term"),
    "term_freq": _sql({**TURNS, **_grams("turns", "conv_id, turn")}, "SELECT conv_id, turn, term, tf FROM postings"),
    "doc_freq": _sql(DOC_GRAMS, "SELECT term, df, cf FROM frequencies"),
    "vocabulary": _sql({**DOC_GRAMS, **VOCABULARY}, "SELECT term, term_index, df, cf FROM vocabulary"),
    "idf": _sql(
        DOC_GRAMS, "SELECT term, round(ln((1.0::DOUBLE + n) / (1 + df)) + 1, 6) AS idf FROM frequencies, total"
    ),
    "tfidf": TFIDF_ROWS,
    "tfidf_vector": TFIDF_ROWS,
    "feature_matrix": _sql(
        {
            **TFIDF,
            "size": "SELECT count(*) AS k FROM vocabulary",
            "stats": "SELECT conv_id, turn, unnest(range(" + str(len(ALL)) + ")) AS f, unnest(["
            + ", ".join(f"({e})::DOUBLE" for e in {**BASIC_SQL, **CHAR_SQL, **WORD_SQL}.values())
            + "]) AS value FROM turns",
        },
        "SELECT conv_id, turn, term_index AS feature, round(weight, 6) AS value FROM weights "
        "UNION ALL SELECT conv_id, turn, k + f, round(value, 6) FROM stats, size WHERE value <> 0",
    ),
    "detect_guard": _sql(
        {"word": f"SELECT item_id, unnest({WORDS_OF}) AS w FROM benchmark WHERE text IS NOT NULL"},
        f"SELECT item_id, CASE WHEN w = '' THEN '{ERROR_EMPTY}' WHEN length(w) < 3 THEN '{ERROR_SHORT}' END AS error, "
        "count(*) AS n FROM word GROUP BY ALL",
    ),
    "top_n": _sql(
        RANKING,
        "SELECT conv_id, turn, r - 1 AS rank, language, code, round(confidence, 6) AS confidence, family "
        "FROM ranking WHERE r <= 3",
    ),
    "confidence_level": _sql(
        RANKING,
        f"SELECT conv_id, turn, round(confidence, 6) AS confidence, {LEVEL} AS confidence_level FROM ranking WHERE r = 1",
    ),
    "text_preview": _sql(
        PIECES, f"SELECT doc_id, pos, {_preview(80)} AS single, {_preview(50)} AS batch FROM pieces"
    ),
    "short_warning": _sql(
        PIECES,
        f"SELECT doc_id, pos, CASE WHEN length(text) < 10 THEN '{WARN_VERY_SHORT}' "
        f"WHEN length(text) < 25 THEN '{WARN_SHORT}' END AS warning FROM pieces",
    ),
    "mixed_note": _sql(
        RANKING,
        f"SELECT a.conv_id, a.turn, a.code AS language_code, CASE WHEN a.confidence - b.confidence < 15 THEN '{NOTE_MIXED}' END "
        "AS note FROM ranking a JOIN ranking b ON a.conv_id = b.conv_id AND a.turn = b.turn WHERE a.r = 1 AND b.r = 2",
    ),
    "accuracy": _sql(
        PAIRS,
        "SELECT sum(n)::BIGINT AS total, sum(CASE WHEN actual = predicted THEN n ELSE 0 END)::BIGINT AS correct, "
        "round(sum(CASE WHEN actual = predicted THEN n ELSE 0 END)::DOUBLE / sum(n), 6) AS accuracy FROM pairs",
    ),
    "class_report": _sql(
        REPORT,
        "SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, "
        "support::BIGINT AS support FROM rows_all",
    ),
    "confusion_matrix": _sql(
        PAIRS,
        "SELECT a.label AS actual, b.label AS predicted, coalesce(n, 0)::BIGINT AS n FROM labels_used a CROSS JOIN labels_used b "
        "LEFT JOIN pairs ON actual = a.label AND predicted = b.label",
    ),
    "confusion_wide": _sql(
        PAIRS,
        "SELECT label AS actual, "
        + ", ".join(f"coalesce(sum(n) FILTER (predicted = '{c}'), 0)::BIGINT AS {c}" for c in STAND_IN)
        + " FROM labels_used LEFT JOIN pairs ON actual = label GROUP BY label",
    ),
    "stream_page_sentences": _sql(
        {**PAGE_CLEAN, "snapshots": "SELECT min(page_id) AS page_id FROM pages WHERE html <> '' GROUP BY url"},
        "SELECT DISTINCT language, text FROM page_clean SEMI JOIN snapshots USING (page_id)",
    ),
    "stream_new_sentences": _sql(CORPUS, "SELECT language, text FROM corpus"),
    "train_forest": _sql(
        RANKED,
        "SELECT language, r <= round(0.2 * least(n, 300)) AS is_test, count(*) AS n, true AS accurate FROM ranked WHERE r <= 300 GROUP BY ALL",
    ),
    "calibrate": _sql(
        RANKED,
        f"SELECT language, text, unnest(range({len(LANGUAGES)})) AS class_index, true AS whole, true AS in_range "
        "FROM ranked WHERE r <= 300",
    ),
    "detect": _sql(
        {
            **TURNS,
            "bare": f"SELECT conv_id, turn, {_strip('text')} AS text FROM turns",
            "judged": f"SELECT *, CASE WHEN text = '' THEN '{ERROR_EMPTY}' WHEN length(text) < 3 THEN '{ERROR_SHORT}' END AS error FROM bare",
            "fine": f"SELECT conv_id, turn, {_preview(80)} AS preview, length(text)::BIGINT AS text_length, "
            f"len({WORDS_OF})::BIGINT AS word_count, CASE WHEN length(text) < 10 THEN '{WARN_VERY_SHORT}' "
            f"WHEN length(text) < 25 THEN '{WARN_SHORT}' END AS warning, true AS level_fits, true AS first_fits, true AS note_fits "
            "FROM judged WHERE error IS NULL",
        },
        "SELECT judged.conv_id, judged.turn, error, preview, text_length, word_count, warning, level_fits, first_fits, note_fits "
        "FROM judged LEFT JOIN fine ON judged.conv_id = fine.conv_id AND judged.turn = fine.turn",
    ),
    "detect_batch": _sql(TURNS, f"SELECT conv_id, turn, {_preview(50)} AS preview, true AS known, true AS in_range FROM turns"),
    "save_load_model": _sql(TURNS, "SELECT conv_id, turn, true AS same FROM turns"),
    "stream_detect": _sql(TURNS, "SELECT conv_id, turn, true AS same FROM turns"),
    "suite_eval": _sql(
        CORPUS, "SELECT text, language AS expected, NULL::VARCHAR AS error, true AS alternatives_fit FROM corpus"
    ),
    "extract_paragraphs": _sql(PARAGRAPHS, "SELECT page_id, language, para_pos, text FROM paragraphs"),
    "page_sentences": _sql(PAGE_CLEAN, "SELECT DISTINCT page_id, language, text FROM page_clean"),
    "page_table": _sql(
        {
            **{**PAGES, **PAGE_CLEAN},
            "linked": "SELECT page_id, count(*) AS links FROM links GROUP BY page_id",
            "said": "SELECT page_id, count(DISTINCT text) AS sentences FROM page_clean GROUP BY page_id",
        },
        "SELECT p.page_id, coalesce(links, 0) AS links, coalesce(sentences, 0) AS sentences FROM pages p "
        "LEFT JOIN linked USING (page_id) LEFT JOIN said USING (page_id) WHERE html <> ''",
    ),
    "collect_sentences": _sql(COLLECTED, COLLECT),
    "build_corpus": _sql(
        {**COLLECTED, "corpus": COLLECT, "made": AUGMENTED["made"], "augmented": AUGMENTED["augmented"]},
        "SELECT language, text, is_base FROM augmented",
    ),
    "train_model": _sql(
        {
            "shares": f"SELECT CAST(round({MODEL.test_size} * {MODEL.max_per_class}) AS BIGINT) AS n",
            "classes": f"SELECT code AS label, n FROM (VALUES {_values(LANGUAGES)}) t(code, name, family, iso), shares",
        },
        "SELECT label, n AS support, true AS sound, CAST(NULL AS BOOLEAN) AS accurate FROM classes UNION ALL "
        "SELECT label, (SELECT CAST(sum(n) AS BIGINT) FROM classes), true, CASE WHEN label = 'accuracy' THEN true END "
        "FROM (VALUES ('accuracy'), ('macro avg'), ('weighted avg')) t(label)",
    ),
    "model_info": _sql(
        {"known": f"SELECT *, row_number() OVER () AS i FROM (VALUES {_values(LANGUAGES)}) t(code, name, family, iso)"},
        "SELECT string_agg(name, ',' ORDER BY i) AS languages, string_agg(code, ',' ORDER BY i) AS language_codes, "
        f"string_agg(DISTINCT family, ',' ORDER BY family) AS language_families, {MODEL.max_features}::BIGINT AS features, "
        "'CalibratedRandomForest' AS model_type FROM known",
    ),
}
