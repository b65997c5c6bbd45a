"""Every operator as a query over the parquet tables: ``name -> f(spark, directory)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tongues.config import TopUpConfig, TrainConfig
from tongues.functions import report as R
from tongues.functions import stats as S
from tongues.functions.text import words
from tongues.model.detector import Detector, present
from tongues.model.forest import train_forest as fit_forest
from tongues.model.vectors import feature_matrix as to_matrix
from tongues.model.vectors import feature_vectors, tfidf_vectors
from tongues.operators import evaluate as E
from tongues.operators import links as L
from tongues.operators import ngrams as N
from tongues.operators import pages as O
from tongues.operators import paragraphs as P
from tongues.operators import sampling as B
from tongues.operators import sentences as C
from tongues.operators import sets as U
from tongues.operators import summaries as Z
from tongues.operators.augment import augment as augmented
from tongues.operators.frequent import frequent_terms
from tongues.operators.augment import variants_of
from tongues.plans import training as T
from tongues.plans.build import build_corpus, collect_sentences, page_table
from tongues.sources import dims
from tongues.sources.corpus import read_corpus, read_seed, write_corpus, write_stats
from tongues.sources.known import KnownCorpus
from tongues.sources.scratch import cut_lineage, scratch
from tongues.sources.tables import read_documents, read_pages, spread, table, text_tasks, with_url_language
from tongues.streaming.corpora import CappedCorpus, PageCorpus
from tongues.streaming.jobs import read_available, run_available, stream_detect, stream_new_sentences

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the queries; the SQL checks use the same values.
PATTERNS = {"english": ("the", "st"), "german": ("der", "ung"), "spanish": ("la", "ci"), "french": ("le", "eau")}
LINKS_PER_PAGE = 4
CAP = 500
TOPUP = TopUpConfig(min_total=10**12, min_per_language=1000, limit=1500)
MODEL = TrainConfig()
TURN = ("conv_id", "turn")


def query(f: Query) -> Query:
    QUERIES[f.__name__.removeprefix("q_")] = f
    return f


def pieces(spark, d):
    return C.split_sentences(read_documents(spark, d))


def normal(spark, d):
    return C.normalize_ws(pieces(spark, d))


def clean(spark, d):
    return C.document_sentences(read_documents(spark, d))


def corpus(spark, d):
    return U.distinct_sentences(clean(spark, d))


def augmented_corpus(spark, d):
    return augmented(corpus(spark, d), text_tasks(table(spark, d, "documents")))


def turns(spark, d):
    rows = table(spark, d, "conversations").select(*TURN, "text").filter(F.col("text").isNotNull())
    return spread(rows, *TURN)


def benchmark_sentences(spark, d):
    rows = table(spark, d, "benchmark").select("item_id", F.lit("english").alias("language"), "text")
    return C.document_sentences(rows)


def labelled_sentences(spark, d):
    graded = table(spark, d, "labels").select("doc_id")
    return U.distinct_sentences(C.document_sentences(read_documents(spark, d).join(graded, "doc_id", "left_semi")))


# Sources and sinks


@query
def q_read_pages(spark, d):
    return read_pages(spark, d).select("page_id", "url", F.length("html").cast("long").alias("html_length"))


@query
def q_read_write_corpus(spark, d):
    out = scratch(spark, "corpus")
    write_corpus(corpus(spark, d), out)
    return read_corpus(spark, out)


@query
def q_write_stats(spark, d):
    out = scratch(spark, "stats")
    write_stats(corpus(spark, d), out)
    read = spark.read.schema("total_sentences long, languages map<string,long>, timestamp double, date string").json(out)
    return read.select("total_sentences", F.explode("languages").alias("language", "sentences"))


@query
def q_language_lookup(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    named = docs.join(F.broadcast(dims.language_dim(spark).select("code", F.col("iso").alias("lang"))), "lang", "left")
    code = F.when(F.col("lang").isin("en", "fr"), F.col("code")).otherwise(F.col("lang"))
    return dims.language_lookup(named.select("doc_id", code.alias("language")))


# Links


@query
def q_page_links(spark, d):
    return L.page_links(read_pages(spark, d))


def resolved(spark, d):
    pages = with_url_language(read_pages(spark, d)).select("page_id", "language", "url", "html")
    return L.resolve_links(L.page_links(pages, "page_id", "language", "url"))


@query
def q_resolve_links(spark, d):
    return resolved(spark, d).select("page_id", "pos", "target")


def articles(spark, d):
    return L.article_links(resolved(spark, d), dims.link_rule_dim(spark, PATTERNS))


@query
def q_article_links(spark, d):
    return articles(spark, d).select("page_id", "pos", "target")


def linking_pages(spark, d):
    """Records of the pages with the addresses of their article links as an array."""
    pages = with_url_language(read_pages(spark, d)).filter(F.col("html").rlike(r"(?i)<a[\s/]"))
    records = O.page_records(pages, keep=("page_id", "language", "url"))
    return L.article_targets(records, dims.link_rule_dim(spark, PATTERNS))


@query
def q_top_links(spark, d):
    return L.first_targets(linking_pages(spark, d), limit=LINKS_PER_PAGE)


def page_sources(spark, d):
    """Every page is a start page of its own language, in page order."""
    return with_url_language(read_pages(spark, d)).select("language", F.col("page_id").alias("source_rank"), "url")


def candidates(spark, d):
    linking = linking_pages(spark, d).withColumnRenamed("page_id", "source_rank")
    best = L.first_targets(linking, "language", "source_rank", limit=LINKS_PER_PAGE)
    return L.page_candidates(page_sources(spark, d), best)


@query
def q_page_candidates(spark, d):
    return candidates(spark, d)


@query
def q_page_frontier(spark, d):
    return L.page_frontier(candidates(spark, d), read_pages(spark, d))


# Paragraphs and sentences


@query
def q_extract_paragraphs(spark, d):
    return P.extract_paragraphs(with_url_language(read_pages(spark, d)), dims.rule_dim(spark))


@query
def q_page_sentences(spark, d):
    rows = C.clean_sentences(P.page_sentences(with_url_language(read_pages(spark, d)), dims.rule_dim(spark)))
    return rows.select("page_id", "language", "text").distinct()


@query
def q_page_table(spark, d):
    """Links of every page, and different clean sentences that the rule of its own language finds in it."""
    records, bits = page_table(read_pages(spark, d), dims.rule_dim(spark))
    found = O.record_sentences(with_url_language(records), bits).distinct().groupBy("page_id").agg(F.count("*").alias("sentences"))
    return records.select("page_id", F.size("links").cast("long").alias("links")).join(found, "page_id", "left").na.fill(0, ["sentences"])


@query
def q_collect_sentences(spark, d):
    return collect_sentences(
        read_pages(spark, d), page_sources(spark, d), link_rules=dims.link_rule_dim(spark, PATTERNS)
    )


@query
def q_build_corpus(spark, d):
    return build_corpus(
        spark, "hybrid", read_pages(spark, d), page_sources(spark, d), link_rules=dims.link_rule_dim(spark, PATTERNS)
    )


@query
def q_split_sentences(spark, d):
    return pieces(spark, d)


@query
def q_normalize_ws(spark, d):
    return normal(spark, d).select("doc_id", "pos", "text")


@query
def q_filter_length(spark, d):
    return C.filter_length(normal(spark, d)).select("doc_id", "pos", "text")


@query
def q_filter_min_words(spark, d):
    return C.filter_min_words(normal(spark, d)).select("doc_id", "pos", "text")


@query
def q_filter_digit_ratio(spark, d):
    return C.filter_digit_ratio(normal(spark, d)).select("doc_id", "pos", "text")


@query
def q_filter_url(spark, d):
    return C.filter_url(normal(spark, d)).select("doc_id", "pos", "text")


@query
def q_filter_email(spark, d):
    return C.filter_email(normal(spark, d)).select("doc_id", "pos", "text")


@query
def q_capitalize_first(spark, d):
    return C.capitalize_first(normal(spark, d)).select("doc_id", "pos", "text")


@query
def q_clean_sentences(spark, d):
    return clean(spark, d)


# Sets


@query
def q_distinct_sentences(spark, d):
    return corpus(spark, d)


@query
def q_new_sentences(spark, d):
    return U.new_sentences(clean(spark, d), benchmark_sentences(spark, d), ["text"])


@query
def q_known_corpus(spark, d):
    """``new_sentences`` against a corpus that is stored in buckets of its texts."""
    known = KnownCorpus(spark, f"{scratch(spark, 'known')}/corpus", on=("text",))
    known.add(benchmark_sentences(spark, d).select("language", "text"))
    return known.unknown(clean(spark, d))


@query
def q_capped_corpus(spark, d):
    return U.capped_corpus(clean(spark, d), CAP, "doc_id")


@query
def q_hybrid_topup(spark, d):
    return U.hybrid_topup(labelled_sentences(spark, d), clean(spark, d), TOPUP, tuple(PATTERNS))


@query
def q_union_corpora(spark, d):
    return U.union_corpora(clean(spark, d), benchmark_sentences(spark, d))


# Augmentation


@query
def q_aug_case(spark, d):
    return variants_of(corpus(spark, d), "case")


@query
def q_aug_punct(spark, d):
    return variants_of(corpus(spark, d), "punctuation")


@query
def q_aug_prefix(spark, d):
    return variants_of(corpus(spark, d), "prefix")


@query
def q_aug_spacing(spark, d):
    return variants_of(corpus(spark, d), "spacing")


@query
def q_aug_typo(spark, d):
    return variants_of(corpus(spark, d), "typo")


@query
def q_augment(spark, d):
    return augmented_corpus(spark, d)


# Summaries


@query
def q_corpus_counts(spark, d):
    return Z.corpus_counts(corpus(spark, d))


@query
def q_augment_counts(spark, d):
    return Z.augment_counts(augmented_corpus(spark, d))


@query
def q_length_stats(spark, d):
    return Z.length_stats(augmented_corpus(spark, d)).withColumn("avg_length", F.round("avg_length", 6))


@query
def q_load_summary(spark, d):
    summary = Z.load_summary(corpus(spark, d))
    return summary.select(
        "total", F.explode(F.arrays_zip("per_label", "names")).alias("e")
    ).select("total", F.col("e.per_label.label").alias("language"), F.col("e.per_label.n").alias("sentences"), F.col("e.names").alias("name"))


# Sampling


@query
def q_balance(spark, d):
    return B.balance(corpus(spark, d))


@query
def q_stratified_split(spark, d):
    return B.stratified_split(corpus(spark, d))


@query
def q_stratified_folds(spark, d):
    return B.stratified_folds(corpus(spark, d))


@query
def q_copy_folds(spark, d):
    """Folds of sentences that repeat within and across documents: how many copies of each are in each fold."""
    folded = B.stratified_folds(clean(spark, d).select("doc_id", "pos", "language", "text"))
    return folded.groupBy("language", "text", "fold").agg(F.count("*").alias("copies"))


@query
def q_class_weights(spark, d):
    return B.class_weights(corpus(spark, d)).withColumn("weight", F.round("weight", 6))


@query
def q_split_summary(spark, d):
    return B.split_summary(B.stratified_split(corpus(spark, d)), len(S.ALL))


# Features


def _features(df, features):
    columns = features(F.col("text"))
    return df.select("doc_id", *[
        (F.round(value, 6) if name.endswith(("_ratio", "_length")) else value).alias(name) for name, value in columns.items()
    ])


@query
def q_feat_basic(spark, d):
    return _features(read_documents(spark, d), S.basic_features)


@query
def q_feat_chars(spark, d):
    return _features(read_documents(spark, d), S.char_features)


@query
def q_feat_words(spark, d):
    return _features(read_documents(spark, d), S.word_features)


@query
def q_feat_vector(spark, d):
    vectors = feature_vectors(read_documents(spark, d)).select("doc_id", vector_to_array("stats").alias("v"))
    return vectors.select("doc_id", *[F.round(F.get("v", F.lit(i)), 6).alias(name) for i, name in enumerate(S.ALL)])


@query
def q_char_ngrams(spark, d):
    return N.term_counts(read_documents(spark, d))


@query
def q_term_freq(spark, d):
    return N.term_freq(turns(spark, d), TURN)


@query
def q_doc_freq(spark, d):
    return N.text_frequencies(read_documents(spark, d))


@query
def q_vocabulary(spark, d):
    return frequent_terms(read_documents(spark, d).select("text"))


@query
def q_idf(spark, d):
    docs = read_documents(spark, d)
    return N.idf(N.text_frequencies(docs), docs).select("term", F.round("idf", 6).alias("idf"))


def turn_terms(spark, d):
    texts = turns(spark, d)
    return N.idf(N.vocabulary(N.doc_freq(N.term_freq(texts, TURN)), texts), texts)


@query
def q_tfidf(spark, d):
    weights = N.tfidf_rows(turns(spark, d), turn_vocabulary(spark, d), TURN)
    return weights.withColumn("weight", F.round("weight", 6))


def turn_vocabulary(spark, d):
    return [(r["term"], r["idf"]) for r in turn_terms(spark, d).orderBy("term_index").collect()]


def _long(df, vector, position, value):
    entries = df.select(*TURN, F.posexplode(vector_to_array(vector)))
    return entries.filter(F.col("col") != 0).select(
        *TURN, F.col("pos").cast("long").alias(position), F.round("col", 6).alias(value)
    )


@query
def q_tfidf_vector(spark, d):
    return _long(tfidf_vectors(turns(spark, d), turn_vocabulary(spark, d)), "tfidf", "term_index", "weight")


@query
def q_feature_matrix(spark, d):
    return _long(to_matrix(turns(spark, d), turn_vocabulary(spark, d)), "features", "feature", "value")


# Detection parts, over probabilities from word counts


def stand_in(df):
    """Smoothed shares of the five word patterns, in code order: a predictor SQL can repeat."""
    hits = S.word_features(F.col("text"))
    by_code = {
        "english": "the_english", "french": "et_french", "german": "und_german",
        "italian": "e_italian", "spanish": "y_spanish",
    }
    counts = [hits[by_code[code]] + 1 for code in STAND_IN]
    total = sum(counts[1:], counts[0])
    return df.withColumn("probabilities", F.array(*[c / total for c in counts]))


STAND_IN = ("english", "french", "german", "italian", "spanish")


def stand_in_detections(spark, d, top_n=2):
    return present(stand_in(turns(spark, d)), STAND_IN, top_n=top_n)


@query
def q_detect_guard(spark, d):
    word = table(spark, d, "benchmark").select("item_id", F.explode(words(F.col("text"))).alias("word"))
    return word.select("item_id", R.detect_guard(F.col("word")).alias("error")).groupBy("item_id", "error").agg(
        F.count("*").alias("n")
    )


@query
def q_top_n(spark, d):
    top = stand_in_detections(spark, d, 3).select(*TURN, F.posexplode("top_predictions"))
    return top.select(
        *TURN, F.col("pos").cast("long").alias("rank"), "col.language", "col.code",
        F.round("col.confidence", 6).alias("confidence"), "col.family",
    )


@query
def q_confidence_level(spark, d):
    return stand_in_detections(spark, d).select(*TURN, F.round("confidence", 6).alias("confidence"), "confidence_level")


@query
def q_text_preview(spark, d):
    return pieces(spark, d).select(
        "doc_id", "pos", R.text_preview(F.col("text"), 80).alias("single"), R.text_preview(F.col("text"), 50).alias("batch")
    )


@query
def q_short_warning(spark, d):
    return pieces(spark, d).select("doc_id", "pos", R.short_warning(F.col("text")).alias("warning"))


@query
def q_mixed_note(spark, d):
    return stand_in_detections(spark, d).select(*TURN, "language_code", "note")


def stand_in_pairs(spark, d):
    best = R.top_predictions(F.col("probabilities"), STAND_IN, 1, {}, {})
    return E.pair_counts(stand_in(read_documents(spark, d)).withColumn("predicted", F.get(best, F.lit(0))["code"]))


@query
def q_accuracy(spark, d):
    return E.accuracy(stand_in_pairs(spark, d)).withColumn("accuracy", F.round("accuracy", 6))


@query
def q_class_report(spark, d):
    rounded = [F.round(m, 6).alias(m) for m in ("precision", "recall", "f1")]
    return E.class_report(stand_in_pairs(spark, d)).select("label", *rounded, "support")


@query
def q_confusion_matrix(spark, d):
    return E.confusion_matrix(stand_in_pairs(spark, d))


@query
def q_confusion_wide(spark, d):
    return E.confusion_wide(stand_in_pairs(spark, d), list(STAND_IN))


# The model


_MODELS: dict[tuple[str, str], T.Training] = {}


def trained(spark, d) -> T.Training:
    """One training run per application and directory, shared by the model queries."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _MODELS:
        seed = augmented(read_seed(spark)).select("language", "text")
        # sentences repeat here: training makes its sample distinct without a shuffle of all of them
        _MODELS[key] = T.train_model(clean(spark, d).select("language", "text").unionByName(seed), MODEL)
    return _MODELS[key]


@query
def q_train_forest(spark, d):
    """Rows of the split on which a forest is fitted and judged, and whether it gets 95 % of the test rows right."""
    detector = trained(spark, d).detector
    rows = cut_lineage(detector.features(B.stratified_split(cut_lineage(B.balance(corpus(spark, d))))))
    classes = [r["language"] for r in rows.select("language").distinct().sort("language").collect()]
    forest = fit_forest(rows.filter(~F.col("is_test")).select("language", "features"), classes, MODEL)
    best = R.top_predictions(vector_to_array("_p"), classes, 1, {}, {})
    scored = forest.transform(rows.filter("is_test")).withColumn("predicted", F.get(best, F.lit(0))["code"])
    accurate = E.accuracy(E.pair_counts(scored)).select((F.col("accuracy") >= 0.95).alias("accurate")).scalar()
    return rows.groupBy("language", "is_test").agg(F.count("*").alias("n")).withColumn("accurate", accurate)


@query
def q_calibrate(spark, d):
    """A probability for every class of every example; those of one example add up to one."""
    scored = trained(spark, d).detector.score(B.balance(corpus(spark, d)))
    whole = F.abs(F.aggregate("probabilities", F.lit(0.0), lambda a, x: a + x) - 1) < 1e-9
    each = scored.select("language", "text", whole.alias("whole"), F.posexplode("probabilities").alias("class_index", "p"))
    return each.select("language", "text", F.col("class_index").cast("long"), "whole", F.col("p").between(0, 1).alias("in_range"))


@query
def q_train_model(spark, d):
    """Held-out rows of each language and of all, whether the report's shares are sound, and whether it gets 95 % right."""
    report = trained(spark, d).report()
    sound = F.lit(True)
    for share in ("precision", "recall", "f1"):
        sound = sound & (F.col(share).isNull() | F.col(share).between(0, 1))
    overall = F.when(F.col("label") == "accuracy", F.col("f1") >= 0.95)
    return report.select("label", "support", sound.alias("sound"), overall.alias("accurate"))


@query
def q_detect(spark, d):
    """What the text alone decides of a detection, and whether the rest of each row fits together."""
    found = trained(spark, d).detector.detect(turns(spark, d))
    fine = F.col("error").isNull()
    first = F.get("top_predictions", F.lit(0))
    return found.select(
        *TURN, "error", F.col("text").alias("preview"), "text_length", "word_count", "warning",
        F.when(fine, F.col("confidence_level") == R.confidence_level(F.col("confidence"))).alias("level_fits"),
        F.when(fine, (first["code"] == F.col("language_code")) & (first["confidence"] == F.col("confidence"))).alias("first_fits"),
        F.when(fine, F.col("note").eqNullSafe(R.mixed_note(F.col("top_predictions")))).alias("note_fits"),
    )


@query
def q_detect_batch(spark, d):
    detector = trained(spark, d).detector
    found = detector.detect_batch(turns(spark, d))
    known, right = F.col("language_code").isin(*detector.classes), (F.col("confidence") > 0) & (F.col("confidence") <= 100)
    return found.select(*TURN, F.col("text").alias("preview"), known.alias("known"), right.alias("in_range"))


def _same(one, other, *columns):
    """Whether two results agree on ``columns``, row by row."""
    other = other.select(*TURN, *[F.col(c).alias(f"_{c}") for c in columns])
    agree = F.lit(True)
    for c in columns:
        close = F.abs(F.col(c) - F.col(f"_{c}")) < 1e-9 if c == "confidence" else F.lit(False)
        agree = agree & (F.col(c).eqNullSafe(F.col(f"_{c}")) | F.coalesce(close, F.lit(False)))
    return one.join(other, list(TURN), "full").select(*TURN, agree.alias("same"))


@query
def q_save_load_model(spark, d):
    """Whether a model that was saved and loaded gives what the one in memory gives."""
    out = scratch(spark, "model")
    detector = trained(spark, d).detector
    detector.save(spark, out)
    again = Detector.load(spark, out).detect_batch(turns(spark, d))
    return _same(detector.detect_batch(turns(spark, d)), again, "language_code", "confidence", "text")


@query
def q_model_info(spark, d):
    """What the model says about itself; lists are joined by commas."""
    info = trained(spark, d).detector.info(spark)
    return info.select(*[F.array_join(c, ",").alias(c) if kind.startswith("array") else F.col(c) for c, kind in info.dtypes])


def suite(spark, d):
    """Sentences with their language, in many tasks: scoring takes long for few bytes, and Spark would merge partitions by their bytes."""
    rows = corpus(spark, d).select("text", F.col("language").alias("expected"))
    return rows.repartition(text_tasks(table(spark, d, "documents")), "text")


@query
def q_suite_eval(spark, d):
    found = T.suite_eval(trained(spark, d).detector, suite(spark, d))
    listed = F.col("correct") == F.col("alternatives").isNull()
    return found.select("text", "expected", "error", listed.alias("alternatives_fit"))


# Streams


def _stream(spark, d, name):
    """The table as a stream; a pattern takes one file as well as a folder of files, a plain path folders alone."""
    schema = table(spark, d, name).schema
    return spark.readStream.schema(schema).parquet(f"{d.rstrip('/')}/{name}.parque[t]")


@query
def q_stream_new_sentences(spark, d):
    out = scratch(spark, "stream")
    documents = dims.with_language(_stream(spark, d, "documents").filter(F.col("text").isNotNull()), "lang")
    fresh = stream_new_sentences(documents, tasks=spark.sparkContext.defaultParallelism)
    run_available(fresh, f"{out}/rows", f"{out}/checkpoint")
    return read_available(spark, f"{out}/rows", fresh.schema)


@query
def q_stream_page_sentences(spark, d):
    """New sentences of a stream of pages, of one snapshot for each address."""
    out = scratch(spark, "stream")
    found = PageCorpus(spark, f"{out}/corpus", dims.rule_dim(spark), tasks=spark.sparkContext.defaultParallelism)
    found.start(with_url_language(_stream(spark, d, "pages")), f"{out}/checkpoint")
    return found.read()


@query
def q_stream_capped_corpus(spark, d):
    """The capped corpus of documents that arrive in three parts, one after another."""
    out = scratch(spark, "stream")
    rows = clean(spark, d).select("doc_id", "language", "text")
    last = rows.agg(F.coalesce(F.max("doc_id"), F.lit(0))).first()[0]
    found = CappedCorpus(spark, f"{out}/corpus", CAP, "doc_id")
    for low, high in ((0, last // 40), (last // 40 + 1, last // 20), (last // 20 + 1, last)):
        rows.filter(F.col("doc_id").between(low, high)).write.mode("append").parquet(f"{out}/in")
        found.start(spark.readStream.schema(rows.schema).parquet(f"{out}/in"), f"{out}/checkpoint")
    return found.read()


@query
def q_stream_detect(spark, d):
    out = scratch(spark, "stream")
    texts = _stream(spark, d, "conversations").select(*TURN, "text").filter(F.col("text").isNotNull())
    detector = trained(spark, d).detector
    found = stream_detect(texts, detector)
    run_available(found, f"{out}/rows", f"{out}/checkpoint")
    return _same(read_available(spark, f"{out}/rows", found.schema), detector.detect(turns(spark, d)), "language_code", "confidence", "error", "text")
