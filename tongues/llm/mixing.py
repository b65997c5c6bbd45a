"""Mixing to target weights with soft membership: posteriors of domains, then document rates by least squares."""

from __future__ import annotations

import logging
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tongues.llm.linear import Model, Settings, fit
from tongues.llm.sampling import smallest
from tongues.sources.scratch import stored

#: The domains, and the share of all tokens that each is to have after mixing. Clean documents have a little probability
#: of the other domains, and none of them is given up for a share: where it cannot be met otherwise it is not met.
DOMAINS = ("clean", "junk", "toxic")
TARGETS = {"clean": 0.95, "junk": 0.05, "toxic": 0.0}
#: Labelled documents per domain that the classifier is fitted on.
PER_DOMAIN = 800
#: Least rate of documents whose best posterior is the first domain, so that none of them is lost.
LEAST = 1.0
#: Tokens aimed at, as a multiple of what the first domain has divided by its target: the first
#: domain's documents then have rates of about this much.
HEADROOM = 1.1
BUCKETS = 1 << 15
#: The penalties leave some hundred words and signs of weight in the model.
SETTINGS = Settings(alpha=0.2, l1=12.0, l2=0.01, epochs=8)
#: Weight of staying near rate one, which makes the solution unique; the projected gradient that ends the steps, as a share of
#: a domain's tokens; and passes after which they end in any case, with a warning.
RIDGE, FLAT, STEPS = 1e-4, 1e-9, 200
_LOG = logging.getLogger(__name__)
_TOKEN = re.compile(rb"[a-z\x80-\xff]+|[.,;:]|[^a-z\x80-\xff\s0-9.,;:]+")


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the words and of the runs of signs in the whole text, each with weight one."""
    found = {zlib.crc32(word) % BUCKETS for word in set(_TOKEN.findall(text.encode().lower()))}
    return np.fromiter(found, np.int64, len(found)), np.ones(len(found))


def labelled_domains(labels: DataFrame) -> DataFrame:
    """``doc_id, domain`` of the labelled documents: toxic if any label says so, else junk if any says poor quality."""
    known = labels.filter(F.col("doc_id").isNotNull() & (F.col("quality").isNotNull() | F.col("toxic").isNotNull()))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "junk").otherwise("clean")
    return known.select("doc_id", domain.alias("domain"))


def train_domains(docs: DataFrame, labels: DataFrame, per_domain: int = PER_DOMAIN, settings: Settings = SETTINGS) -> Model:
    """A classifier fitted on the labelled documents with the smallest hashes, ``per_domain`` of each domain at most.

    The sample is drawn from the narrow label table; its size bounds the broadcast with which
    the texts are found. As the sample favours rare domains, the intercepts are moved from its shares to those among all
    labelled documents. Without labelled texts every document has equal posteriors.
    """
    known = labelled_domains(labels)
    counts = {r["domain"]: r["count"] for r in known.groupBy("domain").count().collect()}
    chosen = smallest(known.withColumn("h", F.xxhash64("doc_id")), "domain", ["h", "doc_id"], per_domain).drop("rank")
    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
    # a repeated doc_id may bring several texts: the bound holds for texts as well
    texts = smallest(texts.withColumn("t", F.xxhash64("text")), "domain", ["h", "t"], per_domain)
    sample = [(r["domain"], r["text"]) for r in texts.sort("domain", "rank").collect()]
    if not sample:
        return Model(list(DOMAINS), np.zeros((BUCKETS + 1, len(DOMAINS))), np.ones(BUCKETS))
    model = fit([features(t) for _, t in sample], [DOMAINS.index(d) for d, _ in sample], list(DOMAINS), np.ones(BUCKETS), settings)
    shares = np.array([sum(d == name for d, _ in sample) for name in DOMAINS]) / len(sample)
    priors = np.array([counts.get(d, 0) for d in DOMAINS]) / sum(counts.values())
    model.weights[-1] += model.temperature * np.where(shares > 0, np.log(np.maximum(priors, 1e-9) / np.maximum(shares, 1e-9)), -30.0)
    return model


def posteriors(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, twin, tokens, p``: words of the whole text and the probability of each domain.

    ``twin`` is a hash of the text. Null and empty texts have no tokens and the model's view of an empty text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            tokens, found = [], []
            for value in batch.column(2):
                text = value.as_py() or ""
                tokens.append(len(text.split()))
                found.append(m.probabilities(features(text)))
            p = pa.array(np.array(found).ravel() if found else np.empty(0))
            offsets = pa.array(np.arange(0, len(found) * len(DOMAINS) + 1, len(DOMAINS)), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(tokens, pa.int64()), pa.ListArray.from_arrays(offsets, p)], ["doc_id", "twin", "tokens", "p"])

    schema = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string("twin long, tokens long, p array<double>").fields])
    return docs.select("doc_id", F.xxhash64("text").alias("twin"), "text").mapInArrow(run, schema)


@dataclass
class Rates:
    """Document rates as three numbers: ``pull`` for each domain. They depend on the posteriors alone."""

    pull: np.ndarray
    totals: np.ndarray
    wanted: np.ndarray
    reached: np.ndarray
    least: float = 0.0
    passes: int = 0
    gradient: float = 0.0

    def at(self, p: np.ndarray) -> np.ndarray:
        """Rates of the documents with posteriors ``p``, one row each."""
        return np.maximum(np.where((p[:, :1] >= p).all(axis=1), self.least, 0.0), 1.0 - p @ self.pull)

    def column(self, p: str = "p") -> Column:
        """The same as an expression over an array of posteriors."""
        return F.greatest(_floor(p, self.least), 1.0 - _product(p, self.pull))

    def shares(self) -> str:
        """Shares of all tokens that were wanted and reached."""
        both = [x / x.sum() if x.sum() > 0 else x for x in (self.wanted, self.reached)]
        return ", ".join(f"{d}: wanted {a:.4f}, reached {b:.4f}" for d, a, b in zip(DOMAINS, *both))


def _product(p: str, pull: np.ndarray) -> Column:
    return reduce(Column.__add__, [F.col(p)[i] * float(x) for i, x in enumerate(pull)])


def _floor(p: str, least: float) -> Column:
    """``least`` for documents whose best posterior is the first domain's, and zero for the others."""
    return F.when(reduce(Column.__and__, [F.col(p)[0] >= F.col(p)[i] for i in range(len(DOMAINS))]), F.lit(float(least))).otherwise(0.0)


def _pass(rows: DataFrame, pull: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, float, float]:
    """At the rates of ``pull``: expected tokens by domain, the Gram matrix of the posteriors of documents that are not at their bound,
    the integral of the rates along the pull, and all tokens. One pass over narrow rows, which are added up where they are read."""
    width, tokens = len(DOMAINS), F.col("tokens").cast("double")
    marked = rows.select(tokens.alias("t"), "p", _floor("p", least).alias("f"), _product("p", pull).alias("u"))
    p, free = [F.col("p")[i] for i in range(width)], 1.0 - F.col("u") > F.col("f")
    weight = F.when(free, F.col("t")).otherwise(0.0)
    rate = F.greatest("f", 1.0 - F.col("u"))
    # the integral of the rate from 0 to u, where it is 1 - u down to the bound, and the bound from there on
    edge = 1.0 - F.col("f")
    area = F.when(free, F.col("u") - F.col("u") * F.col("u") / 2).otherwise(edge - edge * edge / 2 + F.col("f") * (F.col("u") - edge))
    sums = [F.sum(F.col("t") * rate * x) for x in p] + [F.sum(weight * p[i] * p[j]) for i in range(width) for j in range(i, width)]
    found = [x or 0.0 for x in marked.agg(*[c.alias(f"s{i}") for i, c in enumerate([*sums, F.sum(F.col("t") * area), F.sum("t")])]).first()]
    gram = np.zeros((width, width))
    gram[np.triu_indices(width)] = found[width:-2]
    return np.array(found[:width]), gram + np.triu(gram, 1).T, found[-2], found[-1]


def fit_rates(rows: DataFrame, targets: dict[str, float], headroom: float = HEADROOM, least: float = 0.0) -> Rates:
    """Nonnegative rates, of ``least`` or more for documents that are best in the first domain, whose expected tokens by domain match the targets, by projected gradient.

    ``rows`` has ``tokens`` and ``p``. Minimised is half the squared error of each domain's expected tokens, divided by what the domain has
    now, plus ``RIDGE`` times half the squared distance of the rates from one, weighted by tokens. The gradient of a document is the same function of its posteriors
    for all documents, so every iterate is a rate of one less the posteriors' product with a pull, projected onto the bound. A step
    has two metrics: documents at their bound that the gradient presses on stay there, and the others move along the gradient in the metric of their own Hessian, which
    the Gram matrix of their posteriors, three by three, gives; it is halved until the objective's dual falls. So a step is one pass, and nothing is replayed.
    Steps go on until the projected gradient is small; ``STEPS`` without that are warned of. Where the bound forbids the
    targets, the error that remains is the smallest. A domain without tokens is left out; with no tokens at all every rate is one.
    """
    width = len(DOMAINS)
    pull, zero = np.zeros(width), np.zeros(width)
    now, _, _, total = _pass(rows, zero, 0.0)
    share = np.array([targets.get(d, 0.0) for d in DOMAINS])
    if total <= 0 or share[0] <= 0 or now[0] <= 0:
        return Rates(zero, now, now, now, 0.0 if total <= 0 else least, 1)
    wanted = headroom * now[0] / share[0] * share
    there = now > 0
    scale = RIDGE * np.where(there, now, 1.0)
    passes = 1

    def look(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, np.ndarray]:
        nonlocal passes
        passes += 1
        reached, gram, area, _ = _pass(rows, at, least)
        slope = np.where(there, reached - wanted - scale * at, 0.0)
        return reached, gram, float(scale @ (at * at) / 2 + wanted @ at - area), slope

    reached, gram, height, slope = look(pull)
    while True:
        gradient = float(np.abs(slope[there] / now[there]).max())
        if gradient <= FLAT or passes >= STEPS:
            break
        step = np.zeros(width)
        step[there] = np.linalg.solve((gram + np.diag(scale))[np.ix_(there, there)], slope[there])
        length = 1.0
        while True:
            ahead = look(pull + length * step)
            if ahead[2] <= height - 1e-4 * length * float(slope @ step) or length < 1e-6 or passes >= STEPS:
                break
            length /= 2
        pull = pull + length * step
        reached, gram, height, slope = ahead
    found = Rates(pull, now, wanted, reached, least, passes, gradient)
    if gradient > FLAT:
        _LOG.warning("mixing: %d steps did not settle the rates, whose projected gradient is still %.2g; %s", passes, gradient, found.shares())
    _LOG.info("mixing: %s", found.shares())
    return found


@dataclass
class Mixture:
    """Documents with their rates, and what the rates were to reach and reach."""

    documents: DataFrame
    rates: Rates

    def totals(self) -> DataFrame:
        """``domain, wanted, reached``: expected tokens, one row for each domain."""
        rows = [(d, float(a), float(b)) for d, a, b in zip(DOMAINS, self.rates.wanted, self.rates.reached)]
        return self.documents.sparkSession.createDataFrame(rows, "domain string, wanted double, reached double")


def mixture(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> Mixture:
    """``doc_id, twin, tokens``, the posteriors ``p_*``, ``rate`` and ``copies`` of every row of ``docs``, with the totals wanted and reached.

    ``copies`` is the rate rounded up or down by a hash of id and text, so that it equals the rate on average;
    rounding is repeatable. Documents that are clean by their best posterior have a rate of ``LEAST`` or more, whatever the targets: this is a bounded
    least-squares problem, and its totals are as near to the targets as that permits.
    """
    model = train_domains(docs, labels)
    rows = stored(posteriors(docs, model), "posteriors")
    rates = fit_rates(rows, targets or TARGETS, least=LEAST)
    chance = F.pmod(F.xxhash64("doc_id", "twin"), F.lit(1 << 20)) / float(1 << 20)
    split = [F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(DOMAINS)]
    rated = rows.select("doc_id", "twin", "tokens", *split, rates.column().alias("rate"))
    return Mixture(rated.withColumn("copies", F.floor(F.col("rate") + chance).cast("long")), rates)


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """The documents of ``mixture`` with the ``domain`` of their best posterior, and its tokens ``wanted`` and ``reached`` by all documents."""
    found = mixture(docs, labels, targets)
    posterior = [F.col(f"p_{d}") for d in DOMAINS]
    best = F.array_position(F.array(*posterior), F.greatest(*posterior)).cast("int") - 1  # ties to the first
    names = {"domain": DOMAINS, "wanted": found.rates.wanted.tolist(), "reached": found.rates.reached.tolist()}
    return found.documents.withColumns({k: F.get(F.lit(list(v)), best) for k, v in names.items()})


def mixed_documents(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as its ``copies`` say, in the columns of ``docs``."""
    copies = mixture(docs, labels, targets).documents.groupBy("doc_id", "twin").agg(F.max("copies").alias("_copies"))
    copies = copies.filter("_copies > 0").toDF("_id", "_text", "_copies")
    marked = docs.withColumn("_twin", F.xxhash64("text"))
    joined = marked.join(copies, marked["doc_id"].eqNullSafe(copies["_id"]) & (marked["_twin"] == copies["_text"]))
    again = joined.withColumn("_again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    return again.select(*[again[c] for c in docs.columns])
