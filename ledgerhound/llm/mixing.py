"""Mixing to target weights over soft domain memberships.

A naive Bayes classifier, trained on a labelled table, gives each document a posterior over the domains. Document rates
are then fitted so that the expected tokens of each domain, the sum over documents of rate * tokens * posterior, meet the targets:
least squares of the relative misses over rates not below a floor, by projected gradient with implicit steps. A step moves every rate along its
posteriors, by a multiplier for each domain, and cuts it off at the floor; the multipliers are the gradient at the point that the step reaches, not at the one it leaves, so a step
can be long and rare domains are no slower than common ones. They solve a small equation, by Newton's method with a line search: one aggregation over the documents a
time, which sends the domains' totals and the small Gram matrix of the rates that aren't cut off to the driver. The fit ends when the targets are met, or when
a step changes nothing: then the projected gradient is zero and no free rate can improve; the misses are returned and logged as a warning.
Posteriors and rates stay in Spark; everything is DataFrame functions.

The classifier is fitted on at most ``LABELLED`` labelled rows (smallest id hash) with hashed words in ``BUCKETS`` buckets; posteriors
read every word of every text. Documents without a word get the prior. Null text counts as empty; it has no tokens, so its rate
doesn't matter and stays 1. Domains without any expected token can't be met and are left out of the targets, which are scaled to
sum to one. With no labelled row all documents form one domain ``all``. Of two domains with one posterior, the one that sorts last is the document's domain. A step's
aggregate has a column for each pair of domains. Only doc_id and text are read, and all columns come back, so others can have any name. Repeated rows are documents like others, each with its own
rate; very long texts count by their words. An empty table gives no rows.
"""

from __future__ import annotations

import logging
import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, materialize, row_hash, table, text_rows
from .registry import register

BUCKETS = 1 << 14
LABELLED = 20_000
SMOOTHING = 1.0
#: Posteriors are softened: the log odds of a text are those of a text of this many words.
EFFECTIVE_WORDS = 20.0
TOLERANCE = 1e-4
#: How stiff a step is against its multipliers, relative to the largest target; less where a domain is rarer.
STIFFNESS = 1e-7
#: The queries' target: a domain's share of the tokens to this power (rare domains are seen more often).
TEMPERATURE = 0.7
#: The queries keep every document at least once.
LEAST_RATE = 1.0
#: Rates are returned to this many decimals; copies are dealt from whole rates.
RATE_DECIMALS = 3
SEED = 11


def word_counts(rows: DataFrame, *keys: str) -> DataFrame:
    """keys, bucket: a row for each word of each text, with its feature bucket."""
    words = F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[ \t\n\x0B\f\r]+"))
    bucket = F.pmod(F.xxhash64("w"), F.lit(BUCKETS)).cast("int")
    return rows.select(*keys, words.alias("w")).filter("w <> ''").select(*keys, bucket.alias("bucket"))


def labelled_rows(docs: DataFrame, labelled: DataFrame, limit: int = LABELLED) -> DataFrame:
    """(text, domain) of a bounded number of labelled documents; ``labelled``: (doc_id, domain), one domain for each id."""
    some = (labelled.filter("doc_id IS NOT NULL AND domain IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("l_id"))
            .agg(F.min(F.col("domain").cast("string")).alias("domain")).orderBy(F.xxhash64("l_id"), "l_id").limit(limit))
    rows = text_rows(docs)
    return rows.join(F.broadcast(some), F.col("doc_id") == F.col("l_id")).select("text", "domain")  # at most ``limit`` small rows


def train(docs: DataFrame, labelled: DataFrame, limit: int = LABELLED) -> tuple[list[str], DataFrame | None, list[float]]:
    """(domains, one row of log likelihoods for each bucket, log priors)."""
    rows = materialize(labelled_rows(docs, labelled, limit), "mix-labelled")
    sizes = {r.domain: r.n for r in rows.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``limit``
    domains = sorted(sizes)
    if not domains:
        return [], None, []
    each = [F.count(F.when(F.col("domain") == d, 1)).alias(f"c{i}") for i, d in enumerate(domains)]
    counts = materialize(word_counts(rows, "domain").groupBy("bucket").agg(*each), "mix-counts")
    totals = counts.agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(len(domains))]).first()
    liks = counts.select("bucket", *[F.log((F.col(f"c{i}") + SMOOTHING) / ((totals[i] or 0) + SMOOTHING * BUCKETS)).alias(f"l{i}") for i in range(len(domains))])
    everything = sum(sizes.values())
    unseen = [math.log(SMOOTHING / ((totals[i] or 0) + SMOOTHING * BUCKETS)) for i in range(len(domains))]
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    model = every.join(liks, "bucket", "left").select("bucket", *[F.coalesce(f"l{i}", F.lit(unseen[i])).alias(f"l{i}") for i in range(len(domains))])
    return domains, materialize(model, "mix-model"), [math.log(sizes[d] / everything) for d in domains]


def posteriors(docs: DataFrame, domains: list[str], model: DataFrame, priors: list[float]) -> DataFrame:
    """(doc_id, text_hash, nth, tokens, p0, p1, ...) of every row; nth numbers repeated rows."""
    rows = text_rows(docs).select("doc_id", "text", row_hash(F.col("text")).alias("text_hash"))
    d = range(len(domains))
    met = (word_counts(rows, "doc_id", "text_hash").join(F.broadcast(model), "bucket")  # BUCKETS rows
           .groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("words"), *[F.sum(f"l{i}").alias(f"s{i}") for i in d]))
    # Equal rows were summed together: repeated rows have the same words, so their mean is that of one of them.
    own = rows.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    both = own.join(met.withColumnsRenamed({"doc_id": "m_id", "text_hash": "m_hash"}),
                    F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("text_hash") == F.col("m_hash")), "left")
    tokens = F.coalesce(F.col("words") / F.col("copies"), F.lit(0.0))
    soft = F.least(tokens, F.lit(EFFECTIVE_WORDS)) / F.col("words")
    logit = [F.lit(priors[i]) + F.coalesce(F.col(f"s{i}") * soft, F.lit(0.0)) for i in d]
    top = F.greatest(*logit) if len(domains) > 1 else logit[0]
    scored = both.select("doc_id", "text_hash", "copies", tokens.alias("tokens"), *[F.exp(x - top).alias(f"e{i}") for i, x in enumerate(logit)])
    total = sum((F.col(f"e{i}") for i in d), F.lit(0.0))
    return (scored.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
            .select("doc_id", "text_hash", "nth", "tokens", *[(F.col(f"e{i}") / total).alias(f"p{i}") for i in d]))


def wanted_totals(have: list[float], domains: list[str], weights: dict[str, float] | None, temperature: float) -> tuple[list[float], list[float]] | None:
    """(targets, scales of the misses) for totals ``have``; None where no domain with tokens is wanted.

    The targets' total is the least that asks for no domain to shrink: rates then rise where a domain is short.
    """
    d = range(len(domains))
    wanted = weights or {x: (have[i] / (sum(have) or 1)) ** temperature for i, x in enumerate(domains)}
    share = [wanted.get(x, 0.0) if have[i] > 0 else 0.0 for i, x in enumerate(domains)]
    if sum(share) <= 0:
        return None
    share = [s / sum(share) for s in share]
    total = max(have[i] / share[i] for i in d if share[i] > 0)
    target = [s * total for s in share]
    return target, [max(t, h, 1e-9) for t, h in zip(target, have, strict=True)]


def fit_rates(members: DataFrame, domains: list[str], weights: dict[str, float] | None, temperature: float = TEMPERATURE,
              least: float = 0.0) -> tuple[DataFrame, dict]:
    """``members`` with a column rate; and the report: targets, totals, misses (relative, by domain), met and steps.

    ``least`` (not negative) bounds the rates from below: 0 lets documents go, 1 only repeats documents of short domains.
    """
    n, floor = len(domains), float(max(0.0, least))
    pairs = [(i, j) for i in range(n) for j in range(i, n)]

    def raw(pull: np.ndarray) -> Column:
        return sum((F.col(f"p{i}") * F.lit(float(x)) for i, x in enumerate(pull)), F.col("rate"))

    def moved(df: DataFrame, pull: np.ndarray) -> DataFrame:
        """Every rate moved along its posteriors and cut off at the floor."""
        return df.withColumn("rate", F.when(F.col("tokens") > 0, F.greatest(F.lit(floor), raw(pull))).otherwise(F.lit(1.0)))

    def look(df: DataFrame, pull: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The domains' totals after a move, and the Gram matrix of the documents that it doesn't cut off."""
        rows = df.select("tokens", *[f"p{i}" for i in range(n)], F.greatest(F.lit(floor), raw(pull)).alias("rate"),
                         F.when(raw(pull) >= floor, F.col("tokens")).otherwise(F.lit(0.0)).alias("free"))
        got = rows.agg(*[F.sum(F.col("rate") * F.col("tokens") * F.col(f"p{i}")) for i in range(n)],
                       *[F.sum(F.col("free") * F.col(f"p{i}") * F.col(f"p{j}")) for i, j in pairs]).first()
        gram = np.zeros((n, n))
        for (i, j), x in zip(pairs, got[n:], strict=True):
            gram[i, j] = gram[j, i] = x or 0.0
        return np.array([x or 0.0 for x in got[:n]]), gram

    have = members.agg(*[F.sum(F.col("tokens") * F.col(f"p{i}")) for i in range(n)]).first()
    have = [x or 0.0 for x in have]
    found = wanted_totals(have, domains, weights, temperature)
    if found is None:
        return members.withColumn("rate", F.lit(1.0)), {"domains": domains, "targets": have, "totals": have, "misses": {x: 0.0 for x in domains}, "met": True, "steps": 0}
    target, scale = map(np.array, found)
    live = np.array(have) > 0
    now, steps = members.withColumn("rate", F.lit(max(1.0, floor))), 0
    at, gram = look(now, np.zeros(n))
    # A step so long that the rarest domain isn't held back by its own size.
    stiff = min(STIFFNESS / scale.max(), 1e-3 * float(np.min(np.diag(gram)[live] / scale[live] ** 2))) * scale ** 2
    before = (target - at) / scale
    while True:
        pull = np.zeros(n)
        if steps:
            at, gram = look(now, pull)
        while True:  # the move whose gradient, where it ends, is the move
            miss = (target - at) / scale
            slope = np.where(live, at - target + stiff * pull, 0.0)
            met = bool(np.abs(miss).max() <= TOLERANCE)
            if met or np.abs(slope / scale).max() <= TOLERANCE / 100:
                break
            own = gram[np.ix_(live, live)] + np.diag(stiff[live])
            unit = 1 / np.sqrt(np.diag(own))  # domains differ by many orders of size
            move = np.zeros(n)
            move[live] = -unit * np.linalg.lstsq(own * np.outer(unit, unit), unit * slope[live], rcond=1e-14)[0]
            fall, part = -float(slope @ move), 1.0
            while True:
                at, gram = look(now, pull + part * move)
                steps += 1
                rise = float(np.where(live, at - target + stiff * (pull + part * move), 0.0) @ move)
                if rise <= 0.1 * fall or part < 1e-12:
                    break
                part *= max(0.1, fall / (fall + rise))  # went beyond the lowest point of the line
            pull = pull + part * move
            if part < 1e-12:  # rounding leaves no shorter way
                break
        now = moved(now, pull)
        if met or np.abs(miss - before).max() <= TOLERANCE / 100:  # or no free rate can improve
            break
        now, before = materialize(now, "mix-rates"), miss
    misses = dict(zip(domains, miss.tolist(), strict=True))
    if not met:
        logging.getLogger(__name__).warning("targets can't be met with rates of at least %s; relative misses: %s", floor, misses)
    return now, {"domains": domains, "targets": target.tolist(), "totals": at.tolist(), "misses": misses, "met": met, "steps": steps}


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | None = None, limit: int = LABELLED,
        least: float = 0.0) -> tuple[DataFrame, dict]:
    """(doc_id, text_hash, nth, tokens, domain, posterior, rate, copies, miss) of every row, and the fit's report.

    miss: how far the document's domain stays below its target, as a part of it (the same for all its documents; 0 within the tolerance).
    copies: the whole part of the rate, and one more with the probability of the rest, by a hash of the row.
    """
    domains, model, priors = train(docs, labelled, limit)
    if not domains:
        spark = docs.sparkSession
        domains, priors = ["all"], [0.0]
        model = spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"), F.lit(0.0).alias("l0"))
    members = materialize(posteriors(docs, domains, model, priors), "mix-members")
    rated, report = fit_rates(members, domains, weights, least=least)
    best = F.greatest(*[F.struct(F.col(f"p{i}").alias("p"), F.lit(x).alias("domain")) for i, x in enumerate(domains)]) if len(domains) > 1 \
        else F.struct(F.col("p0").alias("p"), F.lit(domains[0]).alias("domain"))
    u = F.shiftrightunsigned(F.xxhash64("doc_id", "text_hash", "nth", F.lit(SEED)), 11) / float(1 << 53)
    copies = F.floor("rate") + (u < F.col("rate") - F.floor("rate")).cast("long")
    miss = F.lit(0.0)
    for x, v in report["misses"].items():
        miss = F.when((F.col("best.domain") == x) & F.lit(abs(v) > TOLERANCE), F.lit(round(v, 6))).otherwise(miss)
    return rated.withColumn("rate", F.round("rate", RATE_DECIMALS)).withColumn("best", best).select("doc_id", "text_hash", "nth", "tokens", F.col("best.domain").alias("domain"),
                                                 F.round("best.p", 9).alias("posterior"), "rate", copies.alias("copies"), miss.alias("miss")), report


def mixed_docs(docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | None = None, least: float = 0.0) -> DataFrame:
    """The rows of ``docs``, each as often as its copies say, with its columns."""
    got, _ = mix(docs, labelled, weights, least=least)
    # Repeated rows of one document and text share a row here: their copies are dealt as their number and the rest.
    nth, copy, k_id, k_hash, k_copies, k_rows = fresh(docs, "row_nth", "row_copy", "mixed_id", "mixed_hash", "mixed_copies", "mixed_rows")
    times = got.groupBy(F.col("doc_id").alias(k_id), F.col("text_hash").alias(k_hash)).agg(
        F.sum("copies").alias(k_copies), F.count(F.lit(1)).alias(k_rows))
    met = docs.join(times, F.col("doc_id").cast("long").eqNullSafe(F.col(k_id)) & (row_hash(F.col("text").cast("string")) == F.col(k_hash)))
    single = met.filter(F.col(k_rows) == 1).withColumn(nth, F.lit(1))
    again = met.filter(F.col(k_rows) > 1).withColumn(nth, F.row_number().over(Window.partitionBy(k_id, k_hash).orderBy(k_id)))
    whole = F.floor(F.col(k_copies) / F.col(k_rows)) + (F.col(nth) <= F.col(k_copies) % F.col(k_rows)).cast("long")
    out = single.unionByName(again).withColumn(copy, F.explode(F.array_repeat(F.lit(1), whole.cast("int"))))
    return out.select(*docs.columns)


def domains_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the rows of the labels table: the language of the document."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("domain"))
    marks = labels.select(F.col("doc_id").cast("long").alias("l_id")).distinct()
    return own.join(marks, F.col("doc_id") == F.col("l_id"), "left_semi")


@register("op6_mixing")
def op6_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    got, _ = mix(docs, domains_of(docs, table(spark, sf_dir, "labels")), least=LEAST_RATE)
    return got.select("doc_id", "tokens", "domain", "posterior", "rate", "copies", "miss")
