"""Quality classifier: document evidence combined with site posteriors (empirical Bayes).

1. A logistic model gives each document a probability from its text statistics.
2. Hosts and paths hold Beta posteriors over the good share of their documents.
   The documents' probabilities are soft counts.  Hosts shrink toward the global
   share, paths toward their host; how strongly is estimated from the spread
   between sites (method of moments), so sparse sites fall back on their prior.
3. A document's log odds shift by the log odds of its path against the global
   share.  Its own soft count is left out of its path first.

All site figures are grouped sums, combined inside the tasks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from punctua.llm.common import stored
from punctua.llm.text_stats import FEATURES, labelled_stats, with_stats

#: Labelled documents used for the logistic model, its penalty, most steps of its solver.
FIT_ROWS = 20_000
PENALTY = 1e-4
STEPS = 100
#: Documents with a lower probability of being good are rejected.
LEAST = 0.5
#: Log odds of one document and of a site are kept within these bounds.
MOST_EVIDENCE, MOST_SHIFT = 12.0, 2.0
#: Bounds of the prior strength, in documents.
STRENGTH = (2.0, 10_000.0)
#: Ratios are also given squared, so that both ends of a range can be bad.
TERMS = tuple(FEATURES) + tuple(f"{f}^2" for f in FEATURES)


@dataclass(frozen=True)
class Evidence:
    """Logistic model over standardised text statistics."""

    center: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    bias: float

    def log_odds(self, features: str = "stats") -> Column:
        out = F.lit(self.bias)
        for z, w in zip(_terms(features, self.center, self.scale), self.weights):
            out = out + z * F.lit(w)
        return F.greatest(F.lit(-MOST_EVIDENCE), F.least(F.lit(MOST_EVIDENCE), out))


def _terms(prefix: str, center, scale) -> list[Column]:
    base = [F.greatest(F.lit(-5.0), F.least(F.lit(5.0), (F.col(f"{prefix}.{f}") - c) / s)) for f, c, s in zip(FEATURES, center, scale)]
    return base + [z * z for z in base]


def fit_evidence(rows: DataFrame) -> Evidence:
    """Ridge logistic regression on (label, features).

    Without both labels the model says the share of good documents (even odds
    without any).
    """
    rows = stored(rows.select("label", F.struct(*FEATURES).alias("f")), "evidence")
    first = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("p"), *[F.avg(f"f.{f}").alias(f"m_{f}") for f in FEATURES], *[F.stddev_pop(f"f.{f}").alias(f"s_{f}") for f in FEATURES]).first()
    n, share = first["n"], first["p"]
    if not n or share in (0.0, 1.0):
        odds = 0.0 if not n else math.log((share * n + 0.5) / ((1 - share) * n + 0.5))
        return Evidence((0.0,) * len(FEATURES), (1.0,) * len(FEATURES), (0.0,) * len(TERMS), odds)
    center = tuple(float(first[f"m_{f}"]) for f in FEATURES)
    scale = tuple(float(first[f"s_{f}"]) or 1.0 for f in FEATURES)
    terms = rows.select(F.col("label").cast("double").alias("label"), array_to_vector(F.array(*_terms("f", center, scale))).alias("features"))
    fitted = LogisticRegression(regParam=PENALTY, standardization=False, maxIter=STEPS).fit(terms)
    return Evidence(center, scale, tuple(map(float, fitted.coefficients)), float(fitted.intercept))


def site_posteriors(scored: DataFrame) -> DataFrame:
    """(host, path, n, good, prior, strength, base) per path of (host, path, p).

    ``good`` is the soft count of the path, ``prior`` the posterior mean of its
    host, ``strength`` how many documents that prior counts for, ``base`` the
    global share.
    """
    paths = stored(scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("good")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("good").alias("hgood"))
    share = hosts.agg((F.sum("hgood") / F.sum("hn")).alias("share")).first()["share"]
    base = min(max(share if share is not None else 0.5, 1e-6), 1 - 1e-6)
    strong = _strength(hosts, F.col("hn"), F.col("hgood") / F.col("hn"), F.lit(base))
    prior = (F.col("hgood") + base * strong) / (F.col("hn") + strong)
    hosts = hosts.select(_safe("host").alias("__h"), prior.alias("prior"))
    rows = stored(paths.withColumn("__h", _safe("host")).join(hosts, "__h").drop("__h"), "sites")
    within = _strength(rows, F.col("n"), F.col("good") / F.col("n"), F.col("prior"))
    return rows.withColumns({"strength": F.lit(within), "base": F.lit(base)})


def _safe(name: str) -> Column:
    """A join key that tells NULL from any text."""
    return F.struct(F.col(name).isNull().alias("none"), F.coalesce(F.col(name), F.lit("")).alias("value"))


def _strength(rows: DataFrame, n: Column, mean: Column, prior: Column) -> float:
    """Prior strength by moments: the weighted spread of site means around their
    prior is what sampling explains plus a part 1 / (strength + 1)."""
    n = n.cast("double")
    noise = prior * (1 - prior)
    got = rows.agg(F.sum(n * (mean - prior) * (mean - prior)).alias("seen"), F.sum(noise).alias("sampling"), F.sum(n * noise).alias("full")).first()
    if got["full"] is None or got["full"] - got["sampling"] <= 1e-9:
        return STRENGTH[1]
    between = max((got["seen"] - got["sampling"]) / (got["full"] - got["sampling"]), 1e-9)
    return min(max(1 / between - 1, STRENGTH[0]), STRENGTH[1])


def _posterior(rows: DataFrame) -> Column:
    """Probability of one document, from its log odds and its path without itself."""
    others, good = F.greatest(F.col("n") - 1, F.lit(0)), F.greatest(F.col("good") - F.col("p"), F.lit(0.0))
    share = (good + F.col("prior") * F.col("strength")) / (others + F.col("strength"))
    share = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), share))
    logit = lambda p: F.log(p / (1 - p))
    shift = F.greatest(F.lit(-MOST_SHIFT), F.least(F.lit(MOST_SHIFT), logit(share) - logit(F.col("base"))))
    return 1 / (1 + F.exp(-(F.col("log_odds") + shift)))


def _evidence(docs: DataFrame, model: Evidence, text_col: str, host: Column, path: Column) -> DataFrame:
    rows = with_stats(docs, text_col).withColumn("log_odds", model.log_odds())
    return rows.withColumns({"p": 1 / (1 + F.exp(-F.col("log_odds"))), "host": host, "path": path})


def classify(docs: DataFrame, model: Evidence, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """Per row: doc_id, evidence (the text alone), site_share, quality (combined) and kept.

    A NULL text counts as empty; NULL hosts and paths are sites of their own.
    Rows are separate even if they repeat; other columns are ignored, and an
    empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(host_col).cast("string").alias("host"), F.col(path_col).cast("string").alias("path"))
    scored = stored(_evidence(rows, model, "text", F.col("host"), F.col("path")).select("doc_id", "host", "path", "log_odds", "p"), "evidence")
    joined = _with_sites(scored, site_posteriors(scored))
    quality = _posterior(joined)
    share = (F.col("good") + F.col("prior") * F.col("strength")) / (F.col("n") + F.col("strength"))
    return joined.select("doc_id", F.col("p").alias("evidence"), share.alias("site_share"), quality.alias("quality"), (quality >= LEAST).alias("kept"))


def _with_sites(rows: DataFrame, sites: DataFrame) -> DataFrame:
    keyed = sites.select(_safe("host").alias("__host"), _safe("path").alias("__path"), "n", "good", "prior", "strength", "base")
    return rows.withColumns({"__host": _safe("host"), "__path": _safe("path")}).join(keyed, ["__host", "__path"]).drop("__host", "__path")


def keep_good(docs: DataFrame, model: Evidence, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that :func:`classify` keeps, with their columns.

    The first scan leaves only (host, path, p); the second one judges each row
    against its site's posterior, so texts do not move unless the table of sites
    is too large to send around.
    """
    named = {c: f"__in_{k}" for k, c in enumerate(docs.columns)}
    inner = docs.select(*[F.col(f"`{c}`").alias(alias) for c, alias in named.items()])
    host, path = F.col(named[host_col]).cast("string"), F.col(named[path_col]).cast("string")
    rows = _evidence(inner, model, named[text_col], host, path)
    sites = site_posteriors(stored(rows.select("host", "path", "p"), "evidence"))
    kept = _with_sites(rows.drop("stats"), sites)
    kept = kept.filter(_posterior(kept) >= LEAST)
    return kept.select(*[F.col(alias).alias(c) for c, alias in named.items()])


def fit(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> Evidence:
    """The document model from about ``most`` labelled documents at most."""
    return fit_evidence(labelled_stats(docs, labels, most))
