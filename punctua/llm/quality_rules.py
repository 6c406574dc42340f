"""Learned decision lists of threshold rules, grown and pruned by sequential covering.

A rule is a conjunction of ``feature > x`` and ``feature <= x``.  One after the
other, a rule is grown on two thirds of the labelled documents that no earlier
rule covers, by information gain, and its last conditions are pruned on the
other third.  All the learner sees are counts of labels per (feature, bin) among
the documents that satisfy the conditions so far, a table of fixed size.  The
list is emitted as one conditional Spark expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from punctua.llm.common import stored
from punctua.llm.text_stats import FEATURES, labelled_stats, with_stats

#: Labelled documents used, thresholds per feature and label, length limits of the list.
FIT_ROWS = 20_000
BINS = 25
MOST_RULES = 12
MOST_CONDITIONS = 4
#: A rule must be right this often among the documents held out for pruning.
PRECISION = 0.95
LEAST_HITS = 3
#: Fixed values of the contract.
LEAST_WORDS, MOST_REPEAT_PERCENT = 50, 50


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    at: int
    value: float

    def on(self, value: Column) -> Column:
        return value > F.lit(self.value) if self.above else value <= F.lit(self.value)

    def binned(self) -> Column:
        b = F.col(f"bin_{self.feature}")
        return b > self.at if self.above else b <= self.at

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.value:.6g}"


@dataclass
class RuleList:
    """Ordered rules; the first that fires rejects the document."""

    rules: list[tuple[Condition, ...]] = field(default_factory=list)

    def verdict(self, features: str = "stats") -> Column:
        """Number of the rule that fires (from 1), 0 if none does."""
        out = None
        for k, rule in enumerate(self.rules, 1):
            test = _all(c.on(F.col(f"{features}.{c.feature}")) for c in rule)
            out = F.when(test, k) if out is None else out.when(test, k)
        return (out.otherwise(0) if out is not None else F.lit(0)).cast("int")

    def __str__(self) -> str:
        return "\n".join(f"{k}. reject if {' and '.join(map(str, r))}" for k, r in enumerate(self.rules, 1))


def _all(tests) -> Column:
    out = F.lit(True)
    for test in tests:
        out = out & test
    return out


def learn(rows: DataFrame) -> RuleList:
    """Rules that cover label 0, from (draw, label, features).

    Without both labels there is nothing to learn and the list is empty.
    """
    rows = stored(rows, "labelled")
    marks = [i / BINS for i in range(BINS + 1)]
    # Quantiles of each label, so that values that only few documents have are cut too.
    cuts = rows.groupBy("label").agg(*[F.percentile_approx(f, marks, 10_000).alias(f) for f in FEATURES]).collect()
    edges = {f: _between(sorted({e for cut in cuts for e in cut[f]})) for f in FEATURES}
    # Number of thresholds below the value: bin b means value > edges[b - 1].
    grown_on = F.pmod(F.floor(F.col("draw") * 9e8), F.lit(3)) > 0
    part = rows.select("label", grown_on.alias("grow"), *[_bin(f, edges[f]).alias(f"bin_{f}") for f in FEATURES])
    # Documents with equal bins are one row with counts.
    cells = part.groupBy("grow", *[f"bin_{f}" for f in FEATURES]).agg(F.sum(1 - F.col("label")).alias("bad"), F.sum("label").alias("good"))
    left, found, failed = stored(cells, "cells"), RuleList(), set()
    while len(found.rules) < MOST_RULES:
        grown = _grow(left.filter("grow"), edges, failed)
        if not grown:
            break
        rule = _prune(left.filter(~F.col("grow")), grown)
        if not rule:
            # Not good enough on held-out documents: no rule begins with this feature any more.
            failed.add(grown[0].feature)
            continue
        found.rules.append(rule)
        left = left.filter(~_all(c.binned() for c in rule))
    return found


def _between(values: list[float]) -> list[float]:
    """Thresholds halfway between neighbouring values."""
    return [(a + b) / 2 for a, b in zip(values, values[1:])]


def _bin(feature: str, edges: list[float]) -> Column:
    """Number of thresholds below the value: bin b means value > edges[b - 1]."""
    above = [F.when(F.col(feature) > F.lit(float(e)), 1).otherwise(0) for e in edges]
    return sum(above, F.lit(0)).cast("int")


def _grow(rows: DataFrame, edges: dict[str, list[float]], failed: set[str]) -> tuple[Condition, ...]:
    rule: tuple[Condition, ...] = ()
    while len(rule) < MOST_CONDITIONS:
        here = rows.filter(_all(c.binned() for c in rule))
        pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"bin_{f}").alias("bin")) for f in FEATURES])).alias("p")
        counts = here.select(pairs, "bad", "good").groupBy("p.feature", "p.bin").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        table = {(r["feature"], r["bin"]): (r["bad"], r["good"]) for r in counts.collect()}  # at most FEATURES x thresholds
        bad = sum(b for (f, _), (b, _) in table.items() if f == FEATURES[0])
        good = sum(g for (f, _), (_, g) in table.items() if f == FEATURES[0])
        if not bad or not good:
            break
        offers = (s for s in _splits(table, edges, bad, good) if rule or s[1].feature not in failed)
        best = max(offers, key=lambda s: (s[0], str(s[1])), default=None)
        if best is None or best[0] <= 0:
            break
        rule += (best[1],)
    return rule


def _splits(table, edges, bad, good):
    """(gain, condition) of every threshold, both ways."""
    before = math.log2(bad / (bad + good))
    for f in FEATURES:
        low_bad = low_good = 0
        for at, value in enumerate(edges[f]):
            b, g = table.get((f, at), (0, 0))
            low_bad, low_good = low_bad + b, low_good + g
            for above, p, n in ((True, bad - low_bad, good - low_good), (False, low_bad, low_good)):
                if p and p + n < bad + good:
                    yield p * (math.log2(p / (p + n)) - before), Condition(f, above, at, float(value))


def _prune(rows: DataFrame, rule: tuple[Condition, ...]) -> tuple[Condition, ...]:
    """The best prefix of ``rule`` on held-out documents, nothing if none is good enough."""
    if not rule:
        return ()
    sums = []
    for k in range(1, len(rule) + 1):
        fires = _all(c.binned() for c in rule[:k])
        sums += [F.sum(F.when(fires, F.col(c)).otherwise(0)).alias(f"{c}{k}") for c in ("bad", "good")]
    got = rows.agg(*sums).first()
    scored = []
    for k in range(1, len(rule) + 1):
        bad, good = got[f"bad{k}"] or 0, got[f"good{k}"] or 0
        if bad >= LEAST_HITS and bad >= PRECISION * (bad + good):
            scored.append(((bad - good) / (bad + good), bad, -k))
    return rule[: -max(scored)[2]] if scored else ()


def judge(docs: DataFrame, rules: RuleList, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, the base counts, base_failed, kept and rule (0: none fired).

    A NULL text counts as empty and fails the base test.  Rows are judged one by
    one, so repeated rows and NULL ids get their verdict like any other; other
    columns are ignored and an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = with_stats(rows).withColumn("rule", rules.verdict())
    s = lambda name: F.col(f"stats.{name}")
    failed = (s("n_words") < LEAST_WORDS) | (100 * s("n_repeat_words") > MOST_REPEAT_PERCENT * s("n_words"))
    base = [s(c).alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return rows.select("doc_id", *base, failed.alias("base_failed"), (~failed & (F.col("rule") == 0)).alias("kept"), "rule")


def fit(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> RuleList:
    """The list learned from about ``most`` labelled documents at most."""
    return learn(labelled_stats(docs, labels, most))
