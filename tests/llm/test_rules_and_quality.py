"""Quality rules and the site-aware classifier."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from punctua.llm import quality_rules, site_quality, text_stats
from punctua.llm.queries import QUERIES

from edge import DOCS, docs

FOLDER = "/root/testdata/sf0.001"


def plain_stats(text):
    found = [w for w in re.split(r"[ \t-\r]+", text or "") if w]
    lines = [l for l in (text or "").split("\n") if re.search(r"[^ \t-\r]", l)]
    windows = [tuple(found[i:i + 3]) for i in range(len(found) - 2)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= {i, i + 1, i + 2}
    return len(found), sum(map(len, found)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_base_counts_equal_a_plain_count(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").union(docs(spark).select("doc_id", "text"))
    rows = rows.union(spark.createDataFrame([(90, "a b c a b c a b c"), (91, "a a a a"), (92, "a b c d a b c"), (93, "x\nx\n\n x\nx#*$%&|<>")], "doc_id bigint, text string"))
    got = quality_rules.judge(rows, quality_rules.RuleList()).drop("kept", "rule", "base_failed", "doc_id").collect()
    want = [plain_stats(r.text) for r in rows.collect()]
    assert sorted(map(tuple, got)) == sorted(want)


def test_no_labels_no_rules(spark):
    rows, none = docs(spark), spark.createDataFrame([], "doc_id bigint, quality int")
    rules = quality_rules.fit(rows, none)
    assert rules.rules == []
    got = quality_rules.judge(rows, rules)
    assert got.count() == len(DOCS)
    assert got.filter("kept = base_failed").count() == 0
    assert quality_rules.judge(rows.limit(0), rules).count() == 0


def test_rules_find_a_planted_threshold(spark):
    rows = spark.range(3000).select(
        (F.col("id") / 3000).alias("draw"), (F.col("id") % 7 != 0).cast("int").alias("label"),
        *[(F.when((F.col("id") % 7 == 0) & F.lit(f == "symbols_per_word"), 1.0).otherwise(0.0) + F.pmod(F.xxhash64("id", F.lit(f)), F.lit(100)) / 1000).alias(f) for f in text_stats.FEATURES],
    )
    rules = quality_rules.learn(rows)
    assert len(rules.rules) == 1 and len(rules.rules[0]) == 1
    only = rules.rules[0][0]
    assert only.feature == "symbols_per_word" and only.above and 0.1 <= only.value < 1.0
    assert "reject if symbols_per_word >" in str(rules)


def test_learned_rules_spare_good_documents(spark):
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op1_quality_rules"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    wrong = got.filter("quality = 1 AND NOT kept AND NOT base_failed").count()
    left = got.filter("quality = 0 AND kept").count()
    assert wrong <= 0.02 * got.filter("quality = 1").count()
    assert left <= 0.2 * got.filter("quality = 0").count()


def test_site_classifier_on_edge_rows(spark):
    rows = docs(spark)
    labels = spark.createDataFrame([(1, 1), (6, 0), (None, 1), (8, 5), (9, None)], "doc_id bigint, quality int")
    model = site_quality.fit(rows, labels)
    got = site_quality.classify(rows, model).collect()
    assert len(got) == len(DOCS) and all(0 <= r.quality <= 1 for r in got)
    kept = site_quality.keep_good(rows, model)
    assert kept.columns == rows.columns and kept.count() == sum(r.kept for r in got)
    assert site_quality.keep_good(rows.limit(0), model).count() == 0


def test_site_posteriors_equal_a_plain_computation(spark):
    sites = [("h1", "a", 0.9)] * 40 + [("h1", "b", 0.8)] * 3 + [("h2", "a", 0.1)] * 30 + [(None, "a", 0.5)] * 2 + [("h2", None, 0.2)]
    got = {(r.host, r.path): r for r in site_quality.site_posteriors(spark.createDataFrame(sites, "host string, path string, p double")).collect()}
    hosts, paths = Counter(), Counter()
    hn, pn = Counter(), Counter()
    for h, p, v in sites:
        hosts[h] += v; hn[h] += 1; paths[h, p] += v; pn[h, p] += 1  # noqa: E702
    base = sum(hosts.values()) / len(sites)

    def strength(groups):
        seen = sum(n * (m - q) ** 2 for n, m, q in groups)
        sampling, full = sum(q * (1 - q) for _, _, q in groups), sum(n * q * (1 - q) for n, _, q in groups)
        return min(max(1 / max((seen - sampling) / (full - sampling), 1e-9) - 1, 2.0), 10_000.0)

    s = strength([(hn[h], hosts[h] / hn[h], base) for h in hosts])
    prior = {h: (hosts[h] + base * s) / (hn[h] + s) for h in hosts}
    t = strength([(pn[k], paths[k] / pn[k], prior[k[0]]) for k in paths])
    assert set(got) == set(paths)
    for k, r in got.items():
        assert r.n == pn[k] and math.isclose(r.prior, prior[k[0]], rel_tol=1e-9) and math.isclose(r.strength, t, rel_tol=1e-9) and math.isclose(r.base, base, rel_tol=1e-9)


def test_site_evidence_moves_a_doubtful_document(spark):
    model = site_quality.Evidence((0.0,) * 9, (1.0,) * 9, (0.0,) * 18, 0.0)
    rows = [(k, "neutral words", "good" if k < 50 else "bad", "p") for k in range(100)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    scored = frame.select("doc_id", F.col("source").alias("host"), F.col("lang").alias("path"), F.lit(0.0).alias("log_odds"), F.when(F.col("source") == "good", 0.9).otherwise(0.2).alias("p"))
    joined = site_quality._with_sites(scored, site_quality.site_posteriors(scored))
    got = joined.select("host", site_quality._posterior(joined).alias("q")).groupBy("host").agg(F.avg("q").alias("q")).collect()
    q = {r.host: r.q for r in got}
    assert q["good"] > 0.6 > 0.4 > q["bad"]
    assert site_quality.classify(frame, model).count() == 100


@pytest.mark.parametrize("name", ["op6_site_quality"])
def test_held_out_accuracy(spark, name):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    model = site_quality.fit(documents, labels.filter("doc_id % 2 = 0"))
    got = site_quality.classify(documents, model).join(labels.filter("doc_id % 2 = 1").select("doc_id", F.col("quality").alias("label")), "doc_id")
    right = got.filter("kept = (label = 1)").count()
    assert right >= 0.97 * got.count()
