"""Near duplicates of texts and of embeddings against brute force."""

import random
import re

import numpy as np
import xxhash

from pyspark.sql import functions as F

from punctua.llm import lattice_dedup, simhash_dedup
from punctua.llm.components import components
from punctua.llm.queries import QUERIES

from edge import DOCS, docs

FOLDER = "/root/testdata/sf0.001"


def connected(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {n: find(n) for n in nodes}


def plain_print(text):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    pieces = [b" ".join(found[i:i + 3]) for i in range(max(1, len(found) - 2))]
    ones = [0] * 64
    for piece in pieces:
        h = xxhash.xxh64_intdigest(piece, 42)
        for k in range(64):
            ones[k] += h >> k & 1
    return sum(1 << k for k in range(64) if 2 * ones[k] > len(pieces))


def test_components_of_random_graphs(spark):
    draw = random.Random(5)
    pairs = [(draw.randrange(200), draw.randrange(200)) for _ in range(130)] + [(k, k + 1) for k in range(300, 340)] + [(400, k) for k in range(401, 450)] + [(7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()))
    want = connected({x for p in pairs for x in p}, pairs)
    assert all(got.get(n, n) == c for n, c in want.items())
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_fingerprints_equal_a_plain_computation(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").union(docs(spark).select("doc_id", "text"))
    got = simhash_dedup.near_duplicates(rows).select("doc_id", "fingerprint").collect()
    want = [(r.doc_id, f"{plain_print(r.text):016x}") for r in rows.collect()]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_links_of_planted_fingerprints(spark):
    """Dense groups, chains and far neighbours; no link between texts is lost."""
    draw, prints = random.Random(2), set()
    for _ in range(25):
        base = draw.getrandbits(64)
        prints.add(base)
        for _ in range(20):
            other = base
            for k in draw.sample(range(64), draw.randrange(1, 6)):
                other ^= 1 << k
            prints.add(other)
    prints |= {0, (1 << 64) - 1, 1 << 63, 7}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "print bigint")
    near = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 3}
    one = {(a, b) for a, b in near if bin((a ^ b) & ((1 << 64) - 1)).count("1") == 1}
    assert {tuple(sorted(r)) for r in simhash_dedup.one_bit_links(frame).collect()} == one
    found = simhash_dedup.ring_links(frame.withColumn("group", F.col("print"))).collect()
    assert {tuple(sorted(r)) for r in found} == near


def test_rows_made_of_fingerprints_are_not_sent_through_the_driver(spark, tmp_path):
    """The planner takes a side for as small as it was before explode or in its file."""
    spark.range(500).select(F.xxhash64("id").alias("print"), F.xxhash64("id").alias("group")).write.parquet(str(tmp_path / "prints"))
    prints = spark.read.parquet(str(tmp_path / "prints"))
    texts = spark.createDataFrame([(k, f"text {k % 3}") for k in range(9)], "doc_id bigint, text string")
    for frame in (simhash_dedup.one_bit_links(prints), simhash_dedup.ring_links(prints), simhash_dedup.near_duplicates(texts).select("doc_id", "fingerprint")):
        frame.collect()
        joins = re.findall(r"(\w+Join)\b", frame._jdf.queryExecution().executedPlan().toString())
        assert "SortMergeJoin" in joins and "BroadcastHashJoin" not in joins[:1]


def test_the_pipeline_keeps_one_without_sending_rows_through_the_driver(spark, monkeypatch):
    """The stage looks up the group of every row, which its compressed file makes look small."""
    texts = spark.createDataFrame([(k, f"text {k % 3} of a few") for k in range(9)], "doc_id bigint, text string")
    plans, store = [], simhash_dedup.stored

    def seen(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return store(df, name)

    monkeypatch.setattr(simhash_dedup, "stored", seen)
    assert sorted(r.doc_id for r in simhash_dedup.keep_one(texts).collect()) == [0, 1, 2]
    (ids,) = [text for name, text in plans if name == "ids"]
    assert "SortMergeJoin" in ids


def test_near_duplicates_of_edge_rows(spark):
    rows = docs(spark)
    got = simhash_dedup.near_duplicates(rows).collect()
    assert len(got) == len(DOCS)
    by_id = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert by_id[2] == 1 and by_id[4] == by_id[5] == by_id[3] == 3
    kept = simhash_dedup.keep_one(rows)
    assert kept.columns == rows.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {1, 3, 6} <= set(ids) and not {2, 4, 5} & set(ids)
    assert ids.count(None) == 1  # its group has no id at all
    assert simhash_dedup.keep_one(rows.limit(0)).count() == 0


def test_repeated_ids_with_other_texts_keep_every_group(spark):
    a, b, c = "alpha beta gamma delta " * 9, "one two three four five " * 8, "north south east west " * 7
    for rows in ([(1, a), (0, a), (1, b)], [(1, b), (0, a), (1, a)], [(1, a), (1, b), (1, a), (1, c), (2, c), (0, b)]):
        frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
        kept = [(r.doc_id, r.text) for r in simhash_dedup.keep_one(frame).collect()]
        want = {t: min(i for i, u in rows if u == t) for t in {t for _, t in rows}}
        assert sorted(kept) == sorted((i, t) for t, i in want.items())


def brute(ids, vectors):
    good = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    n, links = len(ids), []
    for i in range(n):
        for j in range(i + 1, n):
            if good[i] and good[j] and len(vectors[i]) == len(vectors[j]):
                a, b = np.array(vectors[i], float), np.array(vectors[j], float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.95:
                    links.append((i, j))
    count = np.bincount(np.array(links, int).ravel(), minlength=n) if links else np.zeros(n, int)
    part = connected(range(n), links)
    return links, count, [min(ids[j] for j in range(n) if part[j] == part[i]) for i in range(n)]


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(0)
    base = rng.standard_normal((12, 64))
    rows = []
    for k in range(600):
        v = base[k % 12] + rng.standard_normal(64) * rng.choice([0.05, 0.2, 0.28, 1.0])
        rows.append((k, [float(np.float32(x)) for x in v]))
    rows += [(1000, None), (1001, []), (1002, [0.0] * 64), (1003, [float("nan")] * 64), (1004, [None] + [1.0] * 63), (1005, [float("inf")] + [1.0] * 63), (1006, rows[0][1]), (1007, rows[0][1]), (1008, [1.0, 2.0]), (1009, [2.0, 4.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("node", F.lit("x")).withColumn("v", F.lit(1))
    got = {r.vec_id: r for r in lattice_dedup.near_duplicates(frame).collect()}
    ids = [r[0] for r in rows]
    links, count, component = brute(ids, [r[1] for r in rows])
    found = sum(got[i].n_links for i in ids)
    assert found >= 0.97 * count.sum()
    assert all(got[i].n_links <= c for i, c in zip(ids, count))
    if found == count.sum():
        assert [got[i].component_id for i in ids] == component
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert lattice_dedup.near_duplicates(frame.limit(0)).count() == 0


def test_lattice_points_are_nearest():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((200, 8)) * 3
    first = lattice_dedup.lattice_points(x, 1)[:, 0]
    steps = np.array(np.meshgrid(*[[-1, 0, 1]] * 8)).reshape(8, -1).T
    for row, found in zip(x, first):
        best = np.inf
        for shift in (0.0, 0.5):
            near = np.rint(row - shift) + steps
            near = near[near.sum(axis=1) % 2 == 0] + shift
            best = min(best, ((row - near) ** 2).sum(axis=1).min())
        assert abs(((row - found) ** 2).sum() - best) < 1e-9


def test_embedding_recall_at_the_threshold():
    """Pairs of cosine 0.95 meet in some table in at least 0.97 of cases."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.standard_normal((2000, 64))
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * y
    met = np.zeros(2000, bool)
    for table in range(lattice_dedup.TABLES):
        met |= (lattice_dedup._cells(x, table, lattice_dedup.PROBES) == lattice_dedup._cells(y, table, 1)).any(axis=1)
    assert met.mean() >= 0.97


def test_registered_query(spark):
    got = QUERIES["op8_lattice_near_dedup"](spark, FOLDER)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert got.count() == spark.read.parquet(f"{FOLDER}/embeddings.parquet").count()
