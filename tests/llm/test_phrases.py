"""Collocations from the word graph, against plain counting."""

import random
import re
from collections import Counter, defaultdict

import pytest

from punctua.llm import phrases
from punctua.llm.queries import QUERIES

from edge import docs

FOLDER = "/root/testdata/sf0.001"


def pieces(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
        yield [w for w in re.split("[\x20\x09]+", piece) if w]


def counts(rows):
    """lang -> phrase (tuple) -> occurrences, of one to three words."""
    f = defaultdict(Counter)
    for lang, text in rows:
        for w in pieces(text):
            for k in (1, 2, 3):
                f["und" if lang is None else lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    return f


def brute(rows, least=10, top=2000, covered=50):
    out = []
    for lang, c in counts(rows).items():
        found = {g: a for g, a in c.items() if len(g) > 1 and a >= least}
        inside = defaultdict(int)
        for g, a in found.items():
            for part in (g[:2], g[1:]) if len(g) == 3 else ():
                inside[part] = max(inside[part], a)
        ranked = []
        for g, a in found.items():
            if len(g) == 2 and 100 * inside[g] >= covered * a:
                continue
            s, k = min((1_000_000 * a * a // (c[g[:k]] * c[g[k:]]), k) for k in range(1, len(g)))
            ranked.append((-s, -a, " ".join(g).encode(), c[g[:k]], c[g[k:]]))
        n = sum(a for g, a in c.items() if len(g) == 1)
        out += [(lang, i, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(ranked)[:top], 1)]
    return sorted(out)


def rows_of(frame):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in frame.collect())


def random_rows(seed, n=300):
    rng = random.Random(seed)
    words = ["A", "b", "c", "dd", "é", "日本", "\x1c", "the", "of", "x\xa0y"]
    joints = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "?\r"]
    return [(rng.choice(["en", "de", "", None]), "".join(rng.choice(words[:rng.choice([4, 10])]) + rng.choice(joints) for _ in range(rng.randint(0, 60)))) for _ in range(n)]


@pytest.mark.parametrize("bits", [1 << 27, 64])
def test_equals_plain_counting(spark, bits, monkeypatch):
    """Also with bitmaps so small that every gram is marked."""
    monkeypatch.setattr(phrases, "BITS", bits)
    rows = random_rows(bits)
    frame = spark.createDataFrame(rows, "lang string, text string")
    assert rows_of(phrases.collocations(frame)) == brute(rows)
    assert rows_of(phrases.collocations(frame, least=3, top=7, covered=80)) == brute(rows, 3, 7, 80)


def test_small_slices_and_memories(spark, monkeypatch):
    for name, value in (("SLICE", 50), ("NUMBERED", 20), ("COMBINED", 10)):
        monkeypatch.setattr(phrases, name, value)
    rows = random_rows(3)
    assert rows_of(phrases.collocations(spark.createDataFrame(rows, "lang string, text string"))) == brute(rows)


def test_counts_follow_from_flow_and_ends(spark):
    rows = random_rows(4)
    want = counts(rows)
    grams = phrases.longest_grams(spark.createDataFrame(rows, "lang string, text string"))
    edges, nodes, words = phrases.graph(grams)
    assert {(r.lang, r.w): r.n for r in words.collect()} == {(lang, g[0]): a for lang, c in want.items() for g, a in c.items() if len(g) == 1}
    assert {(r.lang, r.w1, r.w2): r.n for r in nodes.collect()} == {(lang, *g): a for lang, c in want.items() for g, a in c.items() if len(g) == 2 and a >= 10}
    assert {(r.lang, r.w1, r.w2, r.w3): r.n for r in edges.collect()} == {(lang, *g): a for lang, c in want.items() for g, a in c.items() if len(g) == 3 and a >= 10}


def test_unary_paths_become_passages(spark):
    long = " ".join(f"w{i}" for i in range(70))
    rows = [("en", long)] * 12 + [("en", "w3 w4 zz")] * 5 + [("en", "a b a b a b a")] * 10 + [("en", "w60 w61")]
    edges, nodes, _ = phrases.graph(phrases.longest_grams(spark.createDataFrame(rows, "lang string, text string")))
    found = {r.passage: (r.n_words, r.n) for r in phrases.passage_texts(edges, phrases.passages(edges, nodes)).collect()}
    # Pairs that also occur elsewhere end a path.
    parts = [" ".join(f"w{i}" for i in range(a, b)) for a, b in ((0, 5), (3, 62), (60, 70))]
    assert {p: found[p] for p in parts} == {parts[0]: (5, 12), parts[1]: (59, 12), parts[2]: (10, 12)}
    assert found["a b a"] == (3, 30) and found["b a b"] == (3, 20) and len(found) == 5


def test_products_beyond_64_bits(spark):
    a = 3_000_000_000
    row = spark.createDataFrame([(a, a + 1, a + 2)], "n bigint, x bigint, y bigint")
    assert row.select(phrases._score("n", "x", "y").alias("s")).first().s == 1_000_000 * a * a // ((a + 1) * (a + 2))


def test_pieces_longer_than_a_slice_lose_no_gram():
    text = b"aa bb  cc dd ee\tff gg hh. ii jj kk ll mm nn oo"
    batch = phrases.pa.RecordBatch.from_arrays([phrases.pa.array([b"en"]), phrases.pa.array([text])], names=["lang", "text"])
    for size in range(1, 60):
        numbers, rows = phrases._Numbers(), []
        for _, part, behind in phrases._by_language(batch, size):
            rows += [tuple(numbers.words[i] for i in g) for g in phrases._grams(numbers, part, behind).T]
        assert rows == [g for w in pieces(text.decode()) for g in zip(*[[x.encode() for x in w[k:]] + [b""] * k for k in range(3)])]


def test_odd_rows(spark):
    frame = docs(spark)
    rows = [(r.lang, r.text) for r in frame.select("lang", "text").collect()]
    assert rows_of(phrases.collocations(frame)) == brute(rows) != []
    assert phrases.collocations(frame.limit(0)).count() == 0
    assert phrases.collocations(frame.filter("text IS NULL")).count() == 0


def test_query_equals_plain_counting(spark):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert rows_of(QUERIES["op12_phrase_collocations"](spark, FOLDER)) == brute(rows) != []
