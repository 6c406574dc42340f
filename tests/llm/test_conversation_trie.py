"""Prefix trie of conversations, against a plain dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from punctua.llm import conversation_trie
from punctua.llm.queries import QUERIES

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows, headers=6):
    """``rows``: (conv_id, turn, role, text)."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode(), (role or "", text or "")))
    turns = {c: [t[4] for t in sorted(ts)] for c, ts in convs.items()}
    members, ended = defaultdict(list), defaultdict(list)
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % headers
        path = tuple(turns.get(c - c % 100, [])[:h] + own[h:])
        ended[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    digest = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(kids[p]), leaves[p], saved[p], digest(ended[p]))
        for p, m in members.items()
    )


def nodes(frame):
    return sorted(tuple(-1 if r[c] is None else r[c] for c in COLUMNS) for r in frame.collect())


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def random_rows(seed, convs=150):
    """Many shared beginnings, copies, lone conversations and odd values."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-50, 400), convs):
        for turn in range(rng.choice([1, 2, 3, 6, 9, 14])):
            same = rng.random() < 0.85
            rows.append((c, rng.choice([turn, turn, turn, None]) if rng.random() < 0.1 else turn, rng.choice(["u", None, ""]) if not same else "u", "hé" if same else rng.choice(["", None, "b", "ccc"])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("most", [2, 3, 4096])
def test_equals_a_plain_trie(spark, most):
    rows = random_rows(most)
    assert nodes(conversation_trie.trie(table(spark, rows), most=most)) == brute(rows)


def test_conversations_as_they_are(spark):
    rows = random_rows(1)
    assert nodes(conversation_trie.trie(table(spark, rows), headers=1, most=4)) == brute(rows, headers=1)


def test_long_conversation_and_many_copies(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "TURNS", 7)
    monkeypatch.setattr(conversation_trie, "IDS", 5)
    rows = [(0, t, "u", f"t{t}") for t in range(700)] + [(c, t, "u", f"t{t}") for c in range(1, 40) for t in range(30)] + [(50, t, "u", f"t{t}") for t in range(600)]
    assert nodes(conversation_trie.trie(table(spark, rows), most=4)) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (None, 1, "u", "no conversation"), (1, None, None, None), (1, 3, "u", ""), (1, 3, "u", ""), (1, 3, "a", "tie"), (2, 0, "u", "x" * 300_000), (100, 5, "u", "head"),
        (101, 0, "u", "own"), (107, 0, "u", "own"), (3, 0, "u", "only"), (203, 1, "u", "no head"), (-5, 0, "u", "x"), (1 << 40, 0, "u", "x"),
    ]
    extra = table(spark, rows)
    for name in ("pos", "depth", "length", "hi", "n", "first", "level", "head", "__carry"):
        extra = extra.selectExpr("*", f"'{name}' AS `{name}`")
    assert nodes(conversation_trie.trie(extra)) == brute(rows)
    assert conversation_trie.trie(table(spark, rows).limit(0)).count() == 0
    assert conversation_trie.trie(table(spark, rows[:1])).count() == 0


def test_query_equals_a_plain_trie(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert nodes(QUERIES["op11_conversation_trie"](spark, folder)) == brute(rows)
