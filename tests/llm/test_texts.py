"""Personal data, packing, mixing, language model and pipeline."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from punctua.llm import entropy_mix, hmm_lm, packing, pii
from punctua.llm.queries import BYTE_BPE, QUERIES

from edge import DOCS, docs

FOLDER = "/root/testdata/sf0.001"

ENTITIES = [
    "Write to Hein.19@mail5.example.com, or hein.19@mail5.example.com.",
    "+1 (743) 555-3824 is +1-743-555-3824, not +1 (743) 555-3825",
    'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"### 4785380592391139$$$ 4785 3805 9239 1139',
    "card 4111111111111111 and ip 152.143.123.131### but version 1.2.3.4.5",
    "Mr John Smith met Mrs. Smith, Mr Smith and Frau MÜLLER; Госпожа Анна Петрова",
    "DE89 3704 0044 0532 0130 00 sk-abcdefghijklmnop1234 123-45-6789",
]


def replaced(spark, texts, key="k"):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return [r.text for r in pii.replace(rows, key).orderBy("doc_id").collect()]


def luhn(digits):
    values = [int(c) for c in reversed(digits)]
    return sum(v if k % 2 == 0 else sum(divmod(2 * v, 10)) for k, v in enumerate(values)) % 10


def test_surrogates_keep_kind_format_and_reference(spark):
    mail, phone, secret, card, names, ids = replaced(spark, ENTITIES)
    a, b = re.findall(r"[^ ]+@[^ ,]+?(?=[,.]?(?: |$))", mail)
    assert a == b and a.split("@")[1] in ("example.com", "example.net", "example.org") and re.fullmatch(r"[a-z]{4}\.\d\d\d*", a.split("@")[0])
    one, two, three = re.findall(r"\+1[ -]\(?\d{3}\)?[ -]\d{3}-\d{4}", phone)
    digits = [re.sub(r"\D", "", x) for x in (one, two, three)]
    assert digits[0] == digits[1] != digits[2] and digits[0] != "17435553824" and one.startswith("+1 (")
    assert re.search(r'"[0-9a-f]{40}"###', secret) and "24be64439e" not in secret
    x, y = re.search(r"(\d{16})\$", secret)[1], re.search(r"(\d{4} ){3}\d{4}", secret)[0].replace(" ", "")
    assert x == y != "4785380592391139" and (luhn(x) == 0) == (luhn("4785380592391139") == 0) and x[0] == "4"
    assert luhn(re.search(r"\d{16}", card)[0]) == 0 and "152.143" not in card and card.endswith("1.2.3.4.5")
    found = re.match(r"Mr (\w+) (\w+) met Mrs. (\w+), Mr (\w+) and Frau (\w+); Госпожа (\w+) (\w+)", names)
    assert found[1] in pii.GIVEN["latin", "m"] and found[2] == found[3] == found[4] != "Smith"
    assert found[5].isupper() and found[6] in pii.GIVEN["cyrillic", "f"] and re.fullmatch("[А-Яа-я]+", found[7])
    assert re.match(r"DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d sk-[a-z]{16}\d{4} \d{3}-\d\d-\d{4}$", ids)


def test_surrogates_depend_on_the_key_alone(spark):
    assert replaced(spark, ENTITIES) == replaced(spark, ENTITIES) != replaced(spark, ENTITIES, "other")


def test_conflicts_are_resolved(spark):
    """Few possible surrogates: short numbers, and given names of one family."""
    texts = [f"+1 {a}-{b:02d}" for a in range(10, 60) for b in range(0, 40)] + [f"Mr {n} Miller" for n in ("Aa", "Bb", "Cc", "Dd", "Ee", "Ff", "Gg", "Hh", "Ii", "Jj", "Kk", "Ll", "Mm", "Nn", "Oo", "Pp", "Qq", "Rr", "Ss", "Tt")]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in pii.replace(rows, "k").collect()}
    assert pii.exceptions(rows, "k").count() > 0
    assert len(set(got.values())) == len(texts) and not set(got.values()) & set(texts)


def test_a_full_form_ends(spark, monkeypatch):
    """Every number of one form is a real one, so no surrogate outside is left; rows without id share no group."""
    monkeypatch.setattr(pii, "TRIES", 3)
    numbers = [f"+1 {a:02d} {b:02d}" for a in range(100) for b in range(100)]
    texts = [", ".join(numbers[k:k + 100]) for k in range(0, 10_000, 100)] + [f"Again {numbers[7]}; 123-45-6789"]
    rows = spark.createDataFrame([(k if k % 3 else None, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    odd = pii.exceptions(rows, "k")
    assert odd.filter("put is not null").count() == odd.count() == 10_000 and odd.filter("put = normal").count() == 0
    found = {}
    for r in pii.replace(rows.withColumn("old", F.col("text")), "k").collect():
        for old, new in zip(r.old.split(", "), r.text.split(", ")):
            found.setdefault(old, set()).add(new)
    again = found.pop(texts[-1]).pop()
    assert all(len(v) == 1 for v in found.values()) and {v for s in found.values() for v in s} == set(numbers)
    assert all(old not in new for old, new in found.items())
    assert again.startswith(f"Again {min(found[numbers[7]])}; ") and "123-45-6789" not in again


def test_a_form_nearly_full_stays_distinct(spark, monkeypatch):
    """Half of a form is real and there are few attempts: some surrogates are drawn, others swapped."""
    monkeypatch.setattr(pii, "TRIES", 2)
    numbers = [f"+1 {a:02d} {b:02d}" for a in range(50) for b in range(100)]
    rows = spark.createDataFrame(list(enumerate(numbers)), "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in pii.replace(rows, "k").collect()}
    assert len(set(got.values())) == len(numbers) and all(got[k] != n for k, n in enumerate(numbers))
    assert 0 < len(set(got.values()) & set(numbers)) < len(numbers)


def test_surrogates_keep_the_form_they_may_be_swapped_in(spark):
    texts = ["+1 12 34 +49 171 1234567 DE89370400440532013000 GB29NWBK60161331926819 123-45-6789 10.0.0.1 4111111111111111 4111111111111112 "
             "sk-Abcdefghijklmnop1234 24be64439e3e49cf46b2d7c90f3602a3d0b907ff"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(F.explode(pii._entities(F.col("text"))).alias("e")).select("e.*")
    forms = rows.select(*(pii._form(F.col("kind"), n) for n in (F.col("normal"), pii.drawn("k", F.col("kind"), F.col("normal"), F.lit(1))))).collect()
    assert len(forms) == 10 and all(old == new for old, new in forms)


def test_spellings_share_one_surrogate(spark):
    phones, ibans, people = replaced(spark, [
        "+491711234567 is +49 171 1234567, +49-171-1234567 and +49 (0) 171 1234567, not +49 171 1234568",
        "DE89370400440532013000 is DE89 3704 0044 0532 0130 00",
        "Mr Alex Kim, MR ALEX KIM is no title, Mr ALEX KIM, Ms Alex Kim and Mr Kim",
    ])
    found = re.fullmatch(r"(\+49\d{10}) is (\+49 \d{3} \d{7}), (\+49-\d{3}-\d{7}) and (\+49 \(0\) \d{3} \d{7}), not (\+49 \d{3} \d{7})", phones)
    one, *same, other = (re.sub("[^0-9]", "", x.replace("(0)", "")) for x in found.groups())
    assert set(same) == {one} and one not in (other, "491711234567")
    a, b = re.fullmatch(r"(DE\d{20}) is (DE\d\d(?: \d{4}){4} \d\d)", ibans).groups()
    assert a == b.replace(" ", "") != "DE89370400440532013000"
    given, last, loud, loud_last, lady, lady_last, alone = re.fullmatch(r"Mr (\S+) (\S+), MR ALEX KIM is no title, Mr (\S+) (\S+), Ms (\S+) (\S+) and Mr (\S+)", people).groups()
    assert given in pii.GIVEN["latin", "m"] and lady in pii.GIVEN["latin", "f"] and loud == given.upper()
    assert last == lady_last == alone == loud_last.title() != "Kim"


def test_surnames_keep_one_surrogate_through_conflicts(spark, monkeypatch):
    """So few syllables that most first attempts meet another surname."""
    monkeypatch.setitem(pii.SYLLABLES, "latin", ("ba", "del") * 8)
    names = [f"K{a}{b}" for a in "aeiou" for b in "lmnrst"]
    texts = [t for n in names for t in (f"Mr {n}", f"Mrs. Eva {n}", f"Herr Max {n.upper()}", "Mr Badelbadel")]
    got = [t.split(" ")[-1].lower() for t in replaced(spark, texts)]
    by_name = [set(got[4 * k:4 * k + 3]) for k in range(len(names))]
    assert all(len(s) == 1 for s in by_name) and len(set.union(*by_name, {got[3]})) == len(names) + 1
    assert "badelbadel" not in got


def test_personal_data_in_edge_rows(spark):
    rows = docs(spark)
    got = pii.replace(rows, "k")
    assert got.columns == [c for c in rows.columns if c != "n_entities"] + ["n_entities"]
    assert sorted(str((r.doc_id, r.text)) for r in got.collect()) == sorted(str((r[0], r[1])) for r in DOCS)
    assert pii.replace(rows.limit(0), "k").count() == 0


def test_nothing_else_changes(spark):
    before = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for r in QUERIES["op2_pii_surrogates"](spark, FOLDER).collect():
        old = before[r.doc_id]
        if not r.n_entities:
            assert r.text == old
        else:
            cut = re.compile(r"\S*[@\d]\S*(?: \(\d+\) \d+-\d+)?")
            assert cut.split(r.text) == cut.split(old) and r.text != old


def packed_rows(frame):
    rows = frame.collect()
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= packing.CAPACITY
    return rows, by_sequence


@pytest.mark.parametrize("source", ["table", "edge"])
def test_packing_round_trip(spark, source):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet") if source == "table" else docs(spark)
    rows, sequences = packed_rows(packing.pack(frame, *BYTE_BPE))
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, total = Counter(), 0
    for r in frame.select("doc_id", "text").collect():
        ids = np.array(plain.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
        total += len(ids)
        first = len(ids) % 2048 or 2048
        edges = [0, *range(min(first, len(ids)), len(ids) + 1, 2048)]
        for k, (i, j) in enumerate(zip(edges, edges[1:])):
            want[r.doc_id, k, i, j - i, zlib.crc32(ids[i:j].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    assert len(sequences) <= math.ceil(total / 2048) + 2
    assert packing.pack(frame.limit(0), *BYTE_BPE).count() == 0


def test_piece_ids(spark):
    rows = packing.pack(docs(spark), *BYTE_BPE, with_ids=True).collect()
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)


def test_words_tokenize_as_in_context():
    fast, plain = packing.Vocabulary(*BYTE_BPE), Tokenizer.from_file(BYTE_BPE[0])
    odd = ["", " ", "  ", "a  b", "a \n b", "tab\t x", " lead", "trail ", "'s don't I'LL", "x y", "日本", "<|endoftext|>", "ab.\nThe end", "²½ 12ª", "a\n\nb c\r\nd", "x" * 5000, "́e ​"]
    for text in odd * 2:
        assert list(fast.encode(text)) == plain.encode(text, add_special_tokens=False).ids, text


def test_plan_is_nearly_full_and_small():
    counts = {length: 1 + (length * 7919) % 5000 for length in range(1, 2049)}
    steps = packing.plan(counts)
    placed = Counter()
    ends = sorted(steps)
    for (length, rank, _, _), after in zip(ends, ends[1:] + [(0, 0, 0, 0)]):
        placed[length] += (after[1] if after[0] == length else counts[length]) - rank
    assert placed == counts
    opened = max(first + counts[length] for length, _, first, offset in steps if offset == 0)
    assert len(steps) < 40_000 and opened <= 1.02 * sum(k * n for k, n in counts.items()) / 2048 + counts[2048]


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, open_, rest = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        level = rest / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > 2 * sizes[s]]
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            rest -= target[s]
            open_.discard(s)
    return target


@pytest.mark.parametrize("source", ["table", "edge"])
def test_mix_meets_targets(spark, source):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet") if source == "table" else docs(spark)
    rows = entropy_mix.mix(frame).collect()
    assert len(rows) == frame.count()
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in rows:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
        assert 0 <= r.taken <= 2 * r["size"] and r.taken == r.copies * r["size"]
    target = plain_targets(sizes)
    for r in rows:
        assert math.isclose(r.target, target[r.source], rel_tol=1e-9, abs_tol=1e-6) and r.source_size == sizes[r.source]
    slack = 0.01 if source == "table" else 1.0
    assert all(abs(taken[s] - target[s]) <= max(slack * target[s], 60 if source == "table" else largest[s]) for s in sizes)
    assert sorted(map(str, entropy_mix.mix(frame.repartition(7)).collect())) == sorted(map(str, rows))
    assert entropy_mix.mix(frame.limit(0)).count() == 0


@pytest.mark.parametrize("chunk", [50_000, 7])
def test_equal_rows_share_the_copies_of_their_class(spark, monkeypatch, chunk):
    """1,000 rows equal in id and text: the target is met to one document."""
    monkeypatch.setattr(entropy_mix, "RANK_CHUNK", chunk)
    rows = [(1, "one two three", "a", "x")] * 1000 + [(2, "one two three", "b", "x")] * 20 + [(3, "four words are here", "b", "x")] * 30 + [(3, "four words are here", "b", "y")] * 30
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string, more string")
    got = entropy_mix.mix(frame).collect()
    assert len(got) == len(rows)
    for source, longest in (("a", 3), ("b", 4)):
        mine = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= longest and all(r.taken <= 2 * r["size"] for r in mine)
    want = Counter((r.doc_id, r.source) for r in got for _ in range(r.copies))
    assert Counter((r.doc_id, r.source) for r in entropy_mix.repeat_rows(frame).collect()) == want
    assert sorted(map(str, entropy_mix.mix(frame.repartition(5)).collect())) == sorted(map(str, got))


def test_tilt_is_the_entropy_optimum(spark):
    """Of the rates that meet the target, the tilted ones change entropy least."""
    words = [3, 10, 25, 60, 200]
    total, goal = sum(words), 1.3 * sum(words)
    classes = spark.createDataFrame([((False, "a"), w, 1, total, goal) for w in words], "skey struct<none:boolean,name:string>, words bigint, n bigint, source_size bigint, target double")
    row = entropy_mix.tilts(classes).first()
    rate = np.array([2 / (1 + math.exp(-row.tilt * w / row.scale)) for w in words])
    assert abs(rate @ words - goal) < 1e-6 * goal

    def cost(r):
        return float((r * np.log(r) + (2 - r) * np.log(2 - r)).sum())

    rng = np.random.default_rng(0)
    for _ in range(200):
        other = rng.standard_normal(5)
        other -= (other @ words) / (np.array(words) @ words) * np.array(words)
        assert cost(rate + 0.01 * other / np.abs(other).max()) > cost(rate)


def test_repeated_rows_follow_the_mix(spark):
    frame = docs(spark)
    got = entropy_mix.repeat_rows(frame)
    assert got.columns == frame.columns
    want = Counter()
    for r in entropy_mix.mix(frame).collect():
        want[r.doc_id, r.source] += r.copies
    assert Counter((r.doc_id, r.source) for r in got.collect()) == +want


@pytest.mark.parametrize("known, own", [(None, None), (300, 100)])
def test_language_model_base_scores(spark, monkeypatch, known, own):
    """Also when most words are looked up by the join."""
    if known:
        monkeypatch.setattr(hmm_lm, "KNOWN", known)
        monkeypatch.setattr(hmm_lm, "OWN", own)
    frame = docs(spark).select("doc_id", "text").union(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text"))
    tokens = lambda t: [*(t or "").encode().lower().split(), b""]
    out = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1
    rows, count = frame.collect(), Counter()
    for r in rows:
        if not out(r.doc_id):
            count.update(tokens(r.text))
    n, v = sum(count.values()), len(count)
    want = Counter()
    for r in rows:
        t = tokens(r.text)
        base = sum(k * math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w, k in Counter(t).items())
        want[r.doc_id, out(r.doc_id), len(t), sum(count[w] > 0 for w in t), n, round(base, 4)] += 1
    got = hmm_lm.score(frame).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert hmm_lm.score(frame.limit(0)).count() == 0


def test_language_model_is_better_than_the_base(spark):
    got = QUERIES["op5_hmm_scoring"](spark, FOLDER).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def random_model(rng, symbols=6, states=3):
    norm = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    return hmm_lm.Model(norm(rng.random(states), 0), norm(rng.random((states, states)), 1), norm(rng.random((symbols, states)), 0))


def test_forward_equals_all_paths():
    import itertools

    rng = np.random.default_rng(4)
    m = random_model(rng)
    sizes = np.array([4, 1, 6, 3])
    flat, starts = rng.integers(0, 6, sizes.sum()), np.cumsum(sizes) - sizes
    got = hmm_lm.forward(flat, starts, sizes, m)
    for k, (s, n) in enumerate(zip(starts, sizes)):
        x, p = flat[s:s + n], 0.0
        for path in itertools.product(range(3), repeat=int(n)):
            q = m.start[path[0]] * m.emit[x[0], path[0]]
            for t in range(1, n):
                q *= m.move[path[t - 1], path[t]] * m.emit[x[t], path[t]]
            p += q
        assert math.isclose(got[k], math.log10(p), rel_tol=1e-9)


def test_expected_counts_equal_all_paths():
    import itertools

    rng = np.random.default_rng(5)
    m = random_model(rng)
    sizes = np.array([4, 2, 5])
    flat, starts = rng.integers(0, 6, sizes.sum()), np.cumsum(sizes) - sizes
    start, moves, emitted = hmm_lm.expected_counts(flat, starts, sizes, np.array([True] * 3), m)
    want = [np.zeros(3), np.zeros((3, 3)), np.zeros((6, 3))]
    for s, n in zip(starts, sizes):
        x, weights = flat[s:s + n], {}
        for path in itertools.product(range(3), repeat=int(n)):
            q = m.start[path[0]] * m.emit[x[0], path[0]]
            for t in range(1, n):
                q *= m.move[path[t - 1], path[t]] * m.emit[x[t], path[t]]
            weights[path] = q
        total = sum(weights.values())
        for path, q in weights.items():
            want[0][path[0]] += q / total
            for t in range(n):
                want[2][x[t], path[t]] += q / total
                if t:
                    want[1][path[t - 1], path[t]] += q / total
    for got, exact in zip((start, moves, emitted), want):
        assert np.allclose(got, exact, atol=1e-4)


def test_pipeline_stages(spark):
    columns = spark.read.parquet(f"{FOLDER}/documents.parquet").columns
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.stored(stage(spark, frame, FOLDER), name)
        assert after.columns == columns, name
        ids, new = {r.doc_id for r in frame.collect()}, {r.doc_id for r in after.collect()}
        assert new <= ids
        if name == "quality":
            assert {d for d in ids if labels.get(d) == 1} <= new and not {d for d in new if labels.get(d) == 0}
        if name == "near_duplicates":
            assert after.count() == len(new)
        if name == "surrogates":
            assert new == ids and after.filter("n_chars <> length(text)").count() == 0
        frame = after
    rows, _ = packed_rows(corpus_pipeline.STAGES[-1][1](spark, frame, FOLDER))
    assert Counter(r.doc_id for r in rows if r.piece == 0) == Counter(r.doc_id for r in frame.collect())


def test_pipeline_of_edge_rows(spark):
    frame = docs(spark, DOCS).select("doc_id", "text", "lang", "source").withColumn("n_chars", F.length("text").cast("bigint"))
    for start in (frame, frame.limit(0)):
        now = start
        for name, stage in corpus_pipeline.STAGES:
            now = corpus_pipeline.stored(stage(spark, now, FOLDER), name)
        now.count()


def test_texts_are_not_shuffled_to_meet_the_plan(spark, monkeypatch):
    """Whatever the planner's size check says, up to ``PLAN_ROWS`` classes; the rows are the same either way."""
    frame = docs(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = entropy_mix.repeat_rows(frame)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        monkeypatch.setattr(entropy_mix, "PLAN_ROWS", 0)
        assert sorted(map(str, entropy_mix.repeat_rows(frame).collect())) == sorted(map(str, got.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
