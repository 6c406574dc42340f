"""Language model scores from a hidden Markov model.

States emit symbols: the most frequent words, and classes that share the rest.
A word of a class then has its own share of the class, from its count, so every
word has a probability,

    P(word | state) = P(symbol | state) * P(word | symbol).

1. Words are counted over all training documents.
2. Texts are written once as symbol numbers, with the words outside the table of
   frequent words beside them.
3. Baum-Welch: tasks compute expected counts of their documents, one grouped sum
   per symbol adds them up, a few rounds.  Documents are cut into segments for
   training; a later segment starts from the stationary distribution.
4. Scoring runs the scaled forward recursion over whole documents, uncut.  The
   other words find their counts by a join.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from punctua.llm.common import stored

#: Hidden states, rounds of Baum-Welch, tokens per training segment.
STATES, ROUNDS, SEGMENT = 8, 3, 128
#: Words with an emission of their own, classes of the other words, and words
#: whose counts every task knows: tables of fixed size.
OWN, CLASSES, KNOWN = 16_384, 256, 131_072
#: Documents and symbols that the initial guess of the states looks at.
GUESS_DOCS, GUESS_SYMBOLS = 2_000, 512
#: Weight of the overall distribution in each state's emissions, in tokens.
PRIOR = 200.0
#: The end of a text; words are never empty.
END = b""
#: Fixed values of the contract.
FOLDS, HELD_OUT = 5, 1
_FLUSH = 400_000
_BATCH = 4096
#: Texts turned into symbols at a time.
_ROWS = 1000


def word_class(word: bytes) -> int:
    """Class of a word without an own symbol, by its ending."""
    return zlib.crc32(word[-2:]) % CLASSES


def _tokens(text: bytes | None) -> list[bytes]:
    return [*(text or b"").lower().split(), END]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["token", "n"])
        seen.clear()
        return out

    for batch in batches:
        for text in batch.column(0).cast(pa.large_binary()):
            seen.update(_tokens(text.as_py()))
        if len(seen) > _FLUSH:
            yield flush()
    yield flush()


def token_counts(texts: DataFrame) -> DataFrame:
    """(token, n) over all ``texts`` (one column); each task adds up its own first."""
    return texts.mapInArrow(_count, "token binary, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Frequent words with their symbols and probabilities; sizes are fixed bounds."""

    number: dict[bytes, int]  # word -> place in the arrays below
    symbol: np.ndarray
    base: np.ndarray  # log10 of the base model
    inside: np.ndarray  # log10 P(word | symbol)
    symbols: int
    mass: np.ndarray  # overall distribution of symbols
    total: int
    distinct: int
    class_n: np.ndarray
    class_v: np.ndarray

    def base_log(self, c):
        return np.log10((c + 0.5) / (self.total + 0.5 * (self.distinct + 1)))


def vocabulary(counts: DataFrame) -> Vocabulary:
    total, distinct = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    # Words more frequent than a quantile of the counts, so that no task sends more than its part.
    rank = 1 - KNOWN / distinct if distinct > KNOWN else 0.0
    least = counts.agg(F.percentile_approx("n", rank, 100_000)).first()[0] if rank else 0
    often = counts.filter(F.col("n") > least).orderBy(F.desc("n"), "token").limit(KNOWN)
    top = [(bytes(r["token"]), r["n"]) for r in often.collect()]
    end = counts.filter(F.length("token") == 0).first()
    words = [(END, end["n"] if end else 0)] + [t for t in top if t[0] != END]
    own = words[:OWN]
    c = np.array([n for _, n in words], np.float64)
    # All words that are not their own symbol, by class.
    in_class = counts.join(F.broadcast(counts.sparkSession.createDataFrame([(bytearray(w),) for w, _ in own], "token binary")), "token", "left_anti")
    ending = F.pmod(F.crc32(F.expr("substring(token, greatest(length(token) - 1, 1), 2)")), F.lit(CLASSES)).alias("g")
    sums = in_class.groupBy(ending).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()  # at most CLASSES rows
    class_n, class_v = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in sums:
        class_n[r["g"]], class_v[r["g"]] = r["n"], r["v"]
    place = np.arange(len(words))
    classes = np.array([word_class(w) for w, _ in words])
    symbol = np.where(place < len(own), place, len(own) + classes)
    mass = np.concatenate([c[: len(own)], class_n]) + 0.5
    out = Vocabulary({w: i for i, (w, _) in enumerate(words)}, symbol.astype(np.int32), np.empty(0), np.empty(0), len(own) + CLASSES, mass / mass.sum(), int(total or 0), int(distinct or 0), class_n, class_v)
    out.base = out.base_log(c)
    out.inside = np.where(place < len(own), 0.0, np.log10((c + 0.5) / (class_n[classes] + 0.5 * (class_v[classes] + 1))))
    return out


def encode(rows: DataFrame, vocab: Vocabulary) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, base, inside, ids, rare) per row of (doc_id, held_out, text).

    ``ids`` are symbols; ``n_known``, ``base`` and ``inside`` add up the words of
    the table, ``rare`` are the others with how often they occur.
    """
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(vocab)  # at most KNOWN words

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        get, own = v.number.get, v.symbols - CLASSES
        kind = pa.list_(pa.struct([("token", pa.binary()), ("tf", pa.int32())]))
        for batch in (b.slice(at, _ROWS) for b in batches for at in range(0, b.num_rows, _ROWS)):
            cols: list[list] = [[] for _ in range(6)]
            for text in batch.column(2).cast(pa.large_binary()):
                tokens = _tokens(text.as_py())
                at = np.fromiter((get(t, -1) for t in tokens), np.int32, len(tokens))
                known = at[at >= 0]
                ids = v.symbol[at]
                far: list[dict] = []
                if len(known) < len(tokens):
                    where = np.nonzero(at < 0)[0].tolist()
                    rare = Counter(tokens[i] for i in where)
                    group = {t: own + word_class(t) for t in rare}
                    ids[where] = [group[tokens[i]] for i in where]
                    far = [{"token": t, "tf": n} for t, n in rare.items()]
                for col, value in zip(cols, (len(tokens), len(known), float(v.base[known].sum()), float(v.inside[known].sum()), ids, far)):
                    col.append(value)
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.int32()), kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, cols, kinds)], names=["doc_id", "held_out", "n_tokens", "n_known", "base", "inside", "ids", "rare"])

    return rows.select("doc_id", "held_out", "text").mapInArrow(
        coded, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, inside double, ids array<int>, rare array<struct<token:binary,tf:int>>"
    )


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # symbols x states

    def stationary(self) -> np.ndarray:
        now = np.full(len(self.start), 1 / len(self.start))
        for _ in range(500):
            now = now @ self.move
        return now / now.sum()


def first_guess(coded: DataFrame, vocab: Vocabulary) -> Model:
    """States started from groups of similar documents, of a bounded sample.

    Only where Baum-Welch starts depends on the sample; all it learns comes from
    all training documents.
    """
    drawn = F.xxhash64("doc_id", "n_tokens")
    total = coded.count()
    # Rows above a hash that leaves slightly more than wanted go in place, so that all
    # tasks together, and not each of them, send about GUESS_DOCS documents.
    share = (GUESS_DOCS + 8 * GUESS_DOCS**0.5 + 64) / max(total, 1)
    near = coded.filter(drawn < int(2**64 * share) - 2**63) if share < 1 else coded
    sample = near.orderBy(drawn, "doc_id").select("ids").limit(GUESS_DOCS).collect()
    if len(sample) < min(GUESS_DOCS, total):  # many equal hashes above the cut
        sample = coded.orderBy(drawn, "doc_id").select("ids").limit(GUESS_DOCS).collect()
    wide = min(GUESS_SYMBOLS, vocab.symbols)
    x = np.array([np.bincount(np.minimum(r["ids"], wide), minlength=wide + 1)[:wide] for r in sample], np.float64).reshape(-1, wide)
    x = np.log1p(x)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    emit = np.tile(vocab.mass[:, None], (1, STATES))
    if len(x):
        centers = [x.mean(axis=0)]
        for _ in range(STATES - 1):  # the document farthest from all centers
            centers.append(x[np.argmin(np.max(x @ np.array(centers).T, axis=1))])
        centers = np.array(centers)
        for _ in range(20):
            group = np.argmax(x @ centers.T, axis=1)
            for k in range(STATES):
                if (group == k).any():
                    centers[k] = x[group == k].mean(axis=0)
            centers /= np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-9)
        for k in range(STATES):
            seen = np.bincount(np.concatenate([np.asarray(sample[i]["ids"]) for i in np.nonzero(group == k)[0]] or [np.zeros(0, int)]).astype(int), minlength=vocab.symbols)
            emit[:, k] = _normal(seen + PRIOR * vocab.mass)
    stay = 0.95
    move = np.full((STATES, STATES), (1 - stay) / max(STATES - 1, 1))
    np.fill_diagonal(move, stay)
    return Model(np.full(STATES, 1 / STATES), move, emit)


def _normal(x: np.ndarray) -> np.ndarray:
    return x / x.sum()


def expected_counts(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, opening: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected (start, move, emission) counts of segments ``flat[s : s + n]``.

    ``opening`` tells which segments begin a document.  Segments are sorted by
    length, so that step t works on the first of them only.
    """
    order = np.argsort(-sizes, kind="stable")
    starts, sizes, opening = starts[order], sizes[order], opening[order]
    move, emit = model.move.astype(np.float32), model.emit.astype(np.float32)
    first = np.where(opening[:, None], model.start, model.stationary()).astype(np.float32)
    longest, states = int(sizes[0]), len(model.start)
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")  # segments longer than t
    alphas, scales = [], []
    for t in range(longest):
        n = active[t]
        prior = first if t == 0 else alphas[-1][:n] @ move
        a = prior * emit[flat[starts[:n] + t]]
        c = np.maximum(a.sum(axis=1, keepdims=True), np.float32(1e-30))
        alphas.append(a / c)
        scales.append(c)
    moves, beta = np.zeros((states, states)), np.ones_like(first)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        if t + 1 < longest and active[t + 1]:
            m = active[t + 1]
            ahead = emit[flat[starts[:m] + t + 1]] * beta[:m] / scales[t + 1]
            moves += alphas[t][:m].T @ ahead
            beta[:m] = ahead @ move.T
        alphas[t] *= beta[:n]
    symbols = np.concatenate([flat[starts[: active[t]] + t] for t in range(longest)])
    gamma = np.concatenate(alphas)
    emitted = np.stack([np.bincount(symbols, weights=gamma[:, k], minlength=len(emit)) for k in range(states)], axis=1)
    return alphas[0][opening].sum(axis=0, dtype=np.float64), moves * model.move, emitted


def baum_welch(coded: DataFrame, vocab: Vocabulary, model: Model) -> Model:
    """One round over the training documents in ``coded``."""
    spark, states, symbols = coded.sparkSession, STATES, vocab.symbols
    shared = spark.sparkContext.broadcast(model)  # symbols x states numbers

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((symbols + states + 1, states))
        for batch in batches:
            for flat, starts, sizes, opening in _segments(batch.column(0)):
                start, moves, emitted = expected_counts(flat, starts, sizes, opening, shared.value)
                total[:symbols] += emitted
                total[symbols:symbols + states] += moves
                total[-1] += start
        some = np.nonzero(total.sum(axis=1))[0]
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *(pa.array(total[some, k]) for k in range(states))], names=["place", *(f"e{k}" for k in range(states))])

    parts = coded.select("ids").mapInArrow(expect, "place int, " + ", ".join(f"e{k} double" for k in range(states)))
    sums = parts.groupBy("place").agg(*[F.sum(f"e{k}").alias(f"e{k}") for k in range(states)]).collect()  # at most symbols + states + 1 rows
    total = np.zeros((symbols + states + 1, states))
    for r in sums:
        total[r[0]] = r[1:]
    move = total[symbols:symbols + states] + 0.1
    return Model(_normal(total[-1] + 0.1), move / move.sum(axis=1, keepdims=True), (total[:symbols] + PRIOR * vocab.mass[:, None]) / (total[:symbols].sum(axis=0) + PRIOR))


def _segments(ids: pa.ListArray) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of at most ``SEGMENT`` symbols: (flat, starts, sizes, opening), in batches."""
    flat = ids.flatten().to_numpy(zero_copy_only=False)
    lengths = ids.value_lengths().to_numpy(zero_copy_only=False)
    begins = np.cumsum(lengths) - lengths
    pieces = -(-lengths // SEGMENT)
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = np.repeat(begins, pieces) + nth * SEGMENT
    sizes = np.minimum(np.repeat(lengths, pieces) - nth * SEGMENT, SEGMENT)
    for at in range(0, len(starts), _BATCH):
        part = slice(at, at + _BATCH)
        yield flat, starts[part], sizes[part], nth[part] == 0


def forward(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, model: Model) -> np.ndarray:
    """log10 likelihood of each whole sequence, by the scaled forward recursion."""
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    out, alpha = np.zeros(len(sizes)), np.tile(model.start, (len(sizes), 1))
    active = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), side="left")
    for t, n in enumerate(active):
        alpha = (alpha if t == 0 else alpha[:n] @ model.move) * model.emit[flat[starts[:n] + t]]
        c = alpha.sum(axis=1)
        alpha /= c[:, None]
        out[:n] += np.log10(c)
    back = np.empty_like(out)
    back[order] = out
    return back


def likelihoods(coded: DataFrame, model: Model) -> DataFrame:
    """``coded`` without ids and rare words, with ``path``: log10 P of the symbols."""
    shared = coded.sparkSession.sparkContext.broadcast(model)
    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "inside"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            lengths = ids.value_lengths().to_numpy(zero_copy_only=False)
            path = forward(ids.flatten().to_numpy(zero_copy_only=False), np.cumsum(lengths) - lengths, lengths, shared.value)
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(path)], names=[*names, "path"])

    return coded.select(*names, "ids").mapInArrow(score, "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, inside double, path double")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    A NULL text is empty: its only token is the end.  A NULL doc_id is not held
    out.  Repeated rows count and are scored one by one.  Without training
    documents every word is unknown.  Other columns are ignored; an empty table
    gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("held_out", held_out(F.col("doc_id")))
    counts = stored(token_counts(rows.filter("NOT held_out").select("text")), "counts")
    vocab = vocabulary(counts)
    coded = stored(encode(rows, vocab).withColumn("row", F.monotonically_increasing_id()), "coded")
    train = coded.filter("NOT held_out")
    model = first_guess(train, vocab)
    for _ in range(ROUNDS):
        model = baum_welch(train, vocab, model)
    # The words no task knows: their counts come by a join.
    rare = coded.select("row", F.explode("rare").alias("r")).select("row", "r.token", "r.tf")
    group = F.pmod(F.crc32(F.expr("substring(token, greatest(length(token) - 1, 1), 2)")), F.lit(CLASSES)).cast("int")
    c = F.coalesce(F.col("n"), F.lit(0)) + 0.5
    below = F.lit(float(vocab.total + 0.5 * (vocab.distinct + 1)))
    room = F.element_at(F.lit((vocab.class_n + 0.5 * (vocab.class_v + 1)).tolist()), group + 1)
    far = rare.join(counts, "token", "left").groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("tf")).otherwise(0)).alias("far_known"),
        F.sum(F.col("tf") * F.log10(c / below)).alias("far_base"), F.sum(F.col("tf") * F.log10(c / room)).alias("far_inside"),
    )
    out = likelihoods(coded, model).join(far, "row", "left")
    zero = F.lit(0.0)
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("far_known", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(vocab.total).cast("bigint").alias("train_tokens"), (F.col("base") + F.coalesce("far_base", zero)).alias("base_score"),
        (F.col("path") + F.col("inside") + F.coalesce("far_inside", zero)).alias("score"),
    )
