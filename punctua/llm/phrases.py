"""Collocations from a weighted de Bruijn graph of words.

Nodes are pairs of neighbouring words, edges the longest grams (three words),
each linking the two pairs it overlaps; all per language.  Every word position
of a piece adds one longest gram: three words, or two where only their pair is
frequent or the piece ends, or one.  Shorter counts follow from that: a node
occurs as often as its edges leave it plus the times a piece ends with it, and a
word as often as the nodes it opens plus the times it stands last.

Nearly all edges of a corpus are too rare to matter, so their hashes are counted
first and the frequent ones marked in two bitmaps of fixed size.  The marks
decide only how much of a rare gram is written out; a mark too many costs a
row, and every count is exact.

Paths whose inner nodes have one way in and out are then joined to passages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from punctua.llm.common import stored

#: Occurrences below which a phrase is no candidate.
LEAST = 10
#: Phrases returned per language.
TOP = 2000
#: Share (per cent) of a phrase's occurrences that a longer one may cover.
COVERED = 50
#: Bits of each bitmap: 16 MB, whatever the corpus.
BITS = 1 << 27
#: Bytes cut into words at once.
SLICE = 1 << 20
#: Words a worker numbers before it starts anew.  With those of one more slice
#: they stay below 2^21, as grams are keyed by 3 x 21 bits.
NUMBERED = 1 << 20
#: Distinct grams a task combines before it hands them on.
COMBINED = 1 << 21

#: Fixed values of the contract: where pieces end, and lower case of A-Z.
_PIECES = bytes.maketrans(b".,;:!?\x0b\x0c\rABCDEFGHIJKLMNOPQRSTUVWXYZ\t", b"\n" * 9 + b"abcdefghijklmnopqrstuvwxyz ")

#: Where a slice may end, and the words behind it that its last grams need.
_CUT = re.compile(rb"[ \n]")
_NEXT_TWO = re.compile(rb"(?: *[^ \n]+){0,2}")

_M1, _M2, _M3 = (np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_S = np.uint64(29)


class _Numbers(dict):
    """Word to number; 0 ends a piece, 1 is no word."""

    def __init__(self):
        super().__init__({b"\n": 0, b"": 1})
        self.words = [b"", b""]

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.words)
        self.words.append(word)
        return n


def _by_language(batch: pa.RecordBatch, size: int) -> Iterator[tuple[bytes, bytes, bytes]]:
    """(language, text, words behind it): whole texts of a batch, joined as pieces
    and cut again to about ``size`` bytes; the up to two words that follow inside a
    cut piece come along.
    """
    texts: dict[bytes, list[bytes]] = {}
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        texts.setdefault(lang, []).append(text.as_py())
    for lang, all_of in texts.items():
        text = b"\n".join(all_of).translate(_PIECES)
        at = 0
        while at < len(text):
            found = _CUT.search(text, at + size)
            end = found.start() if found else len(text)
            yield lang, text[at:end], _NEXT_TWO.match(text, end)[0]
            at = end


def _grams(numbers: _Numbers, text: bytes, behind: bytes) -> np.ndarray:
    """Rows (word, next, next but one) per position of ``text``; 0 where the piece has ended."""
    tokens, more = (part.replace(b"\n", b" \n ").split(b" ") for part in (text, behind))
    row, rest = (np.fromiter(map(numbers.__getitem__, part), np.int64, len(part)) for part in (tokens, more))
    row, rest = row[row != 1], rest[rest != 1]
    n = len(row)
    row = np.concatenate((row, rest, [0, 0]))
    a, b, c = row[:n], row[1:n + 1], row[2:n + 2]
    return np.stack((a, b, np.where(b == 0, 0, c)))[:, a != 0]


def _mix(h: np.ndarray, m: np.uint64) -> np.ndarray:
    h = h * m
    return h ^ (h >> _S)


class _Hashes:
    """Hashes of numbered words, extended as words come."""

    def __init__(self, numbers: _Numbers):
        self.numbers, self.h = numbers, np.zeros(0, np.uint64)

    def of(self, grams: np.ndarray, lang: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(node: 40 bits, edge: 24 bits, 0 for none) of grams."""
        words, have = self.numbers.words, len(self.h)
        if have < len(words):
            new = np.fromiter(map(xxhash.xxh3_64_intdigest, words[have:]), np.uint64, len(words) - have)
            self.h = np.concatenate((self.h, new))
        a, b, c = self.h[grams[0]], self.h[grams[1]], self.h[grams[2]]
        node = _mix(_mix(a + np.uint64(xxhash.xxh3_64_intdigest(lang)), _M1) + b, _M2)
        edge = (_mix(node + c, _M3) >> np.uint64(40)) | np.uint64(1)
        return (node >> np.uint64(24)).astype(np.int64), np.where(grams[2] == 0, 0, edge.astype(np.int64))


def _places(node: np.ndarray, edge: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bits of nodes and of edges in their bitmaps."""
    return node % bits, ((node * 40_503) ^ (edge * 2_654_435_761)) % bits


def _frequent(texts: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps that hold all nodes and all edges with ``least`` occurrences or more."""

    size, numbered, combined = SLICE, NUMBERED, COMBINED

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _Numbers()
        hashes = _Hashes(numbers)
        kept: list[np.ndarray] = []
        held = 0

        def out() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(kept), return_counts=True)
            kept.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys >> 24), pa.array((keys & 0xFFFFFF).astype("i4")), pa.array(n.astype("i4"))], names=["node", "edge", "n"])

        for batch in batches:
            for lang, text, behind in _by_language(batch, size):
                grams = _grams(numbers, text, behind)
                node, edge = hashes.of(grams[:, grams[1] != 0], lang)
                # Back to one signed number: the order of keys is of no interest.
                kept.append((node << 24) | edge)
                held += len(node)
                if held > 2 * combined:
                    yield out()
                    held = 0
                if len(numbers.words) > numbered:
                    numbers = _Numbers()
                    hashes = _Hashes(numbers)
        if kept:
            yield out()

    counts = texts.mapInArrow(count, "node bigint, edge int, n int").withColumn("node", F.shiftrightunsigned(F.shiftleft("node", 24), 24))
    edges = counts.repartition("node").groupBy("node", "edge").agg(F.sum("n").alias("n"))
    nodes = edges.groupBy("node").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("node", F.lit(0).alias("edge"))
    # Piece ends (edge 0) may mark their node once more.  A filter on ``edge`` here
    # would move before the shuffle, and the shuffle then be done for each side.
    marks = nodes.unionByName(edges.filter(F.col("n") >= least).select("node", "edge"))
    node_bit = F.pmod("node", F.lit(BITS))
    edge_bit = F.pmod((F.col("node") * 40_503).bitwiseXOR(F.col("edge").cast("bigint") * 2_654_435_761), F.lit(BITS))
    at = marks.select((F.col("edge") > 0).alias("e"), F.when(F.col("edge") > 0, edge_bit).otherwise(node_bit).alias("bit"))
    one = F.expr("shiftleft(CAST(1 AS BIGINT), CAST(bit % 64 AS INT))")
    # At most BITS / 64 rows of each kind, however many grams are frequent.
    words = at.groupBy("e", F.floor(F.col("bit") / 64).cast("int").alias("at")).agg(F.bit_or(one).alias("bits"))
    found = words.toArrow()
    maps = []
    for kind in (False, True):
        side = found.filter(pa.compute.equal(found.column("e"), kind))
        bits = np.zeros(BITS // 64, np.int64)
        bits[side.column("at").to_numpy()] = side.column("bits").to_numpy()
        maps.append(bits)
    return maps[0], maps[1]


def _has(bits: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (bits[place >> 6] >> (place & 63)) & 1 == 1


def longest_grams(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST) -> DataFrame:
    """(lang, w1, w2, w3, n): every word position counted once, by its longest gram.

    ``w3`` is empty where the pair ends its piece or the three words occur less
    than ``least`` times, ``w2`` where the word ends its piece or the pair is rare.
    (Some rare grams may be written out; their counts are exact as well.)
    """
    # A table without rows, NULL or empty texts has no grams.
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).cast("binary").alias("lang"), F.col(text_col).cast("string").cast("binary").alias("text"))
    texts = texts.filter(F.length("text") > 0)
    marks = spark.sparkContext.broadcast(_frequent(texts, least))
    size, numbered, combined, bits = SLICE, NUMBERED, COMBINED, BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, edges = marks.value
        numbers = _Numbers()
        hashes = _Hashes(numbers)
        kept: dict[bytes, list[np.ndarray]] = {}
        held = 0

        def out() -> Iterator[pa.RecordBatch]:
            words = pa.array(numbers.words, pa.binary())
            for lang, parts in kept.items():
                keys, n = np.unique(np.concatenate(parts), return_counts=True)
                for i in range(0, len(keys), 1 << 16):
                    part = keys[i:i + (1 << 16)]
                    columns = [words.take(pa.array(part >> shift & 0x1FFFFF)) for shift in (42, 21, 0)]
                    names = pa.array([lang] * len(part), pa.binary())
                    yield pa.RecordBatch.from_arrays([names, *columns, pa.array(n[i:i + (1 << 16)])], names=["lang", "w1", "w2", "w3", "n"])
            kept.clear()

        for batch in batches:
            for lang, text, behind in _by_language(batch, size):
                grams = _grams(numbers, text, behind)
                node, edge = _places(*hashes.of(grams, lang), bits)
                has_node = _has(nodes, node) & (grams[1] != 0)
                b = np.where(has_node, grams[1], 0)
                c = np.where(has_node & _has(edges, edge), grams[2], 0)
                kept.setdefault(lang, []).append(grams[0] << 42 | b << 21 | c)
                held += len(b)
                if held > 2 * combined or len(numbers.words) > numbered:
                    yield from out()
                    held = 0
                if len(numbers.words) > numbered:
                    numbers = _Numbers()
                    hashes = _Hashes(numbers)
        yield from out()

    rows = texts.mapInArrow(count, "lang binary, w1 binary, w2 binary, w3 binary, n bigint")
    rows = rows.groupBy("lang", "w1", "w2", "w3").agg(F.sum("n").alias("n"))
    return rows.select(*[F.col(c).cast("string").alias(c) for c in ("lang", "w1", "w2", "w3")], "n")


def graph(grams: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Edges (lang, w1, w2, w3, n), nodes (lang, w1, w2, n, most_in, most_out) and
    words (lang, w, n) of the graph, from the rows of :func:`longest_grams`.

    Edges and nodes have ``least`` occurrences or more; ``most_in`` and ``most_out``
    are the counts of a node's heaviest edges (0: none).
    """
    edges = grams.filter((F.col("w3") != "") & (F.col("n") >= least))
    # The node's flow: its edges, and the pieces (or rare edges) that end with it.
    nodes = grams.filter("w2 <> ''").groupBy("lang", "w1", "w2").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    words = grams.groupBy("lang", F.col("w1").alias("w")).agg(F.sum("n").alias("n"))
    none = F.lit(0).cast("bigint")
    ends = edges.select("lang", "w1", "w2", none.alias("i"), F.col("n").alias("o"))
    ends = ends.unionByName(edges.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), F.col("n").alias("i"), none.alias("o")))
    most = ends.groupBy("lang", "w1", "w2").agg(F.max("i").alias("most_in"), F.max("o").alias("most_out"))
    nodes = nodes.join(most, ["lang", "w1", "w2"], "left").fillna(0, ["most_in", "most_out"])
    return edges, nodes, words


def unary(n: Column) -> Column:
    """Whether a node (with :func:`graph`'s columns) has one way in and one way out."""
    return (F.col("most_in") == n) & (F.col("most_out") == n)


def passages(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(lang, w1, w2, w3, head, place): the path each edge lies on and its 0-based place.

    Two edges join where all occurrences of the node between them come in by the
    one and leave by the other.  ``head`` is the path's first edge (its words
    joined by spaces).  Such paths have an end, as the first pair of a piece has
    no edge before it.  Every round doubles the way an edge looks back, so the
    rounds are the logarithm of the longest path; each is stored.
    """
    name = F.concat_ws(" ", "w1", "w2", "w3")
    inner = nodes.filter(unary(F.col("n"))).select("lang", "w1", "w2")
    behind = edges.join(inner, ["lang", "w1", "w2"]).join(
        edges.select("lang", F.col("w1").alias("w0"), F.col("w2").alias("w1"), F.col("w3").alias("w2"), F.col("n").alias("before")), ["lang", "w1", "w2"]
    ).filter("before = n")
    behind = behind.select("lang", "w1", "w2", "w3", F.concat_ws(" ", "w0", "w1", "w2").alias("up"))
    now = edges.select("lang", "w1", "w2", "w3").join(behind, ["lang", "w1", "w2", "w3"], "left")
    now = now.select("lang", "w1", "w2", "w3", name.alias("name"), F.coalesce("up", name).alias("head"), F.col("up").isNotNull().cast("bigint").alias("place"))
    now = stored(now, "paths")
    while True:
        up = now.filter("place > 0").select("lang", F.col("name").alias("head"), F.col("head").alias("higher"), F.col("place").alias("more"))
        step = now.join(up, ["lang", "head"], "left")
        step = stored(step.select("lang", "w1", "w2", "w3", "name", F.coalesce("higher", "head").alias("head"), (F.col("place") + F.coalesce("more", F.lit(0))).alias("place"), F.col("more").isNotNull().alias("moved")), "paths")
        if not step.filter("moved").take(1):
            return step.drop("name", "moved")
        now = step.drop("moved")


def passage_texts(edges: DataFrame, places: DataFrame) -> DataFrame:
    """(lang, passage, n_words, n): the text of every path of :func:`passages`."""
    rows = places.join(edges, ["lang", "w1", "w2", "w3"])
    paths = rows.groupBy("lang", "head").agg(F.array_sort(F.collect_list(F.struct("place", "w3"))).alias("tail"), F.min_by(F.concat_ws(" ", "w1", "w2"), "place").alias("start"), F.max("n").alias("n"))
    text = F.concat_ws(" ", "start", F.concat_ws(" ", F.col("tail.w3")))
    return paths.select("lang", text.alias("passage"), (F.size("tail") + 2).cast("bigint").alias("n_words"), "n")


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (left right)), exact in decimals."""
    wide = "CAST({} AS DECIMAL(19,0))".format
    return F.expr(f"({wide(a)} * {wide(a)} * CAST(1000000 AS DECIMAL(7,0))) div ({wide(left)} * {wide(right)})")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP, covered: int = COVERED) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, passage_words) of the best phrases per language.

    ``a``, ``l`` and ``r`` are the occurrences of the phrase and of the two parts of its
    lowest-scoring cut, ``n`` the words of the language; ``passage_words`` is the
    length of the path a phrase of three words lies on (2 for pairs).  A phrase
    inside a longer candidate with ``covered`` per cent of its occurrences is left out.

    NULL and empty texts hold no words, a NULL language is ``und``; repeated rows
    count as often as they occur, texts are never cut, other columns are ignored.
    Ties go by count and then by the bytes of the phrase.  An empty table gives an
    empty result.
    """
    grams = stored(longest_grams(docs, text_col, lang_col, least), "grams")
    edges, nodes, words = graph(grams, least)
    edges, nodes, words = stored(edges, "edges"), stored(nodes, "nodes"), words.filter(F.col("n") >= least)
    places = passages(edges, nodes)
    lengths = places.groupBy("lang", "head").agg((F.max("place") + 3).alias("passage_words"))
    first, last = (words.select("lang", F.col("w").alias(w), F.col("n").alias(f"f_{w}")) for w in ("w1", "w3"))
    # Inner nodes of paths are covered by their edges anyway, and leave first.
    pairs = nodes.filter(~unary(F.col("n"))).filter(100 * F.greatest("most_in", "most_out") < covered * F.col("n"))
    pairs = pairs.join(first, ["lang", "w1"]).join(last.withColumnsRenamed({"w3": "w2", "f_w3": "f_w2"}), ["lang", "w2"])
    pairs = pairs.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("n").alias("a"), F.col("f_w1").alias("l"), F.col("f_w2").alias("r"), _score("n", "f_w1", "f_w2").alias("score"), F.lit(2).cast("bigint").alias("passage_words"))
    opening = nodes.select("lang", "w1", "w2", F.col("n").alias("f_12"))
    closing = nodes.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("n").alias("f_23"))
    threes = edges.join(opening, ["lang", "w1", "w2"]).join(closing, ["lang", "w2", "w3"]).join(first, ["lang", "w1"]).join(last, ["lang", "w3"])
    threes = threes.join(places, ["lang", "w1", "w2", "w3"]).join(lengths, ["lang", "head"])
    threes = threes.withColumns({"s1": _score("n", "f_w1", "f_23"), "s2": _score("n", "f_12", "f_w3")})
    early = F.col("s1") <= F.col("s2")
    threes = threes.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("n").alias("a"), F.when(early, F.col("f_w1")).otherwise(F.col("f_12")).alias("l"), F.when(early, F.col("f_23")).otherwise(F.col("f_w3")).alias("r"), F.least("s1", "s2").alias("score"), "passage_words")
    # Best of each of 64 parts first, so that no language meets in one task.
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = pairs.unionByName(threes).withColumn("__part", part)
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "__part").orderBy(*best))).filter(F.col("rank") <= top)
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("bigint")).filter(F.col("rank") <= top)
    total = grams.groupBy("lang").agg(F.sum("n").alias("n"))
    return some.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "passage_words")
