"""Near duplicates by SimHash: pigeonring candidates, exact Hamming check.

64-bit fingerprints link at ``MOST`` or fewer differing bits.  Equal
fingerprints are one node, so copies are never paired.  Links are found in two
steps:

1. Fingerprints that differ in one bit: they agree once that bit is masked, and
   a masked value has at most two owners.  Only fingerprints that share one
   half with another take part.  This contracts dense groups of near copies.
2. The other links, between different contracted groups, by the pigeonring: of
   four ring segments some start is such that every chain of consecutive
   segments from it stays within its share of the differing bits: 0 bits in the
   first segment, 1 in two, 2 in three, 3 in all.  The first two are the join
   key (the second segment with every single flip), the third and the full
   distance are checked in the join itself.

Step 2 skips pairs that step 1 has already connected; they can add no new
connection.  The result is the same as from all links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from punctua.llm.common import stored
from punctua.llm.components import components

#: Differing bits at which two fingerprints still link.
MOST = 3
SHINGLE_WORDS = 3
#: Seed of the contract's hash.
HASH_SEED = 42
_BLOCK = 1 << 16
#: Hint of the joins with a side of several rows per document or fingerprint, or of
#: well compressed ones.  The planner sizes it by the file it came from, before the
#: rows were multiplied, and would send it through the driver.
SORTED = "merge"


def fingerprint(text: bytes | None) -> int:
    """SimHash of one text (UTF-8); 0 without a word."""
    found = (text or b"").lower().split()
    if not found:
        return 0
    n = max(1, len(found) - SHINGLE_WORDS + 1)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    line = b" ".join(found)
    last = ends[min(SHINGLE_WORDS, len(found)) - 1:] - 1
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):
        pieces = [line[i:j] for i, j in zip(starts[at:min(n, at + _BLOCK)].tolist(), last[at:at + _BLOCK].tolist())]
        h = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(HASH_SEED)), np.uint64, len(pieces))
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little").tobytes()
    return int.from_bytes(bits, "little", signed=True)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary())
        prints = pa.array((fingerprint(t.as_py()) for t in texts), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), prints], names=["doc_id", "print"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, print) per row; ``print`` is the fingerprint as a signed long."""
    pairs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return pairs.mapInArrow(_fingerprints, "doc_id bigint, print bigint")


def one_bit_links(prints: DataFrame) -> DataFrame:
    """(a, b) for distinct fingerprints ``print`` that differ in one bit."""
    low = F.lit(0xFFFFFFFF)
    half = F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.shiftrightunsigned("print", 32).alias("half")),
        F.struct(F.lit(1).alias("side"), F.col("print").bitwiseAND(low).alias("half")),
    ))
    halves = prints.select("print", half.alias("h")).select("print", "h.side", "h.half")
    shared = halves.groupBy("side", "half").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("side", "half")
    near = halves.hint(SORTED).join(shared, ["side", "half"])
    # The half that is shared stays, each bit of the other one is masked.
    bit = near.select("side", "print", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("k"))
    flip = F.expr("shiftleft(CAST(1 AS BIGINT), CAST(k + IF(side = 0, 0, 32) AS INT))")
    owners = bit.select("side", "k", F.col("print").bitwiseAND(F.bitwise_not(flip)).alias("masked"), "print")
    pair = owners.groupBy("side", "k", "masked").agg(F.min("print").alias("a"), F.max("print").alias("b"))
    return pair.filter("a <> b").select("a", "b")


def ring_links(prints: DataFrame, most: int = MOST) -> DataFrame:
    """(a, b) for fingerprints within ``most`` (at most 3) bits whose ``group`` differs.

    ``prints`` has ``print`` (distinct) and ``group``.
    """
    if most > MOST:
        raise ValueError("four segments serve up to three differing bits")
    turns = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), _rotate(F.col("print"), 16 * i).alias("ring")) for i in range(4)]))
    rings = prints.select("group", turns.alias("t")).select("group", F.col("t.i").alias("i"), F.col("t.ring").alias("ring"))
    key = F.shiftrightunsigned("ring", 32)
    flips = F.explode(F.array(*[F.lit(0).cast("bigint")] + [F.lit(1 << k).cast("bigint") for k in range(16)]))
    x = rings.select("i", F.col("ring").alias("x"), F.col("group").alias("gx"), flips.alias("f"))
    x = x.select("i", "x", "gx", F.shiftrightunsigned("x", 32).bitwiseXOR(F.col("f")).alias("key"))
    y = rings.select("i", F.col("ring").alias("y"), F.col("group").alias("gy"), key.alias("key"))
    differ = F.col("x").bitwiseXOR(F.col("y"))
    near = (F.bit_count(F.shiftrightunsigned(differ, 16)) <= 2) & (F.bit_count(differ) <= most)
    same = (x["i"] == y["i"]) & (x["key"] == y["key"])
    pairs = x.hint(SORTED).join(y, same & (F.col("gx") < F.col("gy")) & near)
    back = [F.coalesce(*[F.when(x["i"] == i, _rotate(F.col(c), 64 - 16 * i)) for i in range(4)]) for c in ("x", "y")]
    return pairs.select(back[0].alias("a"), back[1].alias("b")).distinct()


def _rotate(value: Column, by: int) -> Column:
    by %= 64
    return F.shiftleft(value, by).bitwiseOR(F.shiftrightunsigned(value, 64 - by)) if by else value


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits) and component_id,
    the smallest doc_id reachable over links, its own included.

    A NULL text has no words, like an empty one: fingerprint 0, linked like any
    other.  Rows with a repeated doc_id are separate rows of that id.  A NULL
    doc_id takes part and gets its component's smallest id, NULL if no member
    has one.  Other columns are ignored; an empty table gives an empty result.
    """
    rows, groups = _grouped(docs, id_col, text_col, most)
    out = rows.hint(SORTED).join(groups.select("print", "component_id"), "print")
    return out.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def _grouped(docs: DataFrame, id_col: str, text_col: str, most: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, print) per row, and (print, component, component_id) per distinct fingerprint."""
    rows = stored(fingerprints(docs, id_col, text_col), "prints")
    prints = stored(rows.groupBy("print").agg(F.min("doc_id").alias("first_id")), "distinct-prints")
    dense = components(one_bit_links(prints)).select(F.col("node").alias("print"), "component")
    grouped = stored(prints.join(dense, "print", "left").withColumn("group", F.coalesce("component", "print")).drop("component"), "dense-groups")
    links = ring_links(grouped, most)
    # The contracted groups are the nodes of the second contraction.
    a = grouped.select(F.col("print").alias("a"), F.col("group").alias("ga"))
    b = grouped.select(F.col("print").alias("b"), F.col("group").alias("gb"))
    between = links.join(a, "a").join(b, "b").select(F.col("ga").alias("a"), F.col("gb").alias("b"))
    joined = components(between).withColumnRenamed("node", "group")
    full = grouped.join(joined, "group", "left").withColumn("component", F.coalesce("component", "group"))
    full = stored(full.select("print", "first_id", "component"), "components")
    first = full.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return rows, full.join(first, "component").select("print", "component", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST) -> DataFrame:
    """``docs`` with one row per group of near duplicates: that with the smallest id.

    A row stays by its id and fingerprint together, so an id that is repeated with
    other texts loses none of their groups; of equal ones in both, one stays.  Rows
    without an id stay only where no member of the group has one, again one per
    group.  A NULL text is an empty one, other columns are kept as they are, and an
    empty table gives an empty result.
    """
    rows, groups = _grouped(docs, id_col, text_col, most)
    known = rows.hint(SORTED).join(groups, "print").filter("doc_id IS NOT NULL")
    # The survivor of a group: its smallest id and, of that, the smallest fingerprint.
    best = known.filter("doc_id = component_id").groupBy("component").agg(F.min("doc_id").alias("doc_id"), F.min("print").alias("print"))
    best = stored(best.select("doc_id", "print"), "survivors")
    ids = known.groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("stays"), F.count(F.lit(1)).alias("n"))
    ids = stored(ids, "ids")
    key = F.col(id_col).cast("bigint")
    # The ids that go are few against those that stay, so theirs is the side to look up.
    gone = stored(ids.filter("NOT stays OR n > 1").select(F.col("doc_id").alias("__gone")), "gone")
    out = docs.filter(key.isNotNull()).join(gone, key == F.col("__gone"), "left_anti")
    with_print = lambda some: some.withColumn("__print", F.pandas_udf(_prints, "bigint")(F.col(text_col).cast("string")))
    if ids.filter("stays AND n > 1").take(1):
        repeated = ids.filter("stays AND n > 1").select(F.col("doc_id").alias("__id"))
        chosen = best.select(F.col("doc_id").alias("__id"), F.col("print").alias("__print"))
        again = with_print(docs.filter(key.isNotNull()).withColumn("__id", key).join(repeated, "__id", "left_semi"))
        out = out.unionByName(again.join(chosen, ["__id", "__print"], "left_semi").dropDuplicates(["__id", "__print"]).drop("__id", "__print"))
    bare = groups.filter("component_id IS NULL").groupBy("component").agg(F.min("print").alias("__print"))
    bare = stored(bare.select("__print"), "kept-bare")
    if bare.take(1):
        marked = with_print(docs.filter(key.isNull()))
        out = out.unionByName(marked.join(bare, "__print", "left_semi").dropDuplicates(["__print"]).drop("__print"))
    return out


def _prints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(None if t is None else t.encode()) for t in texts], dtype="int64")
