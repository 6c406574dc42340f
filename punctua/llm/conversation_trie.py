"""Trie of conversation prefixes, built by peeling turns off the ends.

A node is a distinct sequence of first turns.  Peeling goes from the greatest
depth up: conversations that end at a depth join the nodes that survive there,
every node loses its last turn, and what has become equal is merged.  A node is
complete when its depth is reached, so its counts, children, leaves and savings
are summed while it is found.

One round per depth would mean hundreds of shuffles, so whole subtrees are
peeled inside a task: those with at most ``SUBTREE`` different conversations first
(level 0), then the tree of what is left, cut in the same way (level 1, with at
most ``SUBTREE`` lowest nodes each), and so on.  The number of levels is the
logarithm of the number of conversations, whatever their length and however many
share a beginning.  Conversations that are equal as a whole are one from the start.

Prefixes are named by 128-bit sums of hashed (depth, turn) pairs, so a name needs
no walk along the conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from punctua.llm.common import stored
from punctua.operators.ordering import every, running

#: Different conversations below a node that one task peels.
SUBTREE = 4096
#: Turns of one conversation that meet in a task.
TURNS = 4096
#: Conversation ids that are joined to one text before hashing.
IDS = 65_536

#: Fixed values of the contract: conversations of one header, most header turns.
FAMILY, HEADERS = 100, 6

_NODE = ["depth", "hi", "lo"]
_EMPTY = hashlib.sha256(b"").hexdigest()


def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, x, y, chars): 1-based places of turns, a 120-bit digest of (role, text)
    and the text's code points.

    Turns go by ``turn``, NULL first, ties by role and text.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"))
    rows = rows.filter("conv_id IS NOT NULL")
    chunk = F.coalesce(every("turn", TURNS), F.lit(-(1 << 62)))
    rows = running(rows, ["conv_id"], ["turn", "role", "text"], {"pos": ("sum", F.lit(1).cast("bigint"))}, chunk, inclusive=True)
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    part = lambda at: F.conv(F.substring("digest", at, 15), 16, 10).cast("bigint")
    rows = rows.withColumn("digest", digest)
    return rows.select("conv_id", "pos", part(1).alias("x"), part(16).alias("y"), F.length("text").cast("bigint").alias("chars"))


def with_shared_headers(turns: DataFrame, family: int = FAMILY, headers: int = HEADERS) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: (conv_id, length), and their turns (conv_id, length, depth, x, y, chars).

    ``turns`` come from :func:`numbered`.  The first h turns of conversation c are those
    of c - c % family (h = crc32 of the decimal c, modulo ``headers``), as far as
    that has any; its own turns follow from the one after its first h.
    """
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    head = F.col("conv_id") - F.pmod("conv_id", F.lit(family))
    h = F.when(F.col("conv_id") == head, F.lit(0)).otherwise(F.crc32(F.col("conv_id").cast("string").cast("binary")) % headers)
    convs = convs.withColumns({"head": head, "h": h.cast("bigint")})
    heads = convs.select(F.col("conv_id").alias("head"), F.col("n").alias("head_n"))
    convs = convs.join(heads, "head", "left").withColumn("taken", F.least("h", F.coalesce("head_n", F.lit(0))))
    convs = convs.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = stored(convs.select("conv_id", "head", "h", "taken", "length"), "conversations")
    own = turns.join(convs, "conv_id").filter("pos > h").withColumn("depth", F.col("pos") - F.col("h") + F.col("taken"))
    first = turns.filter(F.col("pos") < headers).filter(F.pmod("conv_id", F.lit(family)) == 0).withColumnRenamed("conv_id", "head")
    lent = convs.filter("taken > 0").join(first, "head").filter("pos <= taken").withColumn("depth", F.col("pos"))
    cols = ["conv_id", "length", "depth", "x", "y", "chars"]
    return convs.select("conv_id", "length"), own.select(*cols).unionByName(lent.select(*cols))


def prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, depth, x, y, ...) with the prefix that ends there (hi, lo) and the one before (phi, plo)."""
    wide = lambda seed: F.xxhash64("depth", "x", "y", F.lit(seed)).cast("decimal(20,0)")
    rows = running(turns, ["conv_id"], ["depth"], {"phi": ("sum", wide(1)), "plo": ("sum", wide(2))}, every("depth", TURNS))
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("phi", "plo")})
    short = lambda value: F.pmod(value, F.lit(1 << 62).cast("decimal(20,0)")).cast("bigint")
    names = {"hi": short(F.col("phi") + wide(1)), "lo": short(F.col("plo") + wide(2))}
    rows = rows.withColumns(names).withColumns({"phi": short(F.col("phi")), "plo": short(F.col("plo"))})
    return rows.drop("x", "y")


def _peel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by subtree and falling depth to complete nodes.

    A row may add members, and says what its node's last turn and parent are.
    Only the nodes of one depth are held at a time.
    """
    names = ["depth", "hi", "lo", "phi", "plo", "chars", "n", "first", "kids", "leaves", "saved"]
    out: list[tuple] = []
    alive: dict[tuple, list] = {}
    place = None

    def strip() -> dict[tuple, list]:
        """Complete the nodes of the current depth and merge what is left without the last turn."""
        left: dict[tuple, list] = {}
        for (hi, lo), (phi, plo, chars, n, first, kids, leaves, saved) in alive.items():
            leaves, saved = leaves if kids else 1, saved + (n - 1) * chars
            out.append((place[3], hi, lo, phi, plo, first, n, kids, leaves, saved))
            node = left.get((phi, plo))
            if node is None:
                left[phi, plo] = [0, 0, 0, n, first, 1, leaves, saved]
            else:
                node[3] += n
                node[4] = min(node[4], first)
                node[5] += 1
                node[6] += leaves
                node[7] += saved
        return left

    def emit() -> pa.RecordBatch:
        columns = [pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 10
        out.clear()
        return pa.RecordBatch.from_arrays(columns, names=["depth", "hi", "lo", "phi", "plo", "first", "n", "kids", "leaves", "saved"])

    for batch in batches:
        roots = zip(*(batch.column(c).to_pylist() for c in ("root_depth", "root_hi", "root_lo")))
        for root, row in zip(roots, zip(*(batch.column(c).to_pylist() for c in names))):
            depth, hi, lo, phi, plo, chars, n, first, kids, leaves, saved = row
            now = (*root, depth)
            if now != place:
                # Depths of a subtree follow each other without a gap.
                alive = strip() if place is not None else {}
                if place is None or root != place[:3]:
                    alive = {}
                place = now
            node = alive.get((hi, lo))
            if node is None:
                alive[hi, lo] = [phi, plo, chars, n, first, kids, leaves, saved]
                continue
            node[:3] = phi, plo, chars
            if n:
                node[3] += n
                node[4] = first if node[4] is None else min(node[4], first)
                node[5] += kids
                node[6] += leaves
                node[7] += saved
        if len(out) > 1 << 14:
            yield emit()
    if place is not None:
        strip()
    yield emit()


def _digests(ends: DataFrame) -> DataFrame:
    """(depth, hi, lo, ends_sha256) of nodes with ended conversations.

    Ids are joined in bounded runs of the sorted order; a task reads the runs of a
    node one after the other and keeps only the state of the hash.
    """
    run = F.floor(F.col("conv_id") / F.lit(IDS)).alias("run")
    texts = ends.groupBy(*_NODE, run).agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    texts = texts.repartition(*_NODE).sortWithinPartitions(*_NODE, "run")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, rows = None, None, []

        def emit() -> pa.RecordBatch:
            parts = list(zip(*rows)) or [()] * 4
            rows.clear()
            kinds = [pa.int64()] * 3 + [pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(p, k) for p, k in zip(parts, kinds)], names=[*_NODE, "ends_sha256"])

        for batch in batches:
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*_NODE, "ids"))):
                if key == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    rows.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256(ids.encode())
            yield emit()
        if node is not None:
            rows.append((*node, state.hexdigest()))
        yield emit()

    return texts.mapInArrow(digest, "depth bigint, hi bigint, lo bigint, ends_sha256 string")


def _level(weight: Column, most: int) -> Column:
    """0 up to ``most``, 1 up to its square, and so on."""
    powers = [most ** k for k in range(1, 63) if most ** k < 1 << 62]
    return sum((F.when(weight > p, 1).otherwise(0) for p in powers), F.lit(0)).cast("int")


def _nodes(rows: DataFrame, ends: DataFrame, most: int) -> list[DataFrame]:
    """Complete nodes below the root, by level; see the module's text."""
    # Equal conversations are one: that with the smallest id stands for them.
    same = ends.filter("depth > 0").groupBy(*_NODE).agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"))
    rows = rows.join(same.select("conv_id", F.col("n").alias("copies")), "conv_id")
    rows = stored(rows, "different-conversations")
    heavy = rows.groupBy(*_NODE).agg(F.count(F.lit(1)).alias("w")).filter(F.col("w") > most)
    heavy = stored(heavy.select(*_NODE, _level(F.col("w"), most).alias("level")), "shared-prefixes")
    top = heavy.agg(F.max("level")).first()[0] or 0
    rows = rows.join(heavy, _NODE, "left").fillna(0, ["level"])
    root = rows.groupBy("conv_id", "level").agg(F.min(F.struct(*_NODE)).alias("root"))
    rows = rows.join(root, ["conv_id", "level"])
    here = F.col("depth") == F.col("length")
    none = F.lit(0).cast("bigint")
    rows = rows.select(
        "level", *[F.col(f"root.{c}").alias(f"root_{c}") for c in _NODE], *_NODE, "phi", "plo", "chars",
        F.when(here, F.col("copies")).otherwise(none).alias("n"), F.when(here, F.col("conv_id")).alias("first"),
    )
    rows = stored(rows, "paths")
    done: list[DataFrame] = []
    schema = "depth bigint, hi bigint, lo bigint, phi bigint, plo bigint, first bigint, n bigint, kids bigint, leaves bigint, saved bigint"
    for level in range(top + 1):
        now = rows.filter(F.col("level") == level).drop("level")
        sums = {"kids": none, "leaves": none, "saved": none}
        if level == 0:
            now = now.withColumns(sums)
        else:
            # Many conversations run through these nodes, and lower levels end at them.
            below = done[0]
            for more in done[1:]:
                below = below.unionByName(more)
            given = below.groupBy((F.col("depth") - 1).alias("depth"), F.col("phi").alias("hi"), F.col("plo").alias("lo")).agg(
                F.sum("n").alias("n2"), F.min("first").alias("first2"), F.count(F.lit(1)).alias("kids"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
            )
            now = now.groupBy(*[c for c in now.columns if c not in ("n", "first")]).agg(F.sum("n").alias("n"), F.min("first").alias("first"))
            # Only what hangs from nodes of this level; children inside it come by peeling.
            inside = now.select("depth", "hi", "lo")
            now = now.join(given.join(inside, _NODE, "left_semi"), _NODE, "left")
            now = now.withColumns({**{c: F.coalesce(c, none) for c in sums}, "n": F.col("n") + F.coalesce("n2", none), "first": F.least("first", "first2")}).drop("n2", "first2")
        by = ["root_depth", "root_hi", "root_lo"]
        peeled = now.repartition(*by).sortWithinPartitions(*by, F.desc("depth")).mapInArrow(_peel, schema)
        done.append(stored(peeled, "nodes"))
    return done


def trie(turns: DataFrame, family: int = FAMILY, headers: int = HEADERS, most: int = SUBTREE) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` has conv_id, turn, role and text.  Conversations are rebuilt by
    :func:`with_shared_headers` first (``headers=1`` leaves them as they are).

    NULL roles and texts are empty; turns go by ``turn``, NULL first, ties by role
    and text, and repeated rows are turns of their own.  A row without conv_id
    belongs to no conversation.  Texts count whole, other columns are ignored.  An
    empty table has no conversation and so no node.
    """
    if most < 2:
        raise ValueError("a subtree needs room for two conversations")
    convs, rebuilt = with_shared_headers(stored(numbered(turns), "turns"), family, headers)
    rows = stored(prefixes(rebuilt), "prefixes")
    zero = F.lit(0).cast("bigint")
    last = rows.filter("depth = length").select("conv_id", *_NODE)
    ends = last.unionByName(convs.filter("length = 0").select("conv_id", *[zero.alias(c) for c in _NODE]))
    ends = stored(ends, "ends")
    whole = _nodes(rows, ends, most)
    nodes = whole[0]
    for more in whole[1:]:
        nodes = nodes.unionByName(more)
    # The root: nodes of depth 1 without their turn, and conversations without turns.
    bare = ends.filter("depth = 0").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first")).first()
    ones = nodes.filter("depth = 1").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.count(F.lit(1)).alias("kids"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")).first()
    smallest = min((v for v in (bare.first, ones.first) if v is not None), default=None)
    root = [] if smallest is None else [(0, 0, 0, None, smallest, bare.n + (ones.n or 0), ones.kids, ones.leaves or 1, ones.saved or 0)]
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("hi").alias("phi"), F.col("lo").alias("plo"), F.col("first").alias("parent"))
    deep = nodes.filter("depth > 1").join(parents, ["depth", "phi", "plo"])
    shallow = nodes.filter("depth = 1").withColumn("parent", F.lit(smallest).cast("bigint"))
    cols = [*_NODE, "parent", "first", "n", "kids", "leaves", "saved"]
    top = turns.sparkSession.createDataFrame(root, ", ".join(f"{c} bigint" for c in cols))
    out = top.unionByName(shallow.select(*cols)).unionByName(deep.select(*cols)).join(_digests(ends), _NODE, "left")
    return out.select(
        F.col("first").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("kids").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
    )
