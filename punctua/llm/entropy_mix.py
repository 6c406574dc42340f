"""Mixing sources to target word counts by entropy balancing.

Of all rates per document that meet each source's word target and stay within
``MOST`` copies, the one closest to one copy each (in the entropy of a rate
between 0 and ``MOST``) is an exponential tilt of the document's size,

    rate = MOST / (1 + (MOST - 1) exp(-tilt * size)),

with one tilt per source.  The tilts solve a convex dual, by Newton steps inside
a bracket.  A rate depends on source and size only, so the steps run over counts
of (source, size); they sum inside the tasks and the tilts stay a table.

Rates become whole copies: along the sizes of a source the running sum of
copies is rounded, which leaves less than the largest document of words over or
missing; then single copies of fitting size are given or taken.  Within a size
the copies go to documents in a keyed order, up to the place of the last one,
which is found by rank.  A row then tells its copies from its own values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from punctua.llm.common import RANK_CHUNK, place, stored, words

#: Fixed values of the contract.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Newton stops when every source is this close (relative) to its target.
CLOSE = 1e-9
STEPS = 60
#: Classes (source and size) up to which the plan goes to every task, so that no
#: text is shuffled to meet it; with more, the planner's size check decides.
PLAN_ROWS = 1 << 17
#: Sums of decimals are exact, so reruns agree to the last bit.
EXACT = "decimal(38,10)"


def source_targets(sizes: DataFrame) -> DataFrame:
    """(skey, source_size, target) from ``skey`` (a struct: is NULL, source) and ``words``.

    ``SHARE`` of all words is split by weights in code point order, NULL last.
    No source gets more than ``MOST`` times its words; what is over goes to the
    others by weight until none is above.  That is a common level: sources are
    full in the order of what they can hold per weight.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.pmod(F.col("place") - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    # One row per source.
    rows = sizes.groupBy("skey").agg(F.sum("words").alias("source_size"))
    rows = rows.withColumn("place", F.row_number().over(Window.orderBy("skey"))).withColumn("w", weight)
    hold = F.col("source_size") * float(MOST)
    by_level = Window.orderBy((hold / F.col("w")), "skey")
    everything = Window.partitionBy()
    fuller = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("source_size").over(everything) * SHARE - F.coalesce(F.sum(hold).over(fuller), F.lit(0.0))
    left = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(fuller), F.lit(0.0))
    level = F.greatest(rest, F.lit(0.0)) / left * F.col("w")
    # From the first source that the level does not fill on, the level is fixed.
    rows = rows.withColumns({"hold": hold, "level": F.when(level < hold, level / F.col("w"))})
    fixed = F.first("level", ignorenulls=True).over(by_level.rowsBetween(Window.unboundedPreceding, 0))
    target = F.when(fixed.isNull(), F.col("hold")).otherwise(F.least(F.col("hold"), fixed * F.col("w")))
    return rows.select("skey", "source_size", target.alias("target"))


def _rate(tilt: Column, x: Column) -> Column:
    return F.lit(float(MOST)) / (1 + (MOST - 1) * F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), -tilt * x))))


def _total(value: Column) -> Column:
    """A sum that does not depend on the order of its rows."""
    return F.sum(value.cast(EXACT)).cast("double")


def tilts(classes: DataFrame) -> DataFrame:
    """(skey, tilt, scale) from classes (skey, words, n, source_size, target).

    Sizes count in units of the word-weighted mean size of their source.
    Sources without words keep tilt 0; full ones get every rate to ``MOST``.
    """
    words_, n = F.col("words").cast("double"), F.col("n").cast("double")
    scale = F.greatest(_total(n * words_ * words_) / F.greatest(_total(n * words_), F.lit(1.0)), F.lit(1.0))
    now = classes.groupBy("skey").agg(scale.alias("scale"), F.first("target").alias("target"), F.first("source_size").alias("source_size"))
    full, empty = F.col("target") >= F.col("source_size") * float(MOST), F.col("target") <= 0
    now = now.select(
        "skey", "scale", "target",
        F.when(F.col("source_size") == 0, 0.0).when(full, F.lit(float("inf"))).when(empty, F.lit(float("-inf"))).otherwise(0.0).alias("tilt"),
        F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"),
        ((F.col("source_size") == 0) | full | empty).alias("done"),
    )
    now = stored(now, "tilts")
    for _ in range(STEPS):
        open_ = now.filter(~F.col("done"))
        if not open_.take(1):
            break
        rows = classes.select("skey", "words", "n").join(open_.select("skey", "tilt", "scale"), "skey")
        x = words_ / F.col("scale")
        r = _rate(F.col("tilt"), x)
        sums = rows.groupBy("skey").agg(_total(n * r * words_).alias("taken"), _total(n * r * (1 - r / MOST) * x * words_).alias("slope"))
        step = now.join(sums, "skey", "left").withColumn("gap", F.col("taken") - F.col("target"))
        low = F.when(F.col("gap") <= 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(F.col("gap") >= 0, F.col("tilt")).otherwise(F.col("high"))
        step = step.withColumns({"lo": low, "hi": high, "newton": F.col("tilt") - F.col("gap") / F.col("slope")})
        inside = (F.col("newton") > F.col("lo")) & (F.col("newton") < F.col("hi")) & ~F.isnan("newton")
        # Outside the bracket (or with a flat slope): halve it, or double away from 0.
        other = (
            F.when(F.col("hi") == float("inf"), F.greatest(F.col("lo") * 2, F.lit(1.0)))
            .when(F.col("lo") == float("-inf"), F.least(F.col("hi") * 2, F.lit(-1.0)))
            .otherwise((F.col("lo") + F.col("hi")) / 2)
        )
        good = F.abs(F.col("gap")) <= CLOSE * F.col("target")
        now = stored(step.select(
            "skey", "scale", "target",
            F.when(F.col("done") | good, F.col("tilt")).when(inside, F.col("newton")).otherwise(other).alias("tilt"),
            F.when(F.col("done"), F.col("low")).otherwise(F.col("lo")).alias("low"),
            F.when(F.col("done"), F.col("high")).otherwise(F.col("hi")).alias("high"),
            (F.col("done") | good).alias("done"),
        ), "tilts")
    return now.select("skey", "tilt", "scale")


def copies_per_class(classes: DataFrame, solved: DataFrame) -> DataFrame:
    """(skey, words, n, rate, total): whole copies that each (source, size) gives."""
    rows = classes.join(solved, "skey")
    x = F.col("words") / F.col("scale")
    rate = F.when(F.col("tilt") == float("inf"), float(MOST)).when(F.col("tilt") == float("-inf"), 0.0).otherwise(_rate(F.col("tilt"), x))
    rows = rows.withColumn("rate", rate)
    upto = Window.partitionBy("skey").orderBy(F.desc("words")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.round(F.sum((F.col("n") * F.col("rate")).cast(EXACT)).over(upto)).cast("bigint"))
    along = Window.partitionBy("skey").orderBy(F.desc("words"))
    total = F.col("upto") - F.coalesce(F.lag("upto").over(along), F.lit(0))
    total = F.greatest(F.lit(0), F.least(F.col("n") * MOST, total)).cast("bigint")
    rows = rows.withColumn("total", total).select("skey", "words", "n", "rate", "target", "total")
    for _ in range(2):
        rows = _one_more(stored(rows, "copies"))
    return rows


def _one_more(rows: DataFrame) -> DataFrame:
    """Give or take the one copy per source whose size fits best what is missing."""
    missing = rows.groupBy("skey").agg((F.first("target") - F.sum(F.col("total") * F.col("words"))).alias("missing"))
    can = F.when(F.col("missing") > 0, F.col("total") < F.col("n") * MOST).otherwise(F.col("total") > 0)
    left = F.abs(F.abs("missing") - F.col("words"))
    offers = rows.join(missing, "skey").filter(can & (left < F.abs("missing")))
    best = offers.groupBy("skey").agg(
        F.min(F.struct(left.alias("left"), F.col("words"), F.signum("missing").cast("bigint").alias("add"))).alias("best")
    )
    out = rows.join(best, "skey", "left")
    hit = F.col("best.words") == F.col("words")
    return out.withColumn("total", F.col("total") + F.when(hit, F.col("best.add")).otherwise(F.lit(0))).drop("best")


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Columns words, skey (a source, NULL apart) and draw (a hash of the row) added."""
    text, source = F.col(text_col).cast("string"), F.col(source_col).cast("string")
    return docs.withColumns({
        "words": F.size(words(text)).cast("bigint"),
        "skey": F.struct(source.isNull().alias("none"), F.coalesce(source, F.lit("")).alias("name")),
        "draw": F.xxhash64(F.col(id_col).cast("bigint"), text),
    })


def plan(base: DataFrame) -> DataFrame:
    """Per (source, size) of ``base`` (skey, words, draw): how many rows, the
    rate, the copies of each row (``every``) and the place up to which rows get
    one more (``last``, NULL if none does)."""
    counts = base.groupBy("skey", "words").agg(F.count(F.lit(1)).alias("n"))
    per_class = stored(counts, "classes")
    totals = stored(source_targets(per_class.select("skey", (F.col("words") * F.col("n")).alias("words"))), "targets")
    classes = stored(per_class.join(totals, "skey"), "classes")
    given = copies_per_class(classes, tilts(classes)).select("skey", "words", "n", "rate", "total")
    every = F.when(F.col("words") == 0, 0).otherwise(F.floor(F.col("total") / F.col("n"))).cast("bigint")
    more = F.when(F.col("words") == 0, 0).otherwise(F.col("total") - F.floor(F.col("total") / F.col("n")) * F.col("n"))
    given = stored(given.join(totals, "skey").withColumns({"every": every, "more": more}), "plan")
    # Rows with one draw (equal id and text) are one row with a count here.
    some = base.join(given.filter("more > 0").select("skey", "words", "n", "more"), ["skey", "words"])
    some = some.groupBy("skey", "words", "draw").agg(F.count(F.lit(1)).alias("m"), F.first("n").alias("n"), F.first("more").alias("more"))
    some = some.withColumn("place", place([F.col("draw")], F.col("n"))).withColumn("chunk", F.col("place.chunk"))
    counts = some.groupBy("skey", "words", "chunk").agg(F.sum("m").alias("c"))
    earlier = Window.partitionBy("skey", "words").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("skey", "words", "chunk", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("skey", "words", "chunk").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    some = some.withColumn("inside", F.sum("m").over(inside)).join(counts, ["skey", "words", "chunk"])
    below = F.col("before") + F.col("inside") - F.col("m")
    last = some.filter((below < F.col("more")) & (F.col("more") <= below + F.col("m")))
    last = last.select("skey", "words", F.col("place").alias("last"), (F.col("more") - below).alias("tied"))
    return stored(given.join(last, ["skey", "words"], "left").drop("more", "total"), "plan")


def _given(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """``rows`` (skey, words, draw and others) with the columns of the plan and their ``copies``.

    Of rows that share the last draw, as many get one more copy as the plan says.
    Those that are equal in all columns are counted and written out again, in runs,
    so that a group of them is bound to no task.
    """
    at = place([F.col("draw")], F.col("n"))
    if planned.count() <= PLAN_ROWS:
        planned = F.broadcast(planned)
    joined = rows.join(planned, ["skey", "words"])
    on_edge = F.col("last").isNotNull() & (at == F.col("last"))
    more = F.when(F.col("last").isNotNull() & (at < F.col("last")), 1).otherwise(0)
    sure = joined.filter(~on_edge).withColumn("copies", (F.col("every") + more).cast("bigint"))
    edge = joined.filter(on_edge).groupBy(*joined.columns).agg(F.count(F.lit(1)).alias("__m"))
    ahead = Window.partitionBy("skey", "words").orderBy(F.xxhash64(*joined.columns)).rowsBetween(Window.unboundedPreceding, -1)
    lucky = F.least(F.greatest(F.col("tied") - F.coalesce(F.sum("__m").over(ahead), F.lit(0)), F.lit(0)), F.col("__m"))
    edge = edge.withColumn("__lucky", lucky)
    kinds = F.array(F.struct((F.col("every") + 1).alias("copies"), F.col("__lucky").alias("times")), F.struct(F.col("every").alias("copies"), (F.col("__m") - F.col("__lucky")).alias("times")))
    edge = edge.withColumn("__kind", F.explode(kinds)).filter("__kind.times > 0")
    edge = edge.withColumn("__run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__kind.times") - 1, F.lit(RANK_CHUNK).cast("bigint")))).repartition("skey", "words", "__run")
    size = F.least(F.lit(RANK_CHUNK), F.col("__kind.times") - F.col("__run")).cast("int")
    edge = edge.withColumn("copies", F.col("__kind.copies").cast("bigint")).withColumn("__one", F.explode(F.array_repeat(F.lit(1), size)))
    return sure.unionByName(edge.select(sure.columns))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row: doc_id, source, size, source_size, target, rate, copies and taken (copies times size).

    A NULL text has size 0 and gets no copy; a NULL source is a source of its
    own.  Of rows that repeat id and text, as many get one more copy as the target
    asks for.  Reruns agree.  A
    source without words has target 0.  Other columns are ignored; an empty
    table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"))
    base = stored(_sized(rows, "doc_id", "text", "source").drop("text"), "sizes")
    return _given(base, plan(base.select("skey", "words", "draw"))).select(
        "doc_id", "source", F.col("words").alias("size"), "source_size", "target", "rate", "copies", (F.col("copies") * F.col("words")).alias("taken"),
    )


def repeat_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with every row as often as :func:`mix` takes it, columns unchanged."""
    named = {c: f"__in_{k}" for k, c in enumerate(docs.columns)}
    inner = docs.select(*[F.col(f"`{c}`").alias(alias) for c, alias in named.items()])
    sized = _sized(inner, named[id_col], named[text_col], named[source_col])
    base = stored(sized.select("skey", "words", "draw"), "sizes")
    rows = _given(sized, plan(base))
    again = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("__copy")
    return rows.select(*named.values(), again).select(*[F.col(alias).alias(c) for c, alias in named.items()])
