"""Per-text statistics as column expressions: one scan, no shuffle, no Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from punctua.llm.common import SPACES, let, words

#: Fixed value of the contract: characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Fixed value of the contract: words of a repeated window.
WINDOW = 3
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝ"


def _count(text: Column, letters: str) -> Column:
    """How many characters of ``text`` are among ``letters``."""
    return F.length(text) - F.length(F.translate(text, letters, ""))


def repeated_words(found: Column) -> Column:
    """Words that stand in a 3-word window which occurs again in the text.

    Windows are compared by a 64-bit hash.  Only a text with a repeated window
    is sorted by (window, place); the repeated places then cover up to three
    words each, less where the next one begins.
    """
    n = F.size(found)
    windows = F.transform(F.slice(found, F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(0))), lambda w, i: F.xxhash64(w, F.get(found, i + 1), F.get(found, i + 2)))

    def covered(places: Column) -> Column:
        new = F.transform(places, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(new, F.lit(0), lambda a, x: a + x)

    def repeats(ordered: Column) -> Column:
        again = F.filter(ordered, lambda s, i: (s["h"] == F.get(ordered, i - 1)["h"]) | (s["h"] == F.get(ordered, i + 1)["h"]))
        return let(F.sort_array(F.transform(again, lambda s: s["i"])), covered)

    def counted(all_: Column) -> Column:
        ordered = F.sort_array(F.transform(all_, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(all_)) < F.size(all_), let(ordered, repeats)).otherwise(0)

    return let(windows, counted)


def with_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with struct ``stats``: the base counts (long) and ratios (double).

    A NULL text has no words.  Ratios of an empty text are 0.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # Two columns on purpose: the words are an attribute when lambdas refer to them.
    rows = docs.withColumn("__words", words(text))
    found = F.col("__words")
    lines = F.filter(F.split(text, "\n"), lambda l: F.length(F.btrim(l, F.lit(SPACES))) > 0)
    dup_lines = let(lines, lambda ls: F.struct((F.size(ls) - F.size(F.array_distinct(ls))).alias("dup"), F.size(ls).alias("all")))
    counts = F.struct(
        F.size(found).cast("bigint").alias("n_words"),
        F.length(F.array_join(found, "")).cast("bigint").alias("word_chars"),
        _count(text, SYMBOLS).cast("bigint").alias("n_symbols"),
        dup_lines.alias("lines"),
        let(found, repeated_words).cast("bigint").alias("n_repeat_words"),
        _count(text, _UPPER).alias("upper"),
        _count(text, "!").alias("bangs"),
        _count(text, "0123456789").alias("digits"),
        F.size(F.array_distinct(found)).alias("distinct"),
    )
    rows = rows.withColumn("__counts", counts)
    c = lambda name: F.col(f"__counts.{name}")
    share = lambda part, whole: F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))
    stats = F.struct(
        c("n_words"), c("word_chars"), c("n_symbols"), c("lines.dup").cast("bigint").alias("n_dup_lines"), c("n_repeat_words"),
        share(c("n_symbols"), c("n_words")).alias("symbols_per_word"),
        share(c("word_chars"), c("n_words")).alias("chars_per_word"),
        share(c("lines.dup"), c("lines.all")).alias("dup_line_share"),
        share(c("n_repeat_words"), c("n_words")).alias("repeat_share"),
        share(c("upper"), c("word_chars")).alias("upper_share"),
        share(c("bangs"), c("n_words")).alias("bangs_per_word"),
        share(c("digits"), c("word_chars")).alias("digit_share"),
        share(c("distinct"), c("n_words")).alias("distinct_share"),
        F.log1p(c("n_words").cast("double")).alias("log_words"),
    )
    return rows.withColumn("stats", stats).drop("__words", "__counts")


#: Ratios that models use.
FEATURES = ("symbols_per_word", "chars_per_word", "dup_line_share", "repeat_share", "upper_share", "bangs_per_word", "digit_share", "distinct_share", "log_words")


def labelled_stats(docs: DataFrame, labels: DataFrame, most: int, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(draw, label, features) of about ``most`` labelled documents at most.

    The rows are those with the smallest hash of their id, so they do not depend
    on partitioning; the share is set from the number of labels.  Labels other
    than 0 and 1, and NULL ids, are left out.
    """
    known = labels.select(F.col(id_col).cast("bigint").alias("__id"), F.col(label_col).cast("int").alias("__label")).filter("__label IN (0, 1) AND __id IS NOT NULL")
    n = known.count()
    draw = F.shiftrightunsigned(F.xxhash64(F.col("__id"), F.lit(11)), 11) / float(1 << 53)
    # At most about ``most`` rows of two numbers: small enough to send to every task.
    few = known.dropDuplicates(["__id"]).withColumn("__draw", draw).filter(F.col("__draw") * max(n, 1) < most)
    rows = docs.select(F.col(id_col).cast("bigint").alias("__id"), F.col(text_col).cast("string").alias("__text")).join(F.broadcast(few), "__id")
    stats = with_stats(rows, "__text")
    return stats.select(F.col("__draw").alias("draw"), F.col("__label").alias("label"), *[F.col(f"stats.{f}").alias(f) for f in FEATURES])
