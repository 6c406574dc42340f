"""Hashtag trends: daily counts, ranks, rolling sums and sudden growth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from punctua.functions.times import local_time
from punctua.operators.aggregates import distinct_for_pivot, pivot_values
from punctua.operators.relational import in_year


def explode_hashtags(tweets: DataFrame) -> DataFrame:
    """One row per hashtag; tweets without any give no row."""
    return tweets.select("timestamp_ms", "lang", F.explode("entities.hashtags.text").alias("hashtag"))


def tweets_in(df: DataFrame, lang: str = "en", zone: str = "UTC") -> DataFrame:
    """Hashtags of one language in lower case with their wall-clock time in ``zone``."""
    kept = df.filter(F.col("lang") == lang)
    return kept.select("timestamp_s", "lang", F.lower("hashtag").alias("hashtag"), local_time("timestamp_s", zone).alias("date"))


def calendar_view(df: DataFrame, year: int, ts: str = "date", key: str = "hashtag") -> DataFrame:
    """Month, ISO week and day of year of each row of one year."""
    rows = in_year(df, ts, year)
    return rows.select(F.month(ts).alias("month"), F.weekofyear(ts).alias("week"), F.dayofyear(ts).alias("day"), key)


def daily_counts(df: DataFrame, ts: str, key: str, zone: str | None = None) -> DataFrame:
    """Rows per (day of year, key, ISO week).

    A popular key is counted inside each task first; what is shuffled is one
    row per task and key.
    """
    t = F.from_utc_timestamp(F.col(ts), zone) if zone else F.col(ts)
    return df.groupBy(F.dayofyear(t).alias("day"), F.col(key), F.weekofyear(t).alias("week")).agg(
        F.count(F.lit(1)).alias("count")
    )


def weekly_average(day_counts: DataFrame, key: str, week: str = "week", count: str = "count") -> DataFrame:
    """Mean of the daily counts per week; days without a count are not zeros."""
    return day_counts.groupBy(week, key).agg(F.avg(count).alias("avg_count"))


def top_k_per(df: DataFrame, part: list[str], order: Sequence[Column], k: int, name: str = "rank") -> DataFrame:
    """Rows of rank 1..k within each part; ties share a rank.

    The rank filter is applied inside each task before the shuffle
    (``WindowGroupLimit``), so a part with most of the rows costs no more than
    its winners.
    """
    ranked = df.withColumn(name, F.rank().over(Window.partitionBy(*part).orderBy(*order)))
    return ranked.filter(F.col(name) <= k)


def rolling_sum(df: DataFrame, key: str, order: str, value: str, n: int = 7, calendar: bool = False) -> DataFrame:
    """Sum over the current and the ``n - 1`` rows before it, per key.

    Days without a row are skipped; ``calendar`` counts them instead.  ``df``
    has one row per key and day, so a window has as many rows as there are days.
    """
    w = Window.partitionBy(key).orderBy(order)
    w = w.rangeBetween(-(n - 1), 0) if calendar else w.rowsBetween(-(n - 1), 0)
    return df.withColumn("rolling_sum", F.sum(value).over(w))


def increase(df: DataFrame, part: list[str], order: str, value: str) -> DataFrame:
    """Day-over-day increase within ``part``; the first day counts from 0."""
    before = F.lag(value, 1, 0).over(Window.partitionBy(*part).orderBy(order))
    return df.withColumn("previous", before).withColumn("increase", F.col(value) - F.col("previous"))


def growth_rate(df: DataFrame, part: list[str], order: str, value: str) -> DataFrame:
    """Increase relative to the day's own count."""
    return increase(df, part, order, value).withColumn("growth", F.try_divide("increase", value))


def trending(day_counts: DataFrame, key: str, k: int = 3, across_weeks: bool = False) -> DataFrame:
    """The ``k`` keys per week with the biggest day-over-day increase.

    By default a week's first day counts from 0; ``across_weeks`` compares it
    with the key's last day before.
    """
    part = [key] if across_weeks else ["week", key]
    jumps = increase(day_counts, part, "day", "count")
    best = jumps.groupBy("week", key).agg(F.max("increase").alias("next_day_increase"))
    ranked = top_k_per(best, ["week"], [F.desc("next_day_increase")], k)
    return ranked.select(key, "week", "next_day_increase", "rank").orderBy("week", "rank", key)


def series_matrix(day_counts: DataFrame, key: str, days: Sequence[int] | None = None) -> DataFrame:
    """Keys as rows, days as columns, 0 where a key does not occur."""
    days = distinct_for_pivot(day_counts, "day") if days is None else days
    return pivot_values(day_counts, [key], "day", "count", days, fill=0)
