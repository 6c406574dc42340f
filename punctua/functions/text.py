"""Text predicates and clean-up of identifiers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def non_empty(col: Column | str) -> Column:
    """True where the text has at least one character; NULL counts as empty."""
    return F.coalesce(F.length(_c(col)) > 0, F.lit(False))


def contains_text(col: Column | str, needle: str, ignore_case: bool = False) -> Column:
    """Substring test; a NULL text gives NULL, hence is dropped by a filter
    and by its negation alike."""
    c = _c(col)
    return F.lower(c).contains(needle.lower()) if ignore_case else c.contains(needle)


def lacks_text(col: Column | str, needle: str, ignore_case: bool = False) -> Column:
    """Negated :func:`contains_text`; NULL texts do not pass."""
    return ~contains_text(col, needle, ignore_case)


def starts_with(col: Column | str, prefix: str) -> Column:
    """Prefix test; reaches the scan as ``StringStartsWith``."""
    return _c(col).startswith(prefix)


def date_shaped(col: Column | str) -> Column:
    """True for text of the shape ``dd.MM.yyyy``."""
    return F.coalesce(_c(col).rlike(r"^\d{2}\.\d{2}\.\d{4}$"), F.lit(False))


def short_stop_id(col: Column | str, width: int = 7) -> Column:
    """Stop number without the platform part (``8590275:0:A`` -> ``8590275``)."""
    return F.substring(_c(col), 1, width)


def strip_letters(col: Column | str, letters: str) -> Column:
    """Remove every leading and trailing character that is in ``letters``."""
    return F.btrim(_c(col), F.lit(letters))


def digits_only(col: Column | str) -> Column:
    return F.regexp_replace(_c(col), r"\D", "")


def two_decimals(col: Column | str) -> Column:
    return F.format_string("%.2f", _c(col))


def true_flag(col: Column | str) -> Column:
    """Boolean from the text flags ``true``/``false`` and ``1``/``0``."""
    return F.lower(_c(col).cast("string")).isin("true", "1")


def any_flag(cols: list[Column | str]) -> Column:
    """True where at least one of the flag columns is set."""
    return reduce(lambda a, b: a | b, [F.coalesce(true_flag(c), F.lit(False)) for c in cols])


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
