"""Scalar column expressions (all JVM-side built-ins, no Python UDFs).

Spark 4 runs with ANSI mode on: plain casts of junk text and divisions by
zero raise. Every helper here is the null-on-failure form.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def typed_null(dtype: str | T.DataType) -> Column:
    """A NULL literal of a given type so that unions line up."""
    return F.lit(None).cast(dtype)


def to_double(c: ColumnOrName) -> Column:
    """Cast to double, NULL when the text is not a number (B2)."""
    return col(c).try_cast("double")


def to_int(c: ColumnOrName) -> Column:
    """Cast to int, NULL when not an integer."""
    return col(c).try_cast("int")


def to_str(c: ColumnOrName) -> Column:
    return col(c).cast("string")


def clean_upper(c: ColumnOrName) -> Column:
    """upper(trim(c))."""
    return F.upper(F.trim(col(c)))


def safe_timestamp(c: ColumnOrName) -> Column:
    """Parse ISO-ish text to a timestamp; junk → NULL."""
    return F.try_to_timestamp(to_str(c))


def epoch_or_timestamp(c: ColumnOrName) -> Column:
    """Digit strings are epoch seconds / millis / micros by magnitude, other
    text is parsed as a timestamp; junk → NULL (B10)."""
    s = F.trim(to_str(c))
    digits = s.rlike(r"^\d+(\.0+)?$")
    n = F.regexp_extract(s, r"^(\d+)", 1).try_cast("long")
    by_size = (
        F.when(n >= F.lit(10**14), F.timestamp_micros(n))
        .when(n >= F.lit(10**11), F.timestamp_millis(n))
        .otherwise(F.timestamp_seconds(n))
    )
    return F.when(digits, by_size).otherwise(F.try_to_timestamp(s))


def ratio_pct(num: ColumnOrName, den: ColumnOrName, digits: int = 1) -> Column:
    """round(100 * num / nullif(den, 0), digits) as a double."""
    return F.round(F.lit(100.0) * col(num).cast("double") / F.nullif(col(den), F.lit(0)).cast("double"), digits)


def month_start(ts: ColumnOrName) -> Column:
    """date_trunc('month', ts) as a DATE."""
    return F.to_date(F.date_trunc("month", col(ts)))


def date_of_text(c: ColumnOrName) -> Column:
    """try_to_date(left(c::string, 10))."""
    return F.try_to_date(F.left(to_str(c), F.lit(10)))


def month_label(c: ColumnOrName) -> Column:
    """First seven characters of a date, 'yyyy-MM' (B20)."""
    return F.date_format(col(c), "yyyy-MM")


def contains_any(c: ColumnOrName, needles: list[str]) -> Column:
    """True when c contains any of the literal substrings (B22): one search for all of them."""
    return col(c).rlike("|".join(map(re.escape, needles))) if needles else F.lit(False)


def find(c: ColumnOrName, pattern: str) -> Column:
    """Regex search (find semantics, B24)."""
    return col(c).rlike(pattern)


def label_map(c: ColumnOrName, mapping: Mapping, default=None) -> Column:
    """Dictionary lookup as a literal map, else default."""
    if not mapping:
        return F.lit(default)
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    found = F.try_element_at(F.create_map(*pairs), col(c))
    return found if default is None else F.coalesce(found, F.lit(default))


def in_window(c: ColumnOrName, lo: float, hi: float, inclusive: bool = False) -> Column:
    """Numeric sanity window: strict (lo, hi) or inclusive [lo, hi]."""
    x = col(c)
    return x.between(lo, hi) if inclusive else (x > lo) & (x < hi)


def strip_chars(c: ColumnOrName, chars: str) -> Column:
    """Python-style str.strip(chars)."""
    return F.btrim(col(c), F.lit(chars))


# FIXED VALUES: the ASCII whitespace set removed by Python's str.strip().
WHITESPACE = " \t\n\r\x0b\x0c"


def strip_ws(c: ColumnOrName) -> Column:
    """Python ``str.strip()`` on ASCII whitespace (Spark's ``trim`` removes spaces only)."""
    return F.btrim(col(c), F.lit(WHITESPACE))


def last_part(c: ColumnOrName, sep: str) -> Column:
    """Last part after a separator."""
    return F.split_part(col(c), F.lit(sep), F.lit(-1))


def title_case(c: ColumnOrName) -> Column:
    """Title case for display (B41; Spark does not capitalise after '-')."""
    return F.initcap(col(c))


def money_k(c: ColumnOrName, empty: str = "—") -> Column:
    """'$123k' (integer thousands, truncated); empty when null or ≤ 0."""
    x = col(c)
    return F.when(x.isNull() | (x <= 0), F.lit(empty)).otherwise(
        F.concat(F.lit("$"), (x.cast("long") / 1000).cast("long").cast("string"), F.lit("k")))


def money_full(c: ColumnOrName, empty: str = "—") -> Column:
    """'$1,234' with thousands separators; empty when null or ≤ 0."""
    x = col(c)
    return F.when(x.isNull() | (x <= 0), F.lit(empty)).otherwise(
        F.concat(F.lit("$"), F.format_number(x.cast("long"), 0)))


def count_label(c: ColumnOrName) -> Column:
    """'1,234' (B43)."""
    return F.format_number(col(c).cast("long"), 0)


def pct_label(c: ColumnOrName) -> Column:
    """'42%' from a percentage, rounded half-even like Python formatting."""
    return F.concat(F.bround(col(c), 0).cast("long").cast("string"), F.lit("%"))


def pct_of_max(c: ColumnOrName, max_c: ColumnOrName) -> Column:
    """int(c / max * 100), truncated."""
    return F.floor(col(c).cast("double") / F.nullif(col(max_c), F.lit(0)).cast("double") * 100).cast("long")


def zero_if_null(c: ColumnOrName) -> Column:
    return F.coalesce(col(c), F.lit(0.0))
