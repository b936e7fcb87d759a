"""Rule-driven classifiers (C1–C13). Each returns a Column; rules are data.

All classifiers are chained ``CASE WHEN`` expressions: first match wins and a
NULL input falls through to the default, exactly like a searched CASE.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import taxonomy as tx
from .expr import ColumnOrName, col, contains_any, label_map, strip_ws


def first_match(c: ColumnOrName, rules: Sequence[tuple[str, object]], default=None,
                lower: bool = True) -> Column:
    """Regex rules ``[(pattern, label)]`` tested in order on ``lower(c)``."""
    x = F.lower(col(c)) if lower else col(c)
    out = None
    for pattern, label in rules:
        cond = x.rlike(pattern)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default))


def classify(c: ColumnOrName, rules: Sequence[tuple[Sequence[str], object]], default=None,
             lower: bool = True) -> Column:
    """Substring rules ``[([needle, ...], label)]`` tested in order (C6 role clusters)."""
    x = F.lower(col(c)) if lower else col(c)
    out = None
    for needles, label in rules:
        cond = contains_any(x, list(needles))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default))


def work_type(text: ColumnOrName, rules=tx.WORK_TYPE_RULES, default=tx.WORK_TYPE_DEFAULT) -> Column:
    """Work type from free text."""
    return first_match(text, rules, default)


def experience_level(title: ColumnOrName, rules=tx.EXPERIENCE_RULES, default=tx.EXPERIENCE_DEFAULT) -> Column:
    """Seniority code from the raw title (C3); trailing blanks in patterns matter."""
    return first_match(title, rules, default)


def remote_from_text(location: ColumnOrName, text: ColumnOrName, location_word: str = "remote",
                     text_rules=tx.REMOTE_TEXT_RULES, default: str = "0") -> Column:
    """Remote flag variant (a): location mentions remote → '1'; then text rules."""
    loc_hit = F.contains(F.lower(col(location)), F.lit(location_word))
    rest = first_match(text, text_rules, default)
    return F.when(loc_hit, F.lit("1")).otherwise(rest)


def remote_from_flag(flag: ColumnOrName, default: str = "0") -> Column:
    """Remote flag variant (b): coalesce(flag, '0')."""
    return F.coalesce(col(flag).cast("string"), F.lit(default))


def remote_from_flag_or_location(flag: ColumnOrName, location: ColumnOrName, yes: str = "1",
                                 location_word: str = "remote") -> Column:
    """Remote flag variant (c): flag = '1' or location mentions remote → '1', else '0' (C2c)."""
    hit = (col(flag) == F.lit(yes)) | F.contains(F.lower(col(location)), F.lit(location_word))
    return F.when(hit, F.lit("1")).otherwise(F.lit("0"))


def annualize(value: ColumnOrName, period: ColumnOrName, factors: Mapping[str, float] = tx.PAY_FACTORS_ARCHIVE,
              round_half_even: bool = False) -> Column:
    """Scale pay to a year by period (C4). Unknown periods keep the value.

    ``round_half_even`` reproduces the feed collector, which rounds the scaled
    value with Python's banker's rounding; the SQL path does not round.
    """
    f = label_map(period, {k: float(v) for k, v in factors.items()})
    scaled = col(value) * f
    if round_half_even:
        scaled = F.bround(scaled, 0)
    return F.when(f.isNull(), col(value)).otherwise(scaled)


def estimate_midpoint_or_zero(lo: ColumnOrName, hi: ColumnOrName) -> Column:
    """Feed 1 estimate: (min + max) / 2 with missing = 0, and 0 → NULL."""
    s = (F.coalesce(col(lo), F.lit(0.0)) + F.coalesce(col(hi), F.lit(0.0))) / 2
    return F.nullif(s, F.lit(0.0))


def estimate_mean_or_either(lo: ColumnOrName, hi: ColumnOrName) -> Column:
    """Feed 2 estimate: rounded mean when both are truthy, else whichever is.

    Python truthiness: NULL and 0 are both false.
    """
    a, b = col(lo), col(hi)
    a_ok = a.isNotNull() & (a != 0)
    b_ok = b.isNotNull() & (b != 0)
    return (F.when(a_ok & b_ok, F.bround((a + b) / 2, 0))
            .when(a_ok, a)
            .otherwise(b))


def company_tier(name: ColumnOrName, tiers=tx.COMPANY_TIERS, fallback: str = tx.TIER_FALLBACK,
                 unknown: str = tx.TIER_UNKNOWN, min_len: int = 2) -> Column:
    """Tier from regex lists over lower(name); else fallback when length > min_len."""
    x = F.lower(col(name))
    out = None
    for label, pattern in tiers:
        cond = x.rlike(pattern)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    has_name = col(name).isNotNull() & (F.length(col(name)) > min_len)
    out = (F.when(has_name, F.lit(fallback)) if out is None else out.when(has_name, F.lit(fallback)))
    return out.otherwise(F.lit(unknown))


def tier_order(tier: ColumnOrName, tiers=tx.COMPANY_TIERS, fallback: str = tx.TIER_FALLBACK) -> Column:
    """Sort order 1..n for the tiers, n+1 for the fallback."""
    order = {label: i + 1 for i, (label, _) in enumerate(tiers)}
    order[fallback] = len(tiers) + 1
    return label_map(tier, order)


def normalize_state(state: ColumnOrName, names: Mapping[str, str] = tx.US_STATES) -> Column:
    """Full names → codes (case-sensitive, on trimmed text), else upper(trim)."""
    t = F.trim(col(state))
    return F.coalesce(label_map(t, names), F.upper(t))


def is_region_code(code: ColumnOrName, exclude: Sequence[str] = ("US",)) -> Column:
    """Keep two capital letters, not an excluded code."""
    c = col(code)
    cond = (F.length(c) == 2) & c.rlike("^[A-Z]{2}$")
    if exclude:
        cond = cond & ~c.isin(list(exclude))
    return cond


def keyword_filter(title: ColumnOrName, include=tx.TITLE_INCLUDE, exclude=tx.TITLE_EXCLUDE) -> Column:
    """Any exclude substring → False; else any include substring → True."""
    t = F.lower(col(title))
    return ~contains_any(t, list(exclude)) & contains_any(t, list(include))


def clean_title(title: ColumnOrName, separators=tx.TITLE_SEPARATORS) -> Column:
    """Cut at the first separator (in list order) that occurs, then strip whitespace (C11)."""
    t, out = col(title), None
    for sep in separators:
        cond = F.contains(t, F.lit(sep))
        val = strip_ws(F.split_part(t, F.lit(sep), F.lit(1)))
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return strip_ws(t) if out is None else out.otherwise(strip_ws(t))


def seniority_label(level: ColumnOrName, labels=tx.SENIORITY_LABELS, default=None) -> Column:
    """Experience code → display label."""
    return label_map(level, labels, default)


def seniority_order(level: ColumnOrName, order=tx.SENIORITY_ORDER, default=None) -> Column:
    """Experience code → sort order."""
    return label_map(level, order, default)
