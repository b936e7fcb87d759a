"""Property tests: Spark expressions vs plain-Python statements of the same rules.

Each test draws a batch of inputs with hypothesis and evaluates it in one
Spark job, so the Spark side is exercised on many shapes at once.
"""

from decimal import ROUND_HALF_EVEN, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hirelens.functions import taxonomy as tx
from hirelens.functions.classify import (annualize, clean_title, estimate_mean_or_either, estimate_midpoint_or_zero,
                                         keyword_filter)

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

pieces = st.sampled_from(["Data Analyst", "Senior", " | ", " - ", " at ", " @ ", " – ", "etl", "Lead", "x", " ",
                          "ios", "Business Intelligence", "web3", "VP", "\t", "\n"])
titles = st.lists(st.lists(pieces, min_size=0, max_size=6).map("".join), min_size=1, max_size=40)


def py_clean(raw):
    for sep in tx.TITLE_SEPARATORS:
        if sep in raw:
            return raw.split(sep)[0].strip()
    return raw.strip()


def py_keep(title):
    t = title.lower()
    if any(n in t for n in tx.TITLE_EXCLUDE):
        return False
    return any(p in t for p in tx.TITLE_INCLUDE)


@SETTINGS
@given(titles)
def test_title_rules_match_python(spark, batch):
    df = spark.createDataFrame([(t,) for t in batch], "t string")
    got = df.select(clean_title("t").alias("c"), keyword_filter("t").alias("k")).collect()
    assert [r.c for r in got] == [py_clean(t) for t in batch]
    assert [r.k for r in got] == [py_keep(t) for t in batch]


money = st.one_of(st.none(), st.just(0.0), st.integers(1, 400000).map(float), st.floats(0.5, 99.5).map(lambda x: round(x, 1)))


def py_mid(lo, hi):
    s = ((lo or 0.0) + (hi or 0.0)) / 2
    return s or None


def py_either(lo, hi):
    if lo and hi:
        return float(Decimal(repr((lo + hi) / 2)).quantize(Decimal(1), ROUND_HALF_EVEN))
    return lo or hi


@SETTINGS
@given(st.lists(st.tuples(money, money), min_size=1, max_size=40))
def test_estimates_match_python(spark, pairs):
    df = spark.createDataFrame(pairs, "lo double, hi double")
    got = df.select(estimate_midpoint_or_zero("lo", "hi").alias("m"), estimate_mean_or_either("lo", "hi").alias("e")).collect()
    assert [r.m for r in got] == [py_mid(a, b) for a, b in pairs]
    exp = [py_either(a, b) for a, b in pairs]
    assert [r.e for r in got] == [None if x is None else float(x) for x in exp]


periods = st.sampled_from(["HOUR", "WEEK", "WEEKLY", "MONTH", "MONTHLY", "YEAR", "", "hour"])


def py_annualize(v, period):
    if v is None:
        return None
    f = tx.PAY_FACTORS_FEED.get(period)
    if f is None:
        return v
    return float(Decimal(repr(v * f)).quantize(Decimal(1), ROUND_HALF_EVEN))


@SETTINGS
@given(st.lists(st.tuples(money, periods), min_size=1, max_size=40))
def test_feed_annualize_matches_python(spark, rows):
    df = spark.createDataFrame(rows, "v double, p string")
    got = [r[0] for r in df.select(annualize("v", "p", tx.PAY_FACTORS_FEED, round_half_even=True)).collect()]
    assert got == [py_annualize(v, p) for v, p in rows]
