"""Classifier and scalar-rule tables (FIXTURES §4 edge rows)."""

from datetime import datetime

from pyspark.sql import functions as F

from hirelens.functions import taxonomy as tx
from hirelens.functions.classify import (annualize, classify, clean_title, company_tier, estimate_mean_or_either,
                                         estimate_midpoint_or_zero, experience_level, is_region_code, keyword_filter,
                                         normalize_state, remote_from_flag, remote_from_flag_or_location,
                                         remote_from_text, tier_order, work_type)
from hirelens.functions.expr import (epoch_or_timestamp, in_window, money_full, money_k, pct_label, pct_of_max,
                                     ratio_pct, safe_timestamp, strip_chars, title_case, to_double)


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_experience_precedence_and_trailing_blank(spark):
    titles = ["Senior Director of Data", "Lead Senior Engineer", "Sr. Analyst", "Jr Analyst", "Analyst",
              "Team Lead", "Team Lead ", None]
    assert one_col(spark, titles, experience_level) == ["EX", "DI", "SE", "EN", "MI", "MI", "DI", "MI"]


def test_work_type(spark):
    texts = ["we hire c2c", "part time role", "part-time and c2c ok", None, "intro\nthis is a contract role",
             "corp to corp only"]
    assert one_col(spark, texts, work_type) == ["CONTRACT", "PART_TIME", "CONTRACT", "FULL_TIME", "CONTRACT",
                                                "CONTRACT"]
    portal = one_col(spark, ["corp to corp only"], lambda c: work_type(c, tx.WORK_TYPE_RULES_PORTAL))
    assert portal == ["FULL_TIME"]


def test_remote_variants(spark):
    df = spark.createDataFrame([("Remote, US", "x"), ("NYC", "work from home ok"), ("NYC", "hybrid 3 days"),
                                (None, None), ("NYC", "remote-first team")], "loc string, txt string")
    got = [r[0] for r in df.select(remote_from_text("loc", "txt")).collect()]
    assert got == ["1", "1", "hybrid", "0", "1"]
    flags = spark.createDataFrame([("1", "NYC"), (None, "Remote"), ("0", "SF"), (None, None)], "f string, loc string")
    assert [r[0] for r in flags.select(remote_from_flag("f")).collect()] == ["1", "0", "0", "0"]
    assert [r[0] for r in flags.select(remote_from_flag_or_location("f", "loc")).collect()] == ["1", "1", "0", "0"]


def test_role_clusters_first_match(spark):
    titles = ["Senior Data Engineer", "ML and data scientist", "Full Stack Dev", "Platform Engineer II", "Chef", None]
    got = one_col(spark, titles, lambda c: classify(c, tx.ROLES_SALARY, "Other"))
    assert got == ["Data Engineer", "Data Scientist", "Full Stack Engineer", "DevOps/Platform", "Other", "Other"]
    assert one_col(spark, ["LLM Engineer", "BI Developer", "x"], lambda c: classify(c, tx.ROLES_SENIORITY)) == [
        "AI/LLM Engineer", "BI Developer", None]


def test_states(spark):
    vals = ["California", "ca", "CA", "california", "US", "USA", "UK", None, " Texas "]
    codes = one_col(spark, vals, normalize_state)
    assert codes == ["CA", "CA", "CA", "CALIFORNIA", "US", "USA", "UK", None, "TX"]
    keep = one_col(spark, codes, is_region_code)
    assert keep == [True, True, True, False, False, False, True, None, True]


def test_company_tiers(spark):
    names = ["Google LLC", "Stripe", "Oracle", "Acme", "AB", None]
    tiers = one_col(spark, names, company_tier)
    assert tiers == ["FAANG+", "Scale-up", "Enterprise", "Startup / Other", "Unknown", "Unknown"]
    assert one_col(spark, tiers[:4], tier_order, "string") == [1, 2, 3, 4]


def test_pay_windows(spark):
    vals = [10000.0, 10001.0, 29999.0, 30000.0, 500000.0, 500001.0]
    strict = one_col(spark, vals, lambda c: in_window(c, 10000, 1000000), "double")
    incl = one_col(spark, vals, lambda c: in_window(c, 30000, 500000, inclusive=True), "double")
    assert strict == [False, True, True, True, True, True]
    assert incl == [False, False, False, True, True, False]


def test_title_filter_and_clean(spark):
    titles = ["Biostatistics Data Analyst", "Senior Data Analyst", "Data Analyst", "Barista"]
    assert one_col(spark, titles, keyword_filter) == [False, False, True, False]
    raw = ["Data Analyst - LA | Acme", "Data Engineer at X", "  Plain  ", "A @ B — C"]
    assert one_col(spark, raw, clean_title) == ["Data Analyst - LA", "Data Engineer", "Plain", "A @ B"]


def test_estimates(spark):
    df = spark.createDataFrame([(100000.0, 140000.0), (100000.0, None), (None, None), (0.0, 5.0), (0.0, 0.0)],
                               "lo double, hi double")
    mid = [r[0] for r in df.select(estimate_midpoint_or_zero("lo", "hi")).collect()]
    assert mid == [120000.0, 50000.0, None, 2.5, None]
    either = [r[0] for r in df.select(estimate_mean_or_either("lo", "hi")).collect()]
    assert either == [120000.0, 100000.0, None, 5.0, 0.0]


def test_annualize_feed_rounding(spark):
    df = spark.createDataFrame([(50.0, "HOUR"), (70.0, "HOUR"), (120000.0, "YEAR"), (2.5, "WEEK"), (None, "HOUR")],
                               "v double, p string")
    got = [r[0] for r in df.select(annualize("v", "p", tx.PAY_FACTORS_FEED, round_half_even=True)).collect()]
    assert got == [104000.0, 145600.0, 120000.0, 130.0, None]
    sql = [r[0] for r in df.select(annualize("v", F.lit("HOURLY"))).collect()]
    assert sql[0] == 104000.0


def test_timestamps(spark):
    vals = ["2026-01-02T03:04:05Z", "2026-01-02T03:04:05-05:00", "2026-01-02 03:04:05.123456", "2026-01-02",
            "garbage", None]
    got = one_col(spark, vals, safe_timestamp)
    assert got[0] == datetime(2026, 1, 2, 3, 4, 5)
    assert got[1] == datetime(2026, 1, 2, 8, 4, 5)
    assert got[2] == datetime(2026, 1, 2, 3, 4, 5, 123456)
    assert got[3] == datetime(2026, 1, 2)
    assert got[4] is None and got[5] is None
    epochs = one_col(spark, ["1713397508000", "1713397508", "1713397508000000", "2024-04-17", "x"], epoch_or_timestamp)
    assert epochs[0] == epochs[1] == epochs[2] == datetime(2024, 4, 17, 23, 45, 8)
    assert epochs[3] == datetime(2024, 4, 17) and epochs[4] is None


def test_safe_casts_and_ratios(spark):
    assert one_col(spark, ["1.5", "", "abc", None], to_double) == [1.5, None, None, None]
    df = spark.createDataFrame([(1, 3), (0, 0), (2, None)], "a int, b int")
    assert [r[0] for r in df.select(ratio_pct("a", "b")).collect()] == [33.3, None, None]


def test_labels(spark):
    df = spark.createDataFrame([(123456.0,), (999.0,), (0.0,), (None,)], "x double")
    assert [r[0] for r in df.select(money_k("x")).collect()] == ["$123k", "$0k", "—", "—"]
    assert [r[0] for r in df.select(money_full("x")).collect()] == ["$123,456", "$999", "—", "—"]
    p = spark.createDataFrame([(42.5,), (43.5,), (7.0,)], "x double")
    assert [r[0] for r in p.select(pct_label("x")).collect()] == ["42%", "44%", "7%"]
    m = spark.createDataFrame([(50, 200), (199, 200)], "c int, m int")
    assert [r[0] for r in m.select(pct_of_max("c", "m")).collect()] == [25, 99]
    assert one_col(spark, ["power bi", "scikit-learn"], title_case) == ["Power Bi", "Scikit-learn"]
    assert one_col(spark, [", Austin, TX, ", "TX"], lambda c: strip_chars(c, ", ")) == ["Austin, TX", "TX"]
