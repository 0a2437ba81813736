"""Slicers as date intervals that reach the scan, and the texts of formats and exports."""
import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from spendframe.functions import scalar as S
from spendframe.operators.reconcile import column_profile
from spendframe.plans import exports
from spendframe.plans.query import Model
from spendframe.plans.slicers import (MOST_INTERVALS, Between, Chosen, Single, a_year_before, date_intervals, resolved)

from conftest import SF_SMALL
from test_rollups import static_plan

D = dt.date


def days_of(intervals):
    return {a + dt.timedelta(i) for a, b in intervals for i in range((b - a).days)}


ATTRIBUTES = {
    "year": lambda d: d.year, "quarter": lambda d: f"Q{(d.month + 2) // 3}", "quarter_key": lambda d: d.year * 10 + (d.month + 2) // 3,
    "quarter_year": lambda d: f"Q{(d.month + 2) // 3} {d.year}", "month_no": lambda d: d.month, "month": lambda d: d.strftime("%Y-%m"),
    "month_name": lambda d: d.strftime("%B"), "month_short": lambda d: d.strftime("%b"), "month_year": lambda d: d.strftime("%b %Y"),
    "month_year_sort": lambda d: d.year * 100 + d.month, "month_start": lambda d: d.replace(day=1), "date": lambda d: d,
}
RANGES = ("year", "quarter_key", "month", "month_year_sort", "month_start", "date")


@pytest.mark.parametrize("seed", range(40))
def test_intervals_hold_exactly_the_days_that_pass(seed):
    """Any mix of calendar filters over three years, against every day by itself."""
    rng = random.Random(seed)
    every = [D(1999, 1, 1) + dt.timedelta(i) for i in range(1096)]
    where = {}
    for col in rng.sample(sorted(ATTRIBUTES), rng.randint(1, 3)):
        at = ATTRIBUTES[col]
        if col in RANGES and rng.random() < 0.5:
            a, b = sorted(rng.sample(every, 2))
            where[col] = Between(*rng.choice([(at(a), at(b)), (at(a), at(every[-1])), (at(every[0]), at(b))]))
        else:
            where[col] = [at(d) for d in rng.sample(every, rng.randint(1, 3))]
            where[col] = where[col][0] if len(where[col]) == 1 else where[col]

    def passes(d):
        for col, v in where.items():
            x = ATTRIBUTES[col](d)
            if isinstance(v, Between):
                if x < v.low or x > v.high:
                    return False
            elif x not in (v if isinstance(v, list) else [v]):
                return False
        return True

    got = date_intervals(where)
    want = {d for d in every if passes(d)}
    if got is None:         # months or quarters of any year bound no days
        assert set(where) <= {"quarter", "month_no", "month_name", "month_short"}
    elif len(got) < MOST_INTERVALS:
        assert days_of([(a, b) for a, b in got if a > dt.date.min and b < dt.date.max]) & set(every) == want
    else:
        assert want <= days_of(got)


def test_days_of_the_year_before():
    def on(d):
        y = d.replace(year=d.year + 1) if (d.month, d.day) != (2, 29) else d.replace(year=d.year + 1, day=28)
        return y
    for a, b in ((D(2001, 2, 28), D(2001, 3, 1)), (D(2004, 2, 28), D(2004, 2, 29)), (D(2004, 2, 29), D(2005, 1, 1)), (D(2000, 1, 1), D(2000, 1, 2))):
        want = {d for d in (D(1998, 1, 1) + dt.timedelta(i) for i in range(3000)) if a <= on(d) < b}
        assert want <= days_of(a_year_before([(a, b)]))
    assert date_intervals({"channel": "x"}) is None and date_intervals({"year": []}) == []


def test_choices():
    assert resolved({"a": Single("x", "y"), "b": Single(default=3), "c": Chosen(None, (1, 2)), "d": Chosen(), "e": Between(1, 2)}) == {
        "a": "x", "b": 3, "c": [1, 2], "e": Between(1, 2)}
    for bad in (Single(), Single(["a", "b"]), Single(default=("a", "b"))):
        with pytest.raises(ValueError, match="choose one"):
            resolved({"month": bad})


@pytest.mark.parametrize("where, pushed", [
    ({"quarter_key": 19972}, ["1997-04-01", "1997-07-01"]), ({"month_year": "Feb 1996"}, ["1996-02-01", "1996-03-01"]),
    ({"date": Between(D(1997, 3, 5), D(1997, 3, 9))}, ["1997-03-05", "1997-03-10"]),
    ({"year": 1998, "month_no": [1, 2, 12]}, ["1998-01-01", "1998-03-01", "1998-12-01", "1999-01-01"])])
def test_slicers_reach_the_scan(spark, where, pushed):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    try:
        plan = static_plan(spark, lambda: Model(spark, SF_SMALL).evaluate(["channel"], ["spend"], where=where))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = [line for line in plan.split("\n") if "PushedFilters" in line and "orders.parquet" in line]
    assert filters and all(p in filters[0].split("PushedFilters")[1] for p in pushed)


def test_prior_year_under_a_range_equals_the_unfiltered_one(spark):
    m = Model(spark, SF_SMALL)
    whole = {r.month_year_sort: r.spend_py for r in m.evaluate(["month_year_sort"], ["spend_py", "spend"]).collect()}
    part = m.evaluate(["month_year_sort"], ["spend_py", "spend"], where={"month_year_sort": Between(199603, 199702)}).collect()
    assert {r.month_year_sort: r.spend_py for r in part} == {k: v for k, v in whole.items() if 199603 <= k <= 199702} and part


def test_signed_texts(spark):
    df = spark.createDataFrame([(0.036, 0.5, 1234.4), (-0.036, 0.5, -1234.6), (None, None, None), (12.5, 0.1, 0.0), (-10.0, 0.1, 999500.0)],
                               "v double, w double, m double")
    rows = df.select(S.signed_percent("v").alias("p"), S.signed_percent("v", cap=10).alias("c"), S.point_change("v", "w").alias("pp"),
                     S.signed_money("m").alias("m"), S.signed_money("m", True).alias("k")).collect()
    assert [r.p for r in rows] == ["+3.6%", "−3.6%", "new", "+1250.0%", "−1000.0%"]
    assert [r.c for r in rows] == ["+3.6%", "−3.6%", "new", ">+999%", "<-999%"]
    assert [r.pp for r in rows] == ["−46.4pp", "−53.6pp", None, "+1240.0pp", "−1010.0pp"]
    assert [r.m for r in rows] == ["+$1,234", "−$1,235", None, "+$0", "+$999,500"]
    assert [r.k for r in rows][:2] == ["+$1k", "−$1k"]
    zips = spark.createDataFrame([(58523.0,), (None,), (1.5,)], "z double").select(S.whole_text("z").alias("z")).collect()
    assert [r.z for r in zips] == ["58523", None, "1.5"]


def test_export_rows_are_json(spark):
    """Labels with quotes, backslashes and control characters stay whole."""
    labels = ['say "hi"', "back\\slash", "tab\there", "two\nlines", 'end\\"', "é日本", "", None, "a\r\n"]
    df = spark.createDataFrame([(x, i) for i, x in enumerate(labels)], "label string, n int")
    rows = df.select(F.expr(exports._json_row([("label", "text"), ("n", "int")], "`")).alias("row")).collect()
    assert [json.loads(r.row) for r in rows] == [{"label": x, "n": i} for i, x in enumerate(labels)]


def test_column_profile_by_hand(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, ""), ("bbb", 3, None), (None, 4, "x")], "s string, i int, e string").repartition(3)
    got = {r.column_name: r for r in column_profile(df).collect()}
    assert [got[c][1:4] for c in "sie"] == [(2, 1, 5), (4, 0, 4), (2, 3, 1)]
    assert (got["s"].top_value, got["s"].top_count, got["i"].top_value, got["e"].top_value) == ("a", 2, "1", "x")
    assert [r.column_name for r in sorted(got.values(), key=lambda r: r["rank"])] == ["s", "i", "e"] and got["s"].share == 0.5
    assert [r.column_name for r in column_profile(df, top=1).collect()] == ["s"]
