"""Registered queries: contract, invariants, brute-force checks and DuckDB parity."""
import math
from datetime import date

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from spendframe.plans import registry
from spendframe.plans.binding import Star
from spendframe.plans.query import Model
from spendframe.sources.tables import TABLES

from conftest import SF_SMALL

NO_ORACLE = set()


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and set(df.columns) >= {"grain", "key", "transactions", "spend", "clients"}
    assert {r.grain for r in rows} == {"year", "channel", "category", "loctype"}


def test_every_query_has_sql_twin():
    q, s = registry.QUERIES, registry.ORACLE
    E.queries()
    assert len(q) > 200
    assert set(q) - set(s) == NO_ORACLE
    assert set(s) <= set(q)


def test_shares_sum_to_one(spark):
    r = Model(spark, SF_SMALL).evaluate(["year", "channel"], ["channel_share"])
    for row in r.groupBy("year").agg(F.sum("channel_share").alias("s")).collect():
        assert abs(row.s - 1.0) < 1e-9


def test_calendar_day_cells_add_up_to_years(spark):
    cells = E.queries()["calendar_cells"](spark, SF_SMALL)
    t = {r.view: r.s for r in cells.groupBy("view").agg(F.sum("value").alias("s")).collect()}
    assert math.isclose(t["Day"], t["Year"], abs_tol=0.01)
    assert math.isclose(t["Month"], t["Quarter"], abs_tol=0.01)


def test_star_equals_flat_except_prior_year(spark):
    got = {r.query: r.match for r in E.queries()["multiset_match"](spark, SF_SMALL).collect()}
    assert all(v for k, v in got.items() if k != "q07")


def test_prior_year_brute_force(spark):
    """Spend PY by year against a pandas brute force: shift every approved row forward
    12 months (29 Feb -> 28 Feb) and keep the shifted days inside the date range."""
    star = Star(spark, SF_SMALL)
    pdf = star.fact({"date", "ok", "amount"}).toPandas()
    first, last = pdf["date"].min(), pdf["date"].max()

    def shift(d: date) -> date:
        try:
            return d.replace(year=d.year + 1)
        except ValueError:
            return d.replace(year=d.year + 1, day=28)
    ok = pdf[pdf["ok"]]
    exp: dict = {}
    for d, a in zip(ok["date"], ok["amount"]):
        s = shift(d)
        if first <= s <= last:
            exp[s.year] = exp.get(s.year, 0) + float(a)
    got = {r.year: r.spend_py for r in
           Model(spark, SF_SMALL).evaluate(["year"], ["spend_py"]).collect()}
    for y, v in got.items():
        if v is None:
            assert y not in exp
        else:
            assert math.isclose(v, exp[y], abs_tol=0.01)


def test_where_slicer_and_filter_pushdown(spark):
    m = Model(spark, SF_SMALL)
    df = m.evaluate(["channel"], ["spend"], where={"year": 1998})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" in plan or "FileScan" in plan
    all_years = {r.channel: r.spend for r in m.evaluate(["channel"], ["spend"]).collect()}
    one = {r.channel: r.spend for r in df.collect()}
    assert all(one[c] <= all_years[c] + 1e-6 for c in one if one[c] is not None and one[c] > 0)


PARITY = ["q01_total_spend", "q07_spend_yoy", "q10_top_cards", "f07_spend_yoy",
          "figures_4_grains", "m_total_credit_limit", "m_spend_12m", "v_year_table",
          "v_us_states", "calendar_cells", "peak_month", "peak_year", "cal_month_py",
          "x_totals", "quality_report", "money_parse", "outcome_classify",
          "reconcile_figures", "top_bottom_n", "label_three_state"]


def _norm(rows):
    def n(v):
        if isinstance(v, float):
            return round(v, 6)
        if v is not None and type(v).__name__ == "Decimal":
            return round(float(v), 6)
        return v
    return sorted((tuple(n(v) for v in r) for r in rows),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("name", PARITY)
def test_duckdb_parity(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    srows = [tuple(r[c] for c in cols) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    drows = [tuple(r[i] for i in idx) for r in cur.fetchall()]
    assert _norm(srows) == _norm(drows)


def test_credit_limit_and_trailing_12m_brute_force(spark):
    """Total Credit Limit counts each card seen in the group once; Spend 12M sums the
    approved amount over (end - 12 months, end] with end = last day of the group."""
    from dateutil.relativedelta import relativedelta
    star = Star(spark, SF_SMALL)
    f = star.fact({"credit_score_band", "card_key", "date", "ok", "amount", "year"}).toPandas()
    cards = {r.card_key: float(r.credit_limit) for r in star.card_dim().collect()}
    m = Model(spark, SF_SMALL)
    got = {r.credit_score_band: r.total_credit_limit for r in
           m.evaluate(["credit_score_band"], ["total_credit_limit"]).collect()}
    for band, g in f.groupby("credit_score_band"):
        exp = sum(cards[k] for k in set(g["card_key"]))
        assert math.isclose(got[band], exp, abs_tol=0.01)
    spine_last = {r.year: r.e for r in star.date_dim().groupBy("year").agg(
        F.max("date").alias("e")).collect()}
    got12 = {r.year: r.spend_12m for r in m.evaluate(["year"], ["spend_12m"]).collect()}
    ok = f[f["ok"]]
    for y, end in spine_last.items():
        start = end - relativedelta(months=12)
        exp = float(ok[(ok["date"] > start) & (ok["date"] <= end)]["amount"].sum())
        assert math.isclose(got12[y], exp, abs_tol=0.01)
