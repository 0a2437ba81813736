"""Hand-made driver-shaped tables with exact expected answers: prior year across 29 Feb
with a partial last year and a first year without a prior year, the trailing 12 months,
and a credit limit that counts a card once per group."""
import math
import os
import tempfile
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from conftest import SF_SMALL
from spendframe.plans.query import Model

# order: key, customer, status ('P' = declined), date, priority (channel)
ORDERS = [
    (1, 1, "F", datetime(1999, 3, 1), "3-MEDIUM"),
    (2, 1, "F", datetime(2000, 2, 29), "3-MEDIUM"),
    (3, 2, "F", datetime(2000, 3, 1), "5-LOW"),
    (4, 2, "F", datetime(2001, 2, 28), "3-MEDIUM"),
    (5, 1, "F", datetime(2001, 3, 1), "5-LOW"),
    (6, 2, "P", datetime(2000, 6, 15), "3-MEDIUM"),
]
# line: order, part, supplier (card), line number, price (quantity 5: a purchase)
LINES = [(1, 1, 10, 1, 100.0), (2, 1, 10, 1, 50.0), (2, 2, 10, 2, 1.0), (3, 2, 11, 1, 10.0),
         (4, 2, 10, 1, 7.0), (5, 1, 11, 1, 3.0), (6, 1, 10, 1, 999.0)]


@pytest.fixture(scope="module")
def tiny_src():
    out = tempfile.mkdtemp(prefix="spendframe-fixture-")
    rows = {
        "orders": [dict(o_orderkey=k, o_custkey=c, o_orderstatus=s, o_totalprice=0.0,
                        o_orderdate=d, o_orderpriority=p) for k, c, s, d, p in ORDERS],
        "lineitem": [dict(l_orderkey=o, l_partkey=pk, l_suppkey=sk, l_linenumber=ln,
                          l_quantity=5.0, l_extendedprice=px, l_discount=0.0, l_tax=0.0,
                          l_returnflag="N", l_linestatus="F", l_shipdate=datetime(2001, 6, 1))
                     for o, pk, sk, ln, px in LINES],
        "customer": [dict(c_custkey=i, c_name=f"c{i}", c_nationkey=0, c_acctbal=100.0,
                          c_mktsegment="BUILDING") for i in (1, 2)],
        "supplier": [dict(s_suppkey=10, s_name="s10", s_nationkey=0, s_acctbal=2500.0),
                     dict(s_suppkey=11, s_name="s11", s_nationkey=0, s_acctbal=750.25)],
        "part": [dict(p_partkey=i, p_name=f"p{i}", p_brand=f"Brand#{i}", p_type="T", p_size=1,
                      p_retailprice=1.0) for i in (1, 2)],
        "nation": [dict(n_nationkey=0, n_name="FRANCE", n_regionkey=0)],
        "region": [dict(r_regionkey=0, r_name="EUROPE")],
    }
    for name, data in rows.items():
        schema = pq.read_schema(os.path.join(SF_SMALL, f"{name}.parquet"))
        pq.write_table(pa.Table.from_pylist(data, schema=schema),
                       os.path.join(out, f"{name}.parquet"))
    return out


def _by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_prior_year_leap_day_partial_last_year(spark, tiny_src):
    got = _by(Model(spark, tiny_src).evaluate(["year"], ["spend", "spend_py", "spend_yoy"]),
              "year")
    assert {y: r["spend"] for y, r in got.items()} == {1999: 100.0, 2000: 61.0, 2001: 10.0}
    # 29 Feb 2000 moves to 28 Feb 2001; rows of 2001 shift past the last date and drop out
    assert {y: r["spend_py"] for y, r in got.items()} == {1999: None, 2000: 100.0, 2001: 61.0}
    assert got[1999]["spend_yoy"] is None
    assert math.isclose(got[2001]["spend_yoy"], (10.0 - 61.0) / 61.0)


def test_trailing_12_months(spark, tiny_src):
    got = _by(Model(spark, tiny_src).evaluate(["year"], ["spend_12m"]), "year")
    # (end - 12 months, end], end = last visible date of the group
    assert {y: r["spend_12m"] for y, r in got.items()} == {1999: 100.0, 2000: 61.0, 2001: 10.0}
    tot = Model(spark, tiny_src).evaluate([], ["spend_12m"]).first()["spend_12m"]
    assert tot == 10.0          # (2000-03-01, 2001-03-01]


def test_credit_limit_counts_a_card_once(spark, tiny_src):
    got = _by(Model(spark, tiny_src).evaluate(["channel"], ["total_credit_limit"]), "channel")
    # card 10 appears on four orders (one declined) of 3-MEDIUM: counted once
    assert {c: r["total_credit_limit"] for c, r in got.items()} == {"3-MEDIUM": 2500.0,
                                                                  "5-LOW": 750.25}
    tot = Model(spark, tiny_src).evaluate([], ["total_credit_limit"]).first()
    assert tot["total_credit_limit"] == 3250.25
