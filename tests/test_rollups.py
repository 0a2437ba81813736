"""Shared rollups: distinct counts, dense numbers, totals and trailing sums from one read of the fact."""
import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from spendframe.operators import dense, distinct
from spendframe.plans.measures import APPROX_CONF
from spendframe.plans.query import Model

from conftest import SF_CHECK, SF_SMALL


def static_plan(spark, df):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


@pytest.mark.parametrize("name", [
    "figures_4_grains", "column_cardinality", "q06_distinct_counts", "f06_distinct_counts", "value_counts",
    "surrogate_keys", "category_rank", "spend_12m", "q07_spend_yoy", "spend_yoy", "v_category_spend",
    "v_decline_reasons", "v_us_states"])
def test_the_fact_is_read_once(spark, name):
    plan = static_plan(spark, lambda: E.queries()[name](spark, SF_SMALL))
    assert plan.count("lineitem.parquet") == 1 and "Expand " not in plan


@pytest.mark.parametrize("name", ["surrogate_keys", "category_rank"])
def test_no_window_over_a_whole_table(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().analyzed().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert windows and all("], [__place" in line for line in windows)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = [(rng.choice("ab"), rng.choice([None, 1, 2]), rng.choice([None, *range(9)]), rng.choice("xyz"), rng.randint(-5, 9))
            for _ in range(600)]
    return spark.createDataFrame(data, "g string, h int, k bigint, t string, v int").repartition(7), data


def test_pair_rollup_is_exact_and_merges(spark, rows):
    df, data = rows
    keys = {"ks": F.col("k"), "ts": F.col("t"), "pos": F.when(F.col("v") > 0, F.col("k"))}
    values = {"n": (F.lit(1), "count"), "s": (F.col("v"), "sum"), "top": (F.col("v"), "max"), "low": (F.col("v"), "min")}
    how = {n: h for n, (_, h) in values.items()}

    def want(own):
        return (len({r[2] for r in own} - {None}), len({r[3] for r in own}), len({r[2] for r in own if r[4] > 0} - {None}),
                len(own), sum(r[4] for r in own), max(r[4] for r in own), min(r[4] for r in own))

    roll = distinct.pair_rollup(df, ["g", "h"], keys, values)
    halves = [distinct.pair_rollup(df.where(c), ["g", "h"], keys, values) for c in ("v % 2 = 0", "v % 2 <> 0")]
    for pairs in (roll, distinct.merged(halves[0].union(halves[1]), ["g", "h"], how)):
        got = {r[0]: tuple(r[1:]) for r in distinct.counted(distinct.merged(pairs, ["g"], how), ["g"], list(keys), how).collect()}
        assert got == {g: want([r for r in data if r[0] == g]) for g in "ab"}
        grains = {(r[0], r[1]): tuple(r[2:]) for r in distinct.by_grains(pairs, [("G", "g"), ("H", "h")], list(keys), how).collect()}
        assert grains == {**{("G", g): want([r for r in data if r[0] == g]) for g in "ab"},
                          **{("H", None if h is None else str(h)): want([r for r in data if r[1] == h]) for h in (None, 1, 2)}}
    none = distinct.counted(distinct.pair_rollup(df.where("false"), [], keys, values), [], list(keys), how).first()
    assert none.ks == none.ts == 0 and none.s is None
    plain = distinct.counted(distinct.pair_rollup(df, [], {"ks": F.col("k"), "ts": F.col("t")}), [], ["ks", "ts"], {}).first()
    assert (plain.ks, plain.ts) == (9, 3)


@pytest.mark.parametrize("error", [0.05, 0.01])
def test_sketches_keep_their_error_at_every_grain(spark, error):
    """Estimates from one sketch rollup lie within three standard errors, merged or not."""
    df = spark.range(60000).select((F.col("id") % 4).alias("g"), (F.col("id") % 3).alias("h"), (F.col("id") % 20011).alias("k"))
    roll = distinct.sketch_rollup(df, ["g", "h"], {"ks": F.col("k")}, {"n": (F.lit(1), "count")}, error)
    got = distinct.estimated_by_grains(roll, [("G", "g"), ("H", "h")], ["ks"], {"n": "count"}).collect()
    exact = {("G", str(g)): len({i % 20011 for i in range(60000) if i % 4 == g}) for g in range(4)}
    exact |= {("H", str(h)): len({i % 20011 for i in range(60000) if i % 3 == h}) for h in range(3)}
    assert {(r.grain, r.grain_key) for r in got} == set(exact)
    for r in got:
        assert abs(r.ks - exact[r.grain, r.grain_key]) <= 3 * error * exact[r.grain, r.grain_key]
    assert sum(r.n for r in got) == 120000


def test_figures_by_sketches(spark):
    exact = {(r.grain, r["key"]): r for r in E.queries()["figures_4_grains"](spark, SF_CHECK).collect()}
    try:
        spark.conf.set(APPROX_CONF, "0.02")
        df = E.queries()["figures_4_grains"](spark, SF_CHECK)
        assert "hll_sketch_agg" in df._jdf.queryExecution().optimizedPlan().toString()
        got = df.collect()
    finally:
        spark.conf.unset(APPROX_CONF)
    assert len(got) == len(exact)
    for r in got:
        e = exact[r.grain, r["key"]]
        assert r.transactions == e.transactions and r.spend == e.spend
        assert abs(r.cards - e.cards) <= max(1, 0.06 * e.cards) and abs(r.clients - e.clients) <= max(1, 0.06 * e.clients)


@pytest.mark.parametrize("bounds", [3, 255])
def test_dense_numbers(spark, monkeypatch, rows, bounds):
    """Numbers and ranks equal the window's, with ties, nulls and more ranges than values."""
    monkeypatch.setattr(dense, "BOUNDS", bounds)
    df, data = rows
    places = df.select("h", "t", "v").distinct()
    got = [(r.h, r.t, r.v, r.i) for r in dense.with_row_number(places, ["h", "t", "v"], "i").collect()]
    order = sorted({(r[1], r[3], r[4]) for r in data}, key=lambda r: (r[0] is not None, r))
    assert sorted(got, key=lambda r: r[3]) == [(*r, i) for i, r in enumerate(order, 1)]
    groups = df.groupBy("t", "k").agg(F.max("v").alias("m"), F.max(F.when(F.col("v") > 7, F.col("h"))).alias("x"))
    for column in ("m", "x"):
        ranked = dense.with_dense_rank(groups, [column], "r", descending=True).collect()
        values = sorted({r[column] for r in ranked}, key=lambda v: (v is None, -(v or 0)))
        assert all(values[r.r - 1] == r[column] for r in ranked) and len(ranked) == groups.count()
    assert dense.with_row_number(places.where("false"), ["h", "t", "v"], "i").collect() == []


def test_trailing_12_months_against_the_definition(spark):
    """Every group with its end, sparse days, date filters and other keys, against sums by hand."""
    m = Model(spark, SF_SMALL)
    days = [(r.date, r.year, r.month_no) for r in m.spine().select("date", "year", "month_no").collect()]
    fact = [(r.channel, r.date, r.amount if r.ok else None) for r in m.fact({"channel", "date", "ok", "amount"}).collect()]

    def back(d):
        y = d.replace(year=d.year - 1) if (d.month, d.day) != (2, 29) else d.replace(year=d.year - 1, day=28)
        return y

    for where in (None, {"year": [1997, 1998]}, {"channel": "2-HIGH"}):
        got = {(r.channel, r.year): r.spend_12m for r in m.evaluate(["channel", "year"], ["spend_12m"], where=where).collect()}
        seen = [d for d in days if not where or "year" not in where or d[1] in where["year"]]
        want = {}
        for c in {f[0] for f in fact if not where or "channel" not in where or f[0] == where["channel"]}:
            for y in {d[1] for d in seen}:
                if any(f[0] == c and f[1].year == y for f in fact):
                    end = max(d[0] for d in seen if d[1] == y)
                    own = [f[2] for f in fact if f[0] == c and back(end) < f[1] <= end and f[2] is not None]
                    want[c, y] = float(sum(own)) if own else None
        assert got == want


def test_filtered_shares_read_one_rollup(spark):
    """A share whose filter is cleared for its total, next to filters that stay."""
    m = Model(spark, SF_SMALL)
    got = {r.location: (r.spend, r.spend_share) for r in m.evaluate(
        ["location"], ["spend", "spend_share"], where={"location_type": "US state", "year": 1997}).collect()}
    f = m.fact({"location", "location_type", "year", "ok", "amount"}).where("year = 1997 AND ok")
    total = f.agg(F.sum("amount")).first()[0]
    own = f.where("location_type = 'US state'").groupBy("location").agg(F.sum("amount").alias("s")).collect()
    assert {k: v for k, v in got.items() if v[0] is not None} == {r.location: (float(r.s), float(r.s) / float(total)) for r in own}


def test_values_travel_once_per_cell_and_pairs_without_them(spark):
    """Values stand in a lane of their own, one row per cell; for the grains all pairs of a key are
    brought together once, so no pair is dealt out once per grain."""
    df = spark.createDataFrame([(i % 2, f"h{i % 3}", i % 5 or None, i) for i in range(60)], "g int, h string, k int, v int")
    values = {"n": (F.lit(1), "count"), "s": (F.col("v"), "sum")}
    roll = distinct.pair_rollup(df, ["g", "h"], {"ks": F.col("k")}, values)
    rows = roll.collect()
    held = [r for r in rows if r.lane == distinct.VALUES]
    assert len(held) == 6 and sum(r.n for r in held) == 60 and sum(r.s for r in held) == sum(range(60))
    pairs = [r for r in rows if r.lane != distinct.VALUES]
    assert len(pairs) == 6 * 4 and all(r.key is not None and not r.n and r.s is None for r in pairs)
    by = distinct.by_grains(roll, [("G", "g"), ("H", "h")], ["ks"], {"n": "count", "s": "sum"})
    assert {(r.grain, r.grain_key): (r.ks, r.n) for r in by.collect()} == {
        **{("G", str(g)): (4, 30) for g in (0, 1)}, **{("H", f"h{h}"): (4, 20) for h in range(3)}}
    plan = static_plan(spark, lambda: distinct.by_grains(roll, [("G", "g"), ("H", "h")], ["ks"], {"n": "count", "s": "sum"}))
    assert "hashpartitioning(lane#" in plan and not any(
        "hashpartitioning(grain" in line and "lane#" in line for line in plan.splitlines())


def test_pairs_with_coded_cells_give_the_same_figures(spark, rows):
    """Cells joined back by their codes, against cells that travel whole: null cells and keys,
    a group without any key, all kinds of values, no rows."""
    df, _ = rows
    df = df.withColumn("k", F.when(F.col("g") == "b", F.col("k")))
    keys = {"ks": F.col("k"), "ts": F.col("t")}
    values = {"n": (F.lit(1), "count"), "s": (F.col("v"), "sum"), "top": (F.col("v"), "max"), "low": (F.col("v"), "min")}
    grains, how = [("G", "g"), ("H", "h")], {n: h for n, (_, h) in values.items()}
    want = distinct.by_grains(distinct.pair_rollup(df, ["g", "h"], keys, values), grains, list(keys), how)
    got = distinct.coded_by_grains(df, grains, keys, values)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert {(r.grain, r.grain_key): r.ks for r in got.collect()}["G", "a"] == 0
    assert distinct.coded_by_grains(df.where("false"), grains, keys, values).collect() == []
    plan = static_plan(spark, lambda: distinct.coded_by_grains(df, grains, {"ks": F.col("k")}, values))
    dealt = [line for line in plan.splitlines() if "hashpartitioning(lane#" in line]
    assert dealt and "code#" not in dealt[0].split("hashpartitioning")[1]


@pytest.mark.parametrize("src", ["multiset_match", "web_export_json"])
def test_answers_by_few_values_add_up_one_rollup(spark, monkeypatch, src):
    """Queries made of many answers count the fact's rows once for all answers by keys of few
    values; the answers are those of the queries alone."""
    from spendframe.plans import benchmark as B, exports as X
    seen, own = [], Model.with_cells
    monkeypatch.setattr(Model, "with_cells", lambda m, *a: seen.append(m) or own(m, *a))
    plan = static_plan(spark, lambda: E.queries()[src](spark, SF_SMALL))
    assert len(seen) == 1
    m = seen[0]
    if src == "multiset_match":
        flat = B.shared_flat(spark, SF_SMALL)
        shared = {**{q: m for q in ("q01_total_spend", "q02_spend_by_year", "q03_spend_by_channel", "q04_spend_by_category", "q05_fraud_by_channel")},
                  **{q: flat for q in ("f01_total_spend", "f02_spend_by_year", "f03_spend_by_channel", "f04_spend_by_category", "f05_fraud_by_channel")}}
    else:
        assert plan.count("lineitem.parquet") <= 7      # was one for each section at least
        shared = {q: m for q in X.SECTIONS if q.startswith("x_")}
    for q, rows in shared.items():
        got, alone = (sorted(map(str, E.queries()[q](spark, s).collect())) for s in (rows, SF_SMALL))
        assert got == alone, q


@pytest.mark.parametrize("src", ["multiset_match", "quality_report"])
def test_shared_rows_travel_without_what_follows_from_them(spark, src):
    """Rows dealt out for several answers hold dates, keys and texts, not functions of them."""
    plan = static_plan(spark, lambda: E.queries()[src](spark, SF_SMALL))
    dealt = [x.split("hashpartitioning(")[1] for x in plan.splitlines() if "REPARTITION_BY_COL" in x]
    assert dealt
    for x in dealt:
        assert not set(re.findall(r"(\w+)#", x)) & {"year", "month", "month_year", "lab", "fr", "client_id", "card_id"}, x
