"""Plan shape: what must hold for every registered query at any scale."""
from pyspark.sql import functions as F

from conftest import SF_SMALL
from spendframe.operators.joins import with_scalars

PAIR_JOINS = ("CartesianProduct", "BroadcastNestedLoopJoin")


def test_with_scalars_is_not_a_join(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, v int")
    tot = df.agg(F.sum("v").alias("t"), F.count(F.lit(1)).alias("c"))
    out = with_scalars(df, tot)
    plan = out._jdf.queryExecution().toString()
    assert not any(p in plan for p in PAIR_JOINS)
    assert "mergedValue" in plan or plan.count("Subquery") >= 1
    assert sorted((r.k, r.t, r.c) for r in out.collect()) == [("a", 4, 2), ("b", 4, 2)]


def test_label_status_three_states(spark):
    from spendframe.plans.etl import label_status
    rows = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "id long, fraud int")
    got = {r.id: r.status for r in label_status(rows, labels, "id", "fraud").collect()}
    assert got == {1: "Confirmed fraud", 2: "Confirmed not fraud", 3: "Not labelled"}


def test_no_query_pairs_rows(spark):
    """No registered query plans a cartesian product or a nested-loop join: one-row
    totals are scalar subqueries, ranges are bucketed equi-joins."""
    import __spark_entry__ as E
    bad = []
    for name, fn in sorted(E.queries().items()):
        plan = fn(spark, SF_SMALL)._jdf.queryExecution().toString()
        hits = [p for p in PAIR_JOINS if p in plan]
        if hits:
            bad.append((name, hits))
    assert bad == []


def test_written_import_matches_raw_and_prunes_years(spark):
    """The written star (parquet by year in the shared folder) answers as the raw
    tables do, and a year slicer becomes a partition filter."""
    import __spark_entry__ as E
    from spendframe.plans.binding import materialize, release
    from spendframe.plans.query import Model
    qs = E.queries()
    names = ["q02_spend_by_year", "q07_spend_yoy", "q10_top_cards", "m_total_credit_limit",
             "calendar_band_month"]

    def rows(n):
        return sorted(tuple(sorted((k, str(v)) for k, v in r.asDict().items()))
                      for r in qs[n](spark, SF_SMALL).collect())
    base = {n: rows(n) for n in names}
    materialize(spark, SF_SMALL, written=True)
    try:
        assert {n: rows(n) for n in names} == base
        df = Model(spark, SF_SMALL).evaluate(["channel"], ["spend"], where={"year": 1998})
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(year" in plan and "= 1998)]" in plan
    finally:
        release(spark, SF_SMALL)


def test_eager_dimension_aggregation_matches(spark):
    """Aggregating the fact by the dimensions' foreign keys before joining them gives
    the same answers as joining every fact row (forced on at this small size)."""
    import __spark_entry__ as E
    from spendframe.plans.query import EAGER_CONF
    qs = E.queries()
    names = ["q04_spend_by_category", "v_us_states", "v_spend_by_score_band", "v_brand_by_type",
             "x_by_credit_band", "figures_4_grains"]

    def rows(n):
        return sorted(tuple(sorted((k, str(v)) for k, v in r.asDict().items()))
                      for r in qs[n](spark, SF_SMALL).collect())
    got = {}
    try:
        for mode in ("never", "always"):
            spark.conf.set(EAGER_CONF, mode)
            got[mode] = {n: rows(n) for n in names}
        plan = qs["v_us_states"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset(EAGER_CONF)
    assert got["always"] == got["never"]
    # the fact is aggregated by the client's foreign keys below the client join
    assert plan.index("Aggregate [channel") > plan.index("Join LeftOuter")


def test_approx_distinct_opt_in(spark):
    """Distinct-count measures are exact unless a relative error is set; then they are
    HyperLogLog sketches (no Expand) within that error."""
    from spendframe.plans.measures import APPROX_CONF
    from spendframe.plans.query import Model
    m = Model(spark, SF_SMALL)
    exact = {r.channel: (r.cards, r.clients) for r in
             m.evaluate(["channel"], [("cards", "active_cards"), ("clients", "active_clients")])
             .collect()}
    try:
        spark.conf.set(APPROX_CONF, "0.02")
        df = m.evaluate(["channel"], [("cards", "active_cards"), ("clients", "active_clients")])
        plan = df._jdf.queryExecution().executedPlan().toString()
        approx = {r.channel: (r.cards, r.clients) for r in df.collect()}
    finally:
        spark.conf.unset(APPROX_CONF)
    assert "Expand" not in plan and "approx_count_distinct" in plan
    for k, (c, n) in exact.items():
        assert abs(approx[k][0] - c) <= 0.1 * c and abs(approx[k][1] - n) <= 0.1 * n


def test_size_shuffles_never_lowers(spark):
    from spendframe.session import size_shuffles
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "999")
        assert size_shuffles(spark, SF_SMALL) == 999          # tiny input: keeps the setting
        spark.conf.set(key, "1")
        assert size_shuffles(spark, SF_SMALL) >= 2 * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set(key, old)


def test_eager_dimensions_with_prior_year(spark):
    """Prior year over large dimensions: the dimensions join the daily rollup; the
    answers equal the plan that joins every fact row."""
    from spendframe.plans.query import EAGER_CONF, Model
    cases = [(["category_group"], ["spend", "spend_py", "spend_yoy"], None),
             (["year", "location_type"], ["spend_lfl", "spend_lfl_py", "transactions"],
              {"year": [1997, 1999]}),
             (["credit_score_band", "month_year"], ["spend", "spend_py"],
              {"category_group": "PROMO"}),
             (["channel"], ["spend_py", "transactions_lfl_yoy"],
              {"location_type": "US state", "year": 2000})]
    got = {}
    try:
        for mode in ("never", "always"):
            spark.conf.set(EAGER_CONF, mode)
            got[mode] = [sorted(tuple(r) for r in
                                Model(spark, SF_SMALL).evaluate(k, m, where=w).collect())
                         for k, m, w in cases]
    finally:
        spark.conf.unset(EAGER_CONF)
    assert got["always"] == got["never"]
    assert all(got["never"])


def test_eager_dimensions_in_side_plans(spark):
    """Credit limit, trailing 12 months, cleared-filter shares and the prior-year
    fallback below large dimensions equal the plans that join every fact row."""
    from spendframe.plans.query import EAGER_CONF, Model
    cases = [(["credit_score_band"], ["total_credit_limit", "annual_spend_to_limit",
                                      "active_cards"], None),
             (["category_group", "year"], ["spend_12m", "spend"], {"location_type": "US state"}),
             (["category"], ["spend_share", "spend"], {"category_group": "PROMO"}),
             (["card_brand", "year"], ["spend_py", "active_cards"],
              {"income_band": ["$50k-$75k", "$110k+"]}),
             (["location_type"], ["spend_12m", "total_credit_limit"], {"year": 1999})]
    got = {}
    try:
        for mode in ("never", "always"):
            spark.conf.set(EAGER_CONF, mode)
            got[mode] = [sorted(tuple(r) for r in
                                Model(spark, SF_SMALL).evaluate(k, m, where=w).collect())
                         for k, m, w in cases]
    finally:
        spark.conf.unset(EAGER_CONF)
    assert got["always"] == got["never"]
    assert all(got["never"])


def test_global_query_over_no_rows_is_one_row_with_zero_counts(spark):
    """A filter that matches nothing: one row, counts 0, sums and prior year null - in the
    plain plan, the one-scan prior year and the eager plan alike."""
    import spendframe.plans.query as Q
    cases = [(["transactions", "spend"], {"category_group": "NOPE"}),
             (["transactions", "spend", "spend_py"], {"category_group": "NOPE"}),
             (["transactions", "spend_py"], {"channel": "NOPE"}),
             (["transactions", "total_credit_limit", "spend_12m"], {"location_type": "NOPE"})]
    want = [[(0, None)], [(0, None, None)], [(0, None)], [(0, None, None)]]
    try:
        for mode in ("never", "always"):
            spark.conf.set(Q.EAGER_CONF, mode)
            got = [[tuple(r) for r in Q.Model(spark, SF_SMALL).evaluate([], m, where=w).collect()]
                   for m, w in cases]
            assert got == want, mode
    finally:
        spark.conf.unset(Q.EAGER_CONF)


def test_eager_keeps_key_distinct_counts_exact(spark):
    """Active cards / clients under eager aggregation: the key column joins the
    pre-aggregation key and is counted distinctly after the dimension join.  Client bands
    need only the client key (a location also needs channel and line)."""
    from spendframe.plans.query import EAGER_CONF, Model
    cases = [(["credit_score_band"], ["active_clients", "active_cards", "spend"], None),
             ([], ["active_clients", "transactions"], {"income_band": "$110k+"}),
             (["card_type", "year"], ["active_cards", "decline_rate"], {"location_type": "US state"})]
    got = {}
    try:
        for mode in ("never", "always"):
            spark.conf.set(EAGER_CONF, mode)
            got[mode] = [sorted(tuple(r) for r in
                                Model(spark, SF_SMALL).evaluate(k, m, where=w).collect())
                         for k, m, w in cases]
        plan = (Model(spark, SF_SMALL).evaluate(["credit_score_band"], ["active_clients"])
                ._jdf.queryExecution().optimizedPlan().toString())
    finally:
        spark.conf.unset(EAGER_CONF)
    assert got["always"] == got["never"]
    assert all(got["never"])
    assert "Aggregate [client_key" in plan and "line_number" not in plan


def test_fact_join_is_sized_by_the_data(spark, monkeypatch):
    """Tables worth more partitions than twice the cores get them, however the session is set, so
    that the rows which one task of ``column_profile`` counts do not grow with the data."""
    import __spark_entry__ as E
    from spendframe import session
    from spendframe.plans.binding import Star
    cores, had = spark.sparkContext.defaultParallelism, spark.conf.get("spark.sql.shuffle.partitions")
    assert Star(spark, SF_SMALL).join_partitions() == 0
    monkeypatch.setattr(session, "TARGET_PARTITION_BYTES", 1024)
    n = Star(spark, SF_SMALL).join_partitions()
    assert n > 2 * cores
    try:
        plan = E.queries()["column_profile"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert "l_orderkey#" in plan and plan.count(f", {n}\n") >= 2      # both sides of the join
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) >= n    # and the counts of values after it
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", had)
