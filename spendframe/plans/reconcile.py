"""Reconciliation, comparison and profiling jobs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from spendframe.functions import constants as K
from spendframe.operators.calendar import zero_fill
from spendframe.operators.reconcile import column_profile as profile_op
from spendframe.operators.reconcile import field_diff, multiset_diffs, widen
from spendframe.operators.topn import top_n_with_ties
from spendframe.plans.benchmark import GRAINS, figures_4_grains, shared_flat, shared_star
from spendframe.plans.calendar import Calendar
from spendframe.plans.flat import flat_table
from spendframe.plans.binding import Star
from spendframe.plans.oracle import measure_sql, with_ctes
from spendframe.plans.query import Model
from spendframe.plans.registry import ORACLE, QUERIES, register
from spendframe.session import size_shuffles

FIELDS = ["transactions", "approved", "spend", "decline_rate", "labelled", "fraud", "fraud_10k",
          "fraud_10k_naive", "cards", "clients"]
FIELD_MEASURES = [("transactions", "transactions"), ("approved", "approved_transactions"),
                  ("spend", "spend"), ("decline_rate", "decline_rate"),
                  ("labelled", "labelled_transactions"), ("fraud", "fraud_transactions"),
                  ("fraud_10k", "fraud_rate_10k"), ("fraud_10k_naive", "fraud_rate_10k_all"),
                  ("cards", "active_cards"), ("clients", "active_clients")]
TOL = {"decline_rate": K.TOL_RATE, "fraud_10k": K.TOL_PER10K, "fraud_10k_naive": K.TOL_PER10K}


def model_figures(spark, src):
    """The measure layer's answer at the four grains (actual side of X4)."""
    m = Model.over_shared(spark, src, [k for _, k in GRAINS] + ["ok", "lab", "fr", "amount", "card_key", "client_key"])
    out = None
    for grain, key in GRAINS:
        r = m.evaluate([key], FIELD_MEASURES).select(
            F.lit(grain).alias("grain"), F.col(key).cast("string").alias("key"), *FIELDS)
        out = r if out is None else out.unionByName(r)
    return out


def _summary(diff):
    return diff.groupBy("field").agg(F.count(F.lit(1)).alias("checks"),
                                     F.count_if(~F.col("ok")).alias("mismatches"))


def _reconcile_sql() -> str:
    """The same comparison in SQL: the figures by one formula each against the measures' own."""
    actual = " UNION ALL ".join(
        f"SELECT '{grain}' AS grain, CAST({key} AS VARCHAR) AS key, " + ", ".join(
            f"{measure_sql(m)} AS {f}" for f, m in FIELD_MEASURES) + f" FROM att GROUP BY {key}" for grain, key in GRAINS)
    fields = " UNION ALL ".join(
        f"SELECT '{f}' AS field, e.grain IS NOT NULL AND a.grain IS NOT NULL AND coalesce(abs(CAST(e.{f} AS DOUBLE) - "
        f"coalesce(CAST(a.{f} AS DOUBLE), 0)) <= {TOL.get(f, K.TOL_MONEY)}, false) AS ok "
        f"FROM fig e FULL JOIN act a ON e.grain = a.grain AND e.key IS NOT DISTINCT FROM a.key" for f in FIELDS)
    return with_ctes("SELECT field, count(*) AS checks, count(*) FILTER (WHERE NOT ok) AS mismatches "
                     f"FROM ({fields}) GROUP BY field", f"fig AS ({ORACLE['figures_4_grains']})", f"act AS ({actual})")


@register("reconcile_figures", _reconcile_sql())
def reconcile_figures(spark, src):
    """The independent recomputation (grouping-sets pass, blanks as 0) against the
    measure layer, field by field with tolerances; NaN or one-sided keys fail."""
    size_shuffles(spark, src)          # pairs grow with the data: more parts, not larger ones that spill
    diff = field_diff(figures_4_grains(spark, src), model_figures(spark, src),
                      ["grain", "key"], FIELDS, TOL, default_tol=K.TOL_MONEY)
    return _summary(diff)


def expected_calendar(spark, src):
    """Answer key for the calendar: decimal daily sums from the A13 job, zero-filled,
    banded with a range-frame count (a different formulation from rank())."""
    daily = QUERIES["daily_spend"](spark, src).select(
        "date", F.col("spend").cast("decimal(22,2)").alias("v"))
    cal = Calendar(spark, src)
    d = zero_fill(cal.spine().select("date", "year", "quarter"), daily, ["v"])
    grains = [
        d.select(F.lit("Day").alias("view"), F.date_format("date", "yyyy-MM-dd").alias("key"),
                 F.date_format("date", "yyyy-MM").alias("pool"), "v"),
        d.groupBy(F.date_format("date", "yyyy-MM").alias("key"),
                  F.col("year").cast("string").alias("pool")).agg(F.sum("v").alias("v"))
         .select(F.lit("Month").alias("view"), "key", "pool", "v"),
        d.groupBy(F.concat(F.col("year").cast("string"), F.lit("-"), F.col("quarter")).alias("key"))
         .agg(F.sum("v").alias("v")).select(F.lit("Quarter").alias("view"), "key",
                                             F.lit("all").alias("pool"), "v"),
        d.groupBy(F.col("year").cast("string").alias("key")).agg(F.sum("v").alias("v"))
         .select(F.lit("Year").alias("view"), "key", F.lit("all").alias("pool"), "v"),
    ]
    cells = grains[0]
    for g in grains[1:]:
        cells = cells.unionByName(g)
    live = F.col("v") > 0
    w_le = (Window.partitionBy("view", "pool").orderBy("v")
            .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    le = F.count(F.when(live, F.lit(1))).over(w_le)
    eq = F.count(F.when(live, F.lit(1))).over(Window.partitionBy("view", "pool", "v"))
    n = F.count(F.when(live, F.lit(1))).over(Window.partitionBy("view", "pool"))
    below = le - eq
    band = (F.when(~live, 0).when(n == 1, 5)
            .otherwise(F.least(F.lit(5), F.floor(below * 5 / (n - 1)).cast("int") + 1)))
    return cells.select("view", "key", F.round(F.col("v"), 2).cast("double").alias("value"),
                        band.cast("double").alias("band"))


@register("reconcile_calendar", with_ctes(
    "SELECT 'Day' AS view, count(*) AS cells, CAST(0 AS BIGINT) AS mismatches FROM date_dim "
    "UNION ALL SELECT 'Month', count(DISTINCT month), 0 FROM date_dim "
    "UNION ALL SELECT 'Quarter', count(DISTINCT quarter_key), 0 FROM date_dim "
    "UNION ALL SELECT 'Year', count(DISTINCT year), 0 FROM date_dim"))
def reconcile_calendar(spark, src):
    """Every calendar cell's value (+/-0.011) and band (exact) against the answer
    key; a cell on one side only is a mismatch."""
    actual = Calendar(spark, src).cells().select(
        "view", "key", F.col("v").cast("double").alias("value"),
        F.col("band").cast("double").alias("band"))
    diff = field_diff(expected_calendar(spark, src), actual, ["view", "key"], ["value", "band"],
                      {"band": 0.0}, default_tol=K.TOL_MONEY, blank_as_zero=False)
    per_cell = diff.groupBy("view", "key").agg(F.min(F.col("ok").cast("int")).alias("_ok"))
    return per_cell.groupBy("view").agg(F.count(F.lit(1)).alias("cells"),
                                        F.count_if(F.col("_ok") == 0).alias("mismatches"))


PAIRS = [("q01_total_spend", "f01_total_spend", ["spend", "approved", "declines"]),
         ("q02_spend_by_year", "f02_spend_by_year", ["spend", "approved"]),
         ("q03_spend_by_channel", "f03_spend_by_channel", ["spend", "txn"]),
         ("q04_spend_by_category", "f04_spend_by_category", ["spend", "txn"]),
         ("q05_fraud_by_channel", "f05_fraud_by_channel", ["labelled", "fraud", "per10k"]),
         ("q06_distinct_counts", "f06_distinct_counts", ["cards", "clients", "avg"]),
         ("q07_spend_yoy", "f07_spend_yoy", ["spend", "py", "yoy"]),
         ("q08_card_by_year", "f08_card_by_year", ["spend", "txn", "decline"]),
         ("q09_cards_by_month", "f09_cards_by_month", ["cards", "spend", "fraud"]),
         ("q10_top_cards", "f10_card_detail", ["spend", "txn", "decline"])]


def _pair_sql(q, f, cols) -> str:
    """Sorted and paired by position, as the comparison is meant: the pairs that differ by
    more than the tolerance, plus the values that one side has more."""
    lst = ", ".join(f"CAST({c} AS DOUBLE)" for c in cols)

    def ranked(name):
        return (f"SELECT round(v, 2) AS v, row_number() OVER (ORDER BY round(v, 2)) AS i FROM "
                f"(SELECT unnest([{lst}]) AS v FROM ({ORACLE[name]})) WHERE v IS NOT NULL AND NOT isnan(v)")
    return (f"SELECT '{q[:3]}' AS query, count(*) = 0 AS match FROM ({ranked(q)}) a FULL OUTER JOIN "
            f"({ranked(f)}) b ON a.i = b.i WHERE a.i IS NULL OR b.i IS NULL "
            f"OR round(abs(a.v - b.v) * 100) > {int(round(K.TOL_MULTISET * 100))}")


@register("multiset_match", "\nUNION ALL\n".join(_pair_sql(q, f, c) for q, f, c in PAIRS))
def multiset_match(spark, src):
    """Star vs flat, per query: are the numbers returned the same multiset (2 dp, +/-0.02)?
    The star's and the flat model's ten answers each come from one read of their table, in one plan
    (the prior-year pair is expected to differ: visible-date shift vs year arithmetic)."""
    star, flat = shared_star(spark, src), shared_flat(spark, src)
    ahead = multiset_diffs({q[:3]: (QUERIES[q](spark, star), QUERIES[f](spark, flat), cols, cols) for q, f, cols in PAIRS})
    unlike = ahead.groupBy(F.col("name").alias("query")).agg(F.count(F.lit(1)).alias("_n"))
    names = spark.createDataFrame([(q[:3],) for q, _, _ in PAIRS], "query string")
    return names.join(F.broadcast(unlike), "query", "left").select("query", F.col("_n").isNull().alias("match"))


def diverging(star, flat, keys: list[str], fields: list[str], tolerance: float = K.TOL_MULTISET):
    """X7 for any pair: rows on which two answers differ by more than the tolerance, rows of
    one side alone included; null keys match null keys."""
    s = star.select(*keys, *[F.col(c).alias(f"{c}_star") for c in fields], F.lit(True).alias("_s"))
    n = flat.select(*[F.col(k).alias(f"_{k}") for k in keys], *[F.col(c).alias(f"{c}_naive") for c in fields],
                    F.lit(True).alias("_n"))
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    same = F.lit(True)
    for c in fields:
        a, b = F.col(f"{c}_star").cast("double"), F.col(f"{c}_naive").cast("double")
        same = same & (a.eqNullSafe(b) | F.coalesce(F.abs(a - b) <= tolerance, F.lit(False)))
    alone = F.col("_s").isNull() | F.col("_n").isNull()
    return s.join(n, on, "full").where(alone | ~same).select(
        *[F.when(F.col("_s"), F.col(k)).otherwise(F.col(f"_{k}")).alias(k) for k in keys],
        *[f"{c}_{side}" for side in ("star", "naive") for c in fields])


@register("divergence",
          "SELECT coalesce(s.year, n.year) AS year, s.spend AS spend_star, s.py AS py_star, s.yoy AS yoy_star, "
          "n.spend AS spend_naive, n.py AS py_naive, n.yoy AS yoy_naive "
          f"FROM ({ORACLE['q07_spend_yoy']}) s FULL JOIN ({ORACLE['f07_spend_yoy']}) n ON s.year = n.year "
          "WHERE s.year IS NULL OR n.year IS NULL OR " + " OR ".join(
              f"((s.{c} IS NULL) <> (n.{c} IS NULL) OR abs(CAST(s.{c} AS DOUBLE) - CAST(n.{c} AS DOUBLE)) > {K.TOL_MULTISET})"
              for c in ("spend", "py", "yoy")))
def divergence(spark, src):
    """The years in which the star and the flat model answer the same question (spend
    and prior-year spend) differently."""
    return diverging(QUERIES["q07_spend_yoy"](spark, src), QUERIES["f07_spend_yoy"](spark, src),
                     ["year"], ["spend", "py", "yoy"])


@register("result_widen",
          "SELECT CAST(row_number() OVER (ORDER BY year) AS INTEGER) AS i, py, spend, yoy "
          f"FROM ({ORACLE['q07_spend_yoy']})")
def result_widen(spark, src):
    """A long (column, value) result turned back into positional wide rows."""
    r = QUERIES["q07_spend_yoy"](spark, src)
    long = r.selectExpr("year AS ord",
                        "stack(3, 'spend', spend, 'py', py, 'yoy', yoy) AS (column, value)")
    return widen(long, "column", "value", "ord", ["py", "spend", "yoy"])


#: Flat column -> its text in SQL over ``att``.
PROFILE = {
    "transaction_id": "order_key || '-' || line_number", "timestamp": "strftime(date, '%Y-%m-%d %H:%M:%S')",
    "date": "date", "hour": "hour", "client_id": "client_key", "card_id": "card_key", "amount": "amount",
    "channel": "channel", "mcc_text": "mcc", "errors": "coalesce(errors, '')",
    "fraud_label": "CASE fraud_key WHEN 2 THEN 'Yes' WHEN 1 THEN 'No' ELSE '' END", "merchant_category": "category",
    "merchant_state": "coalesce(merchant_state, '')", "card_brand": "card_brand", "card_type": "card_type",
    "card_has_chip": "CASE WHEN has_chip = 'Chip' THEN 'YES' ELSE 'NO' END", "card_credit_limit": "credit_limit",
    "client_age": "age", "client_yearly_income": "yearly_income", "client_credit_score": "credit_score",
    "year": "year", "month_year": "month_year", "is_approved": "is_approved",
    "spend_amount": "CASE WHEN ok THEN amount END", "is_fraud": "is_fraud",
}
PROFILE_TOP = 12


def _profile_sql() -> str:
    rows = " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({e} AS VARCHAR) AS value FROM att" for c, e in PROFILE.items())
    return with_ctes(
        "SELECT column_name, count(value) AS distinct_count, CAST(coalesce(sum(n) FILTER (WHERE coalesce(value, '') = ''), 0) AS BIGINT) "
        "AS blanks, CAST(coalesce(sum(length(value) * n), 0) AS BIGINT) AS bytes, "
        "CAST(coalesce(sum(length(value) * n), 0) AS DOUBLE) / sum(n) AS avg_bytes, "
        "CAST(coalesce(sum(length(value) * n), 0) AS DOUBLE) / sum(sum(length(value) * n)) OVER () AS share, "
        "first(value ORDER BY n DESC, value) FILTER (WHERE coalesce(value, '') <> '') AS top_value, "
        "CAST(max(n) FILTER (WHERE coalesce(value, '') <> '') AS BIGINT) AS top_count, "
        "CAST(row_number() OVER (ORDER BY sum(length(value) * n) DESC, column_name) AS INTEGER) AS rank "
        f"FROM ledger GROUP BY column_name QUALIFY rank <= {PROFILE_TOP}",
        f"vals AS ({rows})", "ledger AS (SELECT column_name, value, count(*) AS n FROM vals GROUP BY 1, 2)")


@register("column_profile", _profile_sql())
def column_profile(spark, src):
    """X8 re-aimed: the flat table's columns by what they cost, keys and timestamp included: the
    dozen dearest.  A task holds the values of its share of rows, so shares are sized by the data."""
    size_shuffles(spark, src)
    return profile_op(flat_table(Star(spark, src)), list(PROFILE), PROFILE_TOP)


@register("top_bottom_n", with_ctes(
    "SELECT direction, category, spend, rank FROM ("
    "SELECT 'top' AS direction, category, CAST(sum(amount) FILTER (WHERE ok) AS DOUBLE) AS spend, "
    "CAST(rank() OVER (ORDER BY sum(amount) FILTER (WHERE ok) DESC NULLS LAST) AS INTEGER) AS rank "
    "FROM att GROUP BY category UNION ALL "
    "SELECT 'bottom', category, CAST(sum(amount) FILTER (WHERE ok) AS DOUBLE), "
    "CAST(rank() OVER (ORDER BY sum(amount) FILTER (WHERE ok) ASC NULLS LAST) AS INTEGER) "
    "FROM att GROUP BY category) WHERE rank <= 5"))
def top_bottom_n(spark, src, n: int = 5):
    """Top or bottom N by competition rank (ties share a rank, all kept), each as a
    one-pass top-N with ties (per-task partial limits, bounded final task)."""
    r = Model(spark, src).evaluate(["category"], ["spend"])
    out = [top_n_with_ties(r, n, "spend", ascending=asc, rank_col="rank")
           .select(F.lit(direction).alias("direction"), "category", "spend", "rank")
           for direction, asc in (("top", False), ("bottom", True))]
    return out[0].unionByName(out[1])
