"""Report visuals V1-V26: each is a group-by + measures + filter (+ sort) over the
star.  The year slicer of the pages is the optional ``where`` parameter of
``Model.evaluate``; the registered versions run unsliced over all rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from spendframe.functions.scalar import point_change, signed_percent
from spendframe.plans.oracle import group_sql, measure_sql, with_ctes
from spendframe.plans.query import Model
from spendframe.plans.registry import register
from spendframe.plans.slicers import Between, Chosen, Single

LIMIT_CTES = (
    """lim AS (SELECT s.{k} AS {k}, sum(c.credit_limit) AS lim
        FROM (SELECT DISTINCT {k}, card_key FROM att) s
        JOIN card_dim c ON s.card_key = c.card_key GROUP BY s.{k})""",
    "yrs AS (SELECT count(*) / 365.25 AS years FROM date_dim)",
)


def simple(name: str, keys, measures, where=None, order_by=None):
    """Register a visual whose measures are all plain aggregates."""
    ms = [(m, m) if isinstance(m, str) else m for m in measures]

    def run(spark, src):
        return Model(spark, src).evaluate(keys, ms, where=where, order_by=order_by)
    run.__name__ = name
    register(name, with_ctes(group_sql(keys, ms, where)))(run)


def _ev(keys, measures, where=None, order_by=None):
    def run(spark, src):
        return Model(spark, src).evaluate(keys, measures, where=where, order_by=order_by)
    return run


# ---------------------------------------------------------------- overview page
simple("v_overview_kpis", [], ["approved_transactions", "spend", "average_transaction",
                               "decline_rate", "fraud_rate_10k"])
simple("v_spend_trend", ["month_start"], ["spend"], order_by=["month_start"])

register("v_year_table", with_ctes(
    f"SELECT a.year, {measure_sql('approved_transactions')} AS approved_transactions, "
    f"{measure_sql('spend')} AS spend, "
    "(CAST(sum(a.amount) FILTER (WHERE a.ok AND a.in_lfl = 'Yes') AS DOUBLE) - max(p.py)) "
    "/ NULLIF(max(p.py), 0) AS spend_lfl_yoy, "
    f"{measure_sql('decline_rate')} AS decline_rate, {measure_sql('fraud_rate_10k')} AS fraud_rate_10k "
    "FROM att a LEFT JOIN lfl_py p ON a.year = p.year GROUP BY a.year",
    """lfl_py AS (SELECT d.year, CAST(sum(a.amount) AS DOUBLE) AS py
       FROM att a JOIN date_dim d ON CAST(a.date + INTERVAL 12 MONTH AS DATE) = d.date
       WHERE a.ok AND a.in_lfl = 'Yes' GROUP BY d.year)"""))(
    _ev(["year"], ["approved_transactions", "spend", "spend_lfl_yoy", "decline_rate",
                   "fraud_rate_10k"], order_by=["year"]))

register("v_category_spend", with_ctes(
    f"SELECT category_group, {measure_sql('spend')} AS spend, "
    "CAST(sum(amount) FILTER (WHERE ok) AS DOUBLE) / "
    "CAST(sum(sum(amount) FILTER (WHERE ok)) OVER () AS DOUBLE) AS spend_share, "
    f"{measure_sql('approved_transactions')} AS approved_transactions "
    "FROM att GROUP BY category_group"))(
    _ev(["category_group"], ["spend", "spend_share", "approved_transactions"],
        order_by=["-spend"]))

register("v_channel_mix", with_ctes(
    "SELECT year, channel, count(*) AS transactions, "
    "CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY year) AS channel_share "
    "FROM att GROUP BY year, channel"))(
    _ev(["year", "channel"], ["transactions", "channel_share"]))


simple("v_by_hour", ["hour"], ["approved_transactions"])


# ---------------------------------------------------------------- channel page
simple("v_channel_kpis", [], ["chip_share", "online_share", "card_not_present_share",
                              "decline_rate", "technical_decline_rate"])

register("v_channel_share_month", with_ctes(
    "SELECT month_start, channel, CAST(count(*) AS DOUBLE) / "
    "sum(count(*)) OVER (PARTITION BY month_start) AS channel_share "
    "FROM att GROUP BY month_start, channel"))(
    _ev(["month_start", "channel"], ["channel_share"]))

register("v_decline_reasons", with_ctes(
    f"SELECT outcome, {measure_sql('declined_transactions')} AS declined_transactions, "
    "CAST(count(*) FILTER (WHERE NOT ok) AS DOUBLE) / "
    "(SELECT count(*) FROM att WHERE NOT ok) AS decline_share_of_class, "
    f"{measure_sql('declined_value')} AS declined_value "
    "FROM att WHERE is_approved = 'No' GROUP BY outcome"))(
    _ev(["outcome"], ["declined_transactions", "decline_share_of_class", "declined_value"],
        where={"is_approved": "No"}, order_by=["-declined_transactions"]))

simple("v_channel_table", ["channel"], ["transactions", "spend", "decline_rate",
                                        "fraud_rate_10k"], order_by=["channel"])

# ---------------------------------------------------------------- fraud page
simple("v_fraud_kpis", [], ["labelled_transactions", "label_coverage", "fraud_transactions",
                            "fraud_rate_10k", "fraud_rate_10k_all"])
simple("v_fraud_by_channel", ["channel"], ["fraud_rate_10k", "fraud_transactions",
                                           "fraud_value"])
simple("v_fraud_by_year", ["year"], ["fraud_rate_10k", "fraud_transactions",
                                     "labelled_transactions"], order_by=["year"])
simple("v_fraud_by_category", ["category_group"], ["fraud_rate_10k", "fraud_transactions"])
simple("v_two_denominators", ["channel"], ["transactions", "labelled_transactions",
                                           "fraud_transactions", "fraud_rate_10k",
                                           "fraud_rate_10k_all", "fraud_value_share"])

# ---------------------------------------------------------------- customer page
register("v_customer_kpis", with_ctes(
    f"SELECT {measure_sql('active_clients')} AS active_clients, "
    f"{measure_sql('active_cards')} AS active_cards, "
    f"{measure_sql('spend_per_client')} AS spend_per_client, "
    "(SELECT CAST(sum(c.credit_limit) AS DOUBLE) FROM (SELECT DISTINCT card_key FROM att) s "
    " JOIN card_dim c ON s.card_key = c.card_key) AS total_credit_limit, "
    "(CAST(sum(amount) FILTER (WHERE ok) AS DOUBLE) / (SELECT years FROM yrs)) / "
    "NULLIF((SELECT CAST(sum(c.credit_limit) AS DOUBLE) FROM (SELECT DISTINCT card_key FROM att) s "
    " JOIN card_dim c ON s.card_key = c.card_key), 0) AS annual_spend_to_limit FROM att",
    LIMIT_CTES[1]))(
    _ev([], ["active_clients", "active_cards", "spend_per_client", "total_credit_limit",
             "annual_spend_to_limit"]))

simple("v_spend_by_score_band", ["credit_score_band"], ["spend", "active_clients",
                                                        "decline_rate"])
simple("v_spend_by_income_band", ["income_band"], ["spend", "active_clients",
                                                   "average_transaction"])
simple("v_brand_by_type", ["card_brand", "card_type"], ["spend"])

register("v_score_band_table", with_ctes(
    "SELECT a.credit_score_band, "
    + ", ".join(f"{measure_sql(k)} AS {k}" for k in
                ["active_clients", "active_cards", "spend", "average_transaction"])
    + ", CAST(max(lim.lim) AS DOUBLE) AS total_credit_limit, "
    "(CAST(sum(a.amount) FILTER (WHERE a.ok) AS DOUBLE) / max(yrs.years)) / "
    "NULLIF(CAST(max(lim.lim) AS DOUBLE), 0) AS annual_spend_to_limit, "
    f"{measure_sql('decline_rate')} AS decline_rate, "
    f"{measure_sql('fraud_rate_10k')} AS fraud_rate_10k "
    "FROM att a LEFT JOIN lim ON a.credit_score_band IS NOT DISTINCT FROM lim.credit_score_band "
    "CROSS JOIN yrs GROUP BY a.credit_score_band",
    LIMIT_CTES[0].format(k="credit_score_band"), LIMIT_CTES[1]))(
    _ev(["credit_score_band"], ["active_clients", "active_cards", "spend", "average_transaction",
                                "total_credit_limit", "annual_spend_to_limit", "decline_rate",
                                "fraud_rate_10k"]))

# ---------------------------------------------------------------- geography page
simple("v_geography_kpis", [], ["spend", "online_share", "approved_transactions",
                                "average_transaction", "fraud_rate_10k"])
simple("v_location_type", ["location_type"], ["transactions", "spend", "fraud_rate_10k"])
simple("v_presentment_by_year", ["year", "channel_type"], ["spend"])

register("v_us_states", with_ctes(
    f"SELECT location, {measure_sql('approved_transactions')} AS approved_transactions, "
    f"{measure_sql('spend')} AS spend, "
    "CAST(sum(amount) FILTER (WHERE ok) AS DOUBLE) / "
    "CAST((SELECT sum(amount) FROM att WHERE ok) AS DOUBLE) AS spend_share, "
    f"{measure_sql('average_transaction')} AS average_transaction, "
    f"{measure_sql('fraud_rate_10k')} AS fraud_rate_10k "
    "FROM att WHERE location_type = 'US state' GROUP BY location"))(
    _ev(["location"], ["approved_transactions", "spend", "spend_share", "average_transaction",
                       "fraud_rate_10k"], where={"location_type": "US state"},
        order_by=["-spend"]))

simple("v_international", ["location"], ["approved_transactions", "spend",
                                         "average_transaction"],
       where={"location_type": "International"}, order_by=["-spend"])

# ---------------------------------------------------------------- shares, ranks
register("category_rank", with_ctes(
    f"SELECT category, {measure_sql('spend')} AS spend, "
    "CAST(dense_rank() OVER (ORDER BY sum(amount) FILTER (WHERE ok) DESC NULLS LAST) AS BIGINT) "
    "AS category_rank FROM att GROUP BY category"))(
    _ev(["category"], ["spend", "category_rank"]))

register("location_rank", with_ctes(
    f"SELECT year, location, {measure_sql('spend')} AS spend, "
    "CAST(dense_rank() OVER (PARTITION BY year ORDER BY sum(amount) FILTER (WHERE ok) DESC "
    "NULLS LAST) AS BIGINT) AS location_rank FROM att GROUP BY year, location"))(
    _ev(["year", "location"], ["spend", "location_rank"]))

register("spend_share", with_ctes(
    "SELECT year, category_group, CAST(sum(amount) FILTER (WHERE ok) AS DOUBLE) / "
    "CAST(sum(sum(amount) FILTER (WHERE ok)) OVER (PARTITION BY year) AS DOUBLE) AS spend_share "
    "FROM att GROUP BY year, category_group"))(
    _ev(["year", "category_group"], ["spend_share"]))

register("decline_share", with_ctes(
    "SELECT channel, outcome_class, CAST(count(*) FILTER (WHERE NOT ok) AS DOUBLE) / "
    "NULLIF(sum(count(*) FILTER (WHERE NOT ok)) OVER (PARTITION BY channel), 0) "
    "AS decline_share_of_class FROM att GROUP BY channel, outcome_class"))(
    _ev(["channel", "outcome_class"], ["decline_share_of_class"]))

register("channel_share_month", with_ctes(
    "SELECT month, channel, CAST(count(*) AS DOUBLE) / "
    "sum(count(*)) OVER (PARTITION BY month) AS channel_share FROM att GROUP BY month, channel"))(
    _ev(["month", "channel"], ["channel_share"]))

register("spend_12m", with_ctes(
    "SELECT m.year, m.month_no, CAST(sum(a.amount) FILTER (WHERE a.ok) AS DOUBLE) AS spend_12m "
    "FROM ends m JOIN att a ON a.date > CAST(m.e - INTERVAL 12 MONTH AS DATE) AND a.date <= m.e "
    "GROUP BY m.year, m.month_no",
    "ends AS (SELECT year, month_no, max(date) AS e FROM date_dim GROUP BY year, month_no)"))(
    _ev(["year", "month_no"], ["spend_12m"]))

register("spend_yoy", with_ctes(
    "SELECT c.year, c.month_no, CAST(c.s AS DOUBLE) AS spend, CAST(p.s AS DOUBLE) AS spend_py, "
    "(CAST(c.s AS DOUBLE) - CAST(p.s AS DOUBLE)) / NULLIF(CAST(p.s AS DOUBLE), 0) AS spend_yoy "
    "FROM cur c LEFT JOIN py p ON c.year = p.year AND c.month_no = p.month_no",
    "cur AS (SELECT year, month_no, sum(amount) FILTER (WHERE ok) AS s FROM att "
    "GROUP BY year, month_no)",
    "py AS (SELECT d.year, d.month_no, sum(a.amount) AS s FROM att a JOIN date_dim d "
    "ON CAST(a.date + INTERVAL 12 MONTH AS DATE) = d.date WHERE a.ok GROUP BY d.year, d.month_no)"))(
    _ev(["year", "month_no"], ["spend", "spend_py", "spend_yoy"]))

register("spend_lfl_yoy", with_ctes(
    "SELECT c.year, c.channel, CAST(c.s AS DOUBLE) AS spend_lfl, CAST(p.s AS DOUBLE) AS spend_lfl_py, "
    "(CAST(c.s AS DOUBLE) - CAST(p.s AS DOUBLE)) / NULLIF(CAST(p.s AS DOUBLE), 0) AS spend_lfl_yoy "
    "FROM cur c LEFT JOIN py p ON c.channel = p.channel AND c.year = p.year",
    "cur AS (SELECT year, channel, sum(amount) FILTER (WHERE ok AND in_lfl = 'Yes') AS s FROM att "
    "GROUP BY year, channel)",
    "py AS (SELECT d.year, a.channel, sum(a.amount) AS s FROM att a JOIN date_dim d "
    "ON CAST(a.date + INTERVAL 12 MONTH AS DATE) = d.date WHERE a.ok AND a.in_lfl = 'Yes' "
    "GROUP BY d.year, a.channel)"))(
    _ev(["year", "channel"], ["spend_lfl", "spend_lfl_py", "spend_lfl_yoy"]))

register("txn_lfl_yoy", with_ctes(
    "SELECT c.year, c.n AS transactions_lfl, p.n AS transactions_lfl_py, "
    "(CAST(c.n AS DOUBLE) - CAST(p.n AS DOUBLE)) / NULLIF(CAST(p.n AS DOUBLE), 0) "
    "AS transactions_lfl_yoy FROM cur c LEFT JOIN py p ON c.year = p.year",
    "cur AS (SELECT year, count(*) FILTER (WHERE ok AND in_lfl = 'Yes') AS n FROM att "
    "GROUP BY year)",
    "py AS (SELECT d.year, count(*) AS n FROM att a JOIN date_dim d "
    "ON CAST(a.date + INTERVAL 12 MONTH AS DATE) = d.date WHERE a.ok AND a.in_lfl = 'Yes' "
    "GROUP BY d.year)"))(
    _ev(["year"], ["transactions_lfl", "transactions_lfl_py", "transactions_lfl_yoy"]))

# ---------------------------------------------------------------- slicers
register("slicer_months", with_ctes(
    f"SELECT month_year_sort, {measure_sql('spend')} AS spend, {measure_sql('transactions')} AS transactions FROM att "
    "WHERE year IN (1996, 1997) AND month_no IN (1, 2, 12) GROUP BY month_year_sort"))(
    _ev(["month_year_sort"], ["spend", "transactions"], where={"year": [1996, 1997], "month_no": Chosen((1, 2, 12))}))

register("slicer_quarter", with_ctes(
    f"SELECT channel, {measure_sql('spend')} AS spend FROM att WHERE quarter_key IN (19962, 19974) GROUP BY channel"))(
    _ev(["channel"], ["spend"], where={"quarter_key": [19962, 19974]}))

register("slicer_range", with_ctes(
    "SELECT c.year, c.channel, CAST(c.s AS DOUBLE) AS spend, CAST(p.s AS DOUBLE) AS spend_py FROM cur c "
    "LEFT JOIN py p ON c.year = p.year AND c.channel = p.channel",
    "cur AS (SELECT year, channel, sum(amount) FILTER (WHERE ok) AS s FROM att "
    "WHERE date BETWEEN DATE '1996-11-15' AND DATE '1998-02-28' GROUP BY year, channel)",
    "py AS (SELECT d.year, a.channel, sum(a.amount) AS s FROM att a JOIN date_dim d "
    "ON CAST(a.date + INTERVAL 12 MONTH AS DATE) = d.date WHERE a.ok "
    "AND d.date BETWEEN DATE '1996-11-15' AND DATE '1998-02-28' GROUP BY d.year, a.channel)"))(
    _ev(["year", "channel"], ["spend", "spend_py"], where={"date": Between(dt.date(1996, 11, 15), dt.date(1998, 2, 28))}))

register("slicer_single", with_ctes(
    f"SELECT date, {measure_sql('spend')} AS spend FROM att WHERE month_year = 'Jun 1997' GROUP BY date"))(
    _ev(["date"], ["spend"], where={"month_year": Single(default="Jun 1997")}))


# ---------------------------------------------------------------- signed formats (2.8)
_SIGN = "CASE WHEN {v} < 0 THEN '\u2212' ELSE '+' END"
_PCT = "round(CAST(abs({v}) AS DECIMAL(28,10)) * 100, 1)"


@register("signed_formats", with_ctes(
    "SELECT year, CASE WHEN yoy IS NULL THEN 'new' ELSE "
    f"{_SIGN.format(v='yoy')} || CAST(CAST({_PCT.format(v='yoy')} AS DECIMAL(20,1)) AS VARCHAR) || '%' END AS yoy_text, "
    "CASE WHEN yoy IS NULL THEN 'new' WHEN abs(yoy) >= 0.05 THEN CASE WHEN yoy > 0 THEN '>+999%' ELSE '<-999%' END "
    f"ELSE {_SIGN.format(v='yoy')} || CAST(CAST({_PCT.format(v='yoy')} AS DECIMAL(20,1)) AS VARCHAR) || '%' END AS capped_text, "
    f"{_SIGN.format(v='(d - r)')} || CAST(CAST({_PCT.format(v='(CAST(d AS DECIMAL(28,10)) - CAST(r AS DECIMAL(28,10)))')} "
    "AS DECIMAL(20,1)) AS VARCHAR) || 'pp' AS points_text FROM f",
    "cur AS (SELECT year, sum(amount) FILTER (WHERE ok) AS spend, CAST(count(*) FILTER (WHERE NOT ok) AS DOUBLE) / count(*) AS d, "
    "CAST(count(*) FILTER (WHERE ok AND amount < 0) AS DOUBLE) / NULLIF(count(*) FILTER (WHERE ok), 0) AS r FROM att GROUP BY year)",
    "py AS (SELECT d.year, sum(a.amount) AS py FROM att a JOIN date_dim d "
    "ON CAST(a.date + INTERVAL 12 MONTH AS DATE) = d.date WHERE a.ok GROUP BY d.year)",
    "f AS (SELECT cur.year, d, r, (CAST(spend AS DOUBLE) - CAST(py AS DOUBLE)) / NULLIF(CAST(py AS DOUBLE), 0) AS yoy "
    "FROM cur LEFT JOIN py ON cur.year = py.year)"))
def signed_formats(spark, src):
    """Signed and capped percent and the change in points: year on year, and decline against
    refund rate (a cap of 5 % here, so that it bites)."""
    r = Model(spark, src).evaluate(["year"], ["spend_yoy", "decline_rate", "refund_rate"])
    return r.select("year", signed_percent("spend_yoy").alias("yoy_text"), signed_percent("spend_yoy", cap=0.05).alias("capped_text"),
                    point_change("decline_rate", "refund_rate").alias("points_text"))
