"""Benchmark queries B1-B21 (star q01-q10, flat f01-f10, credit-limit check),
the 49 measures one by one (m_*), and the 4-grain figures summary (A1)."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendframe.functions.scalar import ratio
from spendframe.operators import distinct
from spendframe.operators.shared import kept, shared
from spendframe.operators.topn import top_n_with_ties
from spendframe.plans.flat import flat_measures, flat_table, of_keys_and_time
from spendframe.plans.measures import APPROX_CONF, MEASURES, PARTS
from spendframe.plans.oracle import with_ctes
from spendframe.plans.query import Model
from spendframe.plans.registry import ORACLE, register
from spendframe.plans.binding import Star

D = "CAST({} AS DOUBLE)"


def _m(spark, src):
    """``src``: a directory, or a model that several queries share."""
    return src if isinstance(src, Model) else Model(spark, src)


#: Fact columns that q01-q10 read, and columns of the flat table that f01-f10 read.
STAR_COLUMNS = ["year", "month_year", "channel", "category", "card_key", "client_key", "ok", "lab", "fr", "amount"]
FLAT_COLUMNS = ["client_id", "card_id", "channel", "merchant_category", "year", "month_year", "is_approved",
                "fraud_label", "amount"]


#: Keys of few values and what adds up by them: one pass over the shared rows for all such answers.
STAR_CELLS = (["year", "channel", "category"], ["n", "n_ok", "n_decl", "n_lab", "n_fr", "spend"])
FLAT_CELLS = (["year", "channel", "merchant_category"],
              ["transactions", "approved", "declines", "labelled", "fraud", "spend"])


class SharedFlat(NamedTuple):
    """Flat rows that several queries share, and their rollup by FLAT_CELLS."""
    rows: DataFrame
    cells: DataFrame


def shared_star(spark, src) -> Model:
    return Model.over_shared(spark, src, STAR_COLUMNS).with_cells(*STAR_CELLS)


def shared_flat(spark, src) -> SharedFlat:
    again = of_keys_and_time()            # do not travel: computed where the rows arrive
    dealt = [c for c in FLAT_COLUMNS if c not in again] + ["client_key", "card_key", "timestamp"]
    rows = shared(flat_table(Star(spark, src), {"merchant_category"}).select(*dealt))
    rows = rows.select(*[again[c].alias(c) if c in again else c for c in FLAT_COLUMNS])
    keys, names = FLAT_CELLS
    ms = flat_measures()
    return SharedFlat(rows, kept(rows.groupBy(*keys).agg(*[ms[n].alias(n) for n in names]), [*keys, *names], apart=True))


def _r(n, d, scale=None):
    s = f"CAST({n} AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0)"
    return f"({s}) * {scale}" if scale else s


# ------------------------------------------------------------------ star q01-q10
@register("q01_total_spend", with_ctes(
    "SELECT CAST(sum(amount) FILTER (WHERE ok) AS DOUBLE) AS spend, "
    "count(*) FILTER (WHERE ok) AS approved, count(*) FILTER (WHERE NOT ok) AS declines FROM att"))
def q01(spark, src):
    return _m(spark, src).evaluate([], [("spend", "spend"), ("approved", "approved_transactions"),
                                        ("declines", "declined_transactions")])


@register("q02_spend_by_year", with_ctes(
    "SELECT year, CAST(sum(amount) FILTER (WHERE ok) AS DOUBLE) AS spend, "
    "count(*) FILTER (WHERE ok) AS approved FROM att GROUP BY year"))
def q02(spark, src):
    return _m(spark, src).evaluate(["year"], [("spend", "spend"),
                                              ("approved", "approved_transactions")])


@register("q03_spend_by_channel", with_ctes(
    "SELECT channel, CAST(sum(amount) FILTER (WHERE ok) AS DOUBLE) AS spend, count(*) AS txn "
    "FROM att GROUP BY channel"))
def q03(spark, src):
    return _m(spark, src).evaluate(["channel"], [("spend", "spend"), ("txn", "transactions")])


@register("q04_spend_by_category", with_ctes(
    "SELECT category, CAST(sum(amount) FILTER (WHERE ok) AS DOUBLE) AS spend, count(*) AS txn "
    "FROM att GROUP BY category"))
def q04(spark, src):
    return _m(spark, src).evaluate(["category"], [("spend", "spend"), ("txn", "transactions")])


@register("q05_fraud_by_channel", with_ctes(
    "SELECT channel, count(*) FILTER (WHERE lab) AS labelled, count(*) FILTER (WHERE fr) AS fraud, "
    f"{_r('count(*) FILTER (WHERE fr)', 'count(*) FILTER (WHERE lab)', 10000)} AS per10k "
    "FROM att GROUP BY channel"))
def q05(spark, src):
    return _m(spark, src).evaluate(["channel"], [("labelled", "labelled_transactions"),
                                                 ("fraud", "fraud_transactions"),
                                                 ("per10k", "fraud_rate_10k")])


@register("q06_distinct_counts", with_ctes(
    "SELECT count(DISTINCT card_key) AS cards, count(DISTINCT client_key) AS clients, "
    f"{_r('sum(amount) FILTER (WHERE ok AND amount > 0)', 'count(*) FILTER (WHERE ok AND amount > 0)')}"
    " AS avg FROM att"))
def q06(spark, src):
    return _m(spark, src).evaluate([], [("cards", "active_cards"), ("clients", "active_clients"),
                                        ("avg", "average_transaction")])


Q07_SQL = with_ctes("""
SELECT cur.year, CAST(cur.spend AS DOUBLE) AS spend, CAST(py.py AS DOUBLE) AS py,
       (CAST(cur.spend AS DOUBLE) - CAST(py.py AS DOUBLE)) / NULLIF(CAST(py.py AS DOUBLE), 0) AS yoy
FROM cur LEFT JOIN py ON cur.year = py.year""",
    "cur AS (SELECT year, sum(amount) FILTER (WHERE ok) AS spend FROM att GROUP BY year)",
    """py AS (SELECT d.year, sum(a.amount) AS py
       FROM att a JOIN date_dim d ON CAST(a.date + INTERVAL 12 MONTH AS DATE) = d.date
       WHERE a.ok GROUP BY d.year)""")


@register("q07_spend_yoy", Q07_SQL)
def q07(spark, src):
    return _m(spark, src).evaluate(["year"], [("spend", "spend"), ("py", "spend_py"),
                                              ("yoy", "spend_yoy")])


@register("q08_card_by_year", with_ctes(
    "SELECT card_key, year, CAST(sum(amount) FILTER (WHERE ok) AS DOUBLE) AS spend, "
    f"count(*) AS txn, {_r('count(*) FILTER (WHERE NOT ok)', 'count(*)')} AS decline "
    "FROM att GROUP BY card_key, year"))
def q08(spark, src):
    return _m(spark, src).evaluate(["card_key", "year"], [("spend", "spend"),
                                                          ("txn", "transactions"),
                                                          ("decline", "decline_rate")])


@register("q09_cards_by_month", with_ctes(
    "SELECT month_year, count(DISTINCT card_key) AS cards, "
    "CAST(sum(amount) FILTER (WHERE ok) AS DOUBLE) AS spend, count(*) FILTER (WHERE fr) AS fraud "
    "FROM att GROUP BY month_year"))
def q09(spark, src):
    return _m(spark, src).evaluate(["month_year"], [("cards", "active_cards"), ("spend", "spend"),
                                                    ("fraud", "fraud_transactions")])


@register("q10_top_cards", with_ctes(
    "SELECT card_key, spend, txn, decline FROM ("
    "SELECT card_key, CAST(sum(amount) FILTER (WHERE ok) AS DOUBLE) AS spend, count(*) AS txn, "
    f"{_r('count(*) FILTER (WHERE NOT ok)', 'count(*)')} AS decline, "
    "rank() OVER (ORDER BY sum(amount) FILTER (WHERE ok) DESC NULLS LAST) AS rk "
    "FROM att GROUP BY card_key) WHERE rk <= 200"))
def q10(spark, src):
    return _m(spark, src).evaluate(["card_key"], [("spend", "spend"), ("txn", "transactions"),
                                                  ("decline", "decline_rate")], top=(200, "spend"))


# ------------------------------------------------------------------ flat f01-f10
FLAT_CTES = (
    """flat AS (
  SELECT CAST(client_key AS VARCHAR) AS client_id, CAST(card_key AS VARCHAR) AS card_id,
         amount, channel, coalesce(errors, '') AS errors,
         CASE fraud_key WHEN 2 THEN 'Yes' WHEN 1 THEN 'No' ELSE '' END AS fraud_label,
         category AS merchant_category, CAST(year(date) AS BIGINT) AS year,
         strftime(date, '%b %Y') AS month_year
  FROM att)""",
    "flat2 AS (SELECT *, CASE WHEN length(errors) = 0 THEN 'Yes' ELSE 'No' END AS is_approved "
    "FROM flat)",
)


def flat_sql(select: str, *extra: str) -> str:
    return with_ctes(select, *FLAT_CTES, *extra)


def _flat_rows(spark, src, need) -> DataFrame:
    """``src``: a directory, or flat rows that several queries share."""
    return src.rows if isinstance(src, SharedFlat) else flat_table(Star(spark, src), need=need)


def _flat(spark, src, keys, names, need=()):
    if isinstance(src, SharedFlat) and set(keys) <= set(FLAT_CELLS[0]) and set(names) <= set(FLAT_CELLS[1]):
        total = lambda n: F.sum(n) if n == "spend" else F.coalesce(F.sum(n), F.lit(0))
        return src.cells.groupBy(*keys).agg(*[total(n).alias(n) for n in names])
    f = _flat_rows(spark, src, set(keys) | set(need))
    ms = flat_measures()
    return f.groupBy(*keys).agg(*[ms[n].alias(n) for n in names])


def _fcast(df, money=()):
    for c in money:
        df = df.withColumn(c, F.col(c).cast("double"))
    return df


FSP = "CAST(sum(amount) FILTER (WHERE is_approved = 'Yes') AS DOUBLE)"


@register("f01_total_spend", flat_sql(
    f"SELECT {FSP} AS spend, count(*) FILTER (WHERE is_approved = 'Yes') AS approved, "
    "count(*) FILTER (WHERE is_approved = 'No') AS declines FROM flat2"))
def f01(spark, src):
    return _fcast(_flat(spark, src, [], ["spend", "approved", "declines"]), ["spend"])


@register("f02_spend_by_year", flat_sql(
    f"SELECT year, {FSP} AS spend, count(*) FILTER (WHERE is_approved = 'Yes') AS approved "
    "FROM flat2 GROUP BY year"))
def f02(spark, src):
    return _fcast(_flat(spark, src, ["year"], ["spend", "approved"]), ["spend"])


@register("f03_spend_by_channel", flat_sql(
    f"SELECT channel, {FSP} AS spend, count(*) AS txn FROM flat2 GROUP BY channel"))
def f03(spark, src):
    df = _flat(spark, src, ["channel"], ["spend", "transactions"])
    return _fcast(df.withColumnRenamed("transactions", "txn"), ["spend"])


@register("f04_spend_by_category", flat_sql(
    f"SELECT merchant_category, {FSP} AS spend, count(*) AS txn FROM flat2 "
    "GROUP BY merchant_category"))
def f04(spark, src):
    df = _flat(spark, src, ["merchant_category"], ["spend", "transactions"])
    return _fcast(df.withColumnRenamed("transactions", "txn"), ["spend"])


F_FR = "count(*) FILTER (WHERE fraud_label = 'Yes')"
F_LAB = "count(*) FILTER (WHERE length(fraud_label) > 0)"
F_DECL = "count(*) FILTER (WHERE is_approved = 'No')"
F_PUR_SUM = "sum(amount) FILTER (WHERE is_approved = 'Yes' AND amount > 0)"
F_PUR_N = "count(*) FILTER (WHERE is_approved = 'Yes' AND amount > 0)"


@register("f05_fraud_by_channel", flat_sql(
    f"SELECT channel, {F_LAB} AS labelled, {F_FR} AS fraud, {_r(F_FR, F_LAB, 10000)} AS per10k "
    "FROM flat2 GROUP BY channel"))
def f05(spark, src):
    df = _flat(spark, src, ["channel"], ["labelled", "fraud"])
    return df.withColumn("per10k", ratio(F.col("fraud"), F.col("labelled"), 10000))


@register("f06_distinct_counts", flat_sql(
    "SELECT count(DISTINCT card_id) AS cards, count(DISTINCT client_id) AS clients, "
    f"{_r(F_PUR_SUM, F_PUR_N)} AS avg FROM flat2"))
def f06(spark, src):
    f = _flat_rows(spark, src, set())
    bought = (F.col("is_approved") == "Yes") & (F.col("amount") > 0)
    how = {"_sum": "sum", "_n": "count"}
    pairs = distinct.pair_rollup(f, [], {"cards": F.col("card_id"), "clients": F.col("client_id")},
                          {"_sum": (F.when(bought, F.col("amount")), "sum"), "_n": (F.when(bought, 1), "count")})
    return distinct.counted(pairs, [], ["cards", "clients"], how).select(
        "cards", "clients", ratio(F.col("_sum").cast("double"), F.col("_n")).alias("avg"))


@register("f07_spend_yoy", flat_sql(
    "SELECT y.year, CAST(y.spend AS DOUBLE) AS spend, CAST(p.spend AS DOUBLE) AS py, "
    "(CAST(y.spend AS DOUBLE) - CAST(p.spend AS DOUBLE)) / NULLIF(CAST(p.spend AS DOUBLE), 0) AS yoy "
    "FROM y LEFT JOIN y p ON p.year = y.year - 1",
    "y AS (SELECT year, sum(amount) FILTER (WHERE is_approved = 'Yes') AS spend FROM flat2 "
    "GROUP BY year)"))
def f07(spark, src):
    """W7 naive prior year: arithmetic on the year column (self-join on year - 1, so a
    missing year gives null rather than the year before it)."""
    by_year = _flat(spark, src, ["year"], ["spend"])
    # each year's row serves as itself and as the year before the next one: one scan
    none = F.lit(None).cast(by_year.schema["spend"].dataType)
    both = by_year.select(F.explode(F.array(
        F.struct("year", F.lit(1).alias("own"), "spend", none.alias("py")),
        F.struct((F.col("year") + 1).alias("year"), F.lit(0).alias("own"), none.alias("spend"),
                 F.col("spend").alias("py")))).alias("r")).select("r.*")
    j = both.groupBy("year").agg(F.max("own").alias("own"), F.max("spend").alias("spend"),
                                 F.max("py").alias("py")).where("own = 1")
    return j.select("year", F.col("spend").cast("double").alias("spend"),
                    F.col("py").cast("double").alias("py"),
                    ((F.col("spend").cast("double") - F.col("py").cast("double")) /
                     F.when(F.col("py") != 0, F.col("py").cast("double"))).alias("yoy"))


@register("f08_card_by_year", flat_sql(
    f"SELECT card_id, year, {FSP} AS spend, count(*) AS txn, {_r(F_DECL, 'count(*)')} AS decline "
    "FROM flat2 GROUP BY card_id, year"))
def f08(spark, src):
    df = _flat(spark, src, ["card_id", "year"], ["spend", "transactions", "declines"])
    return df.select("card_id", "year", F.col("spend").cast("double").alias("spend"),
                     F.col("transactions").alias("txn"),
                     ratio(F.col("declines"), F.col("transactions")).alias("decline"))


@register("f09_cards_by_month", flat_sql(
    f"SELECT month_year, count(DISTINCT card_id) AS cards, {FSP} AS spend, "
    "count(*) FILTER (WHERE fraud_label = 'Yes') AS fraud FROM flat2 GROUP BY month_year"))
def f09(spark, src):
    return _fcast(_flat(spark, src, ["month_year"], ["cards", "spend", "fraud"]), ["spend"])


@register("f10_card_detail", flat_sql(
    "SELECT card_id, spend, txn, decline FROM ("
    f"SELECT card_id, {FSP} AS spend, count(*) AS txn, {_r(F_DECL, 'count(*)')} AS decline, "
    "rank() OVER (ORDER BY sum(amount) FILTER (WHERE is_approved = 'Yes') DESC NULLS LAST) AS rk "
    "FROM flat2 GROUP BY card_id) WHERE rk <= 200"))
def f10(spark, src):
    df = _flat(spark, src, ["card_id"], ["spend", "transactions", "declines"])
    df = df.select("card_id", F.col("spend").cast("double").alias("spend"),
                   F.col("transactions").alias("txn"),
                   ratio(F.col("declines"), F.col("transactions")).alias("decline"))
    return top_n_with_ties(df, 200, "spend")


# ------------------------------------------------------------------ B21 limits check
LIMIT_CTES = (
    """g AS (SELECT credit_score_band, count(DISTINCT client_key) AS clients,
              count(DISTINCT card_key) AS cards, sum(amount) FILTER (WHERE ok) AS spend
       FROM att GROUP BY credit_score_band)""",
    """lim AS (SELECT s.credit_score_band, sum(c.credit_limit) AS lim
        FROM (SELECT DISTINCT credit_score_band, card_key FROM att) s
        JOIN card_dim c ON s.card_key = c.card_key GROUP BY s.credit_score_band)""",
    "yrs AS (SELECT count(*) / 365.25 AS years FROM date_dim)",
)
LIMITS_SQL = with_ctes("""
SELECT g.credit_score_band, g.clients, g.cards, CAST(g.spend AS DOUBLE) AS spend,
       CAST(lim.lim AS DOUBLE) AS "limit",
       (CAST(g.spend AS DOUBLE) / yrs.years) / NULLIF(CAST(lim.lim AS DOUBLE), 0) AS annual_to_limit,
       yrs.years AS years
FROM g LEFT JOIN lim ON g.credit_score_band IS NOT DISTINCT FROM lim.credit_score_band, yrs""",
    *LIMIT_CTES)


@register("limits_by_band", LIMITS_SQL)
def limits_by_band(spark, src):
    return _m(spark, src).evaluate(["credit_score_band"], [
        ("clients", "active_clients"), ("cards", "active_cards"), ("spend", "spend"),
        ("limit", "total_credit_limit"), ("annual_to_limit", "annual_spend_to_limit"),
        ("years", "years_in_period")])


@register("credit_limit_by_band", with_ctes(
    "SELECT lim.credit_score_band, CAST(lim.lim AS DOUBLE) AS total_credit_limit FROM lim",
    *LIMIT_CTES))
def credit_limit_by_band(spark, src):
    """Dimension restricted by the filtered fact (cards seen in each band)."""
    return _m(spark, src).evaluate(["credit_score_band"], ["total_credit_limit"])


@register("annual_spend_to_limit", with_ctes(
    "SELECT g.credit_score_band, (CAST(g.spend AS DOUBLE) / yrs.years) / "
    "NULLIF(CAST(lim.lim AS DOUBLE), 0) AS annual_spend_to_limit FROM g LEFT JOIN lim "
    "ON g.credit_score_band IS NOT DISTINCT FROM lim.credit_score_band, yrs", *LIMIT_CTES))
def annual_spend_to_limit(spark, src):
    return _m(spark, src).evaluate(["credit_score_band"], ["annual_spend_to_limit"])


# ------------------------------------------------------------------ A1 figures, 4 grains
FIG_SQL_ONE = """
SELECT '{grain}' AS grain, CAST({key} AS VARCHAR) AS "key", count(*) AS transactions,
       count(*) FILTER (WHERE ok) AS approved,
       CAST(round(coalesce(sum(amount) FILTER (WHERE ok), 0), 2) AS DOUBLE) AS spend,
       round(CAST(count(*) FILTER (WHERE NOT ok) AS DOUBLE) / count(*), 6) AS decline_rate,
       count(*) FILTER (WHERE lab) AS labelled, count(*) FILTER (WHERE fr) AS fraud,
       round(coalesce(CAST(count(*) FILTER (WHERE fr) AS DOUBLE) /
             NULLIF(count(*) FILTER (WHERE lab), 0) * 10000, 0), 4) AS fraud_10k,
       round(CAST(count(*) FILTER (WHERE fr) AS DOUBLE) / count(*) * 10000, 4) AS fraud_10k_naive,
       count(DISTINCT card_key) AS cards, count(DISTINCT client_key) AS clients
FROM att GROUP BY {key}"""
GRAINS = [("year", "year"), ("channel", "channel"), ("category", "category_group"),
          ("loctype", "location_type")]


@register("figures_4_grains", with_ctes("\nUNION ALL\n".join(
    FIG_SQL_ONE.format(grain=g, key=k) for g, k in GRAINS)))
def figures_4_grains(spark, src):
    """A1 + T4: ten figures at four grains in one scan, stacked as (grain, key, ...), from one
    rollup that all grains share: pairs of a cell and a card or client (exact), or a sketch of each
    per cell when ``spendframe.approxDistinct`` is set.  Blank figures read 0, as the
    reconciliation treats them."""
    m = _m(spark, src)
    cell = [k for _, k in GRAINS]
    f = m.fact(set(cell) | {"ok", "lab", "fr", "amount", "card_key", "client_key"})
    keys = {"cards": F.col("card_key"), "clients": F.col("client_key")}
    parts = {"transactions": "n", "approved": "n_ok", "_spend": "spend", "_decl": "n_decl", "labelled": "n_lab",
             "fraud": "n_fr"}
    values = {name: (PARTS[p].row(), PARTS[p].how) for name, p in parts.items()}
    how = {name: PARTS[p].how for name, p in parts.items()}
    error = spark.conf.get(APPROX_CONF, None)
    if error:
        g = distinct.estimated_by_grains(distinct.sketch_rollup(f, cell, keys, values, float(error)), GRAINS, list(keys), how)
    else:
        g = distinct.coded_by_grains(f, GRAINS, keys, values)
    return g.select(
        "grain", F.col("grain_key").alias("key"), "transactions", "approved",
        F.round(F.coalesce(F.col("_spend"), F.lit(0)), 2).cast("double").alias("spend"),
        F.round(ratio(F.col("_decl"), F.col("transactions")), 6).alias("decline_rate"),
        "labelled", "fraud",
        F.round(F.coalesce(ratio(F.col("fraud"), F.col("labelled"), 10000), F.lit(0.0)), 4)
         .alias("fraud_10k"),
        F.round(ratio(F.col("fraud"), F.col("transactions"), 10000), 4).alias("fraud_10k_naive"),
        "cards", "clients")


# ------------------------------------------------------------------ m_*: each measure alone
SPECIAL_SQL = {
    "total_credit_limit": """
SELECT s.channel, CAST(sum(c.credit_limit) AS DOUBLE) AS total_credit_limit
FROM (SELECT DISTINCT channel, card_key FROM att) s JOIN card_dim c ON s.card_key = c.card_key
GROUP BY s.channel""",
    "years_in_period": """
SELECT channel, (SELECT count(*) FROM date_dim) / 365.25 AS years_in_period
FROM att GROUP BY channel""",
    "annual_spend_to_limit": """
l AS (SELECT s.channel, sum(c.credit_limit) AS lim
        FROM (SELECT DISTINCT channel, card_key FROM att) s
        JOIN card_dim c ON s.card_key = c.card_key GROUP BY s.channel)
;SELECT a.channel, (CAST(sum(a.amount) FILTER (WHERE a.ok) AS DOUBLE)
       / ((SELECT count(*) FROM date_dim) / 365.25)) / NULLIF(CAST(max(l.lim) AS DOUBLE), 0)
       AS annual_spend_to_limit
FROM att a JOIN l ON a.channel = l.channel GROUP BY a.channel""",
    "channel_share": """
SELECT channel, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () AS channel_share
FROM att GROUP BY channel""",
    "decline_share_of_class": """
SELECT channel, CAST(count(*) FILTER (WHERE NOT ok) AS DOUBLE)
       / NULLIF(count(*) FILTER (WHERE NOT ok), 0) AS decline_share_of_class
FROM att GROUP BY channel""",
    "spend_py": """
SELECT channel, CAST(sum(amount) FILTER (WHERE ok AND CAST(date + INTERVAL 12 MONTH AS DATE)
       <= (SELECT last FROM bounds)) AS DOUBLE) AS spend_py
FROM att GROUP BY channel""",
    "spend_yoy": """
SELECT channel, (CAST(sum(amount) FILTER (WHERE ok) AS DOUBLE)
         - CAST(sum(amount) FILTER (WHERE ok AND CAST(date + INTERVAL 12 MONTH AS DATE)
                <= (SELECT last FROM bounds)) AS DOUBLE))
       / NULLIF(CAST(sum(amount) FILTER (WHERE ok AND CAST(date + INTERVAL 12 MONTH AS DATE)
                <= (SELECT last FROM bounds)) AS DOUBLE), 0) AS spend_yoy
FROM att GROUP BY channel""",
    "spend_lfl_py": """
SELECT channel, CAST(sum(amount) FILTER (WHERE ok AND in_lfl = 'Yes' AND
       CAST(date + INTERVAL 12 MONTH AS DATE) <= (SELECT last FROM bounds)) AS DOUBLE) AS spend_lfl_py
FROM att GROUP BY channel""",
    "spend_lfl_yoy": """
t AS (SELECT channel, CAST(sum(amount) FILTER (WHERE ok AND in_lfl = 'Yes') AS DOUBLE) AS cur,
       CAST(sum(amount) FILTER (WHERE ok AND in_lfl = 'Yes' AND CAST(date + INTERVAL 12 MONTH AS DATE)
            <= (SELECT last FROM bounds)) AS DOUBLE) AS py FROM att GROUP BY channel)
;SELECT channel, (cur - py) / NULLIF(py, 0) AS spend_lfl_yoy FROM t""",
    "transactions_lfl_py": """
SELECT channel, count(*) FILTER (WHERE ok AND in_lfl = 'Yes' AND
       CAST(date + INTERVAL 12 MONTH AS DATE) <= (SELECT last FROM bounds)) AS transactions_lfl_py
FROM att GROUP BY channel""",
    "transactions_lfl_yoy": """
t AS (SELECT channel, CAST(count(*) FILTER (WHERE ok AND in_lfl = 'Yes') AS DOUBLE) AS cur,
       CAST(count(*) FILTER (WHERE ok AND in_lfl = 'Yes' AND CAST(date + INTERVAL 12 MONTH AS DATE)
            <= (SELECT last FROM bounds)) AS DOUBLE) AS py FROM att GROUP BY channel)
;SELECT channel, (cur - py) / NULLIF(py, 0) AS transactions_lfl_yoy FROM t""",
    "spend_12m": """
SELECT channel, CAST(sum(amount) FILTER (WHERE ok AND
       date > CAST((SELECT last FROM bounds) - INTERVAL 12 MONTH AS DATE)
       AND date <= (SELECT last FROM bounds)) AS DOUBLE) AS spend_12m
FROM att GROUP BY channel""",
    "spend_share": """
SELECT channel, CAST(sum(amount) FILTER (WHERE ok) AS DOUBLE)
       / CAST((SELECT sum(amount) FROM att WHERE ok) AS DOUBLE) AS spend_share
FROM att GROUP BY channel""",
    "category_rank": """
SELECT category, CAST(dense_rank() OVER (ORDER BY sum(amount) FILTER (WHERE ok) DESC NULLS LAST)
       AS BIGINT) AS category_rank
FROM att GROUP BY category""",
    "location_rank": """
SELECT location, CAST(dense_rank() OVER (ORDER BY sum(amount) FILTER (WHERE ok) DESC NULLS LAST)
       AS BIGINT) AS location_rank
FROM att GROUP BY location""",
    "report_period": """
SELECT channel, (SELECT CASE
         WHEN month(first) = 1 AND day(first) = 1 AND month(last) = 12 AND day(last) = 31
              AND year(first) = year(last) THEN strftime(last, '%Y')
         WHEN month(first) = 1 AND day(first) = 1 AND month(last) = 12 AND day(last) = 31
              THEN strftime(first, '%Y') || ' to ' || strftime(last, '%Y')
         ELSE strftime(first, '%b %Y') || ' to ' || strftime(last, '%b %Y') END FROM bounds)
       AS report_period
FROM att GROUP BY channel""",
}
RANK_GROUP = {"category_rank": "category", "location_rank": "location"}


def _special_sql(key: str) -> str:
    """Entries are a SELECT, or ``extra CTE ;SELECT`` when they need a helper CTE."""
    s = SPECIAL_SQL[key]
    if ";SELECT" in s:
        cte, select = s.split(";SELECT", 1)
        return with_ctes("SELECT" + select, cte)
    return with_ctes(s)


def _measure_query(key: str):
    group = RANK_GROUP.get(key, "channel")

    def run(spark, src):
        return Model(spark, src).evaluate([group], [key])
    run.__name__ = f"m_{key}"
    return run


def _measure_sql(key: str) -> str | None:
    m = MEASURES[key]
    if key in SPECIAL_SQL:
        return _special_sql(key)
    if m.sql is None:
        return None
    expr = m.sql
    if m.kind == "money":
        expr = f"CAST({expr} AS DOUBLE)"
    elif m.kind == "count":
        expr = f"CAST({expr} AS BIGINT)"
    return with_ctes(f"SELECT channel, {expr} AS {key} FROM att GROUP BY channel")


for _key in MEASURES:
    register(f"m_{_key}", _measure_sql(_key))(_measure_query(_key))


# The naive prior year (year arithmetic on the flat table) under its survey name.
register("spend_yoy_naive", ORACLE["f07_spend_yoy"])(f07)
