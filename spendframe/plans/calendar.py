"""Calendar page: D1-D10 date columns, W1/W2 cells and bands, W8 prior-year caps,
W10-W16 facts, and the card totals.  Generic over an additive daily measure
(``value`` part) with a second count (``count`` part); the registered queries use
Spend and Approved Transactions, as the report does.

Everything is planned on the *daily rollup* (one row per day and key), so its size
is the number of days, whatever the number of transactions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendframe.functions import constants as K
from spendframe.functions.scalar import (change, month_in_quarter, ordinal_suffix, ratio,
                                         short_money, week_of_month)
from spendframe.operators.calendar import rank_band, zero_fill
from spendframe.operators.joins import with_scalars
from spendframe.plans.oracle import with_ctes
from spendframe.plans.query import Model
from spendframe.plans.registry import register


@dataclass
class CalendarConfig:
    value: str = "spend"          # additive daily part
    count: str = "n_ok"           # second figure in a cell


class Calendar:
    def __init__(self, spark, src, cfg: CalendarConfig | None = None, where=None):
        self.m = Model(spark, src)
        self.cfg = cfg or CalendarConfig()
        self.where = where

    def daily(self) -> DataFrame:
        """Daily rollup: only days with rows (value null-free sums of the fact); through the
        model's rollup, so a dimension filter too large to broadcast joins daily rows."""
        v, c = self.cfg.value, self.cfg.count
        return self.m.rollup(["date"], sorted({v, c}), self.where).select(
            "date", F.col(v).alias("v"), F.col(c).alias("c"))

    def spine(self) -> DataFrame:
        return self.m.spine()

    def cells_day(self) -> DataFrame:
        """Zero-filled day cells over the whole spine."""
        return zero_fill(self.spine().select("date", "year", "month_no", "quarter"),
                         self.daily(), ["v", "c"])

    def cells(self) -> DataFrame:
        """All four grains, stacked (view, key, pool, value, count), from ONE pass over
        the zero-filled day cells: grouping sets (day, month, quarter, year) expand day rows
        only, so the fact rollup under them is computed once."""
        d = self.cells_day().select("date", F.date_format("date", "yyyy-MM").alias("ym"),
                                    "year", "quarter", "v", "c")
        cols = ["date", "ym", "year", "quarter"]
        g = d.groupingSets([["date", "ym", "year"], ["ym", "year"], ["year", "quarter"],
                            ["year"]], *cols).agg(
            F.sum("v").alias("v"), F.sum("c").alias("c"), F.grouping_id().alias("_gid"))
        # grouping_id bits, first column highest: date 8, ym 4, year 2, quarter 1
        gid, y = F.col("_gid"), F.col("year").cast("string")
        view = (F.when(gid == 1, "Day").when(gid == 9, "Month").when(gid == 12, "Quarter")
                .otherwise("Year"))
        key = (F.when(gid == 1, F.date_format("date", "yyyy-MM-dd")).when(gid == 9, F.col("ym"))
               .when(gid == 12, F.concat(y, F.lit("-"), F.col("quarter"))).otherwise(y))
        pool = F.when(gid == 1, F.col("ym")).when(gid == 9, y).otherwise(F.lit("all"))
        allc = g.select(view.alias("view"), key.alias("key"), pool.alias("pool"), "v", "c")
        return rank_band(allc, "v", ["view", "pool"])


def _cal(spark, src):
    return Calendar(spark, src)


CAL_CTES = (
    "daily AS (SELECT date, sum(amount) FILTER (WHERE ok) AS v, count(*) FILTER (WHERE ok) AS c "
    "FROM att GROUP BY date)",
    "cells_day AS (SELECT d.date, d.year, d.month_no, d.quarter, coalesce(x.v, 0) AS v, "
    "coalesce(x.c, 0) AS c FROM date_dim d LEFT JOIN daily x ON d.date = x.date)",
    """grains AS (
  SELECT 'Day' AS view, strftime(date, '%Y-%m-%d') AS key, strftime(date, '%Y-%m') AS pool, v, c
  FROM cells_day
  UNION ALL SELECT 'Month', strftime(date, '%Y-%m'), CAST(year AS VARCHAR), sum(v), sum(c)
  FROM cells_day GROUP BY strftime(date, '%Y-%m'), year
  UNION ALL SELECT 'Quarter', CAST(year AS VARCHAR) || '-' || quarter, 'all', sum(v), sum(c)
  FROM cells_day GROUP BY year, quarter
  UNION ALL SELECT 'Year', CAST(year AS VARCHAR), 'all', sum(v), sum(c) FROM cells_day GROUP BY year)""",
    """banded AS (
  SELECT g.*, (SELECT count(*) FROM grains l WHERE l.view = g.view AND l.pool = g.pool AND l.v > 0)
           AS n_live,
         (SELECT count(*) FROM grains l WHERE l.view = g.view AND l.pool = g.pool AND l.v > 0
            AND l.v < g.v) AS below
  FROM grains g)""",
)
CELLS_SELECT = ("SELECT view, key, CAST(v AS DOUBLE) AS value, CAST(c AS BIGINT) AS count, "
                "CAST(CASE WHEN v <= 0 THEN 0 WHEN n_live <= 1 THEN 5 "
                "ELSE least(5, (below * 5) // (n_live - 1) + 1) END AS BIGINT) AS band FROM banded")


def _cells_out(df: DataFrame) -> DataFrame:
    return df.select("view", "key", F.col("v").cast("double").alias("value"),
                     F.col("c").cast("bigint").alias("count"), "band")


@register("calendar_cells", with_ctes(CELLS_SELECT, *CAL_CTES))
def calendar_cells(spark, src):
    """W2 + W1: every cell of the four views with its value, count and band."""
    return _cells_out(_cal(spark, src).cells())


for _view in ("Day", "Month", "Quarter", "Year"):
    def _one(spark, src, _v=_view):
        return _cells_out(_cal(spark, src).cells().where(F.col("view") == _v))
    register(f"calendar_band_{_view.lower()}",
             with_ctes(CELLS_SELECT + f" WHERE view = '{_view}'", *CAL_CTES))(_one)


# ---------------------------------------------------------------- date dimension D1-D9
@register("date_dim", with_ctes(
    "SELECT date, year, month_no, month_year, month_year_sort, month_start, quarter, quarter_key, "
    "day_of_week, day_name, in_lfl, is_complete_year FROM date_dim"))
def date_dim(spark, src):
    """Contiguous day spine with calendar columns and like-for-like flags."""
    return Model(spark, src).spine().select(
        "date", "year", "month_no", "month_year", "month_year_sort", "month_start", "quarter",
        "quarter_key", "day_of_week", "day_name", "in_lfl", "is_complete_year")


@register("calendar_axes", with_ctes(
    "SELECT date, 'Q' || CAST(quarter(date) AS VARCHAR) || ' ' || CAST(year(date) AS VARCHAR) "
    "AS quarter_label, CAST(year(date) * 10 + quarter(date) AS BIGINT) AS quarter_key, "
    "CAST((month(date) - 1) % 3 + 1 AS BIGINT) AS month_in_quarter_no, "
    "CASE (month(date) - 1) % 3 WHEN 0 THEN '1st month' WHEN 1 THEN '2nd month' "
    "ELSE '3rd month' END AS month_in_quarter, "
    "CAST(isodow(date) AS BIGINT) AS weekday_no, strftime(date, '%a') AS day_short, "
    "strftime(date, '%A') AS day_name, "
    "CAST(floor((day(date) + isodow(date_trunc('month', date)) - 2) / 7) + 1 AS BIGINT) "
    "AS week_of_month FROM date_dim"))
def calendar_axes(spark, src):
    """Quarter key/label, month-in-quarter, Monday-first weekday, week-of-month row."""
    d = Model(spark, src).spine().select("date")
    miq = month_in_quarter("date")
    labels = K.MONTH_IN_QUARTER
    return d.select(
        "date",
        F.concat(F.lit("Q"), F.quarter("date").cast("string"), F.lit(" "),
                 F.year("date").cast("string")).alias("quarter_label"),
        (F.year("date") * 10 + F.quarter("date")).cast("bigint").alias("quarter_key"),
        miq.cast("bigint").alias("month_in_quarter_no"),
        F.when(miq == 1, labels[0]).when(miq == 2, labels[1]).otherwise(labels[2])
         .alias("month_in_quarter"),
        (F.weekday("date") + 1).cast("bigint").alias("weekday_no"),
        F.date_format("date", "EEE").alias("day_short"),
        F.date_format("date", "EEEE").alias("day_name"),
        week_of_month("date").cast("bigint").alias("week_of_month"))


@register("year_is_whole", with_ctes(
    "SELECT year, count(*) AS days, count(*) >= 365 AS is_whole FROM date_dim GROUP BY year"))
def year_is_whole(spark, src):
    """A year is whole when the date table holds >= 365 of its days."""
    return (Model(spark, src).spine().groupBy("year")
            .agg(F.count(F.lit(1)).alias("days"))
            .withColumn("is_whole", F.col("days") >= 365))


def day_slice(cal: Calendar, months: list[str], years: list[int]) -> DataFrame:
    """J9 (virtual relationship): day cells with the calendar columns pinned to literal
    value lists (month names, years)."""
    return (cal.cells_day().where(F.date_format("date", "MMMM").isin(*months) & F.col("year").isin(*years))
            .select(F.date_format("date", "yyyy-MM-dd").alias("key"),
                    F.col("v").cast("double").alias("value"),
                    F.col("c").cast("bigint").alias("count")))


MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July", "August", "September",
               "October", "November", "December"]


@register("calendar_day_slice", with_ctes(
    "SELECT strftime(date, '%Y-%m-%d') AS key, CAST(v AS DOUBLE) AS value, "
    "CAST(c AS BIGINT) AS count FROM cells_day", *CAL_CTES[:2]))
def calendar_day_slice(spark, src):
    """J9 with every month and every year of the spine in the lists."""
    cal = _cal(spark, src)
    years = [r.year for r in cal.spine().select("year").distinct().collect()]   # a row per year
    return day_slice(cal, MONTH_NAMES, years)


# ---------------------------------------------------------------- W8 prior-year caps
@register("cal_month_py", with_ctes(
    "SELECT e.year, e.month_no, CAST(cur.v AS DOUBLE) AS value, CAST(sum(x.v) AS DOUBLE) "
    "AS value_py FROM ends e "
    "LEFT JOIN (SELECT year(date) AS y, month(date) AS m, sum(v) AS v FROM daily GROUP BY 1, 2) cur "
    "ON cur.y = e.year AND cur.m = e.month_no "
    "LEFT JOIN daily x ON year(x.date) = e.year - 1 AND month(x.date) = e.month_no "
    "AND x.date <= CAST(e.e - INTERVAL 12 MONTH AS DATE) GROUP BY e.year, e.month_no, cur.v",
    CAL_CTES[0],
    "ends AS (SELECT year, month_no, max(date) AS e FROM date_dim GROUP BY year, month_no)"))
def cal_month_py(spark, src):
    """Same days of the same month a year earlier, capped at the last visible day minus 12 months."""
    cal = _cal(spark, src)
    daily = cal.daily().select("date", "v", F.year("date").cast("bigint").alias("y"),
                               F.month("date").cast("bigint").alias("m"))
    ends = cal.spine().groupBy("year", "month_no").agg(F.max("date").alias("_e"))
    cur = daily.groupBy("y", "m").agg(F.sum("v").alias("value"))
    prev = (daily.join(F.broadcast(ends.select(F.col("year").alias("y2"),
                                               F.col("month_no").alias("m2"), "_e")),
                       (daily.y + 1 == F.col("y2")) & (daily.m == F.col("m2")))
            .where(F.col("date") <= F.add_months("_e", -12))
            .groupBy("y2", "m2").agg(F.sum("v").alias("value_py")))
    out = (ends.join(cur, (ends.year == cur.y) & (ends.month_no == cur.m), "left")
           .join(prev, (ends.year == prev.y2) & (ends.month_no == prev.m2), "left"))
    return out.select("year", "month_no", F.col("value").cast("double").alias("value"),
                      F.col("value_py").cast("double").alias("value_py"))


@register("cal_year_py", with_ctes(
    "SELECT e.year, CAST(cur.v AS DOUBLE) AS value, CAST(sum(x.v) AS DOUBLE) AS value_py "
    "FROM ends e LEFT JOIN (SELECT year(date) AS y, sum(v) AS v FROM daily GROUP BY 1) cur "
    "ON cur.y = e.year LEFT JOIN daily x ON year(x.date) = e.year - 1 "
    "AND x.date <= CAST(e.e - INTERVAL 12 MONTH AS DATE) GROUP BY e.year, cur.v",
    CAL_CTES[0], "ends AS (SELECT year, max(date) AS e FROM date_dim GROUP BY year)"))
def cal_year_py(spark, src):
    """The year before, up to the same day of the year (part year vs same part)."""
    cal = _cal(spark, src)
    daily = cal.daily().select("date", "v", F.year("date").cast("bigint").alias("y"))
    ends = cal.spine().groupBy("year").agg(F.max("date").alias("_e"))
    cur = daily.groupBy("y").agg(F.sum("v").alias("value"))
    prev = (daily.join(F.broadcast(ends.select(F.col("year").alias("y2"), "_e")),
                       daily.y + 1 == F.col("y2"))
            .where(F.col("date") <= F.add_months("_e", -12))
            .groupBy("y2").agg(F.sum("v").alias("value_py")))
    out = (ends.join(cur, ends.year == cur.y, "left").join(prev, ends.year == prev.y2, "left"))
    return out.select("year", F.col("value").cast("double").alias("value"),
                      F.col("value_py").cast("double").alias("value_py"))


# ---------------------------------------------------------------- W10 active days
@register("active_days", with_ctes(
    "SELECT strftime(date, '%Y-%m') AS month, count(*) FILTER (WHERE v > 0) AS active_days, "
    "count(*) AS days, CAST(sum(v) AS DOUBLE) AS value, "
    "CAST(sum(v) AS DOUBLE) / NULLIF(count(*) FILTER (WHERE v > 0), 0) AS avg_per_active_day "
    "FROM cells_day GROUP BY strftime(date, '%Y-%m')", *CAL_CTES[:2]))
def active_days(spark, src):
    """Days with value > 0 per month, and value per active day."""
    d = _cal(spark, src).cells_day()
    g = d.groupBy(F.date_format("date", "yyyy-MM").alias("month")).agg(
        F.count_if(F.col("v") > 0).alias("active_days"), F.count(F.lit(1)).alias("days"),
        F.sum("v").alias("_v"))
    return g.select("month", "active_days", "days", F.col("_v").cast("double").alias("value"),
                    ratio(F.col("_v"), F.col("active_days")).alias("avg_per_active_day"))


# ---------------------------------------------------------------- W11 peak day
@register("peak_day", with_ctes(
    "SELECT month, strftime(date, '%Y-%m-%d') AS best_date, CAST(v AS DOUBLE) AS best, "
    "days_all, quiet_days, CAST(v AS DOUBLE) / NULLIF(CAST(total AS DOUBLE), 0) AS best_share "
    "FROM (SELECT strftime(date, '%Y-%m') AS month, date, v, "
    "row_number() OVER (PARTITION BY strftime(date, '%Y-%m') ORDER BY v DESC, date) AS rn, "
    "count(*) OVER (PARTITION BY strftime(date, '%Y-%m')) AS days_all, "
    "count(*) FILTER (WHERE v <= 0) OVER (PARTITION BY strftime(date, '%Y-%m')) AS quiet_days, "
    "sum(v) OVER (PARTITION BY strftime(date, '%Y-%m')) AS total FROM cells_day) WHERE rn = 1",
    *CAL_CTES[:2]))
def peak_day(spark, src):
    """Biggest day of each month (ties -> earliest date), quiet days, its share."""
    d = _cal(spark, src).cells_day()
    g = d.groupBy(F.date_format("date", "yyyy-MM").alias("month")).agg(
        F.max("v").alias("_best"),
        F.min_by("date", F.struct((-F.col("v")).alias("nv"), F.col("date").alias("d")))
         .alias("_bd"),
        F.count(F.lit(1)).alias("days_all"),
        F.count_if(F.col("v") <= 0).alias("quiet_days"),
        F.sum("v").alias("_total"))
    return g.select("month", F.date_format("_bd", "yyyy-MM-dd").alias("best_date"),
                    F.col("_best").cast("double").alias("best"), "days_all", "quiet_days",
                    ratio(F.col("_best"), F.col("_total")).alias("best_share"))


# ---------------------------------------------------------------- W12 peak month
@register("peak_month", with_ctes(
    "SELECT p.year, CAST(max(v) AS DOUBLE) AS best, "
    "min(month_name) FILTER (WHERE v = mx) AS best_month, CAST(min(v) AS DOUBLE) AS worst, "
    "min(month_short) FILTER (WHERE v = mn) AS worst_month, "
    "CAST(max(t.total) AS DOUBLE) / count(*) AS avg_per_month, "
    "CAST(max(v) AS DOUBLE) / NULLIF(CAST(max(t.total) AS DOUBLE), 0) AS best_share "
    "FROM (SELECT *, max(v) OVER (PARTITION BY year) AS mx, min(v) OVER (PARTITION BY year) AS mn "
    "      FROM months WHERE v > 0) p JOIN (SELECT year, sum(v) AS total FROM months GROUP BY year) t "
    "ON p.year = t.year GROUP BY p.year",
    *CAL_CTES[:2],
    "months AS (SELECT year, month_no, strftime(min(date), '%B') AS month_name, "
    "strftime(min(date), '%b') AS month_short, sum(v) AS v FROM cells_day GROUP BY year, month_no)"))
def peak_month(spark, src):
    """Per year over the live months: biggest (ties -> alphabetically first name), smallest,
    average per live month, biggest month's share of the year."""
    d = _cal(spark, src).cells_day()
    months = d.groupBy("year", "month_no").agg(
        F.date_format(F.min("date"), "MMMM").alias("month_name"),
        F.date_format(F.min("date"), "MMM").alias("month_short"), F.sum("v").alias("v"))
    total = months.groupBy("year").agg(F.sum("v").alias("_total"))
    live = months.where(F.col("v") > 0)
    g = live.groupBy("year").agg(
        F.max("v").alias("_best"),
        F.min_by("month_name", F.struct((-F.col("v")).alias("a"), F.col("month_name").alias("b")))
         .alias("best_month"),
        F.min("v").alias("_worst"),
        F.min_by("month_short", F.struct(F.col("v").alias("a"), F.col("month_short").alias("b")))
         .alias("worst_month"),
        F.count(F.lit(1)).alias("_n"))
    g = g.join(total, "year")
    return g.select("year", F.col("_best").cast("double").alias("best"), "best_month",
                    F.col("_worst").cast("double").alias("worst"), "worst_month",
                    (F.col("_total").cast("double") / F.col("_n")).alias("avg_per_month"),
                    ratio(F.col("_best"), F.col("_total")).alias("best_share"))


# ---------------------------------------------------------------- W13 / W16 quarters
Q_CTES = (
    "quarters AS (SELECT year, quarter, CAST(year AS VARCHAR) || '-' || quarter AS qkey, "
    "quarter || ' ' || CAST(year AS VARCHAR) AS qlabel, sum(v) AS v FROM cells_day "
    "GROUP BY year, quarter)",
    "whole AS (SELECT year FROM date_dim GROUP BY year HAVING count(*) >= 365)",
)


@register("peak_quarter", with_ctes(
    "SELECT CAST(max(v) AS DOUBLE) AS best, "
    "(SELECT min(qlabel) FROM quarters WHERE v = (SELECT max(v) FROM quarters WHERE v > 0)) "
    "AS best_quarter, "
    "CAST((SELECT sum(v) FROM quarters) AS DOUBLE) / count(*) AS avg_per_quarter, "
    "CAST((SELECT sum(v) FROM quarters q JOIN whole w ON q.year = w.year WHERE quarter = 'Q4') "
    "AS DOUBLE) / NULLIF(CAST((SELECT sum(v) FROM quarters q JOIN whole w ON q.year = w.year) "
    "AS DOUBLE), 0) AS q4_share, "
    "CAST((SELECT sum(v) FROM quarters q JOIN whole w ON q.year = w.year WHERE quarter = 'Q1') "
    "AS DOUBLE) / NULLIF(CAST((SELECT sum(v) FROM quarters q JOIN whole w ON q.year = w.year) "
    "AS DOUBLE), 0) AS q1_share, "
    "(SELECT count(DISTINCT year) FROM quarters WHERE v > 0) - "
    "(SELECT count(DISTINCT q.year) FROM quarters q JOIN whole w ON q.year = w.year "
    " WHERE q.v > 0) AS part_years "
    "FROM quarters WHERE v > 0", *CAL_CTES[:2], *Q_CTES))
def peak_quarter(spark, src):
    """Biggest quarter (ties -> first label), average per live quarter, Q4/Q1 share over
    whole years only, and how many part years were left out."""
    cal = _cal(spark, src)
    d = cal.cells_day()
    whole = (cal.spine().groupBy("year").agg(F.count(F.lit(1)).alias("_days"))
             .where(F.col("_days") >= 365).select("year", F.lit(True).alias("_whole")))
    q = (d.groupBy("year", "quarter").agg(F.sum("v").alias("v"))
         .withColumn("qlabel", F.concat(F.col("quarter"), F.lit(" "), F.col("year").cast("string")))
         .join(F.broadcast(whole), "year", "left"))
    w = F.coalesce(F.col("_whole"), F.lit(False))
    live = F.col("v") > 0
    g = q.agg(
        F.max(F.when(live, F.col("v"))).alias("_best"),
        F.min_by(F.when(live, F.col("qlabel")),
                 F.struct(F.when(live, -F.col("v")).alias("a"), F.col("qlabel").alias("b")))
         .alias("best_quarter"),
        F.sum("v").alias("_all"), F.count_if(live).alias("_n"),
        F.sum(F.when(w & (F.col("quarter") == "Q4"), F.col("v"))).alias("_q4"),
        F.sum(F.when(w & (F.col("quarter") == "Q1"), F.col("v"))).alias("_q1"),
        F.sum(F.when(w, F.col("v"))).alias("_whole_v"),
        F.countDistinct(F.when(live, F.col("year"))).alias("_years"),
        F.countDistinct(F.when(live & w, F.col("year"))).alias("_wyears"))
    return g.select(F.col("_best").cast("double").alias("best"), "best_quarter",
                    (F.col("_all").cast("double") / F.col("_n")).alias("avg_per_quarter"),
                    ratio(F.col("_q4"), F.col("_whole_v")).alias("q4_share"),
                    ratio(F.col("_q1"), F.col("_whole_v")).alias("q1_share"),
                    (F.col("_years") - F.col("_wyears")).alias("part_years"))


@register("quarter_seasonality", with_ctes(
    "SELECT quarter, CAST(sum(v) AS DOUBLE) AS value, CAST(sum(v) AS DOUBLE) / "
    "CAST(sum(sum(v)) OVER () AS DOUBLE) AS share FROM quarters q JOIN whole w ON q.year = w.year "
    "GROUP BY quarter", *CAL_CTES[:2], *Q_CTES))
def quarter_seasonality(spark, src):
    """Each quarter-of-year's share of value over whole years only."""
    cal = _cal(spark, src)
    whole = (cal.spine().groupBy("year").agg(F.count(F.lit(1)).alias("_days"))
             .where(F.col("_days") >= 365).select("year"))
    d = cal.cells_day().join(F.broadcast(whole), "year", "left_semi")
    g = d.groupBy("quarter").agg(F.sum("v").alias("_v"))
    tot = g.agg(F.sum("_v").alias("_t"))
    return (with_scalars(g, tot)
            .select("quarter", F.col("_v").cast("double").alias("value"),
                    ratio(F.col("_v"), F.col("_t")).alias("share")))


# ---------------------------------------------------------------- W14 peak year
@register("peak_year", with_ctes(
    "SELECT CAST(max(v) AS DOUBLE) AS best, min(year) FILTER (WHERE v = (SELECT max(v) FROM pool)) "
    "AS best_year, CAST(sum(v) AS DOUBLE) / count(*) AS avg_per_whole_year, "
    "max(year) AS year_last, min(year) AS year_first, "
    "(CAST(max(v) FILTER (WHERE year = (SELECT max(year) FROM pool)) AS DOUBLE) - "
    " CAST(max(v) FILTER (WHERE year = (SELECT max(year) FROM pool) - 1) AS DOUBLE)) / "
    " NULLIF(CAST(max(v) FILTER (WHERE year = (SELECT max(year) FROM pool) - 1) AS DOUBLE), 0) "
    "AS change_last, "
    "(CAST(max(v) FILTER (WHERE year = (SELECT min(year) FROM pool) + 1) AS DOUBLE) - "
    " CAST(max(v) FILTER (WHERE year = (SELECT min(year) FROM pool)) AS DOUBLE)) / "
    " NULLIF(CAST(max(v) FILTER (WHERE year = (SELECT min(year) FROM pool)) AS DOUBLE), 0) "
    "AS change_second FROM pool",
    *CAL_CTES[:2], Q_CTES[1],
    "pool AS (SELECT c.year, sum(v) AS v FROM cells_day c JOIN whole w ON c.year = w.year "
    "GROUP BY c.year HAVING sum(v) > 0)"))
def peak_year(spark, src):
    """W14 over whole live years: biggest (ties -> earliest), average per whole year,
    last-on-previous and second-on-first change."""
    cal = _cal(spark, src)
    whole = (cal.spine().groupBy("year").agg(F.count(F.lit(1)).alias("_days"))
             .where(F.col("_days") >= 365).select("year"))
    years = (cal.cells_day().join(F.broadcast(whole), "year", "left_semi")
             .groupBy("year").agg(F.sum("v").alias("v")).where(F.col("v") > 0))
    ends = years.agg(F.max("year").alias("year_last"), F.min("year").alias("year_first"))
    y = with_scalars(years, ends)

    def at(cond):        # the value of the one year meeting cond (null when none)
        return F.max(F.when(cond, F.col("v")))
    g = y.agg(
        F.max("v").alias("_best"),
        F.min_by("year", F.struct((-F.col("v")).alias("a"), F.col("year").alias("b")))
         .alias("best_year"),
        # exact decimal sum, then one double division: the same bits whatever the order
        (F.sum("v").cast("double") / F.count(F.lit(1))).alias("avg_per_whole_year"),
        F.max("year_last").alias("year_last"), F.max("year_first").alias("year_first"),
        at(F.col("year") == F.col("year_last")).alias("_last"),
        at(F.col("year") == F.col("year_last") - 1).alias("_before"),
        at(F.col("year") == F.col("year_first")).alias("_first"),
        at(F.col("year") == F.col("year_first") + 1).alias("_second"))
    last, before, first, second = (F.col(c) for c in ("_last", "_before", "_first", "_second"))
    return g.select(F.col("_best").cast("double").alias("best"), "best_year",
                    "avg_per_whole_year", "year_last", "year_first",
                    change(last, before).alias("change_last"),
                    change(second, first).alias("change_second"))


# ---------------------------------------------------------------- W15 weekdays
@register("weekday_avg", with_ctes(
    "SELECT CAST(isodow(date) AS BIGINT) AS weekday_no, strftime(date, '%A') AS day_name, "
    "CAST(sum(v) AS DOUBLE) AS value, count(*) FILTER (WHERE v > 0) AS active_days, "
    "CAST(sum(v) AS DOUBLE) / NULLIF(count(*) FILTER (WHERE v > 0), 0) AS avg_per_active_day, "
    "isodow(date) >= 6 AS is_weekend FROM cells_day GROUP BY isodow(date), strftime(date, '%A')",
    *CAL_CTES[:2]))
def weekday_avg(spark, src):
    """Value per active day by weekday (Monday = 1); weekend flag."""
    d = _cal(spark, src).cells_day()
    g = d.groupBy((F.weekday("date") + 1).cast("bigint").alias("weekday_no"),
                  F.date_format("date", "EEEE").alias("day_name")).agg(
        F.sum("v").alias("_v"), F.count_if(F.col("v") > 0).alias("active_days"))
    return g.select("weekday_no", "day_name", F.col("_v").cast("double").alias("value"),
                    "active_days", ratio(F.col("_v"), F.col("active_days"))
                    .alias("avg_per_active_day"), (F.col("weekday_no") >= 6).alias("is_weekend"))


# ---------------------------------------------------------------- card totals
@register("cal_total_month", with_ctes(
    "SELECT y.year, CAST(y.v AS DOUBLE) AS value, CAST(y.c AS BIGINT) AS count, "
    "CAST(y.v AS DOUBLE) / NULLIF(y.active, 0) AS avg_per_active_day, "
    "CAST(p.v AS DOUBLE) AS value_py, "
    "(CAST(y.v AS DOUBLE) - CAST(p.v AS DOUBLE)) / NULLIF(CAST(p.v AS DOUBLE), 0) AS change "
    "FROM (SELECT year, sum(v) AS v, sum(c) AS c, count(*) FILTER (WHERE v > 0) AS active "
    "      FROM cells_day GROUP BY year) y "
    "LEFT JOIN (SELECT e.year, sum(x.v) AS v FROM ends e JOIN daily x "
    "  ON year(x.date) = e.year - 1 AND x.date <= CAST(e.e - INTERVAL 12 MONTH AS DATE) "
    "  GROUP BY e.year) p ON y.year = p.year",
    *CAL_CTES[:2], "ends AS (SELECT year, max(date) AS e FROM date_dim GROUP BY year)"))
def cal_total_month(spark, src):
    """Month-view card: the year's value, count, value per active day, and the change on
    the same part of the year before."""
    cal = _cal(spark, src)
    y = cal.cells_day().groupBy("year").agg(F.sum("v").alias("_v"), F.sum("c").alias("_c"),
                                            F.count_if(F.col("v") > 0).alias("_a"))
    py = cal_year_py(cal.m.spark, cal.m.src).select("year", "value_py")
    j = y.join(py, "year", "left")
    return j.select("year", F.col("_v").cast("double").alias("value"),
                    F.col("_c").cast("bigint").alias("count"),
                    ratio(F.col("_v"), F.col("_a")).alias("avg_per_active_day"),
                    "value_py", change(F.col("_v"), F.col("value_py")).alias("change"))


@register("cal_total_day", with_ctes(
    "SELECT m.year, m.month_no, CAST(m.v AS DOUBLE) AS value, CAST(m.c AS BIGINT) AS count, "
    "CAST(m.v AS DOUBLE) / NULLIF(m.active, 0) AS avg_per_active_day, "
    "CAST(p.v AS DOUBLE) AS value_py, "
    "(CAST(m.v AS DOUBLE) - CAST(p.v AS DOUBLE)) / NULLIF(CAST(p.v AS DOUBLE), 0) AS change "
    "FROM (SELECT year, month_no, sum(v) AS v, sum(c) AS c, count(*) FILTER (WHERE v > 0) AS active "
    "      FROM cells_day GROUP BY year, month_no) m "
    "LEFT JOIN (SELECT e.year, e.month_no, sum(x.v) AS v FROM ends e JOIN daily x "
    "  ON year(x.date) = e.year - 1 AND month(x.date) = e.month_no "
    "  AND x.date <= CAST(e.e - INTERVAL 12 MONTH AS DATE) GROUP BY e.year, e.month_no) p "
    "ON m.year = p.year AND m.month_no = p.month_no",
    *CAL_CTES[:2],
    "ends AS (SELECT year, month_no, max(date) AS e FROM date_dim GROUP BY year, month_no)"))
def cal_total_day(spark, src):
    """Day-view card: the month's value, count, value per active day, change on the same
    days of the same month a year earlier."""
    cal = _cal(spark, src)
    m = cal.cells_day().groupBy("year", "month_no").agg(
        F.sum("v").alias("_v"), F.sum("c").alias("_c"), F.count_if(F.col("v") > 0).alias("_a"))
    py = cal_month_py(cal.m.spark, cal.m.src).select("year", "month_no", "value_py")
    j = m.join(py, ["year", "month_no"], "left")
    return j.select("year", "month_no", F.col("_v").cast("double").alias("value"),
                    F.col("_c").cast("bigint").alias("count"),
                    ratio(F.col("_v"), F.col("_a")).alias("avg_per_active_day"),
                    "value_py", change(F.col("_v"), F.col("value_py")).alias("change"))


@register("cal_total_all", with_ctes(
    "SELECT CAST(sum(v) AS DOUBLE) AS value, CAST(sum(c) AS BIGINT) AS count, "
    "CAST(sum(v) AS DOUBLE) / NULLIF(count(*) FILTER (WHERE v > 0), 0) AS avg_per_active_day, "
    "(SELECT count(*) FROM (SELECT year FROM cells_day GROUP BY year HAVING sum(v) > 0)) "
    "AS year_count FROM cells_day", *CAL_CTES[:2]))
def cal_total_all(spark, src):
    d = _cal(spark, src).cells_day()
    yc = d.groupBy("year").agg(F.sum("v").alias("_yv")).agg(
        F.count_if(F.col("_yv") > 0).alias("year_count"))
    g = d.agg(F.sum("v").alias("_v"), F.sum("c").alias("_c"),
              F.count_if(F.col("v") > 0).alias("_a"))
    return with_scalars(g, yc).select(F.col("_v").cast("double").alias("value"),
                                  F.col("_c").cast("bigint").alias("count"),
                                  ratio(F.col("_v"), F.col("_a")).alias("avg_per_active_day"),
                                  "year_count")


# ---------------------------------------------------------------- formatting / narrative
def _short_sql(v: str) -> str:
    return (f"CASE WHEN {v} >= 1000000 THEN '$' || CAST(round({v} * 0.000001, 2) AS VARCHAR) || 'M' "
            f"WHEN {v} >= 10000 THEN '$' || CAST(round({v} * 0.001, 1) AS VARCHAR) || 'k' "
            f"WHEN {v} >= 1000 THEN '$' || CAST(round({v} * 0.001, 2) AS VARCHAR) || 'k' "
            f"ELSE '$' || CAST(CAST(round({v}, 0) AS BIGINT) AS VARCHAR) END")


@register("short_format", with_ctes(
    "SELECT strftime(date, '%Y-%m') AS month, CAST(sum(v) AS DOUBLE) AS value, "
    f"{_short_sql('CAST(sum(v) AS DECIMAL(20,2))')} AS short_value "
    "FROM cells_day GROUP BY strftime(date, '%Y-%m')", *CAL_CTES[:2]))
def short_format(spark, src):
    """$1.23M / $12.3k / $1.23k / $123 labels of monthly values (exact decimal rounding)."""
    d = _cal(spark, src).cells_day()
    g = d.groupBy(F.date_format("date", "yyyy-MM").alias("month")).agg(
        F.sum("v").cast("decimal(20,2)").alias("_v"))
    return g.select("month", F.col("_v").cast("double").alias("value"),
                    short_money(F.col("_v")).alias("short_value"))


@register("calendar_facts", with_ctes(
    "SELECT month, strftime(best_date, '%B %Y') AS month_label, CAST(day(best_date) AS BIGINT) "
    "AS best_day, CASE WHEN day(best_date) % 100 IN (11, 12, 13) THEN 'th' "
    "WHEN day(best_date) % 10 = 1 THEN 'st' WHEN day(best_date) % 10 = 2 THEN 'nd' "
    "WHEN day(best_date) % 10 = 3 THEN 'rd' ELSE 'th' END AS suffix, days_all, quiet_days, "
    "CASE WHEN quiet_days = 0 THEN 'none of the ' || days_all "
    "ELSE quiet_days || ' of ' || days_all END AS quiet_phrase "
    "FROM (SELECT strftime(date, '%Y-%m') AS month, date AS best_date, "
    "row_number() OVER (PARTITION BY strftime(date, '%Y-%m') ORDER BY v DESC, date) AS rn, "
    "count(*) OVER (PARTITION BY strftime(date, '%Y-%m')) AS days_all, "
    "count(*) FILTER (WHERE v <= 0) OVER (PARTITION BY strftime(date, '%Y-%m')) AS quiet_days "
    "FROM cells_day) WHERE rn = 1", *CAL_CTES[:2]))
def calendar_facts(spark, src):
    """Narrative fields of the Day view: 'The biggest day was the 3rd'; 'none of the 31
    days had no spend' / '2 of 30'."""
    pk = peak_day(spark, src)
    bd = F.to_date("best_date")
    return pk.select(
        "month", F.date_format(bd, "MMMM yyyy").alias("month_label"),
        F.dayofmonth(bd).cast("bigint").alias("best_day"),
        ordinal_suffix(F.dayofmonth(bd)).alias("suffix"), "days_all", "quiet_days",
        F.when(F.col("quiet_days") == 0,
               F.concat(F.lit("none of the "), F.col("days_all").cast("string")))
         .otherwise(F.concat(F.col("quiet_days").cast("string"), F.lit(" of "),
                             F.col("days_all").cast("string"))).alias("quiet_phrase"))


# ---------------------------------------------------------------- titles (narrative text)
def _pct_text(x, dp: int) -> "F.Column":
    """abs(x) as a percentage with dp decimals, rounded as an exact decimal."""
    d = F.round((F.abs(x) * 100).cast("decimal(20,6)"), dp)
    return (d.cast("bigint") if dp == 0 else d.cast(f"decimal(20,{dp})")).cast("string")


def _pct_sql(x: str, dp: int) -> str:
    d = f"round(CAST(abs({x}) * 100 AS DECIMAL(20,6)), {dp})"
    return (f"CAST(CAST({d} AS BIGINT) AS VARCHAR)" if dp == 0
            else f"CAST(CAST({d} AS DECIMAL(20,{dp})) AS VARCHAR)")


TITLE_CTES = (
    "months AS (SELECT year, month_no, strftime(min(date), '%B') AS month_name, "
    "strftime(min(date), '%B %Y') AS label, strftime(min(date), '%Y-%m') AS mkey, "
    "CAST(sum(v) AS DECIMAL(20,2)) AS v, count(*) FILTER (WHERE v > 0) AS active "
    "FROM cells_day GROUP BY year, month_no)",
    "years AS (SELECT year, CAST(sum(v) AS DECIMAL(20,2)) AS v FROM months GROUP BY year)",
    "whole AS (SELECT year FROM date_dim GROUP BY year HAVING count(*) >= 365)",
    "qtr AS (SELECT c.quarter, sum(c.v) AS v FROM cells_day c JOIN whole w ON c.year = w.year "
    "GROUP BY c.quarter)",
    "part AS (SELECT (SELECT count(*) FROM years WHERE v > 0) - (SELECT count(*) FROM years y "
    "JOIN whole w ON y.year = w.year WHERE y.v > 0) AS n)",
    "ypool AS (SELECT y.year, y.v FROM years y JOIN whole w ON y.year = w.year WHERE y.v > 0)",
    "wd AS (SELECT strftime(date, '%A') AS day_name, CAST(sum(v) AS DOUBLE) / "
    "NULLIF(count(*) FILTER (WHERE v > 0), 0) AS a FROM cells_day GROUP BY 1)",
)


@register("calendar_titles", with_ctes(
    "SELECT 'Day' AS view, mkey AS key, label || ': ' || " + _short_sql("v") + " || "
    "' in spend across ' || CAST(active AS VARCHAR) || ' active days' AS title FROM months "
    "UNION ALL SELECT 'Month', CAST(y.year AS VARCHAR), CAST(y.year AS VARCHAR) || ': ' || "
    + _short_sql("y.v") + " || ' in spend, and ' || (SELECT min(m.month_name) FROM months m "
    "WHERE m.year = y.year AND m.v = (SELECT max(v) FROM months m2 WHERE m2.year = y.year)) "
    "|| ' was the biggest month' FROM years y "
    "UNION ALL SELECT 'Quarter', 'all', (SELECT min(quarter) FROM qtr WHERE v = (SELECT max(v) "
    "FROM qtr)) || ' carries ' || " + _pct_sql("CAST((SELECT max(v) FROM qtr) AS DOUBLE) / "
                                                "CAST((SELECT sum(v) FROM qtr) AS DOUBLE)", 0)
    + " || '% of all spend, more than any other quarter' || CASE WHEN (SELECT n FROM part) > 0 "
    "THEN ' (whole years only)' ELSE '' END "
    "UNION ALL SELECT 'Year', 'all', CAST(l.year AS VARCHAR) || ' closed at ' || "
    + _short_sql("l.v") + " || ' in spend, ' || CASE WHEN (CAST(l.v AS DOUBLE) - CAST(f.v AS DOUBLE)) "
    "/ CAST(f.v AS DOUBLE) >= 0 THEN 'up ' ELSE 'down ' END || "
    + _pct_sql("(CAST(l.v AS DOUBLE) - CAST(f.v AS DOUBLE)) / CAST(f.v AS DOUBLE)", 1)
    + " || '% on ' || CAST(f.year AS VARCHAR) || CASE WHEN (SELECT n FROM part) > 0 "
    "THEN ' (whole years only)' ELSE '' END FROM ypool l, ypool f "
    "WHERE l.year = (SELECT max(year) FROM ypool) AND f.year = (SELECT min(year) FROM ypool) "
    "UNION ALL SELECT 'Weekday', 'all', (SELECT min(day_name) FROM wd WHERE a = (SELECT max(a) "
    "FROM wd WHERE a > 0)) || 's run highest per active day'",
    *CAL_CTES[:2], *TITLE_CTES))
def calendar_titles(spark, src):
    """Title Cal Day / Month / Quarter / Year / Weekday: the headline sentences of the
    calendar views, built from the same cells as the matrices."""
    cal = _cal(spark, src)
    d = cal.cells_day()
    months = d.groupBy("year", "month_no").agg(
        F.date_format(F.min("date"), "MMMM").alias("month_name"),
        F.date_format(F.min("date"), "MMMM yyyy").alias("label"),
        F.date_format(F.min("date"), "yyyy-MM").alias("mkey"),
        F.sum("v").cast("decimal(20,2)").alias("v"), F.count_if(F.col("v") > 0).alias("active"))
    day = months.select(F.lit("Day").alias("view"), F.col("mkey").alias("key"),
                        F.concat("label", F.lit(": "), short_money("v"), F.lit(" in spend across "),
                                 F.col("active").cast("string"), F.lit(" active days"))
                        .alias("title"))
    yr = months.groupBy("year").agg(
        F.sum("v").cast("decimal(20,2)").alias("v"),
        F.min_by("month_name", F.struct((-F.col("v")).alias("a"), F.col("month_name").alias("b")))
         .alias("best"))
    month = yr.select(F.lit("Month").alias("view"), F.col("year").cast("string").alias("key"),
                      F.concat(F.col("year").cast("string"), F.lit(": "), short_money("v"),
                               F.lit(" in spend, and "), "best", F.lit(" was the biggest month"))
                      .alias("title"))
    whole = (cal.spine().groupBy("year").agg(F.count(F.lit(1)).alias("_d"))
             .where(F.col("_d") >= 365).select("year"))
    wyears = yr.join(F.broadcast(whole), "year", "left_semi")
    part = (with_scalars(yr.agg(F.count_if(F.col("v") > 0).alias("_a")),
                         wyears.agg(F.count_if(F.col("v") > 0).alias("_w")))
            .select((F.col("_a") - F.col("_w")).alias("part_years")))
    suffix = F.when(F.col("part_years") > 0, F.lit(" (whole years only)")).otherwise(F.lit(""))
    q = (d.join(F.broadcast(whole), "year", "left_semi").groupBy("quarter").agg(F.sum("v").alias("v"))
         .agg(F.max("v").alias("_best"), F.sum("v").alias("_tot"),
              F.min_by("quarter", F.struct((-F.col("v")).alias("a"), F.col("quarter").alias("b")))
              .alias("_q")))
    quarter = with_scalars(q, part).select(
        F.lit("Quarter").alias("view"), F.lit("all").alias("key"),
        F.concat("_q", F.lit(" carries "), _pct_text(ratio(F.col("_best"), F.col("_tot")), 0),
                 F.lit("% of all spend, more than any other quarter"), suffix).alias("title"))
    yp = wyears.where(F.col("v") > 0)
    ends = yp.agg(F.max("year").alias("_ly"), F.min("year").alias("_fy"),
                  F.max_by("v", "year").alias("_lv"), F.min_by("v", "year").alias("_fv"))
    chg = change(F.col("_lv"), F.col("_fv"))
    year = with_scalars(ends, part).select(
        F.lit("Year").alias("view"), F.lit("all").alias("key"),
        F.concat(F.col("_ly").cast("string"), F.lit(" closed at "), short_money("_lv"),
                 F.lit(" in spend, "), F.when(chg >= 0, F.lit("up ")).otherwise(F.lit("down ")),
                 _pct_text(chg, 1), F.lit("% on "), F.col("_fy").cast("string"), suffix)
        .alias("title"))
    wd = (d.groupBy(F.date_format("date", "EEEE").alias("day_name"))
          .agg(ratio(F.sum("v"), F.count_if(F.col("v") > 0)).alias("a"))
          .where(F.col("a") > 0)
          .agg(F.min_by("day_name", F.struct((-F.col("a")).alias("x"), F.col("day_name").alias("y")))
               .alias("_d")))
    weekday = wd.select(F.lit("Weekday").alias("view"), F.lit("all").alias("key"),
                        F.concat("_d", F.lit("s run highest per active day")).alias("title"))
    return day.unionByName(month).unionByName(quarter).unionByName(year).unionByName(weekday)


# ---------------------------------------------------------------- standfirsts (narrative text)
def _count_text(c) -> "F.Column":
    return F.format_number(F.col(c).cast("bigint"), 0) if isinstance(c, str) else F.format_number(c, 0)


def _change_words(cur, prev) -> "F.Column":
    chg = change(cur, prev)
    return F.concat(F.when(chg >= 0, F.lit("up ")).otherwise(F.lit("down ")), _pct_text(chg, 1),
                    F.lit("%"))


def _words_sql(cur: str, prev: str) -> str:
    chg = f"((CAST({cur} AS DOUBLE) - CAST({prev} AS DOUBLE)) / CAST({prev} AS DOUBLE))"
    return (f"CASE WHEN {chg} >= 0 THEN 'up ' ELSE 'down ' END || {_pct_sql(chg, 1)} || '%'")


STAND_CTES = (
    "mcell AS (SELECT year, month_no, strftime(min(date), '%B %Y') AS label, "
    "strftime(min(date), '%Y-%m') AS mkey, CAST(sum(v) AS DECIMAL(20,2)) AS v, sum(c) AS c, "
    "count(*) AS days_all, count(*) FILTER (WHERE v <= 0) AS quiet FROM cells_day "
    "GROUP BY year, month_no)",
    "ends_m AS (SELECT year, month_no, max(date) AS e FROM date_dim GROUP BY year, month_no)",
    "mpy AS (SELECT e.year, e.month_no, sum(x.v) AS py FROM ends_m e JOIN daily x "
    "ON year(x.date) = e.year - 1 AND month(x.date) = e.month_no "
    "AND x.date <= CAST(e.e - INTERVAL 12 MONTH AS DATE) GROUP BY e.year, e.month_no)",
    "best AS (SELECT strftime(date, '%Y-%m') AS mkey, day(date) AS d, v FROM (SELECT date, v, "
    "row_number() OVER (PARTITION BY strftime(date, '%Y-%m') ORDER BY v DESC, date) AS rn "
    "FROM cells_day) WHERE rn = 1)",
    "ycell AS (SELECT year, CAST(sum(v) AS DECIMAL(20,2)) AS v, sum(c) AS c FROM cells_day "
    "GROUP BY year)",
    "ends_y AS (SELECT year, max(date) AS e, count(*) >= 365 AS whole FROM date_dim GROUP BY year)",

    "ypy AS (SELECT e.year, sum(x.v) AS py FROM ends_y e JOIN daily x ON year(x.date) = e.year - 1 "
    "AND x.date <= CAST(e.e - INTERVAL 12 MONTH AS DATE) GROUP BY e.year)",
    "ybest AS (SELECT year, max(mv) AS mv, min(mname) FILTER (WHERE mv = mx) AS mname FROM ("
    "SELECT year, strftime(min(date), '%B') AS mname, sum(v) AS mv, "
    "max(sum(v)) OVER (PARTITION BY year) AS mx FROM cells_day GROUP BY year, month_no) GROUP BY year)",
)


def _suffix_sql(d: str) -> str:
    return (f"CASE WHEN {d} % 100 IN (11, 12, 13) THEN 'th' WHEN {d} % 10 = 1 THEN 'st' "
            f"WHEN {d} % 10 = 2 THEN 'nd' WHEN {d} % 10 = 3 THEN 'rd' ELSE 'th' END")


@register("calendar_standfirst", with_ctes(
    "SELECT 'Day' AS view, m.mkey AS key, m.label || ' recorded ' || " + _short_sql("m.v")
    + " || ' in spend from ' || format('{:,}', m.c) || ' transactions' || "
    "CASE WHEN p.py > 0 THEN ', ' || " + _words_sql("m.v", "p.py")
    + " || ' on the same month a year earlier' ELSE '' END || '. The biggest day was the ' || "
    "CAST(b.d AS VARCHAR) || " + _suffix_sql("b.d") + " || ' at ' || "
    + _short_sql("CAST(b.v AS DECIMAL(20,2))") + " || '; ' || CASE WHEN m.quiet = 0 THEN "
    "'none of the ' || CAST(m.days_all AS VARCHAR) ELSE CAST(m.quiet AS VARCHAR) || ' of ' || "
    "CAST(m.days_all AS VARCHAR) END || ' days had no spend.' AS text "
    "FROM mcell m LEFT JOIN mpy p ON m.year = p.year AND m.month_no = p.month_no "
    "JOIN best b ON m.mkey = b.mkey "
    "UNION ALL SELECT 'Month', CAST(y.year AS VARCHAR), CAST(y.year AS VARCHAR) || ' recorded ' || "
    + _short_sql("y.v") + " || ' in spend from ' || format('{:,}', y.c) || ' transactions' || "
    "CASE WHEN p.py > 0 THEN ', ' || " + _words_sql("y.v", "p.py") + " || ' on ' || "
    "CASE WHEN e.whole THEN '' ELSE 'the same period of ' END || CAST(y.year - 1 AS VARCHAR) "
    "ELSE '' END || '. ' || b.mname || ' alone was ' || "
    + _pct_sql("CAST(b.mv AS DOUBLE) / CAST(y.v AS DOUBLE)", 1)
    + " || '% of the year' || CASE WHEN e.whole THEN '' ELSE ' to date' END || "
    "'. Switch to Day to open a month.' FROM ycell y LEFT JOIN ypy p ON y.year = p.year "
    "JOIN ends_y e ON y.year = e.year JOIN ybest b ON y.year = b.year "
    "UNION ALL SELECT 'Quarter', 'all', CAST((SELECT min(year) FROM ycell WHERE v > 0) AS VARCHAR) "
    "|| ' to ' || CAST((SELECT max(year) FROM ycell WHERE v > 0) AS VARCHAR) || ' recorded ' || "
    + _short_sql("CAST((SELECT sum(v) FROM ycell) AS DECIMAL(20,2))")
    + " || ' in spend from ' || format('{:,}', (SELECT sum(c) FROM ycell)) || ' transactions. "
    "Read across a row for the shape of a year, down a column for the same quarter year on year.' "
    "UNION ALL SELECT 'Year', 'all', CAST((SELECT count(*) FROM ycell WHERE v > 0) AS VARCHAR) || "
    "' years, ' || " + _short_sql("CAST((SELECT sum(v) FROM ycell) AS DECIMAL(20,2))")
    + " || ' in spend from ' || format('{:,}', (SELECT sum(c) FROM ycell)) || ' transactions. "
    "Switch to Quarter or Month to see where inside a year the change came from.'",
    *CAL_CTES[:2], *STAND_CTES))
def calendar_standfirst(spark, src):
    """Standfirst Cal Day / Month / Quarter / Year: the paragraph under each view's title."""
    cal = _cal(spark, src)
    d = cal.cells_day()
    m = d.groupBy("year", "month_no").agg(
        F.date_format(F.min("date"), "MMMM yyyy").alias("label"),
        F.date_format(F.min("date"), "yyyy-MM").alias("mkey"),
        F.sum("v").cast("decimal(20,2)").alias("v"), F.sum("c").alias("c"),
        F.count(F.lit(1)).alias("days_all"), F.count_if(F.col("v") <= 0).alias("quiet"))
    mpy = cal_month_py(spark, src).select("year", "month_no", F.col("value_py").alias("py"))
    best = d.groupBy(F.date_format("date", "yyyy-MM").alias("mkey")).agg(
        F.min_by(F.struct(F.dayofmonth("date").alias("d"), F.col("v").alias("bv")),
                 F.struct((-F.col("v")).alias("a"), F.col("date").alias("b"))).alias("_b"))
    mj = m.join(mpy, ["year", "month_no"], "left").join(best, "mkey")
    bd = F.col("_b.d")
    day = mj.select(
        F.lit("Day").alias("view"), F.col("mkey").alias("key"),
        F.concat("label", F.lit(" recorded "), short_money("v"), F.lit(" in spend from "),
                 _count_text("c"), F.lit(" transactions"),
                 F.when(F.col("py") > 0, F.concat(F.lit(", "), _change_words(F.col("v"), F.col("py")),
                                                  F.lit(" on the same month a year earlier")))
                 .otherwise(F.lit("")),
                 F.lit(". The biggest day was the "), bd.cast("string"), ordinal_suffix(bd),
                 F.lit(" at "), short_money(F.col("_b.bv")), F.lit("; "),
                 F.when(F.col("quiet") == 0, F.concat(F.lit("none of the "),
                                                      F.col("days_all").cast("string")))
                 .otherwise(F.concat(F.col("quiet").cast("string"), F.lit(" of "),
                                     F.col("days_all").cast("string"))),
                 F.lit(" days had no spend.")).alias("text"))
    y = d.groupBy("year").agg(F.sum("v").cast("decimal(20,2)").alias("v"), F.sum("c").alias("c"))
    ypy = cal_year_py(spark, src).select("year", F.col("value_py").alias("py"))
    whole = cal.spine().groupBy("year").agg((F.count(F.lit(1)) >= 365).alias("whole"))
    mon = d.groupBy("year", "month_no").agg(F.date_format(F.min("date"), "MMMM").alias("mname"),
                                            F.sum("v").alias("mv"))
    yb = mon.groupBy("year").agg(F.max("mv").alias("mv"), F.min_by(
        "mname", F.struct((-F.col("mv")).alias("a"), F.col("mname").alias("b"))).alias("mname"))
    yj = y.join(ypy, "year", "left").join(whole, "year").join(yb, "year")
    month = yj.select(
        F.lit("Month").alias("view"), F.col("year").cast("string").alias("key"),
        F.concat(F.col("year").cast("string"), F.lit(" recorded "), short_money("v"),
                 F.lit(" in spend from "), _count_text("c"), F.lit(" transactions"),
                 F.when(F.col("py") > 0, F.concat(
                     F.lit(", "), _change_words(F.col("v"), F.col("py")), F.lit(" on "),
                     F.when(F.col("whole"), F.lit("")).otherwise(F.lit("the same period of ")),
                     (F.col("year") - 1).cast("string"))).otherwise(F.lit("")),
                 F.lit(". "), "mname", F.lit(" alone was "),
                 _pct_text(ratio(F.col("mv"), F.col("v")), 1), F.lit("% of the year"),
                 F.when(F.col("whole"), F.lit("")).otherwise(F.lit(" to date")),
                 F.lit(". Switch to Day to open a month.")).alias("text"))
    tot = y.agg(F.min(F.when(F.col("v") > 0, F.col("year"))).alias("_f"),
                F.max(F.when(F.col("v") > 0, F.col("year"))).alias("_l"),
                F.sum("v").cast("decimal(20,2)").alias("_v"), F.sum("c").alias("_c"),
                F.count_if(F.col("v") > 0).alias("_n"))
    quarter = tot.select(
        F.lit("Quarter").alias("view"), F.lit("all").alias("key"),
        F.concat(F.col("_f").cast("string"), F.lit(" to "), F.col("_l").cast("string"),
                 F.lit(" recorded "), short_money("_v"), F.lit(" in spend from "), _count_text("_c"),
                 F.lit(" transactions. Read across a row for the shape of a year, down a column "
                       "for the same quarter year on year.")).alias("text"))
    year = tot.select(
        F.lit("Year").alias("view"), F.lit("all").alias("key"),
        F.concat(F.col("_n").cast("string"), F.lit(" years, "), short_money("_v"),
                 F.lit(" in spend from "), _count_text("_c"),
                 F.lit(" transactions. Switch to Quarter or Month to see where inside a year "
                       "the change came from.")).alias("text"))
    return day.unionByName(month).unionByName(quarter).unionByName(year)
