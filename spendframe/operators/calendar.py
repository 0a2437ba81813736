"""Heat-map calendar operators, generic over any additive daily measure.

* ``zero_fill``: day spine LEFT JOIN daily rollup (a day with no rows is a 0 cell);
* ``rank_band``: five bands by *rank* among the live (value > 0) cells of a pool, in
  integer arithmetic: band = min(5, below * 5 div (live - 1) + 1), 5 when only one
  cell is live, 0 for an empty cell.  ``below`` is rank() - 1 inside the live cells
  of the pool, so ties share a band.

Pools are a month (day cells), a year (month cells) or everything (quarter and year
cells); all are bounded by the length of the date range, never by row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendframe.functions.constants import CALENDAR_BANDS


def zero_fill(spine: DataFrame, daily: DataFrame, cols: list[str]) -> DataFrame:
    """Spine (one row per day) left-joined to a daily rollup; missing values -> 0."""
    j = spine.join(daily, "date", "left")        # both sides: one row per day
    for c in cols:
        j = j.withColumn(c, F.coalesce(F.col(c), F.lit(0)))
    return j


def rank_band(df: DataFrame, value: str, pool: list[str], out: str = "band",
              bands: int = CALENDAR_BANDS) -> DataFrame:
    live = F.col(value) > 0
    w_pool = Window.partitionBy(*pool)
    w_rank = Window.partitionBy(*pool, live).orderBy(F.col(value).asc())
    n = F.count(F.when(live, F.lit(1))).over(w_pool)
    below = F.rank().over(w_rank) - 1
    band = (F.when(~live, F.lit(0))
            .when(n <= 1, F.lit(bands))
            # floor of an exact small-integer quotient == integer div
            .otherwise(F.least(F.lit(bands), F.floor(below * bands / (n - 1)).cast("int") + 1)))
    return df.withColumn(out, band.cast("bigint"))
