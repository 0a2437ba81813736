"""Top-N that keeps ties at the boundary, in one pass, never a whole table in one task.

``rank() <= n`` over the whole result is planned by Catalyst (InsertWindowGroupLimit)
as a *partial* WindowGroupLimit in every task - each keeps only its rows ranked <= n,
ties included - then a single-partition exchange of at most n (+ ties) rows per task
and a final limit + rank.  One scan of the input, a bounded final task.

The rule applies up to ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000 by
default), so MOST_ROWS is the largest n: a longer list is a sort, not a top-N.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MOST_ROWS = 1000


def top_n_with_ties(df: DataFrame, n: int, by: str, ascending: bool = False,
                    rank_col: str | None = None) -> DataFrame:
    """Rows whose competition rank on ``by`` is <= n (nulls last).  ``rank_col`` keeps
    the rank as a column."""
    if not 0 < n <= MOST_ROWS:
        raise ValueError(f"n must be 1 to {MOST_ROWS}: {n}")
    order = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    out = df.withColumn("__rk", F.rank().over(Window.orderBy(order))).where(F.col("__rk") <= n)
    return out.withColumnRenamed("__rk", rank_col) if rank_col else out.drop("__rk")
