"""Dense numbers and ranks over tables of any size.

A window ordered over a whole table runs in one task.  Here the table is cut into ranges at BOUNDS
values taken from it (those of the rows of least hash, so every run cuts alike), each range
is numbered by itself, and a range starts at the number of rows (or of different values) in the
ranges before it.  The cuts and the counts of the ranges are scalar values of bounded size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendframe.operators.joins import with_scalars
from spendframe.operators.shared import kept

BOUNDS = 255


def _numbered(df: DataFrame, columns: Sequence[str], name: str, descending: bool, ranks: bool) -> DataFrame:
    by, names = F.struct(*columns), df.columns
    df = kept(df, names)
    bounds = df.orderBy(F.xxhash64(*names)).limit(BOUNDS).agg(F.array_sort(F.collect_set(by)).alias("__bounds"))
    place = F.size(F.filter("__bounds", lambda b: b > by if descending else b < by))
    placed = with_scalars(df, bounds).select(*names, place.alias("__place"))
    counts = placed.groupBy("__place").agg(F.countDistinct(by) if ranks else F.count(F.lit(1)).alias("n")).toDF("place", "n")
    ranges = with_scalars(placed, counts.agg(F.collect_list(F.struct("place", "n")).alias("__ranges")))
    order = [F.desc_nulls_last(c) if descending else F.asc_nulls_first(c) for c in columns]
    inside = Window.partitionBy("__place").orderBy(*order)
    own = F.dense_rank().over(inside) if ranks else F.row_number().over(inside)
    before = F.aggregate(F.filter("__ranges", lambda e: e["place"] < F.col("__place")), F.lit(0).cast("bigint"),
                         lambda n, e: n + e["n"])
    return ranges.withColumn(name, own.cast("bigint") + before).drop("__place", "__ranges")


def with_row_number(df: DataFrame, columns: Sequence[str], name: str, descending: bool = False) -> DataFrame:
    """``df`` with ``name``: 1, 2, ... in the order of ``columns`` (nulls first; last if descending)."""
    return _numbered(df, columns, name, descending, False)


def with_dense_rank(df: DataFrame, columns: Sequence[str], name: str, descending: bool = False) -> DataFrame:
    """``df`` with ``name``: 1 and one more for each different value of ``columns`` before a row's."""
    return _numbered(df, columns, name, descending, True)
