"""Distinct counts at several grains without expanding the input for each of them.

``countDistinct`` of several columns, or at several grouping sets, is planned as an Expand: every
input row is repeated for each column and each set, with all group columns beside it.  Here one
*pair rollup* is shared instead: a row goes once to each distinct key (a lane), is
combined with the others of its (cell, lane, key) before the shuffle, and carries the additive
values in the first lane.  Everything after works on pairs: a grain is the pairs without the columns
that it does not keep, and pair rollups of parts of the data merge by adding them up.

``sketch_rollup`` is the form for estimates: one HyperLogLog sketch per cell and key in a
single pass, of fixed size; sketches merge, so all grains come from the cells.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendframe.operators.shared import kept

#: How the values of a row are combined, and then the combined ones of several pairs.
FIRST = {"count": F.count, "sum": F.sum, "max": F.max, "min": F.min}
AGAIN = {"count": F.sum, "sum": F.sum, "max": F.max, "min": F.min}
#: The lane of the additive values.
VALUES = -1
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _key_type(df: DataFrame, keys: Mapping[str, Column]) -> str:
    """One type for the keys of all lanes: whole numbers as bigint, anything else as text."""
    kinds = [f.dataType for f in df.select(*[c.alias(k) for k, c in keys.items()]).schema]
    return "bigint" if all(isinstance(k, INTEGRAL) for k in kinds) else "string"


def pair_rollup(df: DataFrame, cell: Sequence[str], keys: Mapping[str, Column],
                values: Mapping[str, tuple[Column, str]] | None = None) -> DataFrame:
    """(cell..., lane, key, values...): one row per distinct key of each lane in each cell.

    ``keys``: name -> column, counted apart (a null is no key); ``values``: name -> (column,
    "count" | "sum" | "max" | "min"), whose combined values stand in lane VALUES, without a key.
    With values, pairs without a key are left out (the group has its row of values)."""
    values = dict(values or {})
    kind = _key_type(df, keys)
    types = dict(df.select(*[c.alias(n) for n, (c, _) in values.items()]).dtypes) if values else {}
    none = [F.lit(None).cast(t).alias(n) for n, t in types.items()]
    lanes = [F.struct(F.lit(i).alias("lane"), c.cast(kind).alias("key"), *none) for i, c in enumerate(keys.values())]
    if values:
        lanes.append(F.struct(F.lit(VALUES).alias("lane"), F.lit(None).cast(kind).alias("key"),
                              *[col.alias(n) for n, (col, _) in values.items()]))
    rows = df.select(*cell, F.inline(F.array(*lanes)))
    if values:
        rows = rows.where((F.col("lane") == VALUES) | F.col("key").isNotNull())
    rolled = rows.groupBy(*cell, "lane", "key")
    return rolled.agg(*[FIRST[how](n).alias(n) for n, (_, how) in values.items()]) if values else rows.distinct()


def merged(rollup: DataFrame, cell: Sequence[str], values: Mapping[str, str]) -> DataFrame:
    """A pair rollup at a coarser cell (or of several rollups put together)."""
    kept = rollup.select(*cell, "lane", "key", *values)
    if not values:
        return kept.distinct()
    return kept.groupBy(*cell, "lane", "key").agg(*[AGAIN[how](n).alias(n) for n, how in values.items()])


def counted(rollup: DataFrame, cell: Sequence[str], keys: Sequence[str], values: Mapping[str, str]) -> DataFrame:
    """(cell..., a count per key, values...) of a pair rollup at ``cell``."""
    counts = [F.count_if((F.col("lane") == i) & F.col("key").isNotNull()).alias(k) for i, k in enumerate(keys)]
    totals = [AGAIN[how](n).alias(n) for n, how in values.items()]
    return rollup.groupBy(*cell).agg(*counts, *totals)


def by_grains(rollup: DataFrame, grains: Sequence[tuple[str, str]], keys: Sequence[str],
              values: Mapping[str, str]) -> DataFrame:
    """(grain, key, a count per key, values...) for each (grain name, cell column): the pairs, not
    the input rows, are repeated for the grains, after all pairs of a key (one per cell at most) are
    brought together, so that they are combined for each grain where they are."""
    at = F.inline(F.array(*[F.struct(F.lit(g).alias("grain"), F.col(c).cast("string").alias("grain_key"))
                            for g, c in grains]))
    together = rollup.repartition("lane", "key")
    pairs = together.select(at, "lane", "key", *values)
    return counted(merged(pairs, ["grain", "grain_key"], values), ["grain", "grain_key"], keys, values)


def coded_by_grains(df: DataFrame, grains: Sequence[tuple[str, str]], keys: Mapping[str, Column],
                    values: Mapping[str, tuple[Column, str]]) -> DataFrame:
    """`by_grains` of a `pair_rollup` of ``df`` by the grains' columns, for cells of several columns:
    a pair travels with a 64-bit code of its cell, and the cells (one row each, with their values)
    are joined back where all pairs of a key are.  Cells are few beside pairs; they are broadcast."""
    cell, names = [c for _, c in grains], list(keys)
    how = {n: h for n, (_, h) in values.items()}
    kind = _key_type(df, keys)
    types = dict(df.select(*cell, *[c.alias(n) for n, (c, _) in values.items()]).dtypes)
    code = F.xxhash64(*[x for c in cell for x in (F.col(c), F.col(c).isNull())])
    none = lambda cols: [F.lit(None).cast(types[c]).alias(c) for c in cols]
    lanes = [F.struct(F.lit(i).alias("lane"), c.cast(kind).alias("key"), *none([*cell, *values])) for i, c in enumerate(keys.values())]
    lanes.append(F.struct(F.lit(VALUES).alias("lane"), F.lit(None).cast(kind).alias("key"), *cell,
                          *[c.alias(n) for n, (c, _) in values.items()]))
    rows = df.select(code.alias("code"), F.inline(F.array(*lanes))).where((F.col("lane") == VALUES) | F.col("key").isNotNull())
    rolled = rows.groupBy("code", "lane", "key", *cell).agg(*[FIRST[h](n).alias(n) for n, h in how.items()])
    rolled = kept(rolled, rolled.columns, apart=True)
    at = F.inline(F.array(*[F.struct(F.lit(g).alias("grain"), F.col(c).cast("string").alias("grain_key")) for g, c in grains]))
    cells = rolled.where(F.col("lane") == VALUES).select("code", *cell, *values)
    totals = cells.select(at, *values).groupBy("grain", "grain_key").agg(*[AGAIN[h](n).alias(n) for n, h in how.items()])
    together = rolled.where(F.col("lane") != VALUES).select("lane", "key", "code").repartition("lane", "key")
    pairs = together.join(F.broadcast(cells.select("code", *cell)), "code").select(at, "lane", "key").distinct()
    counts = pairs.groupBy("grain", "grain_key").agg(*[F.count_if(F.col("lane") == i).alias(k) for i, k in enumerate(names)])
    both = counts.select("grain", "grain_key", *names, *none(values)).unionByName(
        totals.select("grain", "grain_key", *[F.lit(0).cast("bigint").alias(k) for k in names], *values))
    return both.groupBy("grain", "grain_key").agg(*[F.sum(k).alias(k) for k in names], *[AGAIN[h](n).alias(n) for n, h in how.items()])


def lg_k(relative_error: float) -> int:
    """The size of a sketch (log2 of its registers) whose standard error is ``relative_error``."""
    return min(21, max(4, math.ceil(math.log2((1.04 / relative_error) ** 2))))


def sketch_rollup(df: DataFrame, cell: Sequence[str], keys: Mapping[str, Column],
                  values: Mapping[str, tuple[Column, str]], relative_error: float) -> DataFrame:
    """(cell..., a sketch per key, values...) in one pass."""
    size = lg_k(relative_error)
    kind = _key_type(df, keys)
    return df.groupBy(*cell).agg(*[F.hll_sketch_agg(c.cast(kind), F.lit(size)).alias(k) for k, c in keys.items()],
                                 *[FIRST[how](c).alias(n) for n, (c, how) in values.items()])


def estimated(rollup: DataFrame, cell: Sequence[str], keys: Sequence[str], values: Mapping[str, str]) -> DataFrame:
    """(cell..., an estimate per key, values...) of a sketch rollup at a coarser cell."""
    return rollup.groupBy(*cell).agg(
        *[F.hll_sketch_estimate(F.hll_union_agg(k)).alias(k) for k in keys],
        *[AGAIN[how](n).alias(n) for n, how in values.items()])


def estimated_by_grains(rollup: DataFrame, grains: Sequence[tuple[str, str]], keys: Sequence[str],
                        values: Mapping[str, str]) -> DataFrame:
    """`by_grains` from a sketch rollup."""
    at = F.inline(F.array(*[F.struct(F.lit(g).alias("grain"), F.col(c).cast("string").alias("grain_key"))
                            for g, c in grains]))
    return estimated(rollup.select(at, *keys, *values), ["grain", "grain_key"], keys, values)
