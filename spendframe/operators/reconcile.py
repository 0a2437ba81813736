"""Result-set comparison operators (X4-X9, W17), all distributed.

* ``field_diff``: full outer join of two keyed result sets, every field unpivoted
  (``stack``) and compared with a per-field tolerance; a value missing on one side
  (null/NaN) is a mismatch, never a silent pass.
* ``multiset_diffs``: do two results hold the same numbers (2 dp, within a tolerance)?
  Buckets of values are compared by fingerprints, unequal ones by running differences.
* ``widen``: long (query, column, value) -> wide rows, positional per column.
* ``column_profile``: distinct values, blanks, bytes and heavy hitters per column from one
  ledger of values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendframe.functions.constants import TOL_MULTISET
from spendframe.operators.shared import kept

#: Values per bucket of ``multiset_diff``, in hundredths.
BUCKET_CENTS = 1_000_000

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)


def field_diff(expected: DataFrame, actual: DataFrame, keys: list[str], fields: list[str],
               tolerance: dict[str, float], default_tol: float = 0.011,
               blank_as_zero: bool = True) -> DataFrame:
    """One row per (keys, field) with expected, actual, |diff| and an ``ok`` flag;
    ``_presence`` says both / expected_only / actual_only."""
    e = expected.select(*keys, *[F.col(f).alias(f"e_{f}") for f in fields], F.lit(True).alias("_e"))
    a = actual.select(*[F.col(k).alias(f"_a_{k}") for k in keys],
                      *[F.col(f).alias(f"a_{f}") for f in fields], F.lit(True).alias("_a"))
    cond = [e[k].eqNullSafe(a[f"_a_{k}"]) for k in keys]
    j = e.join(a, cond, "full")
    j = j.select(*[F.coalesce(F.col(k), F.col(f"_a_{k}")).alias(k) for k in keys],
                 *[f"e_{f}" for f in fields], *[f"a_{f}" for f in fields],
                 F.when(F.col("_e") & F.col("_a"), "both").when(F.col("_e"), "expected_only")
                  .otherwise("actual_only").alias("_presence"))
    # both sides unpivoted together: keys are compared once, null keys included
    expr = "stack({}, {}) as (field, e_v, a_v)".format(len(fields), ", ".join(
        f"'{f}', CAST(`e_{f}` AS DOUBLE), CAST(`a_{f}` AS DOUBLE)" for f in fields))
    both = j.selectExpr(*[f"`{k}`" for k in keys], "_presence", expr)
    tol = F.lit(default_tol)
    for f, t in tolerance.items():
        tol = F.when(F.col("field") == f, F.lit(t)).otherwise(tol)
    av_ = F.coalesce(F.col("a_v"), F.lit(0.0)) if blank_as_zero else F.col("a_v")
    diff = F.abs(F.col("e_v") - av_)
    ok = (F.col("_presence") == "both") & diff.isNotNull() & ~F.isnan(diff) & (diff <= tol)
    return both.select(*keys, "field", "_presence", F.col("e_v").alias("expected"),
                       F.col("a_v").alias("actual"), diff.alias("diff"), ok.alias("ok"))


def melt_numbers(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The numeric values of a result (all numeric columns, or ``columns``), as
    (column, value double)."""
    cols = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, value double")
    expr = "stack({}, {}) as (column, value)".format(
        len(cols), ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols))
    return df.selectExpr(expr)


def multiset_diffs(pairs: dict[str, tuple], tolerance: float = TOL_MULTISET) -> DataFrame:
    """Do two results hold the same numbers?  For each name -> (a, b, columns of a, columns of b),
    both are rounded to 2 dp, sorted and paired; every pair may differ by ``tolerance``.  Rows:
    (name, v, ahead) where one side is ahead of the other by more than the tolerance allows; a
    name without rows matches.

    Pairs agree when, for every v, one side has no more values up to v than the other has up to
    v + tolerance.  First, each side of each BUCKET of values is reduced to a count and a
    fingerprint that does not depend on order (two exclusive ors of hashes of a value and its
    count).  A bucket that is equal on both sides, and before which both have as many values, holds
    for itself and changes nothing elsewhere; only the others (and those after an unequal one,
    into which the tolerance reaches) are compared value by value."""
    cents = F.round(F.col("value") * 100).cast("bigint")
    every = None
    for name, (a, b, a_cols, b_cols) in pairs.items():
        for side, df, cols in (("a", a, a_cols), ("b", b, b_cols)):
            part = melt_numbers(df, cols).select(F.lit(name).alias("name"), F.lit(side).alias("side"), "value")
            every = part if every is None else every.unionByName(part)
    counts = every.where(F.col("value").isNotNull() & ~F.isnan("value")).groupBy("name", "side", cents.alias("v")).agg(
        F.count(F.lit(1)).alias("n"))
    counts = kept(counts, ["name", "side", "v", "n"]).withColumn("bucket", F.floor(F.col("v") / BUCKET_CENTS))

    def of(side, value):
        return F.when(F.col("side") == side, value)

    prints = [F.xxhash64("v", "n"), F.xxhash64("n", F.lit(1), "v")]
    buckets = counts.groupBy("name", "bucket").agg(
        *[F.coalesce(F.sum(of(s, F.col("n"))), F.lit(0)).alias(f"n_{s}") for s in "ab"],
        *[F.bit_xor(of(s, p)).alias(f"p{i}_{s}") for s in "ab" for i, p in enumerate(prints)])
    along = Window.partitionBy("name").orderBy("bucket")
    unequal = ~((F.col("n_a") == F.col("n_b")) & F.col("p0_a").eqNullSafe(F.col("p0_b")) & F.col("p1_a").eqNullSafe(F.col("p1_b")))
    ahead_before = F.sum(F.col("n_a") - F.col("n_b")).over(along) - (F.col("n_a") - F.col("n_b"))
    opened = buckets.select("name", "bucket", (unequal | (ahead_before != 0) | F.coalesce(
        F.lag(unequal).over(along), F.lit(False))).alias("open")).where("open").drop("open")

    left = counts.join(opened, ["name", "bucket"], "left_semi").select("name", "side", "v", "n")
    step = int(round(tolerance * 100))
    # two tests: each side against the other moved down by the tolerance
    both = left.select("name", "v", F.inline(F.array(
        F.struct(F.col("side").alias("test"), F.lit(0).alias("moved"), F.col("n")),
        F.struct(F.when(F.col("side") == "a", "b").otherwise("a").alias("test"), F.lit(step).alias("moved"), (-F.col("n")).alias("n")))))
    events = both.groupBy("name", "test", (F.col("v") - F.col("moved")).alias("v")).agg(F.sum("n").alias("n")).withColumn(
        "bucket", F.floor(F.col("v") / BUCKET_CENTS))
    totals = events.groupBy("name", "test", "bucket").agg(F.sum("n").alias("total")).withColumn(
        "before", F.sum("total").over(Window.partitionBy("name", "test").orderBy("bucket")) - F.col("total"))
    inside = F.sum("n").over(Window.partitionBy("name", "test", "bucket").orderBy("v"))
    ahead = events.withColumn("inside", inside).join(totals, ["name", "test", "bucket"]).select(
        "name", (F.col("v") / 100).alias("v"), (F.col("before") + F.col("inside")).alias("ahead"))
    return ahead.where("ahead > 0").groupBy("name", "v").agg(F.max("ahead").alias("ahead"))


def multiset_diff(a: DataFrame, b: DataFrame, a_cols: list[str] | None = None,
                  b_cols: list[str] | None = None, tolerance: float = TOL_MULTISET) -> DataFrame:
    """`multiset_diffs` of one pair: rows (v, ahead)."""
    return multiset_diffs({"": (a, b, a_cols, b_cols)}, tolerance).drop("name")


def widen(long_df: DataFrame, column: str = "column", value: str = "value",
          order: str = "ord", columns: list[str] | None = None) -> DataFrame:
    """A positional row number per column, then one wide row per position.  With
    ``columns`` given the pivot needs no extra job to find them."""
    w = Window.partitionBy(column).orderBy(order)
    numbered = long_df.withColumn("i", F.row_number().over(w))
    return numbered.groupBy("i").pivot(column, columns).agg(F.first(value))


def value_ledger(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value, n): how often each column has each value, as text, in one pass.  A task
    counts its own values first, so a frequent one is a row per task."""
    lanes = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.inline(lanes)).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def column_profile(df: DataFrame, columns: list[str] | None = None, top: int | None = None) -> DataFrame:
    """X8 re-aimed: what each column costs - distinct values, blanks (null or ''), text bytes, bytes
    per row, share of all bytes, its most frequent value and how often that occurs - ranked
    by bytes, the ``top`` dearest if given."""
    cols = columns or df.columns
    blank = F.col("value").isNull() | (F.col("value") == "")
    held = value_ledger(df, cols).groupBy("column_name").agg(
        F.count("value").alias("distinct_count"), F.coalesce(F.sum(F.when(blank, F.col("n"))), F.lit(0)).alias("blanks"),
        F.coalesce(F.sum(F.length("value") * F.col("n")), F.lit(0)).alias("bytes"), F.sum("n").alias("_rows"),
        F.min(F.when(~blank, F.struct((-F.col("n")).alias("n"), "value"))).alias("_top"))
    every = Window.partitionBy(F.lit(1))                # a row per column
    dearest = Window.partitionBy(F.lit(1)).orderBy(F.desc("bytes"), "column_name")
    ranked = held.select(
        "column_name", "distinct_count", "blanks", "bytes", (F.col("bytes") / F.col("_rows")).alias("avg_bytes"),
        (F.col("bytes") / F.sum("bytes").over(every)).alias("share"), F.col("_top.value").alias("top_value"),
        (-F.col("_top.n")).alias("top_count"), F.row_number().over(dearest).alias("rank"))
    return ranked.where(F.col("rank") <= top) if top else ranked


def bench_compare(star: DataFrame, naive: DataFrame, noise_floor_ms: float) -> DataFrame:
    """Two timing tables (query, cold_ms, warm_ms) joined; deltas and whether the
    cold difference clears the harness noise floor."""
    s = star.select("query", F.col("cold_ms").alias("cold_star"), F.col("warm_ms").alias("warm_star"))
    n = naive.select("query", F.col("cold_ms").alias("cold_naive"),
                     F.col("warm_ms").alias("warm_naive"))
    j = s.join(n, "query")
    return j.select("*", F.round(F.col("cold_naive") - F.col("cold_star"), 1).alias("cold_delta_ms"),
                    F.round(F.col("warm_naive") - F.col("warm_star"), 1).alias("warm_delta_ms"),
                    (F.abs(F.col("cold_naive") - F.col("cold_star")) >= noise_floor_ms)
                    .alias("cold_separable"))
