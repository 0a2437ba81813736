"""Sets of whole-number keys as bitmaps, and seeded samples of keys.

A key set is (bucket, bits): a bitmap of fixed size for each range of 32,768 keys.  Sets are built
from distinct keys by aggregation, merge, and are combined bucket by bucket, so a join of
two key sets moves a few kilobytes per range instead of a row per key, and counts of unions,
intersections and differences are bit counts.

``bottom_k`` draws k keys without replacement: those whose seeded hash is least.  A task needs
its own k least only, so samples of parts of the data merge into the sample of all of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_set(df: DataFrame, key: str) -> DataFrame:
    """(bucket, bits) of the distinct values of ``key``; a null bucket holds what is no key."""
    keys = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return keys.groupBy(F.bitmap_bucket_number(F.col(key)).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col(key))).alias("bits"))


def merged(*sets: DataFrame) -> DataFrame:
    """The union of key sets."""
    every = sets[0]
    for s in sets[1:]:
        every = every.unionByName(s)
    return every.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def compared(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row (n_a, n_b, n_both): the sizes of two key sets and of their intersection."""
    both = a.select("bucket", "bits", F.lit(1).alias("side")).unionByName(b.select("bucket", "bits", F.lit(2).alias("side")))
    held = both.groupBy("bucket").agg(
        F.sum(F.when(F.col("side") == 1, F.bitmap_count("bits"))).alias("a"),
        F.sum(F.when(F.col("side") == 2, F.bitmap_count("bits"))).alias("b"),
        F.bitmap_count(F.bitmap_and_agg("bits")).alias("both"), F.count(F.lit(1)).alias("sides"))
    real = F.col("bucket").isNotNull()
    total = lambda c: F.coalesce(F.sum(F.when(c[0], F.col(c[1]))), F.lit(0)).cast("bigint")
    return held.agg(total((real, "a")).alias("n_a"), total((real, "b")).alias("n_b"),
                    total((real & (F.col("sides") == 2), "both")).alias("n_both"))


def bottom_k(df: DataFrame, key: str, k: int, seed: int) -> DataFrame:
    """The ``k`` values of ``key`` whose hash with ``seed`` is least (all, if fewer); a null is none."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    keys = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).select(key, h.alias("_h"))
    return keys.orderBy(F.asc_nulls_last("_h")).limit(k).where(F.col("_h").isNotNull()).select(key)
