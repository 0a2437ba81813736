"""Join helpers for a star: fact many-to-one dimension, semi/anti joins, guards.

Broadcast policy.  A side is hinted for broadcast only when its size is bounded
by construction (a fixed lookup, a date spine, a global aggregate) or when the
optimizer's size estimate is under a limit.  Anything else is left to Catalyst
(sort-merge join) and AQE, which converts to broadcast at run time when the
shuffled side proves small and splits skewed partitions when one key is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# 64 MB: a dimension under this estimate is shipped to every executor.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan (the figure autoBroadcastJoinThreshold uses)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # pragma: no cover - plan stats unavailable (e.g. Connect)
        return None


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    size = estimated_bytes(df)
    return F.broadcast(df) if size is not None and size <= limit else df


# In-memory rows are wider than compressed parquet; the scan estimate is scaled by this.
EXPANSION = 4


def join_dim(fact: DataFrame, dim: DataFrame, on, how: str = "left",
             bounded: bool = False, size_proxy: DataFrame | None = None) -> DataFrame:
    """Many-to-one join of fact to a dimension whose key is unique.

    ``bounded=True`` marks a dimension whose row count does not grow with the data
    (fixed lookup rows, the date spine); it is always broadcast.  Others are
    broadcast only under the size check, else shuffled on the key (AQE may still
    switch to broadcast at run time).  ``size_proxy`` is the dimension's own base-table
    scan: Catalyst's estimate of a dimension that itself joins small lookups
    multiplies sizes and is useless, while a scan estimate is the file size.
    """
    if bounded:
        side = F.broadcast(dim)
    else:
        size = estimated_bytes(size_proxy if size_proxy is not None else dim)
        ok = size is not None and size * (EXPANSION if size_proxy is not None else 1) \
            <= BROADCAST_LIMIT_BYTES
        side = F.broadcast(dim) if ok else dim
    return fact.join(side, on=on, how=how)


def _key_set(keys: DataFrame, on) -> DataFrame:
    """The distinct keys of ``keys``.  A key set is often a fact column; the distinct runs
    a partial aggregate before its shuffle, so a key holding a third of all rows sends one
    row per task instead of landing whole in one task (AQE cannot split the build side of
    a semi/anti join).  Duplicates do not change EXISTS / NOT EXISTS."""
    if isinstance(on, str):
        on = [on]
    if isinstance(on, (list, tuple)) and all(isinstance(c, str) for c in on):
        return keys.select(*on).distinct()
    return keys


def semi(df: DataFrame, keys: DataFrame, on, bounded: bool = False) -> DataFrame:
    """EXISTS: rows of ``df`` whose key appears in ``keys``."""
    k = _key_set(keys, on)
    side = F.broadcast(k) if bounded else broadcast_if_small(k)
    return df.join(side, on=on, how="left_semi")


def anti(df: DataFrame, keys: DataFrame, on, bounded: bool = False) -> DataFrame:
    """NOT EXISTS: rows of ``df`` whose key is absent from ``keys``."""
    k = _key_set(keys, on)
    side = F.broadcast(k) if bounded else broadcast_if_small(k)
    return df.join(side, on=on, how="left_anti")


class GuardError(RuntimeError):
    """A data-quality guard found rows that must not exist."""


def guard_empty(df: DataFrame, what: str, sample: int = 5) -> DataFrame:
    """Abort when ``df`` has any row (unmapped code, silent sampled client).  Only a
    handful of offending keys are fetched for the message."""
    bad = df.take(sample)
    if bad:
        raise GuardError(f"{what}: {[tuple(r) for r in bad]}")
    return df


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a global aggregate (exactly one row) to every row of ``df``
    as uncorrelated scalar subqueries.  Catalyst merges sibling subqueries over the same
    plan into one (MergeScalarSubqueries), runs it once and reads the values as
    constants: no join, no cartesian product, nothing sized by ``df``."""
    return df.select("*", *[one_row.select(one_row[c]).scalar().alias(c)
                            for c in one_row.columns])


def salted_join(fact: DataFrame, dim: DataFrame, key: str, salts: int = 16,
                how: str = "left") -> DataFrame:
    """Fact many-to-one a dimension too large to broadcast, when one key may hold a
    large share of the fact: each fact row gets a salt in [0, salts) derived from its
    own columns (deterministic, so a retried task re-creates the same rows), the
    dimension is replicated once per salt, and the join runs on (key, salt).  A hot key
    is spread over ``salts`` tasks instead of one.  The dimension grows by ``salts``, so
    use it only for dimensions much smaller than the fact (AQE's skew-join splitting is
    the default alternative)."""
    f = fact.withColumn("__salt", F.pmod(F.xxhash64(*fact.columns), F.lit(salts)))
    d = dim.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"),
                                                      F.lit(salts - 1).cast("long"))))
    return f.join(d, on=[key, "__salt"], how=how).drop("__salt")
