"""Helpers shared by the training-data operators: table reads, shared-folder tables that
cut lineage, partition counts, and connected components."""

from __future__ import annotations

import gc
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendframe.session import ensure_checkpoint_dir

#: Separators of words: space and the ASCII controls tab to carriage return.
SEPARATORS = " \t\n\x0b\x0c\r"
SPLIT_WORDS = r"[\x20\x09-\x0D]+"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_ROWS = 1000
#: Bits of the bitmap in `let_through`.
FILTER_BITS = 1 << 20


def bound_batches(spark: SparkSession) -> None:
    """Rows hold whole texts, so Arrow batches of Python tasks get BATCH_ROWS rows at most."""
    if int(spark.conf.get(ARROW_ROWS, "10000")) > BATCH_ROWS:
        spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))


def read_table(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """One table of ``sf_dir``, reduced to ``columns`` in the scan (all when none given)."""
    bound_batches(spark)
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df.select(*columns) if columns else df


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder of the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/spendframe-{name}-{uuid.uuid4().hex}"


@contextmanager
def own_shuffles_only(spark: SparkSession):
    """Spark deletes the shuffle files of each query begun inside as soon as it ends; the
    session's setting comes back behind it."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, the rows survive
    a lost executor, and every later reader sees the same rows.  Nobody reads the write's
    shuffle files again, so they go with it and the disk holds those of one query at a time."""
    spark = df.sparkSession
    bound_batches(spark)
    path = shared_path(spark, name)
    with own_shuffles_only(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._shared_path = path
    return out


def release(*tables: DataFrame | None) -> None:
    """Delete the shared tables behind ``materialize`` results that nothing reads any more.
    Broadcasts, and shuffle files of plans run elsewhere, go with their plans: Spark deletes them once
    the driver has collected its garbage, which a job of many short stages rarely does by itself."""
    held = [df for df in tables if getattr(df, "_shared_path", None) is not None]
    for df in held:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(df._shared_path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    if held:
        gc.collect()
        held[0].sparkSession._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as keep it from any column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def split_words(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: the words (runs of other characters than SEPARATORS) of ``text`` as an
    array, empty for a null or wordless text."""
    trimmed = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(SEPARATORS))
    words = F.when(F.col("_trimmed") == "", F.array().cast("array<string>")).otherwise(
        F.split("_trimmed", SPLIT_WORDS))
    return df.withColumn("_trimmed", trimmed).withColumn(out, words).drop("_trimmed")


def let_through(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """``df`` without most rows whose ``key`` (a 64-bit hash) is not in ``wanted``, before
    anything is shuffled.  The keys' places in a bitmap of FILTER_BITS bits (a fixed size) are
    one scalar value; rows that share a place with a wanted key stay, so a join must follow."""
    words = FILTER_BITS // 64
    place = F.col(key).bitwiseAND(F.lit(FILTER_BITS - 1))
    word, bit = F.shiftrightunsigned(place, 6).cast("int"), place.bitwiseAND(F.lit(63)).cast("int")
    used = wanted.groupBy(word.alias("word")).agg(F.bit_or(F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), bit)).alias("bits"))
    every = df.sparkSession.range(words).select(F.col("id").cast("int").alias("word")).join(used, "word", "left")
    bitmap = every.agg(F.transform(F.sort_array(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast(
        "bigint")).alias("bits")))), lambda x: x["bits"]).alias("bitmap"))
    bitmap = materialize(bitmap.coalesce(1), "filter")
    return df.where(F.getbit(F.get(bitmap.scalar(), word), bit) == 1)


def components(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)`` as (node, root), root the smallest node.

    Distributed union-find by alternating star contraction: the large star points every
    larger neighbour of a node to the smallest node around it, the small star points the
    smaller ones.  Each round is two aggregations and two joins on node ids and is written
    to the shared folder; only two counters reach the driver.  Nodes without an edge do not
    appear.  Null ends and self loops are ignored; with no edge the result is empty."""
    pairs = (edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
             .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    current = materialize(pairs, f"{name}-cc")
    before = None
    for _ in range(max_rounds):
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.where(F.col("b") > F.col("a")).join(low, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct())
        # small star: every edge points from the larger to the smaller node
        small_low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(small_low, "a")
        small = (joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(small_low.select("a", F.col("m").alias("b"))).where("a != b").distinct())
        following = materialize(small, f"{name}-cc")
        state = following.agg(F.count("*").alias("n"),
                              F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        release(current)
        current = following
        if before == (state.n, state.s):
            break
        before = (state.n, state.s)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    out = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = out.union(current.select("b", "b").distinct())
    out._shared_path = current._shared_path
    return out
