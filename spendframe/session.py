"""Spark session defaults for the card-spend model.

Every setting here is a stock Spark option.  AQE re-plans joins at run time
(broadcast conversion, skew splitting, partition coalescing), which is what
keeps a hot card, client or category from landing in one task.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "spendframe", driver_memory: str = "16g") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.driver.memory", driver_memory)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus) * 2))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; only when it is unset
    (local tests) point it at a fresh scratch folder."""
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: a cluster needs a shared "
                               "checkpoint folder (a machine-local one does not survive an "
                               "executor loss)")
        path = tempfile.mkdtemp(prefix="spendframe-ckpt-")   # local mode only (tests)
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


# Scan bytes of the fact tables per shuffle partition of the fact join: a million lines or so, which
# keeps what one task sorts and counts to some hundred MB.
TARGET_PARTITION_BYTES = 16 * 1024 * 1024


def partitions_by_size(spark: SparkSession, src: str) -> int:
    """The scan size of the fact tables of ``src`` over TARGET_PARTITION_BYTES."""
    from spendframe.operators.joins import estimated_bytes
    from spendframe.sources.tables import Tables
    t = Tables(spark, src)
    size = sum(estimated_bytes(df) or 0 for df in (t.lineitem, t.orders))
    return -(-size // TARGET_PARTITION_BYTES)


def size_shuffles(spark: SparkSession, src: str) -> int:
    """Size ``spark.sql.shuffle.partitions`` for the fact join of ``src``: the fact tables'
    scan size over TARGET_PARTITION_BYTES, at least twice the cores, never lower than the
    current setting.  AQE can coalesce small partitions afterwards but cannot split a too
    large one (short of its skew handling), so the start count must fit the data.  Call
    once per job (it sets a session option); at sf0.1 it leaves the local default."""
    want = max(2 * spark.sparkContext.defaultParallelism, partitions_by_size(spark, src))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), want)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n
