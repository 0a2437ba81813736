"""Readers for the driver's parquet tables (one file or directory per table).

Readers are lazy: Catalyst prunes the columns a query does not touch and pushes
filters into the parquet scan (``PushedFilters`` / ``ReadSchema`` in explain).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

DEFAULT_SF_DIR = "/root/testdata/sf0.01"


def table_path(src: str, name: str) -> str:
    """Path of a table; ``src`` may be in any store that Spark reads."""
    return f"{src.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, src: str, name: str) -> DataFrame:
    """Lazy parquet reader; files are listed anew for every query, so a replaced source is
    seen at once."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(src, name))


class Tables:
    """Lazy accessor: ``Tables(spark, src).lineitem``."""

    def __init__(self, spark: SparkSession, src: str):
        self.spark, self.src = spark, src

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return read_table(self.spark, self.src, name)
        raise AttributeError(name)
