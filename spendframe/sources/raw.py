"""Raw-source readers and star writers.

* ``read_csv_typed``: explicit-schema CSV reader (header promotion, FAILFAST) - the
  CSV scan of the transaction, client and card files; splits replace pandas chunks.
* ``read_json_map``: a ``{key: value}`` JSON object file -> (key, value) rows.
* ``read_label_map``: ``{"target": {id: "Yes"|"No"}}`` -> (id, label) rows.  Both split one
  object over many tasks (``json_object.py``).
* ``write_fact_by_year`` / ``read_fact``: the fact partitioned by year, sorted within
  partitions, dynamic partition overwrite so one year reloads alone; reading back
  prunes partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendframe.sources.json_object import read_entries

TRANSACTIONS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("date", T.StringType()),
    T.StructField("client_id", T.LongType()), T.StructField("card_id", T.LongType()),
    T.StructField("amount", T.StringType()), T.StructField("use_chip", T.StringType()),
    T.StructField("merchant_id", T.LongType()), T.StructField("merchant_city", T.StringType()),
    T.StructField("merchant_state", T.StringType()), T.StructField("zip", T.DoubleType()),
    T.StructField("mcc", T.LongType()), T.StructField("errors", T.StringType()),
])

LABEL_SCHEMA = T.StructType([T.StructField("target", T.MapType(T.StringType(), T.StringType()))])


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType,
                   columns: list[str] | None = None) -> DataFrame:
    """The header must name the schema's columns in order: ``enforceSchema=false`` makes a
    file with exchanged columns fail instead of loading them under the wrong names."""
    df = (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
          .option("enforceSchema", False).option("encoding", "UTF-8").csv(path))
    return df.select(*columns) if columns else df


def _not_empty(df: DataFrame, path: str) -> DataFrame:
    try:
        if not df.isEmpty():
            return df
    except Exception as e:
        raise ValueError(f"no entries could be read from {path}: {str(e)[:300]}") from e
    raise ValueError(f"no entry could be read from {path}")


def read_json_map(spark: SparkSession, path: str, value_type: str = "string") -> DataFrame:
    """A {code: text} JSON object, on one line or many, read by many tasks -> (key, value) rows.
    No entry is an error, and so is a broken one."""
    return _not_empty(read_entries(spark, path, (), value_type), path)


def explode_label_map(text_col) -> "F.Column":
    return F.explode(F.from_json(text_col, LABEL_SCHEMA).getField("target"))


def read_label_map(spark: SparkSession, path: str) -> DataFrame:
    """{"target": {id: "Yes"|"No"}}, on one line or many, read by many tasks -> (id, label) rows.
    No entry is an error, and so is a broken one."""
    return _not_empty(read_entries(spark, path, ("target",)).select(F.col("key").alias("id"), F.col("value").alias("label")), path)


def write_fact_by_year(fact: DataFrame, path: str, years_overwrite: bool = True) -> None:
    """S8 + S11: one directory per year, rows sorted by (date, card) inside each file.
    A range repartition on (date, card, row hash) spreads every year over many tasks (a
    year is never one task, however large); the row hash, a deterministic function of
    the row, splits even one hot (date, card) over several tasks and keeps retries
    reproducible.  Each task's rows are then sorted on (date, card), so the files are in
    (date, card) order.  Dynamic partition overwrite replaces only the years present.
    With ``years_overwrite=False`` the whole directory is replaced (a full import).  The
    mode is a per-write option, never a session-wide setting."""
    h = F.xxhash64(*[F.col(c) for c in fact.columns])
    (fact.repartitionByRange("date", "card_key", h).sortWithinPartitions("date", "card_key")
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic" if years_overwrite else "static")
     .partitionBy("year").parquet(path))


def read_fact(spark: SparkSession, path: str, years: list[int] | None = None) -> DataFrame:
    """The multi-file (all years) scan; a year filter prunes directories."""
    df = spark.read.option("basePath", path).parquet(f"{path}/year=*")
    return df.where(F.col("year").isin(*years)) if years else df


def write_csv(df: DataFrame, path: str, line_sep: str = "\n") -> None:
    """CSV sink with a header and a fixed line ending (one file per task)."""
    (df.write.mode("overwrite").option("header", True).option("lineSep", line_sep)
     .csv(path))
