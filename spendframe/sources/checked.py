"""Typed CSV reading with a channel for what does not fit.

``read_checked`` gives every record of the files once: typed, or as its text with the reason why it is
rejected (a field that is not of its type, too few or too many fields, a required field that
is missing, or a rule that it breaks).  ``accounted`` compares what was read with the lines of the
files, so that nothing is lost in between.  A file whose header names other columns, or the
same ones in another order, fails as a whole."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendframe.operators.joins import GuardError
from spendframe.operators.shared import kept

RECORD = "_record"
REASON = "_reason"


def read_checked(spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str] = (),
                 rules: Mapping[str, Column] | None = None) -> DataFrame:
    """The columns of ``schema``, with _record (the text of a rejected record) and _reason (null:
    good).  ``rules``: reason -> a condition that good records meet."""
    whole = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
    df = (spark.read.schema(whole).option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
          .option("columnNameOfCorruptRecord", RECORD).option("encoding", "UTF-8").csv(path))
    df = kept(df, whole.names)          # a reader of few columns would find other records broken
    reason = F.when(F.col(RECORD).isNotNull(), F.lit("not of the schema"))
    for c in required:
        reason = reason.when(F.col(c).isNull(), F.lit(f"no {c}"))
    for what, good in (rules or {}).items():
        reason = reason.when(~F.coalesce(good, F.lit(True)), F.lit(what))
    text = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in schema.names])
    out = df.withColumn(REASON, reason)
    return out.withColumn(RECORD, F.when(F.col(REASON).isNotNull(), F.coalesce(RECORD, text)))


def good(df: DataFrame) -> DataFrame:
    """The records that fit."""
    return df.where(F.col(REASON).isNull()).drop(RECORD, REASON)


def rejected(df: DataFrame, source: str) -> DataFrame:
    """(source, reason, record) of the others."""
    return df.where(F.col(REASON).isNotNull()).select(
        F.lit(source).alias("source"), F.col(REASON).alias("reason"), F.col(RECORD).alias("record"))


def accounted(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    """One row (lines, good, rejected): the lines of the files but their headers and blank ones, and
    the records read from them (a record has no line breaks inside)."""
    text = spark.read.text(path).where(F.trim("value") != "")
    lines = text.groupBy(F.col("_metadata.file_path").alias("file")).agg((F.count(F.lit(1)) - 1).alias("n"))
    read = df.agg(F.count_if(F.col(REASON).isNull()).alias("good"), F.count_if(F.col(REASON).isNotNull()).alias("rejected"))
    total = lines.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("lines"))
    return total.select("lines", *[read.select(c).scalar().alias(c) for c in ("good", "rejected")])


def check_accounted(spark: SparkSession, path: str, df: DataFrame) -> dict:
    """The row of ``accounted``; an error if it does not add up."""
    r = accounted(spark, path, df).first()
    if r.lines != r.good + r.rejected:
        raise GuardError(f"{path}: {r.lines} lines, but {r.good} good and {r.rejected} rejected records")
    return r.asDict()
