"""A star kept with its rollups, of which one year can be loaded anew.

Beside the fact (a folder per year) stand two rollups.  The *daily* one has the additive parts per
day and channel, also a folder per year; a reload replaces that year's.  Measures that
reach across years (prior year, trailing 12 months) come from it, so a reloaded year shows in the
years after it too.  The *card* totals run over all years; a reload corrects them by the difference
of the year's new and old rows, and never reads the other years.

Totals are written to a folder per generation, so readers of the one before keep their files.  A
reload leaves its generation unnamed until fact and daily rollup are in place; one that
failed on the way is seen by that, readers of the rollups refuse, and ``repair`` makes both rollups
from the fact as it stands.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendframe.operators.joins import GuardError
from spendframe.operators.shared import kept
from spendframe.plans.binding import date_attributes
from spendframe.plans.measures import PARTS
from spendframe.sources.raw import read_fact, write_fact_by_year

DAILY = ["n", "n_ok", "spend"]
CARD = ["n", "spend"]


def _parts(df: DataFrame, keys: list[str], parts: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[PARTS[p].spark().alias(p) for p in parts])


class KeptStar:
    """The star under ``base``; its fact has year, date, card_key, channel, ok, amount at least."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _write_daily(self, fact: DataFrame, every_year: bool) -> None:
        _parts(fact, ["year", "date", "channel"], DAILY).write.mode("overwrite").option(
            "partitionOverwriteMode", "static" if every_year else "dynamic").partitionBy("year").parquet(f"{self.base}/daily")

    def _folders(self) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/cards")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _generation(self) -> int:
        """The last named generation of the card totals, 0 without one."""
        names = self._folders()
        if any(not n.isdigit() for n in names):
            raise GuardError(f"a reload of {self.base} did not end: repair() makes its rollups anew")
        return max(map(int, names), default=0)

    def build(self, fact: DataFrame) -> None:
        """Write everything."""
        write_fact_by_year(fact, f"{self.base}/fact", years_overwrite=False)
        self.repair()

    def repair(self) -> None:
        """Make both rollups from the fact."""
        fact = read_fact(self.spark, f"{self.base}/fact")
        self._write_daily(fact, True)
        done = [int(n) for n in self._folders() if n.isdigit()]
        n = max(done, default=0) + 1
        _parts(fact, ["card_key"], CARD).write.mode("overwrite").parquet(f"{self.base}/cards/{n}")
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in self._folders():
            if not name.isdigit():
                path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/cards/{name}")
                path.getFileSystem(conf).delete(path, True)

    def reload(self, year: int, rows: DataFrame) -> None:
        """Replace the rows of ``year`` by ``rows`` (all of that year); other years are not read."""
        old = _parts(read_fact(self.spark, f"{self.base}/fact", [year]), ["card_key"], CARD)
        new = _parts(rows, ["card_key"], CARD)
        change = old.select("card_key", *[(-F.col(p)).alias(p) for p in CARD]).unionByName(new)
        corrected = self.cards().unionByName(change).groupBy("card_key").agg(
            *[F.sum(p).cast(new.schema[p].dataType).alias(p) for p in CARD]).where("n > 0")
        n = self._generation() + 1
        corrected.write.mode("overwrite").parquet(f"{self.base}/cards/{n}.new")
        write_fact_by_year(rows, f"{self.base}/fact")
        self._write_daily(rows, False)
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        at = path(f"{self.base}/cards/{n}.new")
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).rename(at, path(f"{self.base}/cards/{n}"))

    def cards(self) -> DataFrame:
        """(card_key, n, spend) over all years."""
        return self.spark.read.parquet(f"{self.base}/cards/{self._generation()}")

    def daily(self) -> DataFrame:
        self._generation()
        return self.spark.read.parquet(f"{self.base}/daily")

    def by_year(self) -> DataFrame:
        """(year, spend, spend_py, spend_12m) from the daily rollup alone: the prior year over the
        visible days shifted by 12 months, and the 12 months up to each year's last day."""
        days = kept(self.daily().groupBy("date").agg(F.sum("spend").alias("v")), ["date", "v"])
        b = days.agg(F.min("date").alias("first"), F.max("date").alias("last"))
        spine = date_attributes(b.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date"), "last"))
        moved = F.inline(F.array(F.struct(F.col("date").alias("d"), F.lit(0).alias("moved")),
                                 F.struct(F.add_months("date", 12).alias("d"), F.lit(1).alias("moved"))))
        both = days.select("v", moved).join(F.broadcast(spine.select(F.col("date").alias("d"), "year")), "d")
        years = both.groupBy("year").agg(F.sum(F.when(F.col("moved") == 0, F.col("v"))).alias("spend"),
                                         F.sum(F.when(F.col("moved") == 1, F.col("v"))).alias("spend_py"))
        ends = spine.groupBy("year").agg(F.max("date").alias("end"))
        marks = ends.select("year", F.inline(F.array(
            F.struct(F.col("end").alias("date"), F.lit(1).alias("sign")), F.struct(F.add_months("end", -12).alias("date"), F.lit(-1).alias("sign")))))
        line = days.unionByName(marks, allowMissingColumns=True)          # a row a day, two a year
        run = F.coalesce(F.sum("v").over(Window.orderBy("date").rangeBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0))
        twelve = line.withColumn("run", run).where("sign IS NOT NULL").groupBy("year").agg(F.sum(F.col("sign") * F.col("run")).alias("spend_12m"))
        return years.join(twelve, "year").select("year", *[F.col(c).cast("double").alias(c) for c in ("spend", "spend_py", "spend_12m")])
