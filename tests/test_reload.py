"""A reloaded year in the rollups, against a full build."""
import pytest
from pyspark.sql import functions as F

from spendframe.operators.joins import GuardError
from spendframe.plans import reload as R
from spendframe.plans.etl import transaction_files
from spendframe.plans.query import Model

from conftest import SF_SMALL


def state(star):
    return (sorted(tuple(r) for r in star.cards().collect()), sorted(tuple(r) for r in star.by_year().collect()),
            sorted(tuple(r) for r in star.daily().select("year", "date", "channel", *R.DAILY).collect()))


def test_reload_equals_a_full_build(spark, tmpdir_fresh, monkeypatch):
    cols = ["year", "date", "card_key", "channel", "ok", "amount"]
    fact = Model(spark, SF_SMALL).fact(set(cols)).select(*cols)
    year = 1996
    # fewer rows, other amounts, a card that goes (all of its rows are of that year) and one that comes
    rows = fact.where((F.col("year") == year) & (F.col("card_key") % 3 != 0)).withColumn(
        "amount", (F.col("amount") + 1).cast("decimal(12,2)")).union(
        spark.createDataFrame([(year, 77, "2-HIGH", True)], "y bigint, k bigint, c string, o boolean").select(
            "y", F.lit("1996-02-29").cast("date"), F.lit(10**9).cast(fact.schema["card_key"].dataType), "c", "o",
            F.lit(5).cast("decimal(12,2)")))
    kept, full = R.KeptStar(spark, f"{tmpdir_fresh}/a"), R.KeptStar(spark, f"{tmpdir_fresh}/b")
    kept.build(fact)
    kept.reload(year, rows)
    full.build(fact.where(F.col("year") != year).unionByName(rows))
    want = state(full)
    assert state(kept) == want
    kept.reload(year, rows)             # once more changes nothing
    assert state(kept) == want

    write = R.write_fact_by_year
    monkeypatch.setattr(R, "write_fact_by_year", lambda *a, **k: (write(*a, **k), 1 / 0))
    with pytest.raises(ZeroDivisionError):
        kept.reload(1997, fact.where("year = 1997 AND channel = '2-HIGH'"))
    with pytest.raises(GuardError, match="repair"):
        kept.cards()
    monkeypatch.setattr(R, "write_fact_by_year", write)
    kept.repair()
    full.reload(1997, fact.where("year = 1997 AND channel = '2-HIGH'"))
    assert state(kept) == state(full)


def test_csv_files_are_in_order(spark):
    path = transaction_files(spark, SF_SMALL)
    rows = spark.read.option("header", True).csv(path).select(F.col("_metadata.file_name").alias("f"), F.monotonically_increasing_id().alias("i"),
                                                              "date", F.col("card_id").cast("bigint").alias("c")).collect()
    by_file = {}
    for r in sorted(rows, key=lambda r: r.i):
        by_file.setdefault(r.f, []).append((r.date, r.c))
    assert all(v == sorted(v) for v in by_file.values()) and len(rows) > 5000
