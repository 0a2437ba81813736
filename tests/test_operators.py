"""Operators on small frames: rank bands, top-N ties, peak ties, reconcile, guards, IO."""
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from spendframe.operators.calendar import rank_band
from spendframe.operators.joins import GuardError, guard_empty
from spendframe.operators.reconcile import field_diff, multiset_diff
from spendframe.operators.topn import top_n_with_ties
from spendframe.sources.raw import (TRANSACTIONS_SCHEMA, read_csv_typed, read_fact,
                                    read_json_map, read_label_map, write_fact_by_year)


def _bands(spark, values):
    df = spark.createDataFrame([(str(i), float(v)) for i, v in enumerate(values)], "k string, v double")
    out = rank_band(df.withColumn("pool", F.lit("p")), "v", ["pool"]).orderBy(
        F.col("k").cast("int")).collect()
    return [r["band"] for r in out]


def test_band_all_equal_and_single_live(spark):
    assert _bands(spark, [5.0, 5.0, 5.0]) == [1, 1, 1]
    assert _bands(spark, [0.0, 7.0, -1.0]) == [0, 5, 0]


def test_band_by_rank_integer_formula(spark):
    # live = 6 cells; below = 0..5 -> min(5, below*5 div 5 + 1)
    assert _bands(spark, [1, 2, 3, 4, 5, 6]) == [1, 2, 3, 4, 5, 5]
    # ties share the band of their rank
    assert _bands(spark, [1, 2, 2, 9]) == [1, 2, 2, 5]


def test_top_n_keeps_ties(spark):
    df = spark.createDataFrame([("a", 10.0), ("b", 9.0), ("c", 9.0), ("d", 1.0)], "k string, s double")
    got = sorted(r.k for r in top_n_with_ties(df, 2, "s").collect())
    assert got == ["a", "b", "c"]
    assert sorted(r.k for r in top_n_with_ties(df, 10, "s").collect()) == ["a", "b", "c", "d"]


def test_top_n_window_and_cutoff_paths_agree(spark):
    df = spark.createDataFrame([("a", 10.0), ("b", 9.0), ("c", 9.0), ("d", 1.0), ("e", None)],
                               "k string, s double")
    cases = [(2, False), (1, True), (2, True), (5, False), (10, False)]
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    old = spark.conf.get(key)
    got = {}
    try:
        for conf in ("1000", "-1"):      # window-group-limit plan, then the cutoff plan
            spark.conf.set(key, conf)
            got[conf] = ([sorted(r.k for r in top_n_with_ties(df, n, "s", asc).collect())
                          for n, asc in cases],
                         sorted((r.k, r.rk) for r in
                                top_n_with_ties(df, 2, "s", rank_col="rk").collect()))
    finally:
        spark.conf.set(key, old)
    assert got["1000"] == got["-1"]
    assert got["1000"][0][:3] == [["a", "b", "c"], ["d"], ["b", "c", "d"]]
    assert got["1000"][1] == [("a", 1), ("b", 2), ("c", 2)]


def test_peak_day_tie_takes_earliest(spark):
    df = spark.sql("SELECT date'2020-01-03' d, 5 v UNION ALL SELECT date'2020-01-01', 5 "
                   "UNION ALL SELECT date'2020-01-02', 4")
    r = df.agg(F.min_by("d", F.struct((-F.col("v")).alias("a"), F.col("d").alias("b")))).first()[0]
    assert str(r) == "2020-01-01"


def test_field_diff_one_sided_and_nan_fail(spark):
    exp = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "k string, x double")
    act = spark.createDataFrame([("a", 1.005), ("b", float("nan")), ("d", 4.0)], "k string, x double")
    d = {r.k: r.ok for r in field_diff(exp, act, ["k"], ["x"], {}).collect()}
    assert d == {"a": True, "b": False, "c": False, "d": False}


def test_multiset_diff(spark):
    a = spark.createDataFrame([(1.0,), (2.004,)], "v double")
    b = spark.createDataFrame([(2.0,), (1.0,)], "v double")
    assert multiset_diff(a, b).count() == 0
    c = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert multiset_diff(a, c).count() > 0


def test_guard_raises(spark):
    with pytest.raises(GuardError):
        guard_empty(spark.createDataFrame([(1,)], "x int"), "bad rows")
    guard_empty(spark.createDataFrame([], "x int"), "bad rows")


def test_csv_json_readers(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "tx.csv")
    with open(p, "w") as fh:
        fh.write("id,date,client_id,card_id,amount,use_chip,merchant_id,merchant_city,"
                 "merchant_state,zip,mcc,errors\n")
        fh.write("1,2010-01-01 00:01:00,7,9,$-77.00,Swipe Transaction,3,X,GA,30301.0,5411,\n")
    df = read_csv_typed(spark, p, TRANSACTIONS_SCHEMA, ["id", "amount", "merchant_state"])
    assert df.collect()[0].asDict() == {"id": 1, "amount": "$-77.00", "merchant_state": "GA"}
    j = os.path.join(tmpdir_fresh, "mcc.json")
    with open(j, "w") as fh:
        fh.write('{"5411": "Grocery Stores", "5812": "Restaurants"}\n')
    assert sorted(tuple(r) for r in read_json_map(spark, j).collect()) == [
        ("5411", "Grocery Stores"), ("5812", "Restaurants")]
    lab = os.path.join(tmpdir_fresh, "labels.json")
    with open(lab, "w") as fh:
        fh.write('{"target": {"1": "Yes", "2": "No"}}\n{"target": {"3": "No"}}\n')
    assert sorted(tuple(r) for r in read_label_map(spark, lab).collect()) == [
        ("1", "Yes"), ("2", "No"), ("3", "No")]


def test_year_partitioned_round_trip(spark, tmpdir_fresh):
    df = spark.sql("SELECT date'2018-03-01' AS date, 2018 AS year, 1L AS card_key, 1.5 AS amount "
                   "UNION ALL SELECT date'2019-01-02', 2019, 2L, 2.5")
    path = os.path.join(tmpdir_fresh, "fact")
    write_fact_by_year(df, path)
    assert {"year=2018", "year=2019"} <= set(os.listdir(path))
    only = read_fact(spark, path, [2019]).collect()
    assert [r.card_key for r in only] == [2]
    # reload one year alone: the other year survives (dynamic partition overwrite)
    write_fact_by_year(df.where("year = 2019").withColumn(
        "amount", F.lit(9.0).cast(df.schema["amount"].dataType)), path)
    rows = {r.year: r.amount for r in read_fact(spark, path).collect()}
    assert rows == {2018: 1.5, 2019: 9.0}


def test_salted_join_equals_plain_join(spark):
    from spendframe.operators.joins import salted_join
    fact = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 99), (3, 7)], "k int, v int")
    dim = spark.createDataFrame([(1, "hot"), (2, "two")], "k int, name string")
    a = sorted(tuple(r) for r in salted_join(fact, dim, "k", salts=4).select("k", "v", "name").collect())
    b = sorted(tuple(r) for r in fact.join(dim, "k", "left").select("k", "v", "name").collect())
    assert a == b
