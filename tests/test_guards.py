"""Inputs that once gave wrong or missing rows without an error."""
import json
import shutil

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from spendframe.functions.scalar import money
from spendframe.operators.reconcile import field_diff, multiset_diff
from spendframe.operators.topn import top_n_with_ties
from spendframe.plans.binding import refresh, release
from spendframe.plans.calendar import Calendar
from spendframe.plans.query import Model
from spendframe.plans.reconcile import diverging
from spendframe.sources.raw import read_csv_typed, read_json_map, read_label_map

from conftest import SF_SMALL


def test_money_that_is_no_amount_fails(spark):
    df = spark.createDataFrame([("$1.50",), ("$-77.00",), (None,)], "t string")
    assert [str(r.m) for r in df.select(money("t").alias("m")).collect()] == ["1.50", "-77.00", "None"]
    for bad in ("$1,234.50", "$abc"):
        with pytest.raises(Exception, match="not an amount"):
            spark.createDataFrame([(bad,)], "t string").select(money("t")).collect()


@pytest.mark.parametrize("indent", [None, 2])
def test_json_files_in_common_forms(spark, tmpdir_fresh, indent):
    codes = {"5411": "Grocery Stores", "4829": "Money \"Transfer\": fast", "1711": "Heating, Air"}
    with open(f"{tmpdir_fresh}/codes.json", "w") as f:
        json.dump(codes, f, indent=indent)
    assert {r.key: r.value for r in read_json_map(spark, f"{tmpdir_fresh}/codes.json").collect()} == codes
    with open(f"{tmpdir_fresh}/labels.json", "w") as f:
        json.dump({"target": {"10": "Yes", "11": "No"}}, f, indent=indent)
    assert {r.id: r.label for r in read_label_map(spark, f"{tmpdir_fresh}/labels.json").collect()} == {
        "10": "Yes", "11": "No"}


def test_json_without_entries_fails(spark, tmpdir_fresh):
    with open(f"{tmpdir_fresh}/x.json", "w") as f:
        f.write("[1, 2]\n")
    for read in (read_json_map, read_label_map):
        with pytest.raises(ValueError):
            read(spark, f"{tmpdir_fresh}/x.json")


def test_csv_with_exchanged_columns_fails(spark, tmpdir_fresh):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("client_id", T.LongType()), T.StructField("card_id", T.LongType())])
    with open(f"{tmpdir_fresh}/good.csv", "w") as f:
        f.write("client_id,card_id\n1,2\n")
    with open(f"{tmpdir_fresh}/bad.csv", "w") as f:
        f.write("card_id,client_id\n2,1\n")
    assert read_csv_typed(spark, f"{tmpdir_fresh}/good.csv", schema).collect() == [(1, 2)]
    with pytest.raises(Exception):
        read_csv_typed(spark, f"{tmpdir_fresh}/bad.csv", schema).collect()


def test_field_diff_keeps_null_keys_and_one_sided_rows(spark):
    e = spark.createDataFrame([(None, 1.0), ("a", 2.0), ("b", 3.0)], "k string, x double")
    a = spark.createDataFrame([(None, 99.0), ("a", 2.0), ("c", 4.0)], "k string, x double")
    got = {(r.k, r._presence): r.ok for r in field_diff(e, a, ["k"], ["x"], {}).collect()}
    assert got == {(None, "both"): False, ("a", "both"): True, ("b", "expected_only"): False, ("c", "actual_only"): False}


def test_multiset_tolerance(spark):
    def diff(x, y):
        mk = lambda v: spark.createDataFrame([(float(i),) for i in v], "v double")
        return multiset_diff(mk(x), mk(y)).count()
    assert diff([1.004, 5], [1.006, 5]) == 0
    assert diff([1.00, 1.02], [1.02, 1.04]) == 0
    assert diff([1.00], [1.03]) > 0
    assert diff([1, 1, 2], [1, 2, 2]) > 0
    assert diff([1, 2], [1, 2, 3]) > 0
    assert diff([9999.99, 10000.0], [10000.01, 9999.98]) == 0


def test_divergence_shows_one_sided_rows(spark):
    s = spark.createDataFrame([(1, 1.0), (2, 2.0), (None, 5.0)], "year int, py double")
    n = spark.createDataFrame([(1, 1.01), (3, 2.0), (None, 5.5)], "year int, py double")
    assert {r.year for r in diverging(s, n, ["year"], ["py"]).collect()} == {2, 3, None}


def test_top_n_is_bounded(spark):
    with pytest.raises(ValueError):
        top_n_with_ties(spark.range(5).toDF("x"), 5000, "x")


def test_estimates_do_not_depend_on_a_size(spark):
    """With a sketch asked for, plain and eager paths give the same kind of count."""
    answers = []
    try:
        spark.conf.set("spendframe.approxDistinct", "0.3")
        for mode in ("never", "always"):
            spark.conf.set("spendframe.eagerDimAggregation", mode)
            df = Model(spark, SF_SMALL).evaluate(["credit_score_band"], ["active_clients"])
            answers.append(sorted(map(tuple, df.collect()), key=str))
    finally:
        spark.conf.unset("spendframe.approxDistinct")
        spark.conf.unset("spendframe.eagerDimAggregation")
    assert answers[0] == answers[1]


def test_replaced_source_is_seen(spark, tmpdir_fresh):
    src = f"{tmpdir_fresh}/src"
    shutil.copytree(SF_SMALL, src, copy_function=shutil.copyfile)
    total = lambda: Calendar(spark, src).daily().agg(F.sum("c")).first()[0]
    q01 = lambda: E.queries()["q01_total_spend"](spark, src).first().approved
    before = (total(), q01())
    half = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").where("l_orderkey % 2 = 0")
    half.coalesce(1).write.parquet(f"{tmpdir_fresh}/half")
    shutil.copyfile(next(f"{tmpdir_fresh}/half/{f}" for f in __import__("os").listdir(f"{tmpdir_fresh}/half")
                         if f.endswith(".parquet")), f"{src}/lineitem.parquet")
    after = (total(), q01())
    assert 0 < after[0] < before[0] and 0 < after[1] < before[1]
    try:
        refresh(spark, src, written=True)
        assert (total(), q01()) == after
    finally:
        release(spark, src)


def test_two_builds_do_not_break_each_other(spark):
    a = E.queries()["fact_by_year_counts"](spark, SF_SMALL)
    b = E.queries()["fact_union_scan"](spark, SF_SMALL)
    assert a.agg(F.sum("n")).first()[0] == b.agg(F.sum("n")).first()[0]
