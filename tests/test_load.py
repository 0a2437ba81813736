"""Raw files to star: rejected records, guards, dimensions and fact from hand-made files."""
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendframe.operators.joins import GuardError
from spendframe.plans import load as L
from spendframe.sources.checked import accounted, check_accounted, good, read_checked, rejected
from spendframe.sources.raw import TRANSACTIONS_SCHEMA, read_fact

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType()), T.StructField("x", T.DoubleType())])


def write(path, lines):
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_records_are_good_or_rejected(spark, tmpdir_fresh):
    import os
    os.mkdir(f"{tmpdir_fresh}/d")
    write(f"{tmpdir_fresh}/d/a.csv", ["id,t,x", "1,a,1.5", "x2,b,2.5", '3,"c, d",', ",e,1", "5,f", "6,g,7,8", "", "7,bad,1"])
    write(f"{tmpdir_fresh}/d/b.csv", ["id,t,x", "8,h,0.5"])
    df = read_checked(spark, f"{tmpdir_fresh}/d", SCHEMA, ["id"], {"t is bad": F.col("t") != "bad"})
    assert sorted(tuple(r) for r in good(df).collect()) == [(1, "a", 1.5), (3, "c, d", None), (8, "h", 0.5)]
    got = {(r.reason, r.record) for r in rejected(df, "s").collect()}
    assert got == {("not of the schema", "x2,b,2.5"), ("no id", ",e,1.0"), ("not of the schema", "5,f"),
                   ("not of the schema", "6,g,7,8"), ("t is bad", "7,bad,1.0")}
    assert tuple(accounted(spark, f"{tmpdir_fresh}/d", df).first()) == (8, 3, 5)
    with pytest.raises(GuardError):
        check_accounted(spark, f"{tmpdir_fresh}/d", df.where("id IS NULL OR id <> 8"))
    write(f"{tmpdir_fresh}/d/c.csv", ["t,id,x", "z,9,1"])
    with pytest.raises(Exception):
        read_checked(spark, f"{tmpdir_fresh}/d", SCHEMA).collect()


def sources(folder, codes=None):
    tx = ["id,date,client_id,card_id,amount,use_chip,merchant_id,merchant_city,merchant_state,zip,mcc,errors",
          "1,2018-12-31 23:05:00,10,100,$-77.00,Swipe Transaction,1,Beulah,ND,58523.0,5499,",
          "2,2019-01-02 00:06:00,10,101,$14.57,Online Transaction,2,ONLINE,,,5812,Bad PIN",
          "3,2019-02-03 10:00:00,11,102,$80.00,Chip Transaction,3,Tbilisi,Georgia,,5812,\"Bad PIN,Bad CVV\"",
          "4,2019-03-04 11:00:00,11,102,$5.00,Chip Transaction,3,Nowhere,,,5499,",
          "5,2019-03-05 11:00:00,12,103,n/a,Chip Transaction,3,Nowhere,GA,,5499,",
          "6,not a day,12,103,$1.00,Chip Transaction,3,Nowhere,GA,,5499,",
          "7,2019-03-06 12:00:00,99,999,$2.00,Chip Transaction,3,Atlanta,GA,30301.0,5499,"]
    users = ["id,current_age,retirement_age,birth_year,birth_month,gender,address,latitude,longitude,per_capita_income,"
             "yearly_income,total_debt,credit_score,num_credit_cards"]
    users += [f"{i},{age},66,1966,11,Female,{i} Rose Lane,34.15,-117.76,$29278,${inc},$1000,{score},5"
              for i, age, inc, score in ((10, 29, 30000, 579), (11, 75, 0, 800), (12, 44, 74999, 700))]
    cards = ["id,client_id,card_brand,card_type,card_number,expires,cvv,has_chip,num_cards_issued,credit_limit,acct_open_date,"
             "year_pin_last_changed,card_on_dark_web"]
    cards += [f"{i},{c},Visa,Debit,4344676511950444,12/2022,623,{chip},2,${lim},09/2002,2008,No"
              for i, c, chip, lim in ((100, 10, "YES", 999), (101, 10, "NO", 24295), (102, 11, "YES", 50000), (103, 12, "YES", 1))]
    for name, lines in (("transactions", tx), ("users", users), ("cards", cards)):
        write(f"{folder}/{name}_data.csv", lines)
    with open(f"{folder}/mcc_codes.json", "w") as f:
        json.dump(codes or {"5499": "Misc Food, Stores", "5812": "Eating \"Places\""}, f)
    with open(f"{folder}/train_fraud_labels.json", "w") as f:
        json.dump({"target": {"1": "No", "2": "Yes", "4": "No"}}, f)


def groups(spark):
    return spark.createDataFrame([(5499, "Food"), (5812, "Eating")], "mcc bigint, category_group string")


def read_dim(spark, out, name):
    return {r[0]: r for r in spark.read.option("header", True).csv(f"{out}/dim_{name}").collect()}


def test_files_to_star(spark, tmpdir_fresh):
    sources(tmpdir_fresh)
    out = f"{tmpdir_fresh}/out"
    counts = L.load_star(spark, tmpdir_fresh, out, groups(spark))
    assert counts["transactions"] == {"lines": 7, "good": 5, "rejected": 2} and counts["users"]["good"] == 3
    bad = {(r.source, r.reason) for r in spark.read.parquet(f"{out}/rejected").collect()}
    assert bad == {("transactions", "amount is no money"), ("transactions", "date is no time")}
    geo = {r[0]: (r.location_type, r.location) for r in read_dim(spark, out, "geography").values()}
    facts = {r.id: r for r in read_fact(spark, f"{out}/fact").collect()}
    assert {i: geo[str(r.geo_key)] for i, r in facts.items()} == {
        1: ("US state", "North Dakota"), 2: ("Online", "Online"), 3: ("International", "Georgia"),
        4: ("Not recorded", "Not recorded"), 7: ("US state", "Georgia")}
    assert sorted(map(int, geo)) == [1, 2, 3, 4, 5]
    assert {i: (r.outcome_key, r.fraud_key, r.channel_key) for i, r in facts.items()} == {
        1: (0, 1, 1), 2: (2, 2, 3), 3: (8, 0, 2), 4: (0, 1, 2), 7: (0, 0, 2)}
    assert (facts[1].hour, str(facts[1].amount), facts[1].zip, facts[1].year, facts[2].zip) == (23, "-77.00", "58523", 2018, None)
    assert [r.id for r in read_fact(spark, f"{out}/fact", [2018]).collect()] == [1]
    client = read_dim(spark, out, "client")
    assert (client["10"].age_band, client["10"].income_band, client["10"].credit_score_band, client["10"].debt_to_income) == (
        "Under 30", "$30k-$50k", "Poor (<580)", "0.0333")
    assert (client["11"].age_band, client["11"].credit_score_band, client["11"].debt_to_income) == ("75+", "Exceptional (800+)", None)
    card = read_dim(spark, out, "card")
    assert (card["100"].credit_limit_band, card["102"].credit_limit_band, card["101"].has_chip, card["100"].account_opened) == (
        "Under $1k", "$50k+", "No chip", "2002-09-01")
    for name in ("client", "card"):
        assert not L.SENSITIVE & set(next(iter(read_dim(spark, out, name).values())).asDict())
    assert read_dim(spark, out, "merchant_category")["5812"].merchant_category == 'Eating "Places"'


def test_panel_and_guards(spark, tmpdir_fresh):
    sources(tmpdir_fresh)
    out = f"{tmpdir_fresh}/out"
    L.load_star(spark, tmpdir_fresh, out, groups(spark), sample=2)
    # clients 10 and 11 are on file and have good transactions; 12 has none, 99 is not on file
    assert set(read_dim(spark, out, "client")) == {"10", "11"} and set(read_dim(spark, out, "card")) == {"100", "101", "102"}
    assert sorted(r.id for r in read_fact(spark, f"{out}/fact").collect()) == [1, 2, 3, 4]
    sources(tmpdir_fresh, {"5499": "x", "1234": "y"})
    with pytest.raises(GuardError, match="no group"):
        L.load_star(spark, tmpdir_fresh, out, groups(spark))
