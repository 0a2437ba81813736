"""Row functions on hand-made rows (money, bands, rates, outcome, location, formats)."""
from decimal import Decimal

from pyspark.sql import functions as F

from spendframe.functions import constants as K
from spendframe.functions.scalar import band, money, ratio, short_money, week_of_month
from spendframe.plans.binding import location_columns, outcome_columns


def test_money_parse(spark):
    df = spark.createDataFrame([("$-77.00",), ("$0.00",), ("$1234.5",), (None,)], "t string")
    got = [r[0] for r in df.select(money("t")).collect()]
    assert got == [Decimal("-77.00"), Decimal("0.00"), Decimal("1234.50"), None]


def test_band_edge_goes_up(spark):
    df = spark.createDataFrame([(579,), (580,), (669,), (670,), (800,), (None,)], "v int")
    lab, srt = band(F.col("v"), K.CREDIT_SCORE_EDGES, K.CREDIT_SCORE_LABELS)
    got = [tuple(r) for r in df.select(lab, srt).collect()]
    assert got == [("Poor (<580)", 0), ("Fair (580-669)", 1), ("Fair (580-669)", 1),
                   ("Good (670-739)", 2), ("Exceptional (800+)", 4), (None, None)]


def test_ratio_blank_rules(spark):
    df = spark.createDataFrame([(0, 5), (3, 0), (1, 4)], "n int, d int")
    got = [r[0] for r in df.select(ratio("n", "d")).collect()]
    assert got == [0.0, None, 0.25]


def test_outcome_classify(spark):
    df = spark.createDataFrame([(None,), ("Bad PIN",), ("Bad PIN,Insufficient Balance",),
                                ("Something new",), ("",)], "e string")
    oc = outcome_columns(F.col("e"))
    got = [tuple(r) for r in df.select(oc["outcome_key"], oc["outcome"]).collect()]
    assert got == [(0, "Approved"), (2, "Bad PIN"), (8, "Multiple errors"),
                   (8, "Multiple errors"), (0, "Approved")]


def test_location_classify(spark):
    rows = [("GA", "3-MEDIUM"), ("Georgia", "3-MEDIUM"), (None, "1-URGENT"), (None, "3-MEDIUM"),
            ("ZZ", "3-MEDIUM")]
    df = spark.createDataFrame(rows, "s string, channel string")
    names = spark.createDataFrame(K.US_STATES, "_state_code string, _state_name string")
    df = df.join(F.broadcast(names), df.s == F.col("_state_code"), "left")
    loc = location_columns(F.col("s"), F.col("channel"))
    got = {r[0]: (r[1], r[2]) for r in df.select(F.coalesce("s", F.col("channel")),
                                                 loc["location"], loc["location_type"]).collect()}
    assert got["GA"] == ("Georgia", "US state")
    assert got["Georgia"] == ("Georgia", "International")
    assert got["1-URGENT"] == ("Online", "Online")
    assert got["3-MEDIUM"] == ("Not recorded", "Not recorded")
    assert got["ZZ"] == ("ZZ", "International")


def test_short_money_exact_rounding(spark):
    df = spark.createDataFrame([(Decimal("1234567.89"),), (Decimal("12350.00"),),
                                (Decimal("1234.50"),), (Decimal("123.49"),)], "v decimal(20,2)")
    got = [r[0] for r in df.select(short_money("v")).collect()]
    assert got == ["$1.23M", "$12.4k", "$1.23k", "$123"]


def test_week_of_month_monday_grid(spark):
    df = spark.sql("SELECT date'2024-01-01' d UNION ALL SELECT date'2024-01-07' "
                   "UNION ALL SELECT date'2024-01-08' UNION ALL SELECT date'2023-10-01'")
    got = [r[0] for r in df.select(week_of_month("d")).collect()]
    assert got == [1, 1, 2, 1]
