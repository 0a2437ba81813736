"""Raw files to star, as one job.

``load_star`` reads the card files (transactions, clients and cards as CSV, category codes and fraud
labels as JSON objects), sets aside what does not fit, draws the panel, checks the guards, and writes
the dimensions, the fact by year and the rejected records.  Every read splits over tasks; what
reaches the driver are counts and the few offending keys of a guard."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendframe.functions import constants as K
from spendframe.functions.scalar import MONEY, band, ratio, whole_text
from spendframe.operators.dense import with_row_number
from spendframe.operators.joins import anti, guard_empty, join_dim, semi
from spendframe.operators.keysets import bottom_k
from spendframe.plans.binding import outcome_columns
from spendframe.plans.etl import label_status
from spendframe.sources.checked import check_accounted, good, read_checked, rejected
from spendframe.sources.raw import TRANSACTIONS_SCHEMA, read_json_map, read_label_map, write_csv, write_fact_by_year


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(c, t) for c, t in columns.items()])


_I, _S = T.IntegerType(), T.StringType()
# ---- FIXED VALUES: columns of the client and card files, in order ----
USERS_SCHEMA = _schema(
    id=T.LongType(), current_age=_I, retirement_age=_I, birth_year=_I, birth_month=_I, gender=_S, address=_S,
    latitude=T.DoubleType(), longitude=T.DoubleType(), per_capita_income=_S, yearly_income=_S, total_debt=_S,
    credit_score=_I, num_credit_cards=_I)
CARDS_SCHEMA = _schema(
    id=T.LongType(), client_id=T.LongType(), card_brand=_S, card_type=_S, card_number=_S, expires=_S, cvv=_S,
    has_chip=_S, num_cards_issued=_I, credit_limit=_S, acct_open_date=_S, year_pin_last_changed=_I, card_on_dark_web=_S)
#: Columns that must not leave the load.
SENSITIVE = {"address", "latitude", "longitude", "card_number", "cvv", "expires", "card_on_dark_web"}


def _amount(text: str) -> Column:
    """Money text as a decimal, null if it is none (a rule rejects that record)."""
    return F.regexp_replace(F.col(text), r"\$", "").try_cast(MONEY)


def _is_amount(text: str) -> Column:
    return F.col(text).isNull() | _amount(text).isNotNull()


def client_dimension(users: DataFrame) -> DataFrame:
    """The client dimension, without what identifies a person."""
    income, debt = _amount("yearly_income"), _amount("total_debt")
    sb, sbs = band("credit_score", K.CREDIT_SCORE_EDGES, K.CREDIT_SCORE_LABELS)
    ib, ibs = band(income, K.INCOME_EDGES, K.INCOME_LABELS)
    ab, abs_ = band("current_age", K.AGE_EDGES, K.AGE_LABELS)
    return users.select(
        F.col("id").alias("client_key"), "gender", F.col("current_age").alias("age"), ab.alias("age_band"),
        abs_.alias("age_band_sort"), "retirement_age", "birth_year", income.alias("yearly_income"), ib.alias("income_band"),
        ibs.alias("income_band_sort"), _amount("per_capita_income").alias("per_capita_income"), debt.alias("total_debt"),
        F.round(ratio(debt, income), 4).alias("debt_to_income"), "credit_score", sb.alias("credit_score_band"),
        sbs.alias("credit_score_band_sort"), F.col("num_credit_cards").alias("cards_held"))


def card_dimension(cards: DataFrame) -> DataFrame:
    limit, opened = _amount("credit_limit"), F.to_date("acct_open_date", "MM/yyyy")
    lb, lbs = band(limit, K.LIMIT_EDGES, K.LIMIT_LABELS)
    return cards.select(
        F.col("id").alias("card_key"), F.col("client_id").alias("client_key"), "card_brand", "card_type",
        F.when(F.col("has_chip") == "YES", "Chip").otherwise("No chip").alias("has_chip"), limit.alias("credit_limit"),
        lb.alias("credit_limit_band"), lbs.alias("credit_limit_band_sort"), opened.alias("account_opened"),
        F.year(opened).alias("account_opened_year"), F.col("num_cards_issued").alias("cards_issued"),
        F.col("year_pin_last_changed").alias("pin_last_changed"))


def channel_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, c, k, t) for c, k, t in K.CHANNEL_ORDER],
                                 "channel_key int, channel string, channel_sort int, channel_type string")


def outcome_dimension(spark: SparkSession) -> DataFrame:
    rows = [(0, *K.APPROVED_OUTCOME, "Yes")] + [(i, o, c, "No") for i, (_, o, c) in enumerate(K.ERROR_CLASS, 1)]
    rows.append((len(K.ERROR_CLASS) + 1, *K.MULTIPLE_OUTCOME, "No"))
    return spark.createDataFrame([(*r, r[0]) for r in rows],
                                 "outcome_key int, outcome string, outcome_class string, is_approved string, outcome_sort int")


def fraud_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in K.FRAUD_STATUS],
                                 "fraud_key int, fraud_status string, is_labelled string, is_fraud string, fraud_sort int")


def _places(tx: DataFrame) -> DataFrame:
    """``tx`` with location, location_type, state_code and country of the mixed state column."""
    states = tx.sparkSession.createDataFrame(K.US_STATES, "_code string, _name string")
    s, online = F.col("merchant_state"), F.col("channel") == "Online"
    j = join_dim(tx, states, tx.merchant_state == F.col("_code"), bounded=True)
    us = F.col("_name").isNotNull()
    kinds = [(s.isNull() & online, "Online", "Online", "", "United States"), (s.isNull(), "Not recorded", "Not recorded", "", ""),
             (us, F.col("_name"), "US state", s, "United States")]
    rest = (s, F.lit("International"), F.lit(""), s)
    out = {}
    for i, name in enumerate(("location", "location_type", "state_code", "country"), 1):
        c = F.when(kinds[0][0], kinds[0][i])
        for k in kinds[1:]:
            c = c.when(k[0], k[i])
        out[name] = c.otherwise(rest[i - 1])
    return j.select(*tx.columns, *[c.alias(n) for n, c in out.items()])


def read_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The checked files of ``folder``: every record, good or rejected."""
    channels = [c + K.CHANNEL_SUFFIX for c, _, _ in K.CHANNEL_ORDER]
    return {
        "transactions": read_checked(
            spark, f"{folder}/transactions_data.csv", TRANSACTIONS_SCHEMA, ["id", "date", "client_id", "card_id", "amount"],
            {"amount is no money": _is_amount("amount"), "date is no time": F.expr("try_to_timestamp(date, 'yyyy-MM-dd HH:mm:ss')").isNotNull(),
             "unknown channel": F.col("use_chip").isin(*channels)}),
        "users": read_checked(spark, f"{folder}/users_data.csv", USERS_SCHEMA, ["id"], {
            f"{c} is no money": _is_amount(c) for c in ("per_capita_income", "yearly_income", "total_debt")}),
        "cards": read_checked(spark, f"{folder}/cards_data.csv", CARDS_SCHEMA, ["id", "client_id"], {
            "credit_limit is no money": _is_amount("credit_limit")}),
    }


def load_star(spark: SparkSession, folder: str, out: str, groups: DataFrame, sample: int | None = None, seed: int = 42) -> dict:
    """Reads ``folder``, writes ``out`` and returns the counts of the files.  ``groups``: (mcc, category_group).
    With ``sample``, only a seeded panel of clients that are on file and have transactions is kept."""
    sources = read_sources(spark, folder)
    counts = {name: check_accounted(spark, f"{folder}/{name}_data.csv", df) for name, df in sources.items()}
    tx, users, cards = (good(sources[n]) for n in ("transactions", "users", "cards"))
    codes = read_json_map(spark, f"{folder}/mcc_codes.json").select(
        F.col("key").cast("bigint").alias("mcc"), F.col("value").alias("merchant_category"))
    guard_empty(anti(codes, groups, "mcc"), "category codes with no group")
    if sample is not None:
        seen = tx.select(F.col("client_id").alias("id")).distinct()
        panel = bottom_k(semi(users.select("id"), seen, "id"), "id", sample, seed)
        users, kept = semi(users, panel, "id", bounded=True), panel.withColumnRenamed("id", "client_id")
        cards = semi(cards, kept, "client_id", bounded=True)
        tx = semi(tx, cards.select(F.col("id").alias("card_id")), "card_id")
        guard_empty(anti(panel, tx.select(F.col("client_id").alias("id")), "id", bounded=False), "sampled clients have no transactions")
    ts = F.to_timestamp("date", "yyyy-MM-dd HH:mm:ss")
    rows = tx.select(
        "id", F.to_date(ts).alias("date"), F.hour(ts).alias("hour"), F.year(ts).cast("bigint").alias("year"),
        F.col("client_id").alias("client_key"), F.col("card_id").alias("card_key"), "mcc", _amount("amount").alias("amount"),
        F.regexp_replace("use_chip", K.CHANNEL_SUFFIX + "$", "").alias("channel"), "merchant_state",
        whole_text("zip").alias("zip"), outcome_columns(F.col("errors"))["outcome_key"].alias("outcome_key"))
    channels = channel_dimension(spark)
    placed = join_dim(_places(rows), channels.select("channel", "channel_key"), "channel", bounded=True)
    place = ["location_type", "location", "state_code", "country"]
    geography = with_row_number(placed.select(*place).distinct(), place, "geo_key").select("geo_key", *place)
    labels = read_label_map(spark, f"{folder}/train_fraud_labels.json").select(
        F.col("id").cast("bigint").alias("id"), (F.col("label") == "Yes").cast("int").alias("fraud"))
    status = label_status(placed, labels, "id", "fraud").join(
        F.broadcast(fraud_dimension(spark).select("fraud_key", F.col("fraud_status").alias("status"))), "status")
    write_csv(geography.sortWithinPartitions("geo_key"), f"{out}/dim_geography")
    geo = spark.read.schema(geography.schema).option("header", True).option("nullValue", "\x00").csv(f"{out}/dim_geography")
    geo = geo.fillna("")
    fact = join_dim(status, geo.select("geo_key", "location_type", "location"), ["location_type", "location"]).select(
        "id", "date", "hour", "year", "client_key", "card_key", "mcc", "channel_key", "outcome_key", "geo_key", "fraud_key",
        "zip", "amount")
    write_fact_by_year(fact, f"{out}/fact", years_overwrite=False)
    dims = {"client": client_dimension(users), "card": card_dimension(cards), "channel": channels,
            "merchant_category": codes.join(F.broadcast(groups), "mcc"), "outcome": outcome_dimension(spark),
            "fraud_status": fraud_dimension(spark)}
    for name, df in dims.items():
        leaked = SENSITIVE & set(df.columns)
        if leaked:
            raise ValueError(f"dim_{name} would hold {sorted(leaked)}")
        write_csv(df.repartitionByRange(df.columns[0]).sortWithinPartitions(df.columns[0]), f"{out}/dim_{name}")
    bad = None
    for name, df in sources.items():
        part = rejected(df, name)
        bad = part if bad is None else bad.unionByName(part)
    bad.write.mode("overwrite").parquet(os.path.join(out, "rejected"))
    return counts
