"""ETL operators (P1-P20, S1-S12, J1-J7, T6-T7, X2, X11) over the driver tables.

The driver tables are first rendered in the shape of the card files the model is
built from (``raw_transactions``: text money, '<channel> Transaction', error text,
a mixed state/country column), then the cleaning operators parse them back.  Every
query reads the whole tables; outputs are aggregated where a per-row output would
only repeat the input.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendframe.functions import constants as K
from spendframe.functions.scalar import MONEY, band, money, money_text, ratio
from spendframe.operators import distinct
from spendframe.operators.dense import with_row_number
from spendframe.operators.joins import GuardError, anti, guard_empty, join_dim, semi, with_scalars
from spendframe.operators.keysets import bottom_k, compared, key_set
from spendframe.operators.shared import kept
from spendframe.plans.binding import CHIP_CHANNEL, ONLINE_CHANNEL, Star, location_columns
from spendframe.plans.flat import flat_table
from spendframe.plans.measures import PARTS
from spendframe.plans.oracle import with_ctes
from spendframe.plans.query import Model
from spendframe.plans.reload import KeptStar
from spendframe.plans.registry import register
from spendframe.session import ensure_checkpoint_dir
from spendframe.sources.checked import REASON, check_accounted, read_checked
from spendframe.sources.raw import TRANSACTIONS_SCHEMA, explode_label_map, read_fact, write_csv, write_fact_by_year
from spendframe.sources.tables import Tables

SUFFIX = K.CHANNEL_SUFFIX
SAMPLE_SEED, SAMPLE_SIZE = 42, 100


# ---------------------------------------------------------------- raw rendering
def raw_transactions(star: Star) -> DataFrame:
    """Driver tables in the raw card-file shape."""
    f = star.fact({"order_key", "line_number", "timestamp", "client_key", "card_key", "mcc",
                   "channel", "errors", "amount", "merchant_state"})
    return f.select(
        (F.col("order_key") * 10 + F.col("line_number")).alias("id"),
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("date"),
        F.col("client_key").alias("client_id"), F.col("card_key").alias("card_id"),
        money_text("amount").alias("amount"),
        F.concat(F.col("channel"), F.lit(SUFFIX)).alias("use_chip"),
        "merchant_state", "mcc", "errors")


RAW_CTE = ("raw AS (SELECT order_key * 10 + line_number AS id, "
           "strftime(CAST(date AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS date, client_key AS client_id, "
           "card_key AS card_id, '$' || CAST(amount AS VARCHAR) AS amount, "
           f"channel || '{SUFFIX}' AS use_chip, merchant_state, mcc, errors FROM att)")


def _star(spark, src):
    return Star(spark, src)


# ---------------------------------------------------------------- P1-P3
@register("money_parse", with_ctes(
    "SELECT replace(use_chip, ' Transaction', '') AS channel, count(*) AS n, "
    "CAST(sum(CAST(replace(amount, '$', '') AS DECIMAL(12,2))) AS DOUBLE) AS amount_sum, "
    "count(*) FILTER (WHERE CAST(replace(amount, '$', '') AS DECIMAL(12,2)) < 0) AS negatives "
    "FROM raw GROUP BY replace(use_chip, ' Transaction', '')", RAW_CTE))
def money_parse(spark, src):
    """P1/P2: '$-77.00' -> DECIMAL(12,2) (exact cents), checked by sum and sign."""
    r = raw_transactions(_star(spark, src))
    amt = money("amount")
    return (r.groupBy(F.regexp_replace("use_chip", SUFFIX + "$", "").alias("channel"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(amt).cast("double").alias("amount_sum"),
                 F.count_if(amt < 0).alias("negatives")))


@register("date_hour_key",
          "SELECT CAST(CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS DATE) AS date, "
          "CAST(hour(CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP)) AS BIGINT) AS hour, "
          "count(*) AS n FROM events GROUP BY 1, 2")
def date_hour_key(spark, src):
    """Timestamp text -> (date key, integer hour)."""
    ev = Tables(spark, src).events
    t = F.to_timestamp(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "yyyy-MM-dd HH:mm:ss")
    return (ev.groupBy(F.to_date(t).alias("date"), F.hour(t).cast("bigint").alias("hour"))
            .agg(F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------- P4 bands
def _band_counts(df, label, sort):
    return df.groupBy(label, sort).agg(F.count(F.lit(1)).alias("n"))


@register("band_credit_score", with_ctes(
    "SELECT credit_score_band, credit_score_band_sort, count(*) AS n FROM client_banded "
    "GROUP BY 1, 2"))
def band_credit_score(spark, src):
    return _band_counts(_star(spark, src).client_dim(), "credit_score_band",
                        "credit_score_band_sort")


@register("band_income", with_ctes(
    "SELECT income_band, income_band_sort, count(*) AS n FROM client_banded GROUP BY 1, 2"))
def band_income(spark, src):
    return _band_counts(_star(spark, src).client_dim(), "income_band", "income_band_sort")


@register("band_age", with_ctes(
    "SELECT age_band, age_band_sort, count(*) AS n FROM client_banded GROUP BY 1, 2"))
def band_age(spark, src):
    return _band_counts(_star(spark, src).client_dim(), "age_band", "age_band_sort")


@register("band_limit", with_ctes(
    "SELECT credit_limit_band, credit_limit_band_sort, count(*) AS n FROM card_banded "
    "GROUP BY 1, 2"))
def band_limit(spark, src):
    return _band_counts(_star(spark, src).card_dim(), "credit_limit_band",
                        "credit_limit_band_sort")


AMOUNT_EDGES = [0, 1000, 10000, 50000]
AMOUNT_LABELS = ["Negative", "Under $1k", "$1k-$10k", "$10k-$50k", "$50k+"]


@register("band_generic", with_ctes(
    "SELECT CASE WHEN amount < 0 THEN 'Negative' WHEN amount < 1000 THEN 'Under $1k' "
    "WHEN amount < 10000 THEN '$1k-$10k' WHEN amount < 50000 THEN '$10k-$50k' ELSE '$50k+' END "
    "AS band, CASE WHEN amount < 0 THEN 0 WHEN amount < 1000 THEN 1 WHEN amount < 10000 THEN 2 "
    "WHEN amount < 50000 THEN 3 ELSE 4 END AS sort, count(*) AS n FROM att GROUP BY 1, 2"))
def band_generic(spark, src):
    """band(value, edges, labels) -> (label, ordinal) on any column (here: amount)."""
    f = Model(spark, src).fact({"amount"})
    lab, srt = band(F.col("amount"), AMOUNT_EDGES, AMOUNT_LABELS)
    return f.groupBy(lab.alias("band"), srt.alias("sort")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- P5-P7
@register("debt_to_income", with_ctes(
    "SELECT c.c_custkey AS client_key, round(CAST(CAST(abs(c.c_acctbal) * 3 AS DECIMAL(12,2)) "
    "AS DOUBLE) / NULLIF(CAST(CAST((c.c_acctbal + 1000) * 12 AS DECIMAL(12,2)) AS DOUBLE), 0), 4) "
    "AS debt_to_income FROM customer c"))
def debt_to_income(spark, src):
    """P5: total debt / yearly income, 4 dp, null when income is 0."""
    c = Tables(spark, src).customer
    debt = (F.abs(F.col("c_acctbal")) * 3).cast(MONEY)
    income = ((F.col("c_acctbal") + 1000) * 12).cast(MONEY)
    return c.select(F.col("c_custkey").alias("client_key"),
                    F.round(ratio(debt, income), 4).alias("debt_to_income"))


@register("flag_recode",
          "SELECT CASE WHEN raw = 'YES' THEN 'Chip' ELSE 'No chip' END AS has_chip, count(*) AS n "
          "FROM (SELECT CASE WHEN s_suppkey % 7 = 0 THEN 'NO' ELSE 'YES' END AS raw FROM supplier) "
          "GROUP BY 1")
def flag_recode(spark, src):
    """Source flag YES -> 'Chip', anything else -> 'No chip'."""
    s = Tables(spark, src).supplier
    raw = F.when(F.pmod("s_suppkey", F.lit(7)) == 0, "NO").otherwise("YES")
    return (s.select(F.when(raw == "YES", "Chip").otherwise("No chip").alias("has_chip"))
            .groupBy("has_chip").agg(F.count(F.lit(1)).alias("n")))


@register("open_month_parse",
          "SELECT s_suppkey AS card_key, CAST(strptime(txt, '%m/%Y') AS DATE) AS opened, "
          "CAST(year(strptime(txt, '%m/%Y')) AS BIGINT) AS opened_year FROM ("
          "SELECT s_suppkey, lpad(CAST(1 + s_suppkey % 12 AS VARCHAR), 2, '0') || '/' || "
          "CAST(1990 + s_suppkey % 25 AS VARCHAR) AS txt FROM supplier)")
def open_month_parse(spark, src):
    """P7: 'MM/yyyy' text -> first-of-month date and its year."""
    s = Tables(spark, src).supplier
    txt = F.concat(F.lpad((F.pmod("s_suppkey", F.lit(12)) + 1).cast("string"), 2, "0"),
                   F.lit("/"), (F.pmod("s_suppkey", F.lit(25)) + 1990).cast("string"))
    d = F.to_date(txt, "MM/yyyy")
    return s.select(F.col("s_suppkey").alias("card_key"), d.alias("opened"),
                    F.year(d).cast("bigint").alias("opened_year"))


# ---------------------------------------------------------------- P8 code -> group map
BRANDS_PER_GROUP = 5
N_BRANDS = 25


def category_map(spark) -> DataFrame:
    """Rule-built code -> group table: 'Brand#k' -> 'Group ((k-1) div 5 + 1)'."""
    return spark.range(1, N_BRANDS + 1).select(
        F.concat(F.lit("Brand#"), F.col("id").cast("string")).alias("category"),
        F.concat(F.lit("Group "), (F.floor((F.col("id") - 1) / BRANDS_PER_GROUP) + 1)
                 .cast("string")).alias("group_name"))


MAP_SQL = (f"cmap AS (SELECT 'Brand#' || CAST(i AS VARCHAR) AS category, 'Group ' || "
           f"CAST((i - 1) // {BRANDS_PER_GROUP} + 1 AS VARCHAR) AS group_name "
           f"FROM range(1, {N_BRANDS + 1}) t(i))")


@register("unmapped_codes", with_ctes(
    "SELECT DISTINCT p_brand AS category FROM part WHERE p_brand NOT IN "
    "(SELECT category FROM cmap)", MAP_SQL))
def unmapped_codes(spark, src):
    """P8 guard input: codes with no group (must be empty)."""
    codes = Tables(spark, src).part.select(F.col("p_brand").alias("category")).distinct()
    return anti(codes, category_map(spark), "category", bounded=True)


@register("category_group_map", with_ctes(
    "SELECT m.group_name, count(*) AS n, CAST(sum(a.amount) FILTER (WHERE a.ok) AS DOUBLE) "
    "AS spend FROM att a JOIN cmap m ON a.category = m.category GROUP BY m.group_name", MAP_SQL))
def category_group_map(spark, src):
    """Code -> group via a broadcast map; aborts when any code is unmapped."""
    guard_empty(unmapped_codes(spark, src), "codes with no group")
    per_code = Model(spark, src).rollup(["category"], ["n", "spend"], None)   # one row per code
    j = join_dim(per_code, category_map(spark), "category", how="inner", bounded=True)
    return j.groupBy("group_name").agg(F.sum("n").alias("n"),
                                       F.sum("spend").cast("double").alias("spend"))


# ---------------------------------------------------------------- P9-P13
@register("channel_normalise", with_ctes(
    "SELECT channel, CAST(dense_rank() OVER (ORDER BY channel) AS BIGINT) AS channel_key, "
    "CASE WHEN channel IN ('1-URGENT', '2-HIGH') THEN 'Card not present' ELSE 'Card present' END "
    "AS channel_type, n FROM (SELECT replace(use_chip, ' Transaction', '') AS channel, "
    "count(*) AS n FROM raw GROUP BY 1)", RAW_CTE))
def channel_normalise(spark, src):
    """Strip the ' Transaction' suffix, key the channels in order, classify
    presentment.  The key is a rank over the distinct channels (dimension-sized)."""
    r = raw_transactions(_star(spark, src))
    c = (r.groupBy(F.regexp_replace("use_chip", SUFFIX + "$", "").alias("channel"))
         .agg(F.count(F.lit(1)).alias("n")))
    from spendframe.plans.binding import NOT_PRESENT_CHANNELS
    return c.select("channel", F.dense_rank().over(Window.orderBy("channel")).cast("bigint")
                    .alias("channel_key"),
                    F.when(F.col("channel").isin(*NOT_PRESENT_CHANNELS), "Card not present")
                    .otherwise("Card present").alias("channel_type"), "n")


def error_map(spark) -> DataFrame:
    return spark.createDataFrame(
        [(raw, i, lab, cls) for i, (raw, lab, cls) in enumerate(K.ERROR_CLASS, start=1)],
        "err string, outcome_key int, outcome string, outcome_class string")


@register("outcome_classify", with_ctes(
    "SELECT outcome_key, outcome, outcome_class, count(*) AS n FROM att GROUP BY 1, 2, 3"))
def outcome_classify(spark, src):
    """P10 as a map join: blank error = approved, a known error maps through the fixed
    table (broadcast), anything else - several errors, unknown text - is Multiple."""
    r = raw_transactions(_star(spark, src)).select(F.coalesce("errors", F.lit("")).alias("err"))
    j = r.join(F.broadcast(error_map(spark)), "err", "left")
    multi = len(K.ERROR_CLASS) + 1
    approved = F.col("err") == ""
    return (j.select(
        F.when(approved, 0).otherwise(F.coalesce("outcome_key", F.lit(multi))).alias("outcome_key"),
        F.when(approved, K.APPROVED_OUTCOME[0]).otherwise(
            F.coalesce("outcome", F.lit(K.MULTIPLE_OUTCOME[0]))).alias("outcome"),
        F.when(approved, K.APPROVED_OUTCOME[1]).otherwise(
            F.coalesce("outcome_class", F.lit(K.MULTIPLE_OUTCOME[1]))).alias("outcome_class"))
        .groupBy("outcome_key", "outcome", "outcome_class").agg(F.count(F.lit(1)).alias("n")))


@register("location_classify", with_ctes(
    "SELECT location, location_type, count(*) AS n FROM att GROUP BY 1, 2"))
def location_classify(spark, src):
    """State code vs country name vs online null vs not-recorded null; codes
    are named through the fixed state table (broadcast)."""
    star = _star(spark, src)
    r = raw_transactions(star).select("merchant_state",
                                      F.regexp_replace("use_chip", SUFFIX + "$", "")
                                      .alias("channel"))
    r = r.join(F.broadcast(star.state_names), r.merchant_state == F.col("_state_code"), "left")
    loc = location_columns(F.col("merchant_state"), F.col("channel"))
    return (r.select(loc["location"].alias("location"), loc["location_type"].alias("location_type"))
            .groupBy("location", "location_type").agg(F.count(F.lit(1)).alias("n")))


@register("label_three_state",
          "SELECT CASE WHEN l.doc_id IS NULL THEN 'Not labelled' WHEN l.toxic = 1 "
          "THEN 'Confirmed fraud' ELSE 'Confirmed not fraud' END AS status, count(*) AS n "
          "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1")
def label_three_state(spark, src):
    """P13 on a genuine partial label set: not labelled != clean."""
    t = Tables(spark, src)
    j = label_status(t.documents.select("doc_id"), t.labels.select("doc_id", "toxic"),
                     "doc_id", "toxic")
    return j.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def label_status(rows: DataFrame, labels: DataFrame, key: str, flag: str) -> DataFrame:
    """Each row of ``rows`` gets a three-state ``status`` by membership in the label
    set: absent = not labelled, flag 1 = confirmed fraud, otherwise confirmed not fraud.
    The label set is joined many-to-one (broadcast only under the size check)."""
    lab = labels.select(key, flag, F.lit(True).alias("_has"))
    j = join_dim(rows, lab, key, size_proxy=labels)
    st = (F.when(F.col("_has").isNull(), K.FRAUD_STATUS[0][1])
          .when(F.col(flag) == 1, K.FRAUD_STATUS[2][1]).otherwise(K.FRAUD_STATUS[1][1]))
    return j.select(*rows.columns, st.alias("status"))


# ---------------------------------------------------------------- P14, P15, P17, P19, P20
@register("flat_cleanup", with_ctes(
    "SELECT count(*) FILTER (WHERE coalesce(errors, '') = '') AS blank_errors, "
    "count(*) FILTER (WHERE merchant_state IS NULL) AS blank_state, "
    "count(*) FILTER (WHERE fraud_key = 0) AS blank_label, "
    "count(DISTINCT CAST(card_key AS VARCHAR)) AS card_ids FROM att"))
def flat_cleanup(spark, src):
    """Nulls -> '' and keys as text in the flat table."""
    f = flat_table(_star(spark, src), {"merchant_state"})
    return f.agg(F.count_if(F.col("errors") == "").alias("blank_errors"),
                 F.count_if(F.col("merchant_state") == "").alias("blank_state"),
                 F.count_if(F.col("fraud_label") == "").alias("blank_label"),
                 F.countDistinct("card_id").alias("card_ids"))


@register("surrogate_keys", with_ctes(
    "SELECT location_type, location, "
    "CAST(row_number() OVER (ORDER BY location_type, location) AS BIGINT) AS geo_key "
    "FROM (SELECT DISTINCT location_type, location FROM att)"))
def surrogate_keys(spark, src):
    """Dense surrogate keys over the sorted distinct places.  A place is its type and
    label, so a state and a country of one name keep keys of their own."""
    d = Model(spark, src).fact({"location_type", "location"}).select("location_type", "location").distinct()
    return with_row_number(d, ["location_type", "location"], "geo_key")


@register("having_range", with_ctes(
    "SELECT category, spend_share FROM (SELECT category, CAST(sum(amount) FILTER (WHERE ok) AS "
    "DOUBLE) / CAST((SELECT sum(amount) FROM att WHERE ok) AS DOUBLE) AS spend_share FROM att "
    "GROUP BY category) WHERE spend_share BETWEEN 0.035 AND 0.045"))
def having_range(spark, src):
    """A post-aggregate range filter on a measure (low <= measure <= high)."""
    r = Model(spark, src).evaluate(["category"], ["spend_share"])
    return r.where(F.col("spend_share").between(0.035, 0.045))


@register("refunds", with_ctes(
    "SELECT channel, count(*) FILTER (WHERE ok AND amount < 0) AS refunds, "
    "CAST(sum(amount) FILTER (WHERE ok AND amount < 0) AS DOUBLE) AS refund_value, "
    "CAST(count(*) FILTER (WHERE ok AND amount < 0) AS DOUBLE) / "
    "NULLIF(count(*) FILTER (WHERE ok), 0) AS refund_rate, "
    "count(*) FILTER (WHERE amount = 0) AS zero_amounts FROM att GROUP BY channel"))
def refunds(spark, src):
    """Sign tests on the amount (refund < 0, purchase > 0, zero)."""
    refund = F.col("ok") & (F.col("amount") < 0)
    g = Model(spark, src).fact({"channel", "amount", "ok"}).groupBy("channel").agg(
        F.count_if(refund).alias("refunds"), F.sum(F.when(refund, F.col("amount"))).alias("_value"),
        F.count_if("ok").alias("_ok"), F.count_if(F.col("amount") == 0).alias("zero_amounts"))
    return g.select("channel", "refunds", F.col("_value").cast("double").alias("refund_value"),
                    ratio("refunds", "_ok").alias("refund_rate"), "zero_amounts")


@register("flat_calc_columns", with_ctes(
    "SELECT CAST(year(date) AS BIGINT) AS year, CASE WHEN coalesce(errors, '') = '' THEN 'Yes' "
    "ELSE 'No' END AS is_approved, CASE WHEN fraud_key = 2 THEN 'Yes' ELSE 'No' END AS is_fraud, "
    "count(*) AS n, CAST(sum(CASE WHEN coalesce(errors, '') = '' THEN amount END) AS DOUBLE) "
    "AS spend_amount FROM att GROUP BY 1, 2, 3"))
def flat_calc_columns(spark, src):
    """P20: Year, Is Approved, Spend Amount, Is Fraud as calculated columns."""
    f = flat_table(_star(spark, src), set())
    return f.groupBy("year", "is_approved", "is_fraud").agg(
        F.count(F.lit(1)).alias("n"), F.sum("spend_amount").cast("double").alias("spend_amount"))


# ---------------------------------------------------------------- sources S1-S12
@register("scan_profile", with_ctes(
    "SELECT count(*) AS rows, count(DISTINCT id) AS ids, count(*) FILTER (WHERE merchant_state "
    "IS NULL) AS null_state, count(*) FILTER (WHERE errors IS NULL) AS null_errors, "
    "min(date) AS first_ts, max(date) AS last_ts FROM raw", RAW_CTE))
def scan_profile(spark, src):
    """Profile of the typed transaction scan (rows, ids, nulls, range)."""
    r = raw_transactions(_star(spark, src))
    return r.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("id").alias("ids"),
                 F.count_if(F.col("merchant_state").isNull()).alias("null_state"),
                 F.count_if(F.col("errors").isNull()).alias("null_errors"),
                 F.min("date").alias("first_ts"), F.max("date").alias("last_ts"))


NOT_MONEY_LINE = 7


def transaction_files(spark, src) -> str:
    """The transactions as CSV files of the card source's columns, in (date, card) order within each
    file, in a shared folder of their own; the amounts of line 7 are no amounts.  Its path."""
    path = os.path.join(ensure_checkpoint_dir(spark), f"raw-{uuid.uuid4().hex}", "transactions")
    r = raw_transactions(_star(spark, src))
    none = lambda kind: F.lit(None).cast(kind)
    rows = r.select("id", "date", "client_id", "card_id", F.when(F.col("id") % 10 == NOT_MONEY_LINE, "n/a").otherwise(
        F.col("amount")).alias("amount"), "use_chip", none("bigint").alias("merchant_id"), none("string").alias("merchant_city"),
        "merchant_state", none("double").alias("zip"), "mcc", "errors")
    write_csv(rows.repartitionByRange("date", "card_id").sortWithinPartitions("date", "card_id"), path)
    return path


@register("csv_load", with_ctes(
    f"SELECT CASE WHEN line_number = {NOT_MONEY_LINE} THEN 'amount is no money' ELSE 'good' END AS status, count(*) AS n, "
    "count(DISTINCT client_key) AS clients, count(errors) AS with_errors, "
    f"CAST(sum(CASE WHEN line_number <> {NOT_MONEY_LINE} THEN amount END) AS DOUBLE) AS amount, "
    f"CAST(min(CASE WHEN line_number <> {NOT_MONEY_LINE} THEN date END) AS VARCHAR) AS first_day FROM att GROUP BY 1"))
def csv_load(spark, src):
    """Transaction files written and read with their types; records that do not
    fit are counted by reason beside the good ones, and all lines are accounted for."""
    path = transaction_files(spark, src)
    amount = F.regexp_replace("amount", r"\$", "").try_cast(MONEY)
    df = read_checked(spark, path, TRANSACTIONS_SCHEMA, ["id", "date", "client_id", "card_id"],
                      {"amount is no money": amount.isNotNull()})
    check_accounted(spark, path, df)
    fits = F.col(REASON).isNull()
    return df.groupBy(F.coalesce(F.col(REASON), F.lit("good")).alias("status")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("client_id").alias("clients"), F.count("errors").alias("with_errors"),
        F.sum(F.when(fits, amount)).cast("double").alias("amount"),
        F.min(F.when(fits, F.substring("date", 1, 10))).alias("first_day"))


@register("active_entity_scan",
          "SELECT count(DISTINCT o.o_custkey) AS clients, count(DISTINCT l.l_suppkey) AS cards "
          "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey")
def active_entity_scan(spark, src):
    """S3: a two-column scan (column pruning reaches the parquet reader)."""
    f = _star(spark, src).base({"client_key", "card_key"})
    return f.agg(F.countDistinct("client_key").alias("clients"),
                 F.countDistinct("card_key").alias("cards"))


@register("json_map_explode",
          "SELECT k AS key, count(*) AS n, CAST(sum(CAST(json_extract(props, '$.\"' || k || '\"') "
          "AS BIGINT)) AS BIGINT) AS total FROM (SELECT props, unnest(json_keys(props)) AS k "
          "FROM events) GROUP BY k")
def json_map_explode(spark, src):
    """A {key: value} JSON object per row -> (key, value) rows."""
    ev = Tables(spark, src).events
    kv = ev.select(F.explode(F.from_json("props", "MAP<STRING,BIGINT>")).alias("key", "value"))
    return kv.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@register("label_map_explode",
          "SELECT count(*) AS labelled, count(*) FILTER (WHERE toxic = 1) AS fraud, "
          "count(DISTINCT doc_id) AS ids FROM labels")
def label_map_explode(spark, src):
    """The label JSON {"target": {id: "Yes"|"No"}} parsed with a MAP schema and
    exploded.  Rendered one entry per line (a single object cannot be split)."""
    lab = Tables(spark, src).labels
    txt = F.to_json(F.struct(F.create_map(F.col("doc_id").cast("string"),
                                          F.when(F.col("toxic") == 1, "Yes").otherwise("No"))
                             .alias("target")))
    ex = lab.select(explode_label_map(txt).alias("id", "label"))
    return ex.agg(F.count(F.lit(1)).alias("labelled"),
                  F.count_if(F.col("label") == "Yes").alias("fraud"),
                  F.countDistinct("id").alias("ids"))


def _written_fact(spark, src) -> str:
    """Write the star fact by year into the shared folder, in a folder of its own for each
    build, and return its path."""
    path = os.path.join(ensure_checkpoint_dir(spark), f"star-{uuid.uuid4().hex}", "fact")
    fact = Model(spark, src).fact({"year", "date", "card_key", "client_key", "mcc", "channel",
                                   "outcome_key", "fraud_key", "amount"})
    write_fact_by_year(fact, path, years_overwrite=False)
    return path


@register("fact_by_year_counts", with_ctes(
    "SELECT year, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount FROM att GROUP BY year"))
def fact_by_year_counts(spark, src):
    """The fact written one directory per year (sorted inside), read back."""
    path = _written_fact(spark, src)
    return read_fact(spark, path).groupBy(F.col("year").cast("bigint").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").cast("double").alias("amount"))


RELOADED_YEAR = 1996


@register("year_reload", with_ctes(
    "SELECT y.year, CAST(y.s AS DOUBLE) AS spend, CAST(p.s AS DOUBLE) AS spend_py, CAST(t.s AS DOUBLE) AS spend_12m, "
    "(SELECT CAST(sum(amount) AS DOUBLE) FROM chg WHERE ok) AS all_cards FROM y LEFT JOIN p USING (year) LEFT JOIN t USING (year)",
    f"chg AS (SELECT date, year, card_key, ok, CASE WHEN year = {RELOADED_YEAR} THEN 2 * amount ELSE amount END AS amount FROM att "
    f"WHERE year <> {RELOADED_YEAR} OR channel <> '2-HIGH')",
    "y AS (SELECT year, sum(amount) FILTER (WHERE ok) AS s FROM chg GROUP BY year)",
    "p AS (SELECT d.year, sum(amount) AS s FROM chg JOIN date_dim d ON CAST(chg.date + INTERVAL 12 MONTH AS DATE) = d.date "
    "WHERE ok GROUP BY d.year)",
    "t AS (SELECT e.year, sum(amount) AS s FROM (SELECT year, max(date) AS e FROM date_dim GROUP BY year) e JOIN chg "
    "ON chg.date > CAST(e.e - INTERVAL 12 MONTH AS DATE) AND chg.date <= e.e WHERE ok GROUP BY e.year)"))
def year_reload(spark, src):
    """The star written with its rollups, then one year loaded anew (amounts doubled, a channel
    gone): the year itself, the prior year of the next, the trailing 12 months and the totals of the
    cards all show it, as a full build would."""
    star = KeptStar(spark, os.path.join(ensure_checkpoint_dir(spark), f"kept-{uuid.uuid4().hex}"))
    fact = Model(spark, src).fact({"year", "date", "card_key", "channel", "ok", "amount"}).select(
        "year", "date", "card_key", "channel", "ok", "amount")
    star.build(fact)
    rows = fact.where((F.col("year") == RELOADED_YEAR) & (F.col("channel") != "2-HIGH")).withColumn(
        "amount", (F.col("amount") * 2).cast("decimal(12,2)"))
    star.reload(RELOADED_YEAR, rows)
    total = star.cards().agg(F.sum("spend").cast("double").alias("all_cards"))
    return with_scalars(star.by_year().withColumn("year", F.col("year").cast("bigint")), total)


@register("fact_union_scan", with_ctes(
    "SELECT channel, count(*) AS n FROM att GROUP BY channel"))
def fact_union_scan(spark, src):
    """All year files scanned as one table (glob over year=*)."""
    path = _written_fact(spark, src)
    return read_fact(spark, path).groupBy("channel").agg(F.count(F.lit(1)).alias("n"))


@register("pii_dropped", with_ctes(
    "SELECT client_key, credit_score_band, income_band, age_band FROM client_banded"))
def pii_dropped(spark, src):
    """A whitelist extract of the client master; the identifying column never
    leaves the extract (checked on the schema)."""
    keep = ["client_key", "credit_score_band", "income_band", "age_band"]
    out = _star(spark, src).client_dim().select(*keep)
    if "c_name" in out.columns:
        raise GuardError("identifying column leaked")
    return out


# ---------------------------------------------------------------- joins J1-J7, T6, T7
@register("star_join", with_ctes(
    "SELECT channel_type, category_group, location_type, card_brand, count(*) AS n, "
    "CAST(sum(amount) FILTER (WHERE ok) AS DOUBLE) AS spend FROM att GROUP BY 1, 2, 3, 4"))
def star_join(spark, src):
    """The fact joined to every dimension (broadcast after the size check)."""
    f = Model(spark, src).fact({"channel_type", "category_group", "location_type", "card_brand",
                                "ok", "amount"})
    return f.groupBy("channel_type", "category_group", "location_type", "card_brand").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("ok"), F.col("amount"))).cast("double").alias("spend"))


@register("flat_wide", with_ctes(
    "SELECT category AS merchant_category, card_brand, CASE WHEN has_chip = 'Chip' THEN 'YES' "
    "ELSE 'NO' END AS card_has_chip, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount "
    "FROM att GROUP BY 1, 2, 3"))
def flat_wide(spark, src):
    """The one wide table (left joins to category, card and client)."""
    f = flat_table(_star(spark, src))
    return f.groupBy("merchant_category", "card_brand", "card_has_chip").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").cast("double").alias("amount"))


def _seen_clients(spark, src) -> DataFrame:
    return _star(spark, src).base({"client_key"}).distinct()


SAMPLE_SQL = ("panel AS (SELECT client_key FROM (SELECT c_custkey AS client_key FROM customer INTERSECT "
              "SELECT client_key FROM att) "
              f"ORDER BY md5('{SAMPLE_SEED}:' || CAST(client_key AS VARCHAR)) LIMIT {SAMPLE_SIZE})")


def _master(spark, src) -> DataFrame:
    return Tables(spark, src).customer.select(F.col("c_custkey").alias("client_key"))


def panel(spark, src, n: int = SAMPLE_SIZE, seed: int = SAMPLE_SEED, seen: DataFrame | None = None) -> DataFrame:
    """A seeded sample of n eligible clients without replacement.  Eligible are master
    clients with transactions; the n of least seeded hash are drawn (each task keeps its n
    least, nothing is sorted as a whole)."""
    seen = _seen_clients(spark, src) if seen is None else seen.select("client_key").distinct()
    # (null-safe, so that no condition sinks into what ``seen`` shares with other readers)
    m = _master(spark, src).withColumnRenamed("client_key", "_m")
    return bottom_k(seen.join(m, F.col("client_key").eqNullSafe(F.col("_m")), "left_semi"), "client_key", n, seed)


@register("client_panel_sample", with_ctes("SELECT client_key FROM panel", SAMPLE_SQL))
def client_panel_sample(spark, src):
    return panel(spark, src)


@register("semi_join_panel", with_ctes(
    "SELECT channel, count(*) AS n, CAST(sum(amount) FILTER (WHERE ok) AS DOUBLE) AS spend "
    "FROM att WHERE client_key IN (SELECT client_key FROM panel) GROUP BY channel", SAMPLE_SQL))
def semi_join_panel(spark, src):
    """J4 + T7: keep ALL rows of the sampled clients (semi join; the panel is bounded
    by the sample size, so it is broadcast)."""
    f = Model(spark, src).fact({"client_key", "channel", "ok", "amount"})
    p = semi(f, panel(spark, src), "client_key", bounded=True)
    return p.groupBy("channel").agg(F.count(F.lit(1)).alias("n"),
                                    F.sum(F.when(F.col("ok"), F.col("amount"))).cast("double")
                                    .alias("spend"))


@register("silent_clients", with_ctes(
    "SELECT client_key FROM panel WHERE client_key NOT IN (SELECT client_key FROM att)",
    SAMPLE_SQL))
def silent_clients(spark, src):
    """J5/X11 guard input: sampled clients with no transactions (must be empty)."""
    return anti(panel(spark, src), _seen_clients(spark, src), "client_key")


@register("never_transacting",
          "SELECT c_custkey AS client_key FROM customer WHERE c_custkey NOT IN (SELECT o_custkey "
          "FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE o_orderstatus <> 'P')")
def never_transacting(spark, src):
    """Master rows with no (approved) fact rows - customer vs a filtered fact."""
    m = Model(spark, src)
    seen = m.fact({"client_key", "ok"}).where("ok").select("client_key")
    c = Tables(spark, src).customer.select(F.col("c_custkey").alias("client_key"))
    return anti(c, seen, "client_key")


@register("eligible_clients",
          "SELECT c_custkey AS client_key FROM customer INTERSECT SELECT o_custkey FROM orders o "
          "JOIN lineitem l ON l.l_orderkey = o.o_orderkey")
def eligible_clients(spark, src):
    """eligible = master set INTERSECT clients seen in the fact."""
    c = Tables(spark, src).customer.select(F.col("c_custkey").alias("client_key"))
    return c.intersect(_seen_clients(spark, src))


@register("population_counts", with_ctes(
    "SELECT CAST((SELECT count(*) FROM customer) AS BIGINT) AS population_clients, "
    "CAST((SELECT count(DISTINCT client_key) FROM att) AS BIGINT) "
    "AS population_clients_with_transactions, "
    "CAST((SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT client_key FROM att)) "
    "AS BIGINT) AS population_clients_never_transacting, "
    "CAST((SELECT count(*) FROM supplier WHERE s_suppkey NOT IN (SELECT card_key FROM att)) "
    "AS BIGINT) AS population_cards_never_transacting, "
    "CAST((SELECT count(*) FROM panel) AS BIGINT) AS sample_clients, "
    "CAST((SELECT count(*) FROM att) AS BIGINT) AS population_transactions, "
    "CAST((SELECT count(*) FROM att WHERE client_key IN (SELECT client_key FROM panel)) "
    "AS BIGINT) AS sample_transactions, "
    "CAST((SELECT count(DISTINCT card_key) FROM att WHERE client_key IN "
    "(SELECT client_key FROM panel)) AS BIGINT) AS sample_cards_active", SAMPLE_SQL))
def population_counts(spark, src):
    """A10: population vs sample.  Master clients, clients seen in the fact, the never
    transacting on both masters, the panel drawn from the master clients that were seen, and the
    fact rows and active cards the panel keeps.  The fact is read once and reduced to (client,
    card) pairs with their rows; key sets of the pairs and of the masters are compared as bitmaps."""
    supp = Tables(spark, src).supplier.select(F.col("s_suppkey").alias("card_key"))
    return population(_master(spark, src), supp, client_cards(spark, src), panel=lambda pairs: panel(
        spark, src, seen=pairs)).select(
        "population_clients", "population_clients_with_transactions", "population_clients_never_transacting",
        "population_cards_never_transacting", "sample_clients", "population_transactions",
        "sample_transactions", "sample_cards_active")


def client_cards(spark, src) -> DataFrame:
    """(client_key, card_key, n) of the fact, for several readers in one plan."""
    f = Model(spark, src).fact({"client_key", "card_key"})
    return kept(f.groupBy("client_key", "card_key").agg(F.count(F.lit(1)).alias("n")), ["client_key", "card_key", "n"])


def population(clients: DataFrame, cards: DataFrame, pairs: DataFrame, panel, more=()) -> DataFrame:
    """One row of population and sample counts from the masters and the fact's ``pairs``; ``more``:
    further columns of the pairs, summed as population_... and sample_..."""
    client_sets = compared(key_set(clients, "client_key"), key_set(pairs, "client_key"))
    card_sets = compared(key_set(cards, "card_key"), key_set(pairs, "card_key"))
    drawn = panel(pairs)
    p = drawn.withColumnRenamed("client_key", "_p")
    sampled = pairs.join(F.broadcast(p), F.col("client_key").eqNullSafe(F.col("_p")), "left_semi")  # bounded by the panel
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    sums = lambda side: [F.sum(c).alias(f"{side}_{c}") for c in more if c != "n"]
    out = client_sets.select(
        F.col("n_a").alias("population_clients"), F.col("n_both").alias("population_clients_with_transactions"),
        (F.col("n_a") - F.col("n_both")).alias("population_clients_never_transacting"))
    for one in [
        card_sets.select(F.col("n_a").alias("population_cards"), F.col("n_both").alias("population_cards_active"),
                         (F.col("n_a") - F.col("n_both")).alias("population_cards_never_transacting")),
        drawn.agg(F.count(F.lit(1)).alias("sample_clients")),
        pairs.agg(total("n").alias("population_transactions"), *sums("population")),
        sampled.agg(total("n").alias("sample_transactions"), F.countDistinct("card_key").alias("sample_cards_active"),
                    *sums("sample")),
    ]:
        out = with_scalars(out, one)
    return out


@register("reconcile_presence",
          "SELECT CASE WHEN d.doc_id IS NULL THEN 'right_only' WHEN l.doc_id IS NULL THEN 'left_only' "
          "ELSE 'both' END AS presence, count(*) AS n FROM documents d FULL OUTER JOIN labels l "
          "ON d.doc_id = l.doc_id GROUP BY 1")
def reconcile_presence(spark, src):
    """Full outer join with a presence indicator (documents vs labels)."""
    t = Tables(spark, src)
    d = t.documents.select(F.col("doc_id").alias("l_id"))
    lab = t.labels.select(F.col("doc_id").alias("r_id"))
    j = d.join(lab, d.l_id == lab.r_id, "full")
    p = (F.when(F.col("l_id").isNull(), "right_only").when(F.col("r_id").isNull(), "left_only")
         .otherwise("both"))
    return j.groupBy(p.alias("presence")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- X2 quality report
def _melt(df: DataFrame) -> DataFrame:
    cols = df.columns
    expr = "stack({}, {}) as (metric, value)".format(
        len(cols), ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in cols))
    return df.selectExpr(expr)


_IN_PANEL = "client_key IN (SELECT client_key FROM panel)"
#: Metric -> SQL of its value, in the order of the report.
_QUALITY_SQL = {
    "population_clients": "SELECT count(*) FROM customer",
    "population_clients_with_transactions": "SELECT count(*) FROM (SELECT c_custkey FROM customer INTERSECT SELECT client_key FROM att)",
    "population_clients_never_transacting": "SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT client_key FROM att)",
    "population_cards": "SELECT count(*) FROM supplier",
    "population_cards_never_transacting": "SELECT count(*) FROM supplier WHERE s_suppkey NOT IN (SELECT card_key FROM att)",
    "population_transactions": "SELECT count(*) FROM att",
    "population_transactions_labelled": "SELECT count(*) FROM att WHERE lab",
    "population_transactions_fraud": "SELECT count(*) FROM att WHERE fr",
    "sample_clients": "SELECT count(*) FROM panel",
    "sample_transactions": f"SELECT count(*) FROM att WHERE {_IN_PANEL}",
    "sample_cards_active": f"SELECT count(DISTINCT card_key) FROM att WHERE {_IN_PANEL}",
    "sample_labelled": f"SELECT count(*) FROM att WHERE lab AND {_IN_PANEL}",
    "sample_fraud": f"SELECT count(*) FROM att WHERE fr AND {_IN_PANEL}",
    "sample_approved": f"SELECT count(*) FROM att WHERE ok AND {_IN_PANEL}",
    "sample_declined": f"SELECT count(*) FROM att WHERE NOT ok AND {_IN_PANEL}",
    "sample_decline_rate": "SELECT CAST(round(CAST(count(*) FILTER (WHERE NOT ok) AS DOUBLE) / count(*), 6) AS DECIMAL(12,6)) "
                           f"FROM att WHERE {_IN_PANEL}",
    "sample_spend_approved": f"SELECT sum(amount) FROM att WHERE ok AND {_IN_PANEL}",
    "sample_spend_all_rows": f"SELECT sum(amount) FROM att WHERE {_IN_PANEL}",
    "sample_overstatement": f"SELECT sum(amount) - sum(amount) FILTER (WHERE ok) FROM att WHERE {_IN_PANEL}",
    "mcc_codes": "SELECT count(*) FROM part", "mcc_groups": "SELECT count(DISTINCT p_type) FROM part",
    "date_min": "SELECT min(date) FROM att", "date_max": "SELECT max(date) FROM att",
    "partial_final_year": "SELECT year(max(date)) FROM att", "partial_final_year_months": "SELECT month(max(date)) FROM att",
    "fact_years": "SELECT count(DISTINCT year) FROM att",
    "negative_amounts": "SELECT count(*) FROM att WHERE amount < 0", "zero_amounts": "SELECT count(*) FROM att WHERE amount = 0",
    "multi_error_rows": "SELECT count(*) FROM att WHERE outcome_key = 8",
    "approved": "SELECT count(*) FROM att WHERE ok", "declined": "SELECT count(*) FROM att WHERE NOT ok",
    "decline_rate": "SELECT CAST(round(CAST(count(*) FILTER (WHERE NOT ok) AS DOUBLE) / count(*), 6) AS DECIMAL(12,6)) FROM att",
    "spend_approved": "SELECT sum(amount) FROM att WHERE ok", "spend_all_rows": "SELECT sum(amount) FROM att",
    "overstatement": "SELECT sum(amount) - sum(amount) FILTER (WHERE ok) FROM att",
    "state_null_rows": "SELECT count(*) FROM att WHERE merchant_state IS NULL",
    "state_null_and_online": f"SELECT count(*) FROM att WHERE merchant_state IS NULL AND channel = '{ONLINE_CHANNEL}'",
    "state_null_not_online": f"SELECT count(*) FROM att WHERE merchant_state IS NULL AND channel <> '{ONLINE_CHANNEL}'",
    "state_distinct": "SELECT count(DISTINCT merchant_state) FROM att",
    "state_country_names": "SELECT count(DISTINCT merchant_state) FROM att WHERE length(merchant_state) <> 2",
    "chip_first_month": f"SELECT min(month) FROM att WHERE channel = '{CHIP_CHANNEL}'",
    "chip_rows_on_cards_without_a_chip": f"SELECT count(*) FROM att WHERE channel = '{CHIP_CHANNEL}' AND has_chip = 'No chip'",
}


@register("quality_report", with_ctes(
    " UNION ALL ".join(f"SELECT '{m}' AS metric, CAST(({q}) AS VARCHAR) AS value" for m, q in _QUALITY_SQL.items())
    + " UNION ALL SELECT 'error_values: ' || errors, CAST(count(*) AS VARCHAR) FROM att WHERE errors IS NOT NULL GROUP BY errors",
    SAMPLE_SQL))
def quality_report(spark, src):
    """The load's report as (metric, value): both masters against the fact, the panel and what
    it keeps, the fact as a whole, the state column, the chip switch, and each error text.  The fact
    is read once, and reduced to two rollups that all metrics share: by client and card, and
    by the columns that have few values."""
    t = Tables(spark, src)
    m = Model.over_shared(spark, src, ["client_key", "card_key", "lab", "fr", "date", "year", "month", "amount", "outcome_key",
                                       "merchant_state", "channel", "ok", "errors", "has_chip"])
    f = m.star._mat[0]
    parts = {"n": "n", "lab": "n_lab", "fr": "n_fr", "ok": "n_ok", "decl": "n_decl", "spend": "spend", "all": "attempted"}
    pairs = f.groupBy("client_key", "card_key").agg(*[PARTS[p].spark().alias(a) for a, p in parts.items()])
    pairs = kept(pairs, ["client_key", "card_key", *parts])
    clients, cards = _master(spark, src), t.supplier.select(F.col("s_suppkey").alias("card_key"))
    rate = lambda d, n: F.round(F.col(d) / F.col(n), 6).cast("decimal(12,6)")
    pop = population(clients, cards, pairs, panel=lambda p: panel(spark, src, seen=p), more=parts)
    pop = pop.select(
        *[c for c in _QUALITY_SQL if c in pop.columns], F.col("population_lab").alias("population_transactions_labelled"),
        F.col("population_fr").alias("population_transactions_fraud"), F.col("sample_lab").alias("sample_labelled"),
        F.col("sample_fr").alias("sample_fraud"), F.col("sample_ok").alias("sample_approved"),
        F.col("sample_decl").alias("sample_declined"), rate("sample_decl", "sample_transactions").alias("sample_decline_rate"),
        F.col("sample_spend").alias("sample_spend_approved"), F.col("sample_all").alias("sample_spend_all_rows"),
        (F.col("sample_all") - F.col("sample_spend")).alias("sample_overstatement"),
        F.col("population_ok").alias("approved"), F.col("population_decl").alias("declined"),
        rate("population_decl", "population_transactions").alias("decline_rate"), F.col("population_spend").alias("spend_approved"),
        F.col("population_all").alias("spend_all_rows"), (F.col("population_all") - F.col("population_spend")).alias("overstatement"))
    state, chip = F.col("merchant_state"), F.col("channel") == CHIP_CHANNEL
    low = f.groupBy("merchant_state", "channel", "errors", "month", "has_chip").agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("first"), F.max("date").alias("last"),
        F.count_if(F.col("amount") < 0).alias("neg"), F.count_if(F.col("amount") == 0).alias("zero"),
        F.count_if(F.col("outcome_key") == len(K.ERROR_CLASS) + 1).alias("multi"))
    low = kept(low, low.columns)
    total = lambda when, c="n": F.coalesce(F.sum(F.when(when, F.col(c))), F.lit(0))
    facts = low.agg(
        F.min("first").alias("date_min"), F.max("last").alias("date_max"), F.year(F.max("last")).alias("partial_final_year"),
        F.month(F.max("last")).alias("partial_final_year_months"), F.sum("neg").alias("negative_amounts"),
        F.sum("zero").alias("zero_amounts"), F.sum("multi").alias("multi_error_rows"), total(state.isNull()).alias("state_null_rows"),
        total(state.isNull() & (F.col("channel") == ONLINE_CHANNEL)).alias("state_null_and_online"),
        total(state.isNull() & (F.col("channel") != ONLINE_CHANNEL)).alias("state_null_not_online"),
        F.min(F.when(chip, F.col("month"))).alias("chip_first_month"),
        total(chip & (F.col("has_chip") == "No chip")).alias("chip_rows_on_cards_without_a_chip"))
    values = distinct.counted(distinct.pair_rollup(low, [], {
        "fact_years": F.substring("month", 1, 4), "state_distinct": state,
        "state_country_names": F.when(F.length(state) != 2, state)}), [], ["fact_years", "state_distinct", "state_country_names"], {})
    errors = low.groupBy("errors").agg(F.sum("n").alias("n")).where(F.col("errors").isNotNull()).select(
        F.concat(F.lit("error_values: "), "errors").alias("metric"), F.col("n").cast("string").alias("value"))
    codes = t.part.agg(F.count(F.lit(1)).alias("mcc_codes"), F.countDistinct("p_type").alias("mcc_groups"))
    out = errors
    for one in (pop, facts, values, codes):
        out = out.unionByName(_melt(one))
    return out
