"""The flat (one wide table) alternative to the star, X10 + P14 + P20.

Keys as text, the timestamp kept, nulls as empty strings, the source's own labels.
Like the star, it is a view: only the dimensions a query reads are joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendframe.operators.joins import join_dim
from spendframe.plans.binding import Star

FLAT_PART = {"merchant_category"}
FLAT_CARD = {"card_brand", "card_type", "card_has_chip", "card_credit_limit"}
FLAT_CLIENT = {"client_age", "client_yearly_income", "client_credit_score", "merchant_state"}


def of_keys_and_time() -> dict:
    """Columns that are functions of a key or of the timestamp."""
    return {
        "client_id": F.col("client_key").cast("string"),
        "card_id": F.col("card_key").cast("string"),
        "year": F.year("timestamp").cast("bigint"),
        "month_year": F.date_format("timestamp", "MMM yyyy"),
    }


def flat_table(star: Star, need=None) -> DataFrame:
    need = set(need) if need is not None else FLAT_PART | FLAT_CARD | FLAT_CLIENT
    f = star.base()
    own = of_keys_and_time()
    out = f.select(
        F.concat_ws("-", F.col("order_key").cast("string"), F.col("line_number").cast("string"))
         .alias("transaction_id"),
        "timestamp", "date", "hour",
        own["client_id"].alias("client_id"),
        own["card_id"].alias("card_id"),
        "amount", "channel", "line_number", "client_key", "card_key", "mcc",
        F.col("mcc").cast("string").alias("mcc_text"),
        F.coalesce(F.col("errors"), F.lit("")).alias("errors"),
        F.when(F.col("fraud_key") == 2, "Yes").when(F.col("fraud_key") == 1, "No")
         .otherwise("").alias("fraud_label"),
    )
    if need & FLAT_PART:
        out = join_dim(out, star.category_dim().select("mcc", F.col("category").alias(
            "merchant_category")), "mcc", size_proxy=star.t.part.select("p_partkey", "p_brand"))
    if need & FLAT_CARD:
        cd = star.card_dim().select("card_key", "card_brand", "card_type",
                                    F.when(F.col("has_chip") == "Chip", "YES").otherwise("NO")
                                    .alias("card_has_chip"),
                                    F.col("credit_limit").alias("card_credit_limit"))
        out = join_dim(out, cd, "card_key", size_proxy=star.card_proxy())
    if need & FLAT_CLIENT:
        cl = star.client_geo().select("client_key", "_home_state",
                                      F.col("age").alias("client_age"),
                                      F.col("yearly_income").alias("client_yearly_income"),
                                      F.col("credit_score").alias("client_credit_score"))
        out = join_dim(out, cl, "client_key", size_proxy=star.client_proxy())
        st = (F.when(F.col("channel") == "1-URGENT", F.lit(""))
              .when(F.col("line_number") == 7, F.lit(""))
              .otherwise(F.coalesce(F.col("_home_state"), F.lit(""))))
        out = out.withColumn("merchant_state", st).drop("_home_state")
    return with_calc_columns(out)


def with_calc_columns(flat: DataFrame) -> DataFrame:
    """P20: Year, Month Year, Is Approved (no error text), Spend Amount, Is Fraud."""
    own = of_keys_and_time()
    return flat.select(
        "*",
        own["year"].alias("year"),
        own["month_year"].alias("month_year"),
        F.when(F.length("errors") == 0, "Yes").otherwise("No").alias("is_approved"),
        F.when(F.length("errors") == 0, F.col("amount")).alias("spend_amount"),
        F.when(F.col("fraud_label") == "Yes", "Yes").otherwise("No").alias("is_fraud"),
    )


# The 13 flat measures, written the way a wide table invites (iterate and filter);
# each compiles to the same conditional aggregate as its star twin.
def flat_measures() -> dict:
    ok = F.col("is_approved") == "Yes"
    lab = F.length("fraud_label") > 0
    fr = F.col("fraud_label") == "Yes"
    n = F.count(F.lit(1))
    return {
        "transactions": n,
        "approved": F.count_if(ok),
        "declines": F.count_if(~ok),
        "spend": F.sum(F.when(ok, F.col("amount"))),
        "cards": F.countDistinct("card_id"),
        "clients": F.countDistinct("client_id"),
        "labelled": F.count_if(lab),
        "fraud": F.count_if(fr),
        # average over purchases = exact decimal sum / count, divided in DOUBLE
        "avg": (F.sum(F.when(ok & (F.col("amount") > 0), F.col("amount"))).cast("double")
                / F.count_if(ok & (F.col("amount") > 0))),
    }
