"""The measure registry: 49 business measures over the enriched fact.

Each measure is built from *parts*: aggregate expressions evaluated in one
``groupBy().agg()`` pass (conditional sums and counts replace per-measure filter
predicates).  Ratios are formed after aggregation.  Measures that need
another filter context (prior year, trailing 12 months, shares with a dimension
cleared, credit limit through the card dimension, ranks, the date table) are
marked ``special`` and planned by :mod:`spendframe.plans.query`.

Every part and simple measure also carries its SQL text, written separately, used
as the correctness oracle (DuckDB) over the ``att`` view.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from spendframe.functions.scalar import change, ratio
from spendframe.operators.distinct import FIRST
from spendframe.plans.binding import CHIP_CHANNEL, ONLINE_CHANNEL


@dataclass(frozen=True)
class Part:
    """``row``: what one fact row contributes - counted (not null), summed, or the key that is
    counted once."""
    name: str
    row: Callable[[], Column]
    sql: str
    cols: frozenset = field(default_factory=frozenset)
    kind: str = "count"          # count | money | distinct | date

    @property
    def how(self) -> str:
        """How contributions are combined (`operators.distinct`)."""
        return {"count": "count", "money": "sum", "date": "max"}[self.kind]

    def spark(self) -> Column:
        return _distinct(self.row()) if self.kind == "distinct" else FIRST[self.how](self.row())


def _c(name):
    return F.col(name)


APPROX_CONF = "spendframe.approxDistinct"     # relative error, e.g. 0.01; unset = exact


def _distinct(c) -> Column:
    """Exact distinct count by default.  With ``spendframe.approxDistinct`` set (the
    relative standard deviation), a HyperLogLog++ sketch per group instead: no Expand of
    the input, a fixed-size partial per group - the choice at 100 TB when an estimate
    will do.  Registered queries run exact."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    rsd = spark.conf.get(APPROX_CONF, None) if spark is not None else None
    return F.approx_count_distinct(c, float(rsd)) if rsd else F.countDistinct(c)


def AMT_():
    return F.col("amount")


PARTS: dict[str, Part] = {p.name: p for p in [
    Part("n", lambda: F.lit(1), "count(*)"),
    Part("n_ok", lambda: F.when(_c("ok"), 1), "count(*) FILTER (WHERE ok)", frozenset({"ok"})),
    Part("n_decl", lambda: F.when(~_c("ok"), 1), "count(*) FILTER (WHERE NOT ok)",
         frozenset({"ok"})),
    Part("spend", lambda: F.when(_c("ok"), AMT_()), "sum(amount) FILTER (WHERE ok)",
         frozenset({"ok", "amount"}), "money"),
    Part("attempted", lambda: AMT_(), "sum(amount)", frozenset({"amount"}), "money"),
    Part("purchase_value", lambda: F.when(_c("ok") & (AMT_() > 0), AMT_()),
         "sum(amount) FILTER (WHERE ok AND amount > 0)", frozenset({"ok", "amount"}), "money"),
    Part("n_purchase", lambda: F.when(_c("ok") & (AMT_() > 0), 1),
         "count(*) FILTER (WHERE ok AND amount > 0)", frozenset({"ok", "amount"})),
    Part("n_refund", lambda: F.when(_c("ok") & (AMT_() < 0), 1),
         "count(*) FILTER (WHERE ok AND amount < 0)", frozenset({"ok", "amount"})),
    Part("refund_value", lambda: F.when(_c("ok") & (AMT_() < 0), AMT_()),
         "sum(amount) FILTER (WHERE ok AND amount < 0)", frozenset({"ok", "amount"}), "money"),
    Part("cards", lambda: F.col("card_key"), "count(DISTINCT card_key)",
         frozenset({"card_key"}), "distinct"),
    Part("clients", lambda: F.col("client_key"), "count(DISTINCT client_key)",
         frozenset({"client_key"}), "distinct"),
    Part("n_lab", lambda: F.when(_c("lab"), 1), "count(*) FILTER (WHERE lab)", frozenset({"lab"})),
    Part("n_fr", lambda: F.when(_c("fr"), 1), "count(*) FILTER (WHERE fr)", frozenset({"fr"})),
    Part("fraud_value", lambda: F.when(_c("fr"), AMT_()), "sum(amount) FILTER (WHERE fr)",
         frozenset({"fr", "amount"}), "money"),
    Part("labelled_value", lambda: F.when(_c("lab"), AMT_()), "sum(amount) FILTER (WHERE lab)",
         frozenset({"lab", "amount"}), "money"),
    Part("fraud_cards", lambda: F.when(_c("fr"), _c("card_key")),
         "count(DISTINCT card_key) FILTER (WHERE fr)", frozenset({"fr", "card_key"}), "distinct"),
    Part("n_chip", lambda: F.when(_c("channel") == CHIP_CHANNEL, 1),
         f"count(*) FILTER (WHERE channel = '{CHIP_CHANNEL}')", frozenset({"channel"})),
    Part("n_online", lambda: F.when(_c("channel") == ONLINE_CHANNEL, 1),
         f"count(*) FILTER (WHERE channel = '{ONLINE_CHANNEL}')", frozenset({"channel"})),
    Part("n_cnp", lambda: F.when(_c("channel_type") == "Card not present", 1),
         "count(*) FILTER (WHERE channel_type = 'Card not present')", frozenset({"channel_type"})),
    Part("n_tech", lambda: F.when(_c("outcome_class") == "Declined - technical", 1),
         "count(*) FILTER (WHERE outcome_class = 'Declined - technical')",
         frozenset({"outcome_class"})),
    Part("declined_value", lambda: F.when(~_c("ok"), AMT_()),
         "sum(amount) FILTER (WHERE NOT ok)", frozenset({"ok", "amount"}), "money"),
    Part("spend_lfl", lambda: F.when(_c("ok") & (_c("in_lfl") == "Yes"), AMT_()),
         "sum(amount) FILTER (WHERE ok AND in_lfl = 'Yes')",
         frozenset({"ok", "amount", "in_lfl"}), "money"),
    Part("n_ok_lfl", lambda: F.when(_c("ok") & (_c("in_lfl") == "Yes"), 1),
         "count(*) FILTER (WHERE ok AND in_lfl = 'Yes')", frozenset({"ok", "in_lfl"})),
    Part("last_date", lambda: F.col("date"), "max(date)", frozenset({"date"}), "date"),
]}


@dataclass(frozen=True)
class Measure:
    key: str
    title: str                       # the model's measure name
    parts: tuple = ()
    derive: Callable | None = None   # dict[str, Column] -> Column
    sql: str | None = None           # SQL over att, aggregate form
    kind: str = "count"              # count | money | ratio | date | text
    special: str | None = None       # planned by query.py


def _p(name):
    return lambda c: c[name]


def _r(num, den, scale=None):
    return lambda c: ratio(c[num], c[den], scale)


def _sqlr(num_sql, den_sql, scale=None):
    s = f"CAST({num_sql} AS DOUBLE) / NULLIF(CAST({den_sql} AS DOUBLE), 0)"
    return f"({s}) * {scale}" if scale else s


P = {k: v.sql for k, v in PARTS.items()}

MEASURES: dict[str, Measure] = {m.key: m for m in [
    Measure("transactions", "Transactions", ("n",), _p("n"), P["n"]),
    Measure("approved_transactions", "Approved Transactions", ("n_ok",), _p("n_ok"), P["n_ok"]),
    Measure("declined_transactions", "Declined Transactions", ("n_decl",), _p("n_decl"),
            P["n_decl"]),
    Measure("decline_rate", "Decline Rate %", ("n_decl", "n"), _r("n_decl", "n"),
            _sqlr(P["n_decl"], P["n"]), "ratio"),
    Measure("spend", "Spend", ("spend",), _p("spend"), P["spend"], "money"),
    Measure("attempted_value", "Attempted Value", ("attempted",), _p("attempted"), P["attempted"],
            "money"),
    Measure("purchase_value", "Purchase Value", ("purchase_value",), _p("purchase_value"),
            P["purchase_value"], "money"),
    Measure("refunds", "Refunds", ("n_refund",), _p("n_refund"), P["n_refund"]),
    Measure("refund_value", "Refund Value", ("refund_value",), _p("refund_value"),
            P["refund_value"], "money"),
    Measure("refund_rate", "Refund Rate %", ("n_refund", "n_ok"), _r("n_refund", "n_ok"),
            _sqlr(P["n_refund"], P["n_ok"]), "ratio"),
    Measure("average_transaction", "Average Transaction", ("purchase_value", "n_purchase"),
            _r("purchase_value", "n_purchase"), _sqlr(P["purchase_value"], P["n_purchase"]),
            "ratio"),
    Measure("active_cards", "Active Cards", ("cards",), _p("cards"), P["cards"]),
    Measure("active_clients", "Active Clients", ("clients",), _p("clients"), P["clients"]),
    Measure("transactions_per_card", "Transactions per Card", ("n_ok", "cards"),
            _r("n_ok", "cards"), _sqlr(P["n_ok"], P["cards"]), "ratio"),
    Measure("spend_per_card", "Spend per Card", ("spend", "cards"), _r("spend", "cards"),
            _sqlr(P["spend"], P["cards"]), "ratio"),
    Measure("spend_per_client", "Spend per Client", ("spend", "clients"), _r("spend", "clients"),
            _sqlr(P["spend"], P["clients"]), "ratio"),
    Measure("total_credit_limit", "Total Credit Limit", kind="money", special="credit_limit"),
    Measure("years_in_period", "Years in Period", kind="ratio", special="years"),
    Measure("annual_spend_to_limit", "Annual Spend to Limit", ("spend",), kind="ratio",
            special="annual_to_limit"),
    Measure("labelled_transactions", "Labelled Transactions", ("n_lab",), _p("n_lab"), P["n_lab"]),
    Measure("label_coverage", "Label Coverage %", ("n_lab", "n"), _r("n_lab", "n"),
            _sqlr(P["n_lab"], P["n"]), "ratio"),
    Measure("fraud_transactions", "Fraud Transactions", ("n_fr",), _p("n_fr"), P["n_fr"]),
    Measure("fraud_rate_10k", "Fraud Rate per 10k", ("n_fr", "n_lab"), _r("n_fr", "n_lab", 10000),
            _sqlr(P["n_fr"], P["n_lab"], 10000), "ratio"),
    Measure("fraud_rate_10k_all", "Fraud Rate per 10k (all rows)", ("n_fr", "n"),
            _r("n_fr", "n", 10000), _sqlr(P["n_fr"], P["n"], 10000), "ratio"),
    Measure("fraud_value", "Fraud Value", ("fraud_value",), _p("fraud_value"), P["fraud_value"],
            "money"),
    Measure("fraud_value_share", "Fraud Value Share", ("fraud_value", "labelled_value"),
            _r("fraud_value", "labelled_value"), _sqlr(P["fraud_value"], P["labelled_value"]),
            "ratio"),
    Measure("cards_hit_by_fraud", "Cards Hit by Fraud", ("fraud_cards",), _p("fraud_cards"),
            P["fraud_cards"]),
    Measure("average_fraud_transaction", "Average Fraud Transaction", ("fraud_value", "n_fr"),
            _r("fraud_value", "n_fr"), _sqlr(P["fraud_value"], P["n_fr"]), "ratio"),
    Measure("channel_share", "Channel Share %", ("n",), kind="ratio", special="share:channel"),
    Measure("chip_share", "Chip Share %", ("n_chip", "n"), _r("n_chip", "n"),
            _sqlr(P["n_chip"], P["n"]), "ratio"),
    Measure("online_share", "Online Share %", ("n_online", "n"), _r("n_online", "n"),
            _sqlr(P["n_online"], P["n"]), "ratio"),
    Measure("card_not_present_share", "Card Not Present Share %", ("n_cnp", "n"),
            _r("n_cnp", "n"), _sqlr(P["n_cnp"], P["n"]), "ratio"),
    Measure("decline_share_of_class", "Decline Share of Class", ("n_decl",), kind="ratio",
            special="share:outcome"),
    Measure("technical_decline_rate", "Technical Decline Rate %", ("n_tech", "n"),
            _r("n_tech", "n"), _sqlr(P["n_tech"], P["n"]), "ratio"),
    Measure("declined_value", "Declined Value", ("declined_value",), _p("declined_value"),
            P["declined_value"], "money"),
    Measure("spend_py", "Spend PY", kind="money", special="py:spend"),
    Measure("spend_yoy", "Spend YoY %", ("spend",), kind="ratio", special="yoy:spend"),
    Measure("spend_lfl", "Spend LFL", ("spend_lfl",), _p("spend_lfl"), P["spend_lfl"], "money"),
    Measure("spend_lfl_py", "Spend LFL PY", kind="money", special="py:spend_lfl"),
    Measure("spend_lfl_yoy", "Spend LFL YoY %", ("spend_lfl",), kind="ratio",
            special="yoy:spend_lfl"),
    Measure("transactions_lfl", "Transactions LFL", ("n_ok_lfl",), _p("n_ok_lfl"), P["n_ok_lfl"]),
    Measure("transactions_lfl_py", "Transactions LFL PY", kind="count", special="py:n_ok_lfl"),
    Measure("transactions_lfl_yoy", "Transactions LFL YoY %", ("n_ok_lfl",), kind="ratio",
            special="yoy:n_ok_lfl"),
    Measure("spend_12m", "Spend 12M", kind="money", special="trailing12"),
    Measure("spend_share", "Spend Share", ("spend",), kind="ratio", special="share:spend"),
    Measure("category_rank", "Category Rank", ("spend",), kind="count", special="rank:category"),
    Measure("location_rank", "Location Rank", ("spend",), kind="count", special="rank:location"),
    Measure("report_period", "Report Period", kind="text", special="period"),
    Measure("latest_transaction", "Latest Transaction", ("last_date",), _p("last_date"),
            P["last_date"], "date"),
]}

# Columns of each dimension table (cleared for share denominators).
DIM_COLUMNS = {
    "channel": {"channel", "channel_type"},
    "outcome": {"outcome", "outcome_class", "outcome_key", "is_approved", "errors"},
    "category": {"mcc", "category", "category_group"},
    "geography": {"location", "location_type", "state_code", "country", "merchant_state"},
    "card": {"card_key", "credit_limit", "credit_limit_band", "credit_limit_band_sort",
             "card_brand", "card_type", "has_chip"},
    "client": {"client_key", "credit_score", "credit_score_band", "credit_score_band_sort",
               "income_band", "income_band_sort", "age_band", "age_band_sort"},
}
SHARE_CLEARS = {
    "share:channel": ("n", DIM_COLUMNS["channel"]),
    "share:outcome": ("n_decl", DIM_COLUMNS["outcome"]),
    # Spend Share clears Category, Geography, Card, Client, Channel; not Date/Outcome/Fraud.
    "share:spend": ("spend", DIM_COLUMNS["category"] | DIM_COLUMNS["geography"] |
                    DIM_COLUMNS["card"] | DIM_COLUMNS["client"] | DIM_COLUMNS["channel"]),
}
RANK_OVER = {"rank:category": "category", "rank:location": "location"}

DATE_ATTRS = {"date", "year", "quarter", "quarter_year", "quarter_key", "month_no", "month_name",
              "month_short", "month_year", "month_year_sort", "month_start", "month",
              "day_of_week", "day_name", "is_weekend", "in_lfl", "in_lfl_day",
              "is_complete_year"}


def output_cast(kind: str, c: Column) -> Column:
    if kind == "count":
        return c.cast("bigint")
    if kind in ("money", "ratio"):
        return c.cast("double")
    return c
