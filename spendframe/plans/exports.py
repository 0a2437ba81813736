"""Aggregate export (X1 web sections, S10 JSON sink) and the aggregate / data-quality
jobs (A2-A14, X2, X3, J12).  Each section is one grouped aggregate over the star;
the JSON document is written one row per line, never assembled on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendframe.functions import constants as K
from spendframe.functions.scalar import ratio
from spendframe.operators import distinct
from spendframe.operators.joins import with_scalars
from spendframe.plans.binding import CHIP_CHANNEL, ONLINE_CHANNEL
from spendframe.plans.measures import APPROX_CONF, PARTS
from spendframe.plans.oracle import with_ctes
from spendframe.plans.query import Model
from spendframe.plans.registry import register

FIG_COLS = {"ok", "amount", "lab", "fr"}


def figure_aggs() -> list:
    return [F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("approved"),
            F.sum(F.when(F.col("ok"), F.col("amount"))).alias("_spend"),
            F.count_if("lab").alias("labelled"), F.count_if("fr").alias("fraud")]


def figure_cols() -> list:
    """n, approved, spend (2 dp), decline (6 dp), labelled, fraud, per10k, per10k_naive
    (1 dp); a rate with no denominator reads 0, as the export writes it."""
    n, a = F.col("n"), F.col("approved")
    return ["n", "approved",
            F.round(F.coalesce(F.col("_spend"), F.lit(0)), 2).cast("double").alias("spend"),
            F.coalesce(F.round(1 - ratio(a, n), 6), F.lit(0.0)).alias("decline"),
            "labelled", "fraud",
            F.coalesce(F.round(ratio(F.col("fraud"), F.col("labelled"), 10000), 1), F.lit(0.0))
             .alias("per10k"),
            F.coalesce(F.round(ratio(F.col("fraud"), n, 10000), 1), F.lit(0.0))
             .alias("per10k_naive")]


FIG_SQL = ("count(*) AS n, count(*) FILTER (WHERE ok) AS approved, "
           "CAST(round(coalesce(sum(amount) FILTER (WHERE ok), 0), 2) AS DOUBLE) AS spend, "
           "coalesce(round(1 - CAST(count(*) FILTER (WHERE ok) AS DOUBLE) / NULLIF(count(*), 0), 6), 0)"
           " AS decline, count(*) FILTER (WHERE lab) AS labelled, count(*) FILTER (WHERE fr) AS fraud, "
           "coalesce(round(CAST(count(*) FILTER (WHERE fr) AS DOUBLE) / "
           "NULLIF(count(*) FILTER (WHERE lab), 0) * 10000, 1), 0) AS per10k, "
           "coalesce(round(CAST(count(*) FILTER (WHERE fr) AS DOUBLE) / NULLIF(count(*), 0) * 10000, 1), 0)"
           " AS per10k_naive")


# the section figures as measure parts (all additive): part -> figure name
FIG_PARTS = {"n": "n", "n_ok": "approved", "spend": "_spend", "n_lab": "labelled",
             "n_fr": "fraud"}


#: Keys of few values by which the figures of most sections add up.
CELL_KEYS = ["month_year_sort", "channel", "hour", "outcome_key"]


def cell_columns() -> dict:
    """The sections' own keys as functions of CELL_KEYS."""
    month, key = F.col("month_year_sort"), F.col("outcome_key")
    outcomes = [K.APPROVED_OUTCOME, *[(label, cls) for _, label, cls in K.ERROR_CLASS], K.MULTIPLE_OUTCOME]
    of = lambda i: F.element_at(F.array(*[F.lit(o[i]) for o in outcomes]), key + 1)
    year = F.floor(month / 100).cast("bigint")
    return {"year": year, "ok": key == 0, "outcome": of(0), "outcome_class": of(1),
            "month": F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit("-"),
                              F.lpad((month % 100).cast("string"), 2, "0"))}


def _m(spark, src) -> Model:
    """``src``: a directory, or the model that several sections share."""
    return src if isinstance(src, Model) else Model(spark, src)


def _section(spark, src, key, key_name):
    """One export section: the figures by one key, through the model's rollup (eager
    below a dimension too large to broadcast)."""
    g = _m(spark, src).rollup([key], list(FIG_PARTS), None)
    return g.select(F.col(key).alias(key_name),
                    *[F.col(p).alias(a) for p, a in FIG_PARTS.items()]).select(
        key_name, *figure_cols())


@register("x_by_year", with_ctes(f"SELECT year, {FIG_SQL} FROM att GROUP BY year"))
def x_by_year(spark, src):
    return _section(spark, src, "year", "year")


@register("x_by_channel", with_ctes(f"SELECT channel, {FIG_SQL} FROM att GROUP BY channel"))
def x_by_channel(spark, src):
    return _section(spark, src, "channel", "channel")


@register("x_by_category", with_ctes(
    f"SELECT category_group AS category, {FIG_SQL} FROM att GROUP BY category_group"))
def x_by_category(spark, src):
    return _section(spark, src, "category_group", "category").orderBy(F.col("spend").desc())


@register("x_by_loctype", with_ctes(
    f"SELECT location_type AS location, {FIG_SQL} FROM att GROUP BY location_type"))
def x_by_loctype(spark, src):
    return _section(spark, src, "location_type", "location")


BY_OUTCOME_SQL = with_ctes("SELECT outcome, outcome_class AS cls, count(*) AS n FROM att "
                           "WHERE NOT ok GROUP BY outcome, outcome_class")


def _by_outcome(spark, src):
    """Declined rows by outcome with its class (class is functionally dependent on
    the outcome, so it is a second group key rather than a 'first value')."""
    g = _m(spark, src).rollup(["ok", "outcome", "outcome_class"], ["n"], None)
    return (g.where(~F.col("ok")).select("outcome", F.col("outcome_class").alias("cls"), "n")
            .orderBy(F.col("n").desc()))


register("x_by_outcome", BY_OUTCOME_SQL)(_by_outcome)
register("by_outcome", BY_OUTCOME_SQL)(_by_outcome)


@register("x_spend_by_month", with_ctes(
    "SELECT month, CAST(round(sum(amount), 2) AS DOUBLE) AS value FROM att WHERE ok GROUP BY month"))
def x_spend_by_month(spark, src):
    g = _m(spark, src).rollup(["month"], ["n_ok", "spend"], None)
    return (g.where("n_ok > 0").select("month", F.round("spend", 2).cast("double").alias("value"))
            .orderBy("month"))


@register("x_by_hour", with_ctes("SELECT hour, count(*) AS value FROM att WHERE ok GROUP BY hour"))
def x_by_hour(spark, src):
    """X1 by_hour: approved transactions by the hour of the fact."""
    g = _m(spark, src).rollup(["hour"], ["n_ok"], None)
    return g.where("n_ok > 0").select("hour", F.col("n_ok").alias("value")).orderBy("hour")


@register("x_by_credit_band", with_ctes(
    "SELECT credit_score_band AS band, credit_score_band_sort AS sort, "
    f"count(DISTINCT client_key) AS clients, {FIG_SQL} FROM att "
    "GROUP BY credit_score_band, credit_score_band_sort"))
def x_by_credit_band(spark, src):
    """X1 by_credit_band / J11: the client band joined on the (renamed) client key; through
    the model's rollup (eager below a client dimension too large to broadcast)."""
    g = _m(spark, src).rollup(["credit_score_band", "credit_score_band_sort"],
                              [*FIG_PARTS, "clients"], None)
    return (g.select(F.col("credit_score_band").alias("band"),
                     F.col("credit_score_band_sort").alias("sort"), "clients",
                     *[F.col(p).alias(a) for p, a in FIG_PARTS.items()])
            .select("band", "sort", "clients", *figure_cols()).orderBy("sort"))


register("by_credit_band", with_ctes(
    "SELECT credit_score_band AS band, credit_score_band_sort AS sort, "
    f"count(DISTINCT client_key) AS clients, {FIG_SQL} FROM att "
    "GROUP BY credit_score_band, credit_score_band_sort"))(x_by_credit_band)


@register("x_totals", with_ctes(
    f"SELECT {FIG_SQL}, count(DISTINCT client_key) AS clients, "
    "count(DISTINCT card_key) AS cards_active, (SELECT count(*) FROM supplier) AS cards_on_file, "
    "CAST(round(sum(amount), 2) AS DOUBLE) AS attempted_value, "
    "round(CAST(sum(amount) FILTER (WHERE ok AND amount > 0) AS DOUBLE) / "
    "NULLIF(count(*) FILTER (WHERE ok AND amount > 0), 0), 2) AS avg_purchase, "
    "round(CAST(count(*) FILTER (WHERE ok AND amount < 0) AS DOUBLE) / "
    "NULLIF(count(*) FILTER (WHERE ok), 0), 6) AS refund_share, "
    "strftime(min(date), '%Y-%m-%d') AS first, strftime(max(date), '%Y-%m-%d') AS last, "
    "CAST(round(sum(amount) - coalesce(sum(amount) FILTER (WHERE ok), 0), 2) AS DOUBLE) "
    "AS overstatement FROM att"))
def x_totals(spark, src):
    """X1 totals (+ A2, A11): headline figures, distinct clients/cards, value ranges."""
    m = _m(spark, src)
    f = m.fact(FIG_COLS | {"client_key", "card_key", "date"})
    parts = {**{a: p for p, a in FIG_PARTS.items()}, "_att": "attempted", "_pv": "purchase_value", "_pn": "n_purchase",
             "_rn": "n_refund"}
    values = {**{a: (PARTS[p].row(), PARTS[p].how) for a, p in parts.items()},
              "_first": (F.col("date"), "min"), "_last": (F.col("date"), "max")}
    keys = {"clients": F.col("client_key"), "cards_active": F.col("card_key")}
    how = {a: h for a, (_, h) in values.items()}
    g = distinct.counted(distinct.pair_rollup(f, [], keys, values), [], list(keys), how)
    # a total over no rows is a row of zeros
    g = g.withColumns({a: F.coalesce(a, F.lit(0)) for a, h in how.items() if h == "count"})
    cards = m.star.t.supplier.agg(F.count(F.lit(1)).alias("cards_on_file"))
    g = with_scalars(g, cards)      # both sides are global aggregates: one row each
    return g.select(
        *figure_cols(), "clients", "cards_active", "cards_on_file",
        F.round(F.col("_att"), 2).cast("double").alias("attempted_value"),
        F.round(ratio(F.col("_pv"), F.col("_pn")), 2).alias("avg_purchase"),
        F.round(ratio(F.col("_rn"), F.col("approved")), 6).alias("refund_share"),
        F.date_format("_first", "yyyy-MM-dd").alias("first"),
        F.date_format("_last", "yyyy-MM-dd").alias("last"),
        F.round(F.col("_att") - F.coalesce(F.col("_spend"), F.lit(0)), 2).cast("double")
         .alias("overstatement"))


@register("totals", with_ctes(
    f"SELECT {FIG_SQL}, strftime(min(date), '%Y-%m-%d') AS first, "
    "strftime(max(date), '%Y-%m-%d') AS last FROM att"))
def totals(spark, src):
    """A2 + A11: the grand total figures (no keys) and the date range."""
    f = Model(spark, src).fact(FIG_COLS | {"date"})
    return f.agg(*figure_aggs(), F.min("date").alias("_f"), F.max("date").alias("_l")).select(
        *figure_cols(), F.date_format("_f", "yyyy-MM-dd").alias("first"),
        F.date_format("_l", "yyyy-MM-dd").alias("last"))


# ---------------------------------------------------------------- channel mixes
@register("channel_mix_by_year", with_ctes(
    "SELECT year, channel, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY year), 4)"
    " AS share FROM att GROUP BY year, channel"))
def channel_mix_by_year(spark, src):
    """A5: year x channel counts, row-normalised (share within the year)."""
    f = Model(spark, src).fact({"year", "channel"})
    c = f.groupBy("year", "channel").agg(F.count(F.lit(1)).alias("_n"))
    t = c.groupBy("year").agg(F.sum("_n").alias("_t"))     # re-aggregate the small result
    return c.join(t, "year").select("year", "channel",
                                    F.round(F.col("_n") / F.col("_t"), 4).alias("share"))


CHANNELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _pivot_month_channel(spark, src) -> DataFrame:
    g = _m(spark, src).rollup(["month", "channel"], ["n"], None)
    # The channels are fixed values, so no job looks for them; missing cells -> 0.
    return g.groupBy("month").pivot("channel", CHANNELS).agg(F.sum("n")).na.fill(0)


@register("channel_by_month", with_ctes(
    "SELECT month, " + ", ".join(f"count(*) FILTER (WHERE channel = '{c}') AS \"{c}\""
                                 for c in CHANNELS) + " FROM att GROUP BY month"))
def channel_by_month(spark, src):
    """Month x channel counts, one column per channel, zero-filled."""
    return _pivot_month_channel(spark, src)


@register("x_channel_by_month", with_ctes(
    "SELECT month, " + ", ".join(
        f"round(CAST(count(*) FILTER (WHERE channel = '{c}') AS DOUBLE) / count(*), 4) AS \"{c}\""
        for c in CHANNELS) + " FROM att GROUP BY month"))
def x_channel_by_month(spark, src):
    """X1 channel_by_month: each channel's share of the month's attempts, 4 dp."""
    p = _pivot_month_channel(spark, src)
    chans = [c for c in p.columns if c != "month"]
    total = sum((F.col(f"`{c}`") for c in chans), F.lit(0))
    return p.select("month", *[F.round(F.col(f"`{c}`") / total, 4).alias(c) for c in chans])


# ---------------------------------------------------------------- A7 step change + J12
@register("step_change", with_ctes(
    "SELECT (SELECT min(month) FROM s WHERE share > 0) AS first_chip_month, "
    "(SELECT max(month) FROM s WHERE share = 0) AS last_month_without_chip, "
    "(SELECT round(share, 4) FROM s WHERE month = (SELECT max(month) FROM s WHERE share = 0)) "
    "AS share_month_before, "
    "(SELECT round(share, 4) FROM s WHERE month = (SELECT min(month) FROM s WHERE share > 0)) "
    "AS share_first_month, "
    "(SELECT count(*) FROM att WHERE channel = '" + CHIP_CHANNEL + "' AND has_chip = 'No chip') "
    "AS chip_rows_on_cards_without_a_chip",
    "s AS (SELECT month, CAST(count(*) FILTER (WHERE channel = '" + CHIP_CHANNEL + "') AS DOUBLE) "
    "/ count(*) AS share FROM att GROUP BY month)"))
def step_change(spark, src):
    """Chip is switched on, not phased in: first month with chip share > 0, last month
    at 0, the shares either side; with J12 (chip rows on cards without a chip)."""
    m = Model(spark, src)
    f = m.fact({"month", "channel"})
    s = f.groupBy("month").agg(
        (F.count_if(F.col("channel") == CHIP_CHANNEL) / F.count(F.lit(1))).alias("share"))
    g = s.agg(F.min(F.when(F.col("share") > 0, F.col("month"))).alias("first_chip_month"),
              F.max(F.when(F.col("share") == 0, F.col("month"))).alias("last_month_without_chip"),
              F.max_by(F.when(F.col("share") == 0, F.col("share")),
                       F.when(F.col("share") == 0, F.col("month"))).alias("_before"),
              F.min_by(F.when(F.col("share") > 0, F.col("share")),
                       F.when(F.col("share") > 0, F.col("month"))).alias("_first"))
    chip = chip_consistency(spark, src)
    return with_scalars(g, chip).select(
        "first_chip_month", "last_month_without_chip",
        F.round("_before", 4).alias("share_month_before"),
        F.round("_first", 4).alias("share_first_month"), "chip_rows_on_cards_without_a_chip")


@register("chip_consistency", with_ctes(
    "SELECT count(*) AS chip_rows_on_cards_without_a_chip FROM att "
    f"WHERE channel = '{CHIP_CHANNEL}' AND has_chip = 'No chip'"))
def chip_consistency(spark, src):
    """Chip-channel rows on cards recorded without a chip (must be 0 in clean data)."""
    g = Model(spark, src).rollup([], ["n"], {"channel": CHIP_CHANNEL, "has_chip": "No chip"})
    return g.select(F.col("n").alias("chip_rows_on_cards_without_a_chip"))


# ---------------------------------------------------------------- A8, A9, A12, A13, A3
@register("overstatement", with_ctes(
    "SELECT count(*) FILTER (WHERE ok) AS sample_approved, count(*) FILTER (WHERE NOT ok) "
    "AS sample_declined, round(CAST(count(*) FILTER (WHERE NOT ok) AS DOUBLE) / count(*), 6) "
    "AS decline_rate, CAST(round(sum(amount) FILTER (WHERE ok), 2) AS DOUBLE) AS spend_approved, "
    "CAST(round(sum(amount), 2) AS DOUBLE) AS spend_all_rows, "
    "CAST(round(sum(amount) - sum(amount) FILTER (WHERE ok), 2) AS DOUBLE) AS overstatement "
    "FROM att"))
def overstatement(spark, src):
    """What summing attempted amounts over declined rows would overstate."""
    f = Model(spark, src).fact({"ok", "amount"})
    g = f.agg(F.count_if("ok").alias("sample_approved"), F.count_if(~F.col("ok"))
              .alias("sample_declined"), F.sum(F.when(F.col("ok"), F.col("amount"))).alias("_s"),
              F.sum("amount").alias("_a"), F.count(F.lit(1)).alias("_n"))
    return g.select("sample_approved", "sample_declined",
                    F.round(F.col("sample_declined") / F.col("_n"), 6).alias("decline_rate"),
                    F.round("_s", 2).cast("double").alias("spend_approved"),
                    F.round("_a", 2).cast("double").alias("spend_all_rows"),
                    F.round(F.col("_a") - F.col("_s"), 2).cast("double").alias("overstatement"))


@register("null_profile", with_ctes(
    "SELECT count(*) FILTER (WHERE merchant_state IS NULL) AS state_null_rows, "
    f"count(*) FILTER (WHERE merchant_state IS NULL AND channel = '{ONLINE_CHANNEL}') "
    "AS state_null_and_online, "
    f"count(*) FILTER (WHERE merchant_state IS NULL AND channel <> '{ONLINE_CHANNEL}') "
    "AS state_null_not_online FROM att"))
def null_profile(spark, src):
    """A null location is mostly 'online' but not only."""
    f = Model(spark, src).fact({"merchant_state", "channel"})
    nul = F.col("merchant_state").isNull()
    on = F.col("channel") == ONLINE_CHANNEL
    return f.agg(F.count_if(nul).alias("state_null_rows"),
                 F.count_if(nul & on).alias("state_null_and_online"),
                 F.count_if(nul & ~on).alias("state_null_not_online"))


@register("top_codes_not_recorded", with_ctes(
    "SELECT category, count(*) AS n FROM att WHERE location_type = 'Not recorded' "
    "GROUP BY category ORDER BY n DESC, category LIMIT 5"))
def top_codes_not_recorded(spark, src):
    """Top-5 categories among not-recorded-location rows (ties broken by name)."""
    g = Model(spark, src).rollup(["category"], ["n"], {"location_type": "Not recorded"})
    return g.orderBy(F.col("n").desc(), "category").limit(5)


@register("value_counts", with_ctes(
    "SELECT 'errors' AS column_name, errors AS value, count(*) AS n FROM att "
    "WHERE errors IS NOT NULL GROUP BY errors "
    "UNION ALL SELECT 'channel', channel, count(*) FROM att GROUP BY channel"))
def value_counts(spark, src):
    """A3: value counts of the error text and of the channel column."""
    f = Model(spark, src).fact({"errors", "channel"})
    both = f.groupBy("errors", "channel").agg(F.count(F.lit(1)).alias("n"))     # one scan, few rows
    values = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in ("errors", "channel")])
    return (both.select(F.inline(values), "n").where((F.col("column_name") != "errors") | F.col("value").isNotNull())
            .groupBy("column_name", "value").agg(F.sum("n").alias("n")))


@register("by_channel_rollup", with_ctes(
    "SELECT channel, count(*) AS transactions, CAST(sum(amount) FILTER (WHERE ok) AS DOUBLE) "
    "AS spend FROM att GROUP BY ROLLUP (channel)"))
def by_channel_rollup(spark, src):
    """A subtotal row (channel null) under the per-channel rows."""
    f = Model(spark, src).fact({"channel", "ok", "amount"})
    return f.rollup("channel").agg(F.count(F.lit(1)).alias("transactions"),
                                   F.sum(F.when(F.col("ok"), F.col("amount"))).cast("double")
                                   .alias("spend"))


@register("daily_spend", with_ctes(
    "SELECT date, CAST(sum(amount) AS DOUBLE) AS spend FROM att WHERE ok GROUP BY date"))
def daily_spend(spark, src):
    """Decimal-exact daily spend (the calendar's answer key)."""
    f = Model(spark, src).fact({"date", "ok", "amount"})
    return f.where("ok").groupBy("date").agg(F.sum("amount").cast("double").alias("spend"))


@register("column_cardinality", with_ctes(
    "SELECT * FROM (VALUES ('client_key', (SELECT count(DISTINCT client_key) FROM att)), "
    "('card_key', (SELECT count(DISTINCT card_key) FROM att)), "
    "('mcc', (SELECT count(DISTINCT mcc) FROM att)), "
    "('channel', (SELECT count(DISTINCT channel) FROM att)), "
    "('errors', (SELECT count(DISTINCT errors) FROM att)), "
    "('date', (SELECT count(DISTINCT date) FROM att))) AS t(column_name, distinct_count)"))
def column_cardinality(spark, src):
    """A4: distinct count per column, melted to (column, count): exact from pairs of a column
    and a value, or estimated from one sketch per column (``spendframe.approxDistinct``)."""
    cols = ["client_key", "card_key", "mcc", "channel", "errors", "date"]
    f = Model(spark, src).fact(set(cols))
    keys = {c: F.col(c) for c in cols}
    error = spark.conf.get(APPROX_CONF, None)
    g = (distinct.estimated(distinct.sketch_rollup(f, [], keys, {}, float(error)), [], cols, {}) if error
         else distinct.counted(distinct.pair_rollup(f, [], keys), [], cols, {}))
    stack = "stack({}, {}) as (column_name, distinct_count)".format(
        len(cols), ", ".join(f"'{c}', {c}" for c in cols))
    return g.selectExpr(stack)


@register("state_column_audit", with_ctes(
    "SELECT count(DISTINCT merchant_state) AS distinct_values, "
    "count(DISTINCT merchant_state) FILTER (WHERE length(merchant_state) <> 2) AS country_names, "
    "count(*) FILTER (WHERE merchant_state IS NULL) AS null_rows, "
    "count(*) FILTER (WHERE merchant_state = 'Georgia') AS georgia_the_country, "
    "count(*) FILTER (WHERE merchant_state = 'GA') AS ga_the_us_state FROM att"))
def state_column_audit(spark, src):
    """The mixed-meaning location column: codes vs country names vs nulls."""
    f = Model(spark, src).fact({"merchant_state"})
    s = F.col("merchant_state")
    return f.agg(F.countDistinct(s).alias("distinct_values"),
                 F.countDistinct(F.when(F.length(s) != 2, s)).alias("country_names"),
                 F.count_if(s.isNull()).alias("null_rows"),
                 F.count_if(s == "Georgia").alias("georgia_the_country"),
                 F.count_if(s == "GA").alias("ga_the_us_state"))


# ---------------------------------------------------------------- S10 web export (JSON lines)
_RATES = [("n", "int"), ("approved", "int"), ("spend", "num"), ("decline", "num"), ("labelled", "int"),
          ("fraud", "int"), ("per10k", "num"), ("per10k_naive", "num")]
#: Columns of each section in order: whole numbers, numbers (written with 6 decimals) or text.
SECTION_COLUMNS = {
    "x_totals": _RATES + [("clients", "int"), ("cards_active", "int"), ("cards_on_file", "int"),
                          ("attempted_value", "num"), ("avg_purchase", "num"), ("refund_share", "num"),
                          ("first", "text"), ("last", "text"), ("overstatement", "num")],
    "x_by_year": [("year", "int"), *_RATES],
    "x_by_channel": [("channel", "text"), *_RATES],
    "x_by_category": [("category", "text"), *_RATES],
    "x_by_loctype": [("location", "text"), *_RATES],
    "x_by_outcome": [("outcome", "text"), ("cls", "text"), ("n", "int")],
    "x_spend_by_month": [("month", "text"), ("value", "num")],
    "x_by_hour": [("hour", "int"), ("value", "int")],
    "x_by_credit_band": [("band", "text"), ("sort", "int"), ("clients", "int"), *_RATES],
    "x_channel_by_month": [("month", "text"), *[(c, "num") for c in CHANNELS]],
    "quality_report": [("metric", "text"), ("value", "text")],
}
SECTIONS = list(SECTION_COLUMNS)


def _escaped(text: str) -> str:
    """A SQL expression of ``text`` as JSON writes it between quotes, alike in both engines:
    backslashes first, then quotes and the control characters a label can hold."""
    for code, name in ((92, None), (34, None), (10, "n"), (13, "r"), (9, "t")):
        text = f"replace({text}, chr({code}), chr(92) || {f"'{name}'" if name else f'chr({code})'})"
    return text


def _json_row(columns, quote: str) -> str:
    """A SQL expression of one JSON object, the same text for both engines but the quotes."""
    def value(c, kind):
        c = f"{quote}{c}{quote}"
        if kind == "text":
            return f"""coalesce('"' || {_escaped(f"CAST({c} AS STRING)")} || '"', 'null')"""
        if kind == "num":
            c = f"CAST({c} AS DECIMAL(38, 6))"
        return f"coalesce(CAST({c} AS STRING), 'null')"
    return "'{' || " + " || ',' || ".join(f"""'"{c}":' || {value(c, k)}""" for c, k in columns) + " || '}'"


def _section_name(query: str) -> str:
    return query.removeprefix("x_").removesuffix("_report")


def _web_export_sql() -> str:
    from spendframe.plans.registry import ORACLE
    return "\nUNION ALL\n".join(
        f"SELECT '{_section_name(q)}' AS section, {_json_row(SECTION_COLUMNS[q], chr(34))} AS row FROM ({ORACLE[q]})"
        for q in SECTIONS)


def web_export_json(spark, src):
    """Every export section, the quality report included, as JSON lines (section, row).
    Write it with ``write_web_export``; nothing is gathered on the driver.  Sections by keys of few
    values add up one rollup; the others read the fact for themselves."""
    from spendframe.plans.registry import QUERIES
    m = Model(spark, src).with_cells(CELL_KEYS, list(FIG_PARTS), cell_columns())
    parts = [QUERIES[q](spark, m if q.startswith("x_") else src).select(F.lit(_section_name(q)).alias("section"),
                                           F.expr(_json_row(SECTION_COLUMNS[q], "`")).alias("row"))
             for q in SECTIONS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_web_export(spark, src, path: str) -> None:
    """One JSON object per line, one folder per section."""
    web_export_json(spark, src).write.mode("overwrite").partitionBy("section").text(path)
