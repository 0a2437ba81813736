"""DuckDB twins of the star binding (the correctness oracle).

``ATT`` and ``DATES`` are SQL common table expressions over the driver's
pre-registered views; each oracle query is ``with_ctes(select)``.  They restate
the binding in plain SQL, independently of the DataFrame code.
"""

from __future__ import annotations

from spendframe.functions import constants as K
from spendframe.plans.binding import (CHIP_CHANNEL, ERROR_BY_LINE, NOT_PRESENT_CHANNELS,
                                      NOT_RECORDED_LINE, ONLINE_CHANNEL, STATE_REGION)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_codes = ", ".join(_q(c) for c, _ in K.US_STATES)
_states = ", ".join(f"({_q(c)}, {_q(n)})" for c, n in K.US_STATES)
_err_case = " ".join(f"WHEN {i} THEN {_q(e)}" for i, e in enumerate(ERROR_BY_LINE))
_outcome_key = " ".join(f"WHEN errors = {_q(raw)} THEN {i}"
                        for i, (raw, _, _) in enumerate(K.ERROR_CLASS, start=1))
_outcome_lab = " ".join(f"WHEN errors = {_q(raw)} THEN {_q(lab)}" for raw, lab, _ in K.ERROR_CLASS)
_outcome_cls = " ".join(f"WHEN errors = {_q(raw)} THEN {_q(c)}" for raw, _, c in K.ERROR_CLASS)
_np = ", ".join(_q(c) for c in NOT_PRESENT_CHANNELS)


def _band_sql(expr: str, edges, labels) -> tuple[str, str]:
    lab = " ".join(f"WHEN {expr} < {e} THEN {_q(l)}" for e, l in zip(edges, labels))
    srt = " ".join(f"WHEN {expr} < {e} THEN {i}" for i, e in enumerate(edges))
    return (f"CASE WHEN {expr} IS NULL THEN NULL {lab} ELSE {_q(labels[-1])} END",
            f"CASE WHEN {expr} IS NULL THEN NULL {srt} ELSE {len(edges)} END")


_sb, _sbs = _band_sql("credit_score", K.CREDIT_SCORE_EDGES, K.CREDIT_SCORE_LABELS)
_ib, _ibs = _band_sql("yearly_income", K.INCOME_EDGES, K.INCOME_LABELS)
_ab, _abs = _band_sql("age", K.AGE_EDGES, K.AGE_LABELS)
_lb, _lbs = _band_sql("credit_limit", K.LIMIT_EDGES, K.LIMIT_LABELS)

CTES = f"""
state_names AS (SELECT * FROM (VALUES {_states}) AS t(code, name)),
raw_fact AS (
  SELECT l.l_orderkey AS order_key, l.l_linenumber AS line_number,
         CAST(o.o_orderdate AS DATE) AS date,
         CAST((l.l_orderkey + 3 * l.l_linenumber) % 24 AS BIGINT) AS hour,
         o.o_custkey AS client_key, l.l_suppkey AS card_key, l.l_partkey AS mcc,
         o.o_orderpriority AS channel,
         CASE WHEN o.o_orderpriority IN ({_np}) THEN 'Card not present' ELSE 'Card present' END
           AS channel_type,
         CASE WHEN o.o_orderstatus <> 'P' THEN NULL
              ELSE CASE l.l_linenumber % 4 {_err_case} END END AS errors,
         CASE l.l_returnflag WHEN 'R' THEN 2 WHEN 'A' THEN 1 ELSE 0 END AS fraud_key,
         CASE WHEN l.l_quantity <= 2 THEN -CAST(l.l_extendedprice AS DECIMAL(12,2))
              ELSE CAST(l.l_extendedprice AS DECIMAL(12,2)) END AS amount
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
bounds AS (SELECT min(date) AS first, max(date) AS last FROM raw_fact),
dates AS (
  SELECT CAST(d AS DATE) AS date FROM bounds,
         generate_series(CAST(first AS TIMESTAMP), CAST(last AS TIMESTAMP), INTERVAL 1 DAY) AS g(d)
),
date_dim AS (
  SELECT date, CAST(year(date) AS BIGINT) AS year, CAST(month(date) AS BIGINT) AS month_no,
         strftime(date, '%b %Y') AS month_year,
         CAST(year(date) * 100 + month(date) AS BIGINT) AS month_year_sort,
         CAST(date_trunc('month', date) AS DATE) AS month_start,
         strftime(date, '%Y-%m') AS month,
         'Q' || CAST(quarter(date) AS VARCHAR) AS quarter,
         CAST(year(date) * 10 + quarter(date) AS BIGINT) AS quarter_key,
         CAST(isodow(date) AS BIGINT) AS day_of_week,
         strftime(date, '%A') AS day_name,
         CASE WHEN month(date) <= (SELECT month(last) FROM bounds) THEN 'Yes' ELSE 'No' END AS in_lfl,
         CASE WHEN year(date) < (SELECT year(last) FROM bounds) THEN 'Yes' ELSE 'No' END
           AS is_complete_year
  FROM dates
),
client_dim AS (
  SELECT c.c_custkey AS client_key,
         CASE WHEN r.r_name = {_q(STATE_REGION)}
              THEN list_extract([{_codes}], CAST(c.c_custkey % {len(K.US_STATES)} AS INTEGER) + 1)
              ELSE n.n_name END AS home_state,
         CAST(350 + floor(c.c_acctbal / 20) AS INTEGER) AS credit_score,
         CAST((c.c_acctbal + 1000) * 12 AS DECIMAL(12,2)) AS yearly_income,
         CAST(18 + c.c_custkey % 70 AS INTEGER) AS age
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
       LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
client_banded AS (
  SELECT client_key, home_state, credit_score, age, yearly_income,
         {_sb} AS credit_score_band, {_sbs} AS credit_score_band_sort,
         {_ib} AS income_band, {_ibs} AS income_band_sort,
         {_ab} AS age_band, {_abs} AS age_band_sort
  FROM client_dim
),
card_dim AS (
  SELECT s.s_suppkey AS card_key, CAST(s.s_acctbal AS DECIMAL(12,2)) AS credit_limit,
         r.r_name AS card_brand,
         CASE WHEN s.s_acctbal >= 5000 THEN 'Credit' WHEN s.s_acctbal >= 0 THEN 'Debit'
              ELSE 'Debit (Prepaid)' END AS card_type,
         CASE WHEN s.s_suppkey % 7 = 0 THEN 'No chip' ELSE 'Chip' END AS has_chip
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
       LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
card_banded AS (SELECT *, {_lb} AS credit_limit_band, {_lbs} AS credit_limit_band_sort
                FROM card_dim),
fact1 AS (
  SELECT f.*,
         CASE WHEN coalesce(errors, '') = '' THEN 0 {_outcome_key} ELSE {len(K.ERROR_CLASS) + 1} END
           AS outcome_key,
         CASE WHEN coalesce(errors, '') = '' THEN 'Approved' {_outcome_lab}
              ELSE {_q(K.MULTIPLE_OUTCOME[0])} END AS outcome,
         CASE WHEN coalesce(errors, '') = '' THEN 'Approved' {_outcome_cls}
              ELSE {_q(K.MULTIPLE_OUTCOME[1])} END AS outcome_class,
         CASE f.fraud_key WHEN 2 THEN 'Confirmed fraud' WHEN 1 THEN 'Confirmed not fraud'
              ELSE 'Not labelled' END AS fraud_status,
         CASE WHEN f.fraud_key > 0 THEN 'Yes' ELSE 'No' END AS is_labelled,
         CASE WHEN f.fraud_key = 2 THEN 'Yes' ELSE 'No' END AS is_fraud,
         f.fraud_key > 0 AS lab, f.fraud_key = 2 AS fr,
         p.p_brand AS category, p.p_type AS category_group,
         cl.age, cl.yearly_income, cl.credit_score, cl.credit_score_band, cl.credit_score_band_sort, cl.income_band,
         cl.income_band_sort, cl.age_band, cl.age_band_sort,
         CASE WHEN f.channel = {_q(ONLINE_CHANNEL)} THEN NULL
              WHEN f.line_number = {NOT_RECORDED_LINE} THEN NULL
              ELSE cl.home_state END AS merchant_state,
         cd.credit_limit, cd.credit_limit_band, cd.credit_limit_band_sort, cd.card_brand,
         cd.card_type, cd.has_chip,
         dd.year, dd.month_no, dd.month_year, dd.month_year_sort, dd.month_start, dd.month,
         dd.quarter, dd.quarter_key, dd.in_lfl, dd.is_complete_year
  FROM raw_fact f
       LEFT JOIN part p ON f.mcc = p.p_partkey
       LEFT JOIN client_banded cl ON f.client_key = cl.client_key
       LEFT JOIN card_banded cd ON f.card_key = cd.card_key
       JOIN date_dim dd ON f.date = dd.date
),
att AS (
  SELECT f.*, f.outcome_key = 0 AS ok,
         CASE WHEN f.outcome_key = 0 THEN 'Yes' ELSE 'No' END AS is_approved,
         CASE WHEN f.merchant_state IS NULL AND f.channel = {_q(ONLINE_CHANNEL)} THEN 'Online'
              WHEN f.merchant_state IS NULL THEN 'Not recorded'
              WHEN length(f.merchant_state) = 2 AND sn.name IS NOT NULL THEN sn.name
              ELSE f.merchant_state END AS location,
         CASE WHEN f.merchant_state IS NULL AND f.channel = {_q(ONLINE_CHANNEL)} THEN 'Online'
              WHEN f.merchant_state IS NULL THEN 'Not recorded'
              WHEN length(f.merchant_state) = 2 AND sn.name IS NOT NULL THEN 'US state'
              ELSE 'International' END AS location_type
  FROM fact1 f LEFT JOIN state_names sn ON f.merchant_state = sn.code
)
"""


def with_ctes(select: str, *extra: str) -> str:
    """Prefix the model CTEs (plus any ``name AS (...)`` extras) to a SELECT."""
    ctes = [CTES.strip()] + [e.strip() for e in extra]
    return "WITH " + ",\n".join(ctes) + "\n" + select


CHIP = _q(CHIP_CHANNEL)
ONLINE = _q(ONLINE_CHANNEL)


def _lit(v) -> str:
    return _q(v) if isinstance(v, str) else str(v)


def where_sql(where: dict | None) -> str:
    conds = []
    for k, v in (where or {}).items():
        if isinstance(v, (list, tuple, set, frozenset)):
            conds.append(f"{k} IN ({', '.join(_lit(x) for x in v)})")
        else:
            conds.append(f"{k} = {_lit(v)}")
    return (" WHERE " + " AND ".join(conds)) if conds else ""


def measure_sql(key: str) -> str:
    """The hand-written SQL of a plain (non-special) measure, typed as the Spark output."""
    from spendframe.plans.measures import MEASURES
    m = MEASURES[key]
    if m.sql is None:
        raise KeyError(f"{key} needs a hand-written query")
    if m.kind == "money":
        return f"CAST({m.sql} AS DOUBLE)"
    if m.kind == "count":
        return f"CAST({m.sql} AS BIGINT)"
    return m.sql


def group_sql(keys, measures, where=None, source: str = "att") -> str:
    """SELECT keys, measures FROM att [WHERE] GROUP BY keys (measures: (alias, key))."""
    sel = list(keys) + [f"{measure_sql(k)} AS {a}" for a, k in measures]
    gb = f" GROUP BY {', '.join(keys)}" if keys else ""
    return f"SELECT {', '.join(sel)} FROM {source}{where_sql(where)}{gb}"
