"""Row-level expressions.  All are built-in Column expressions (JVM side,
whole-stage codegen); none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(text) -> Column:
    """'$-77.00' -> -77.00 as DECIMAL(12,2); null stays null, and a text that is no amount
    fails the query instead of leaving the sums."""
    t = F.regexp_replace(col_(text), r"\$", "")
    bad = F.raise_error(F.concat(F.lit("not an amount: "), col_(text)))
    return F.coalesce(t.try_cast(MONEY), F.when(t.isNotNull(), bad.cast(MONEY)))


def money_text(amount) -> Column:
    """The source's text form of an amount: '$' followed by the number."""
    return F.concat(F.lit("$"), col_(amount).cast("string"))


def band(value, edges, labels) -> tuple[Column, Column]:
    """Right-open bands: (label, ordinal).  A value on an edge goes to the upper band.
    Null input gives a null band."""
    v = col_(value)
    label = F.when(v.isNull(), F.lit(None).cast("string"))
    sort = F.when(v.isNull(), F.lit(None).cast("int"))
    for i, edge in enumerate(edges):
        label = label.when(v < edge, F.lit(labels[i]))
        sort = sort.when(v < edge, F.lit(i))
    return label.otherwise(F.lit(labels[-1])), sort.otherwise(F.lit(len(edges)))


def ratio(num, den, scale: float | None = None) -> Column:
    """DIVIDE(): null when the denominator is 0 or null; computed in DOUBLE."""
    n = col_(num).cast("double")
    d = col_(den).cast("double")
    out = F.when(d != 0, n / d)
    return out * F.lit(scale) if scale is not None else out


def change(cur, prev) -> Column:
    """(cur - prev) / prev, null when prev is 0 or null."""
    c = col_(cur).cast("double")
    p = col_(prev).cast("double")
    return F.when(p != 0, (c - p) / p)


def weekday_monday1(d) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(col_(d)) + 1



def week_of_month(d) -> Column:
    """Row of a Monday-first month grid, 1..6."""
    d = col_(d)
    first = F.trunc(d, "MM")
    return F.floor((F.dayofmonth(d) + weekday_monday1(first) - 2) / 7).cast("int") + 1


def month_in_quarter(d) -> Column:
    return F.pmod(F.month(col_(d)) - 1, F.lit(3)) + 1


def short_money(v, money_: bool = True) -> Column:
    """$1.23M / $12.3k / $1.23k / $123 for money; 1.23M / 12.3k / 1,234 for counts.
    Rounded as exact decimals (half away from zero), so the text never depends on
    binary floating point."""
    from decimal import Decimal
    v = col_(v).cast("decimal(20,2)")
    p = F.lit("$") if money_ else F.lit("")
    mil = F.round(v * F.lit(Decimal("0.000001")), 2).cast("decimal(20,2)").cast("string")
    k1 = F.round(v * F.lit(Decimal("0.001")), 1).cast("decimal(20,1)").cast("string")
    k2 = F.round(v * F.lit(Decimal("0.001")), 2).cast("decimal(20,2)").cast("string")
    whole = F.round(v, 0).cast("bigint").cast("string")
    out = (F.when(v >= 1000000, F.concat(p, mil, F.lit("M")))
           .when(v >= 10000, F.concat(p, k1, F.lit("k"))))
    if money_:
        return out.when(v >= 1000, F.concat(p, k2, F.lit("k"))).otherwise(F.concat(p, whole))
    return out.otherwise(F.format_number(v, 0))



def ordinal_suffix(n) -> Column:
    n = col_(n)
    return (F.when(F.pmod(n, F.lit(100)).isin(11, 12, 13), F.lit("th"))
            .when(F.pmod(n, F.lit(10)) == 1, F.lit("st"))
            .when(F.pmod(n, F.lit(10)) == 2, F.lit("nd"))
            .when(F.pmod(n, F.lit(10)) == 3, F.lit("rd"))
            .otherwise(F.lit("th")))


MINUS = "\u2212"


def _sign(v: Column) -> Column:
    return F.when(v < 0, F.lit(MINUS)).otherwise(F.lit("+"))


def signed_percent(v, cap: float | None = None, blank: str = "new") -> Column:
    """+3.6% / \u22123.6%, ``blank`` when null; from ``cap`` times on only >+999% or <-999%."""
    v = col_(v).cast("decimal(30,10)")
    body = F.concat(_sign(v), F.round(F.abs(v) * 100, 1).cast("decimal(30,1)").cast("string"), F.lit("%"))
    if cap is not None:
        body = F.when(F.abs(v) >= F.lit(cap), F.when(v > 0, ">+999%").otherwise("<-999%")).otherwise(body)
    return F.when(v.isNull(), F.lit(blank)).otherwise(body)


def point_change(a, b) -> Column:
    """The move from ratio ``b`` to ``a`` in percentage points: +0.4pp."""
    d = col_(a).cast("decimal(30,10)") - col_(b).cast("decimal(30,10)")
    return F.concat(_sign(d), F.round(F.abs(d) * 100, 1).cast("decimal(30,1)").cast("string"), F.lit("pp"))


def signed_money(v, thousands: bool = False) -> Column:
    """+$1,234 / \u2212$1,234; with ``thousands`` +$1k."""
    v = col_(v).cast("decimal(30,4)")
    whole = F.round(F.abs(v) / 1000 if thousands else F.abs(v), 0).cast("decimal(30,0)")
    return F.concat(_sign(v), F.lit("$"), F.format_number(whole, 0), F.lit("k" if thousands else ""))


def whole_text(v) -> Column:
    """A number as text without the ``.0`` that a whole one read as a double carries."""
    return F.regexp_replace(col_(v).cast("string"), r"\.0$", "")
