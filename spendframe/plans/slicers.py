"""Slicers: what a report user can choose, as filters of a query, and as date intervals.

Besides a value or a list of values, a filter can be

* ``Between(low, high)``: both ends in, either open;
* ``Chosen(values, default)``: a list slicer; nothing chosen means its default, and no filter
  where it has none;
* ``Single(value, default)``: a strict single choice; without a value or default, or with
  several, it is an error.

``date_intervals`` turns the calendar filters of a query (year, quarter, month, date, in any of
their forms) into the fewest date intervals that hold every day they can keep.  Stated on
the raw timestamp they reach the scan, where calendar attributes cannot.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Above so many intervals, their hull is used.
MOST_INTERVALS = 24


@dataclass(frozen=True)
class Between:
    low: object = None
    high: object = None


@dataclass(frozen=True)
class Chosen:
    values: tuple | None = None
    default: tuple | None = None


@dataclass(frozen=True)
class Single:
    value: object = None
    default: object = None


def _several(v) -> bool:
    return isinstance(v, (list, tuple, set, frozenset))


def resolved(where: Mapping | None) -> dict:
    """``where`` with choices made: values, lists and Between only."""
    out = {}
    for col, v in (where or {}).items():
        if isinstance(v, Single):
            picked = v.value if v.value is not None else v.default
            if _several(picked) and len(list(picked)) == 1:
                picked = list(picked)[0]
            if picked is None or _several(picked):
                raise ValueError(f"choose one {col}")
            out[col] = picked
        elif isinstance(v, Chosen):
            picked = v.values or v.default
            if picked:
                out[col] = list(picked)
        else:
            out[col] = v
    return out


def condition(col: str, v) -> Column:
    if isinstance(v, Between):
        low = F.lit(True) if v.low is None else F.col(col) >= F.lit(v.low)
        return low if v.high is None else low & (F.col(col) <= F.lit(v.high))
    return F.col(col).isin(*list(v)) if _several(v) else F.col(col) == F.lit(v)


def _day(v) -> dt.date:
    if isinstance(v, dt.datetime):
        return v.date()
    return v if isinstance(v, dt.date) else dt.date.fromisoformat(str(v)[:10])


def _next_month(y: int, m: int) -> dt.date:
    return dt.date(y + m // 12, m % 12 + 1, 1)


#: What a value of a calendar attribute says: (years, months of a year), None for any.
_READ = {
    "year": lambda v: (int(v), None),
    "quarter_key": lambda v: (int(v) // 10, [3 * (int(v) % 10) - 2 + i for i in range(3)]),
    "quarter_year": lambda v: (int(v[-4:]), [3 * int(v[1]) - 2 + i for i in range(3)]),
    "quarter": lambda v: (None, [3 * int(str(v)[-1]) - 2 + i for i in range(3)]),
    "month_year_sort": lambda v: (int(v) // 100, [int(v) % 100]),
    "month": lambda v: (int(v[:4]), [int(v[5:7])]),
    "month_year": lambda v: (int(v[-4:]), [dt.datetime.strptime(v[:3], "%b").month]),
    "month_start": lambda v: (_day(v).year, [_day(v).month]),
    "month_no": lambda v: (None, [int(v)]),
    "month_name": lambda v: (None, [dt.datetime.strptime(v, "%B").month]),
    "month_short": lambda v: (None, [dt.datetime.strptime(v, "%b").month]),
}
#: Attributes whose order is that of the days, so that a range of them is one of days.
_ORDERED = {"year", "quarter_key", "month_year_sort", "month", "month_start", "date"}


def _ends(col: str, v) -> tuple[dt.date, dt.date]:
    """First day and day after of one value of an ordered attribute."""
    if col == "date":
        return _day(v), _day(v) + dt.timedelta(1)
    y, months = _READ[col](v)
    return dt.date(y, months[0] if months else 1, 1), _next_month(y, months[-1] if months else 12)


def date_intervals(where: Mapping | None) -> list[tuple[dt.date, dt.date]] | None:
    """The disjoint (first day, day after) that hold every day the filters can keep, or None when
    the filters bound no days.  An empty list: no day can be kept."""
    low, high, sets = dt.date.min, dt.date.max, []
    yearless: set[int] | None = None
    for col, v in (where or {}).items():
        if isinstance(v, Between):
            if col in _ORDERED:
                low = max(low, _ends(col, v.low)[0]) if v.low is not None else low
                high = min(high, _ends(col, v.high)[1]) if v.high is not None else high
            continue
        values = list(v) if _several(v) else [v]
        if col == "date":
            sets.append([_ends(col, x) for x in values])
        elif col in _READ:
            read = [_READ[col](x) for x in values]
            if read and read[0][0] is None:
                months = {m for _, ms in read for m in ms}
                yearless = months if yearless is None else yearless & months
            else:
                sets.append([_ends(col, x) for x in values])
    if not sets and low == dt.date.min and high == dt.date.max:
        return None
    held = [(low, high)]
    for s in sets:
        held = [(max(a, c), min(b, d)) for a, b in held for c, d in s if max(a, c) < min(b, d)]
    if yearless is not None and all(a > dt.date.min and b < dt.date.max for a, b in held):
        months = [(dt.date(y, m, 1), _next_month(y, m)) for a, b in held for y in range(a.year, b.year + 1) for m in sorted(yearless)]
        held = [(max(a, c), min(b, d)) for a, b in held for c, d in months if max(a, c) < min(b, d)]
    return merged(held)


def merged(intervals: Iterable[tuple[dt.date, dt.date]]) -> list[tuple[dt.date, dt.date]]:
    out: list[tuple[dt.date, dt.date]] = []
    for a, b in sorted(set(intervals)):
        if a >= b:
            continue
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return [(out[0][0], out[-1][1])] if len(out) > MOST_INTERVALS else out


def a_year_before(intervals: list[tuple[dt.date, dt.date]]) -> list[tuple[dt.date, dt.date]]:
    """Days that fall into the intervals when moved 12 months on (29 February to the 28th)."""
    def back(d: dt.date) -> dt.date:
        if d in (dt.date.min, dt.date.max):
            return d
        return d.replace(year=d.year - 1, day=28) if (d.month, d.day) == (2, 29) else d.replace(year=d.year - 1)

    one = dt.timedelta(1)
    return merged((back(a) - one if a > dt.date.min else a, back(b) + one if b < dt.date.max else b) for a, b in intervals)


def on_timestamp(intervals: list[tuple[dt.date, dt.date]], column: str = "timestamp") -> Column:
    """The intervals as ranges of a raw timestamp."""
    at = lambda d: F.lit(f"{d.isoformat()} 00:00:00").cast("timestamp_ntz")

    def one(a, b):
        low = F.lit(True) if a == dt.date.min else F.col(column) >= at(a)
        return low if b == dt.date.max else low & (F.col(column) < at(b))

    return reduce(lambda x, y: x | y, [one(a, b) for a, b in intervals], F.lit(False)) if len(intervals) != 1 else one(*intervals[0])


def on_year(intervals: list[tuple[dt.date, dt.date]], column: str = "year") -> Column | None:
    """The years the intervals touch (a written star prunes folders by them)."""
    if not intervals or intervals[0][0] == dt.date.min or intervals[-1][1] == dt.date.max:
        return None
    years = sorted({y for a, b in intervals for y in range(a.year, (b - dt.timedelta(1)).year + 1)})
    return F.col(column).isin(*years) if len(years) > 1 else F.col(column) == years[0]
