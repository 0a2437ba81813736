"""``query()``: evaluate measures for a group-by and a filter, the Spark way.

Plan shape (measures grouped in a filter context):

1. enriched fact with only the dimensions the query touches;
2. ``where`` filters (pushed into the parquet scans where they hit raw columns);
3. ONE ``groupBy(keys).agg(parts)``: partial aggregation on the map side, so a hot
   key costs one row per task before the shuffle.  Below a dimension too large to
   broadcast the aggregation is eager: by the fact's own keys and the dimension's
   foreign keys first, the dimension joined onto that, then summed (``rollup``);
4. measures that need another filter context are separate small plans joined back
   on the group keys:
   * prior year: when all parts add up, in the same scan (rows emitted at their date and
     12 months later, rolled up by day, joined to the day spine); otherwise a daily
     rollup -> shift date forward 12 months -> join the day spine;
   * trailing 12 months: running totals along the days of a daily rollup, a group's answer
     being their difference at its end and 12 months before (no range join);
   * shares: the same parts re-aggregated at the keys left after clearing a dimension
     (a re-aggregation of the aggregated result, or a second pass when the filter
     itself is cleared);
   * credit limit: distinct (keys, card) from the filtered fact joined to the card
     dimension, so a card is counted once per group;
   * years in period / report period: the day spine under the date filters only;
5. ratios after aggregation; ranks as windows over the aggregated rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendframe.functions.constants import DAYS_PER_YEAR
from spendframe.functions.scalar import change, ratio
from spendframe.operators import distinct
from spendframe.operators.dense import with_dense_rank
from spendframe.operators.joins import join_dim, with_scalars
from spendframe.operators.shared import kept, shared
from spendframe.operators.topn import top_n_with_ties
from spendframe.plans import slicers
from spendframe.plans.binding import Star, date_attributes
from spendframe.plans.measures import (APPROX_CONF, DATE_ATTRS, MEASURES, PARTS, RANK_OVER, SHARE_CLEARS,
                                       output_cast)

ADDITIVE = ("count", "money")      # part kinds that add up across days and groups
EAGER_CONF = "spendframe.eagerDimAggregation"   # auto | always | never
EAGER_DISTINCT = {"cards": "card_key", "clients": "client_key"}   # distinct part -> key column


def _filter(df: DataFrame, where: Mapping | None) -> DataFrame:
    for col, val in (where or {}).items():
        df = df.where(slicers.condition(col, val))
    return df


def _zero_counts(agg: DataFrame, keys: list[str], parts) -> DataFrame:
    """A global aggregate (no keys) is one row even over no input, and a count in it is 0;
    re-summed partial counts over no rows are null, so they are set back to 0."""
    if keys:
        return agg
    fixed = {p: F.coalesce(F.col(p), F.lit(0)) for p in parts if PARTS[p].kind == "count"}
    return agg.withColumns(fixed) if fixed else agg


def join_keys(left: DataFrame, right: DataFrame, keys: list[str],
              bounded: bool = False) -> DataFrame:
    """Left join on group keys, null-safe; with no keys ``right`` is one row.  ``bounded``:
    ``right`` is sized by the date range (spine measures), so it is broadcast and the
    aggregated left side is not re-shuffled for the null-safe keys."""
    if not keys:
        return with_scalars(left, right)
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    if bounded:
        r = F.broadcast(r)
    cond = [left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys]
    out = left.join(r, on=cond, how="left")
    return out.drop(*[f"__r_{k}" for k in keys])


class Model:
    """The card model over one driver directory."""

    def __init__(self, spark: SparkSession, src: str):
        self.spark, self.src = spark, src
        self.star = Star(spark, src)
        self._cells = None                  # (keys, parts, their rollup): see with_cells

    def with_cells(self, keys: list[str], parts: list[str], derived: Mapping | None = None) -> "Model":
        """This model, whose rollups by some of ``keys`` with some of the additive ``parts``, in one
        plan, add up one rollup by all of them instead of reading the fact once each.  Meant for
        keys of few values; ``derived``: further keys, as columns of those."""
        cells = kept(self.rollup(keys, parts, None), [*keys, *parts], apart=True).withColumns(dict(derived or {}))
        self._cells = ({*keys, *(derived or ())}, set(parts), cells)
        return self

    @classmethod
    def over_shared(cls, spark: SparkSession, src: str, need: Iterable[str]) -> "Model":
        """A model whose queries, in one plan, read the columns ``need`` of the fact once.  Functions of
        the date and of the fraud key (and of the error text, where that is needed) do not travel: they
        are computed from it where the rows arrive."""
        m = cls(spark, src)
        if m.star._mat is None:
            need = set(need) | {"date"}
            dealt, again = set(need), {}
            for source, group in m.star.derived_groups().items():
                if here := {c: e for c, e in group.items() if c in need and (source in need or source != "errors")}:
                    dealt, again = dealt - set(here) | {source}, again | here
            rows = shared(m.star.fact(dealt).select(*sorted(dealt)))
            fact = rows.select(*[again[c].alias(c) if c in again else c for c in sorted(need)])
            b = fact.agg(F.min("date").alias("first"), F.max("date").alias("last"))
            days = b.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date"), "last")
            m.star._mat = (fact, date_attributes(days))
        return m

    # ------------------------------------------------------------------ inputs
    def fact(self, need: Iterable[str], where: Mapping | None = None) -> DataFrame:
        need = set(need) | set((where or {}).keys())
        days = slicers.date_intervals(where)
        if days is not None:
            need |= {"timestamp", "year"}
        return self._within(_filter(self.star.fact(need), where), days)

    @staticmethod
    def _within(f: DataFrame, days) -> DataFrame:
        """Calendar filters restated on the raw order timestamp, so they reach the parquet scan
        (PushedFilters) instead of running after the join, and on the year, so that a
        written star skips folders."""
        if days is None:
            return f
        years = slicers.on_year(days)
        f = f.where(slicers.on_timestamp(days))
        return f if years is None else f.where(years)

    def spine(self, date_where: Mapping | None = None, daily: DataFrame | None = None) -> DataFrame:
        """The visible days.  From raw tables, the first and last day come from ``daily`` (a rollup
        of the whole fact with ``date``, read through ``kept``) when there is one, so the
        fact is not read again for them."""
        if daily is None or self.star._mat is not None:
            return _filter(self.star.date_dim(), date_where)
        b = daily.agg(F.min("date").alias("first"), F.max("date").alias("last"))
        days = b.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date"), "last")
        return _filter(date_attributes(days), date_where)

    @staticmethod
    def split_where(where: Mapping | None):
        where = dict(where or {})
        return ({k: v for k, v in where.items() if k not in DATE_ATTRS},
                {k: v for k, v in where.items() if k in DATE_ATTRS})

    # ------------------------------------------------------------------ evaluate
    def evaluate(self, group_by: Iterable[str] = (), measures: Iterable = (),
                 where: Mapping | None = None, order_by: Iterable | None = None,
                 top: tuple | None = None) -> DataFrame:
        """``measures``: keys of MEASURES, or (alias, key) pairs.
        ``order_by``: column names, '-name' for descending.
        ``top``: (n, column) keeps the n highest values of column, ties included."""
        keys, where = list(group_by), slicers.resolved(where)
        wanted = [(m, m) if isinstance(m, str) else tuple(m) for m in measures]
        ms = [MEASURES[k] for _, k in wanted]
        parts = {"n"}
        for m in ms:
            parts |= set(m.parts)
            if m.special and m.special.startswith("share:"):
                parts.add(SHARE_CLEARS[m.special][0])
        py_parts = sorted({s.split(":", 1)[1] for m in ms if m.special
                           for s in [m.special] if s.startswith(("py:", "yoy:"))})
        specials, wide = {m.special for m in ms if m.special}, None
        if py_parts and all(PARTS[p].kind in ADDITIVE for p in parts | set(py_parts)):
            agg = self.current_and_prior(keys, parts, py_parts, where)
        elif "trailing12" in specials and all(PARTS[p].kind in ADDITIVE for p in parts):
            agg = self.with_trailing_12m(keys, parts, where)
        else:
            shares = [s for s in specials if s.startswith("share:")]
            ranks = [s for s in specials if s.startswith("rank:")]
            used = set().union(*[m.parts for m in ms]) | {SHARE_CLEARS[s][0] for s in shares} | ({"spend"} if ranks else set())
            cleared = {k for s in shares for k in (where or {}) if k in SHARE_CLEARS[s][1]}
            if cleared and all(PARTS[p].kind in ADDITIVE for p in used):
                # totals clear a filter: one rollup without it, which the filter then divides
                wide = self.rollup(sorted(set(keys) | cleared), used, {k: v for k, v in where.items() if k not in cleared})
                wide = kept(wide, sorted(used))
                agg = self._divided(wide, keys, used, {k: where[k] for k in cleared})
            else:
                agg = self.rollup(keys, parts, where)
                if used and (shares or ranks):
                    # totals and ranks read the rollup again: all through the same columns
                    agg = kept(agg.select(*keys, *sorted(used)), sorted(used))

        cols = {p: F.col(p) for p in parts}
        extra: dict[str, object] = {}
        fwhere, dwhere = self.split_where(where)
        date_keys = [k for k in keys if k in DATE_ATTRS]

        if specials & {"credit_limit", "annual_to_limit"}:
            agg = join_keys(agg, self.credit_limit(keys, where), keys)
        if specials & {"years", "annual_to_limit"}:
            agg = join_keys(agg, self.years_in_period(date_keys, dwhere), date_keys,
                            bounded=True)
        for s in sorted(specials):
            if s.startswith("py:") or s.startswith("yoy:"):
                part = s.split(":", 1)[1]
                if f"{part}__py" not in agg.columns:
                    agg = join_keys(agg, self.prior_year(part, keys, where), keys)
            elif s.startswith("share:"):
                part, cleared = SHARE_CLEARS[s]
                agg = self._attach_share_total(agg, s, part, cleared, keys, where, wide)
            elif s == "trailing12":
                if "spend_12m" not in agg.columns:
                    agg = join_keys(agg, self.with_trailing_12m(keys, (), where).select(*keys, "spend_12m"), keys)
            elif s.startswith("rank:") and keys == [RANK_OVER[s]]:
                agg = with_dense_rank(agg, ["spend"], f"__{s}", descending=True)
            elif s == "period":
                agg = join_keys(agg, self.report_period(date_keys, dwhere), date_keys,
                                bounded=True)

        out_cols = [F.col(k) for k in keys]
        for (alias, key), m in zip(wanted, ms):
            if m.derive is not None:
                c = m.derive(cols)
            elif m.special == "credit_limit":
                c = F.col("total_credit_limit")
            elif m.special == "years":
                c = F.col("years_in_period")
            elif m.special == "annual_to_limit":
                c = ratio(ratio(F.col("spend"), F.col("years_in_period")),
                          F.col("total_credit_limit"))
            elif m.special.startswith("py:"):
                c = F.col(f"{m.special[3:]}__py")
            elif m.special.startswith("yoy:"):
                part = m.special[4:]
                c = change(F.col(part), F.col(f"{part}__py"))
            elif m.special.startswith("share:"):
                part = SHARE_CLEARS[m.special][0]
                c = ratio(F.col(part), F.col(f"{m.special}__total"))
            elif m.special == "trailing12":
                c = F.col("spend_12m")
            elif m.special.startswith("rank:"):
                over = RANK_OVER[m.special]
                if keys == [over]:
                    c = F.col(f"`__{m.special}`")
                elif over in keys:
                    w = Window.partitionBy(*[k for k in keys if k != over]).orderBy(
                        F.col("spend").desc_nulls_last())
                    c = F.dense_rank().over(w)
                else:
                    c = F.lit(None)
            elif m.special == "period":
                c = F.col("report_period")
            else:  # pragma: no cover
                raise ValueError(m.special)
            out_cols.append(output_cast(m.kind, c).alias(alias))
        res = agg.select(*out_cols)
        if top is not None:
            n, by = top
            res = top_n_with_ties(res, n, by)
        if order_by:
            res = res.orderBy(*[F.col(o[1:]).desc() if o.startswith("-") else F.col(o).asc()
                                for o in order_by])
        return res

    # ------------------------------------------------------------------ special plans
    def credit_limit(self, keys: list[str], where: Mapping | None) -> DataFrame:
        """M17 (filter flowing from the fact to the card dimension): cards seen in the filtered fact, each once per group.
        Below large dimensions the distinct (fact keys, foreign keys, card) set is taken
        first and the dimensions joined onto it (a distinct of a distinct is the same set)."""
        star = self.star
        dims = self._eager_dims(keys, (), where)
        if dims:
            dim_cols = set().union(*[star.DIM_COLS[d] for d in dims])
            fkeys = star.foreign_keys(dims, set(keys) | set(where or {}))
            dim_where = {k: v for k, v in (where or {}).items() if k in dim_cols}
            fact_where = {k: v for k, v in (where or {}).items() if k not in dim_cols}
            pre = sorted((set(keys) - dim_cols) | fkeys | {"card_key"})
            seen = self.fact(set(pre), fact_where).select(*pre).distinct()
            seen = _filter(star.attach_dims(seen, set(keys) | set(dim_where)), dim_where)
            seen = seen.select(*keys, "card_key").distinct()
        else:
            seen = self.fact(set(keys) | {"card_key"}, where).select(*keys, "card_key").distinct()
        cards = self.star.card_dim().select("card_key", F.col("credit_limit").alias("_limit"))
        j = join_dim(seen, cards, "card_key", how="inner", size_proxy=self.star.card_proxy())
        return j.groupBy(*keys).agg(F.sum("_limit").alias("total_credit_limit"))

    def years_in_period(self, date_keys: list[str], date_where: Mapping | None) -> DataFrame:
        """Visible date rows / 365.25 (date filters only reach the date table)."""
        return self.spine(date_where).groupBy(*date_keys).agg(
            (F.count(F.lit(1)) / F.lit(DAYS_PER_YEAR)).alias("years_in_period"))

    def report_period(self, date_keys: list[str], date_where: Mapping | None) -> DataFrame:
        """Label of the visible date range."""
        b = self.spine(date_where).groupBy(*date_keys).agg(F.min("date").alias("_f"),
                                                           F.max("date").alias("_l"))
        f, l = F.col("_f"), F.col("_l")
        whole = ((F.month(f) == 1) & (F.dayofmonth(f) == 1) & (F.month(l) == 12) &
                 (F.dayofmonth(l) == 31))
        label = (F.when(whole & (F.year(f) == F.year(l)), F.date_format(l, "yyyy"))
                 .when(whole, F.concat(F.date_format(f, "yyyy"), F.lit(" to "),
                                       F.date_format(l, "yyyy")))
                 .otherwise(F.concat(F.date_format(f, "MMM yyyy"), F.lit(" to "),
                                     F.date_format(l, "MMM yyyy"))))
        return b.select(*date_keys, label.alias("report_period"))

    def rollup(self, keys: list[str], parts, where: Mapping | None) -> DataFrame:
        """``groupBy(keys).agg(parts)`` over the enriched, filtered fact - eagerly below
        large dimensions when the parts add up (see ``_eager_dims``)."""
        if self._cells and not where and set(keys) <= self._cells[0] and set(parts) <= self._cells[1]:
            g = self._cells[2].groupBy(*keys).agg(*[F.sum(p).alias(p) for p in sorted(parts)])
            return _zero_counts(g, keys, parts)
        if self._eager_dims(keys, parts, where):
            return self.eager_aggregate(keys, parts, where)
        need = set(keys) | {"date"}
        for p in parts:
            need |= PARTS[p].cols
        f = self.fact(need, where)
        apart = sorted(p for p in parts if PARTS[p].kind == "distinct")
        if len(apart) > 1 and not self.spark.conf.get(APPROX_CONF, None):
            return self.pair_aggregate(f, keys, apart, sorted(set(parts) - set(apart)))
        return f.groupBy(*keys).agg(*[PARTS[p].spark().alias(p) for p in sorted(parts)])

    @staticmethod
    def pair_aggregate(f: DataFrame, keys: list[str], apart: list[str], rest: list[str]) -> DataFrame:
        """Several distinct counts with other parts, over one pair rollup (no Expand)."""
        pairs = distinct.pair_rollup(f, keys, {p: PARTS[p].row() for p in apart},
                              {p: (PARTS[p].row(), PARTS[p].how) for p in rest})
        agg = distinct.counted(pairs, keys, apart, {p: PARTS[p].how for p in rest})
        return _zero_counts(agg, keys, rest)

    def _eager_dims(self, keys, parts, where) -> list[str]:
        """Dimensions to join AFTER a first aggregation (eager aggregation): only when every
        part adds up (or is a distinct count of a key column), the star is not imported, and - in ``auto`` mode - a dimension the
        query touches fails the broadcast size check (a shuffle join of every fact row)."""
        mode = self.spark.conf.get(EAGER_CONF, "auto")
        if mode == "never" or self.star._mat is not None:
            return []
        if not all(PARTS[p].kind in ADDITIVE or p in EAGER_DISTINCT for p in parts):
            return []
        if self.spark.conf.get(APPROX_CONF, None) and any(p in EAGER_DISTINCT for p in parts):
            return []      # estimates everywhere: no dimension's size changes the kind of answer
        dims = self.star.dims_for(set(keys) | set(where or {}))
        if mode != "always" and not any(self.star.dim_is_large(d) for d in dims):
            return []
        return dims

    def eager_aggregate(self, keys: list[str], parts: set[str],
                        where: Mapping | None) -> DataFrame:
        """Group-by over large dimensions without shuffling fact rows into a join: the fact
        is aggregated by its own key columns plus the dimensions' foreign keys (map-side
        combine first, so a hot key costs one row per task), the dimensions are joined onto
        that aggregate, dimension filters applied, and the parts summed to the group keys.
        Valid because every part adds up and every dimension column is a function of its
        foreign keys."""
        star = self.star
        dims = star.dims_for(set(keys) | set(where or {}))
        dim_cols = set().union(*[star.DIM_COLS[d] for d in dims])
        fkeys = star.foreign_keys(dims, set(keys) | set(where or {}))
        fact_where = {k: v for k, v in (where or {}).items() if k not in dim_cols}
        dim_where = {k: v for k, v in (where or {}).items() if k in dim_cols}
        distinct = {p: EAGER_DISTINCT[p] for p in parts if p in EAGER_DISTINCT}
        additive = sorted(p for p in parts if p not in distinct)
        # a distinct count of a key column stays exact when the column is a pre-key
        pre_keys = sorted((set(keys) - dim_cols) | fkeys | set(distinct.values()))
        need = set(pre_keys)
        for p in additive:
            need |= PARTS[p].cols
        f = self.fact(need, fact_where)
        pre = (f.groupBy(*pre_keys).agg(*[PARTS[p].spark().alias(p) for p in additive])
               if additive else f.select(*pre_keys).distinct())
        j = _filter(star.attach_dims(pre, set(keys) | set(dim_where)), dim_where)
        g = j.groupBy(*keys).agg(*[F.sum(p).alias(p) for p in additive],
                                 *[F.countDistinct(c).alias(p) for p, c in distinct.items()])
        return _zero_counts(g, keys, additive)

    def current_and_prior(self, keys: list[str], parts: set[str], py_parts: list[str],
                          where: Mapping | None) -> DataFrame:
        """All parts per group and the prior year of ``py_parts``, in ONE scan of the fact
        (additive parts only).  Every fact row is emitted twice - at its own date and
        moved forward 12 months (29 Feb -> 28 Feb) - rolled up by (other keys, day,
        shifted), inner-joined to the visible day spine (shifted days past the end drop
        out; date keys and date filters come from the spine), and summed per group:
        unshifted rows give the parts, shifted rows the prior year.  Groups without a
        current row are dropped, as a group-by over the fact would never form them.  A
        year slicer is widened by one year so it still reaches the scan.  Dimensions that
        would be shuffle-joined (see ``_eager_dims``) are joined onto the daily rollup."""
        fwhere, dwhere = self.split_where(where)
        date_keys = [k for k in keys if k in DATE_ATTRS]
        other = [k for k in keys if k not in DATE_ATTRS]
        every = sorted(set(parts) | set(py_parts))
        # large dimensions are joined onto the daily rollup, not onto fact rows
        star = self.star
        dims = self._eager_dims(keys, set(every), where)
        dim_cols = set().union(*[star.DIM_COLS[d] for d in dims])
        fkeys = star.foreign_keys(dims, set(keys) | set(where or {}))
        dim_where = {k: v for k, v in fwhere.items() if k in dim_cols}
        fwhere = {k: v for k, v in fwhere.items() if k not in dim_cols}
        pre_other = sorted((set(other) - dim_cols) | fkeys)
        need = set(pre_other) | set(fwhere) | {"date"}
        for p in every:
            need |= PARTS[p].cols
        days = slicers.date_intervals(dwhere)
        if days is not None:
            need |= {"timestamp", "year"}
        f = _filter(star.fact(need), fwhere)
        if days is not None:
            f = self._within(f, slicers.merged(days + slicers.a_year_before(days)))
        whole = days is None and not fwhere and not dim_where
        by_day = f.groupBy(*pre_other, "date").agg(*[PARTS[p].spark().alias(p) for p in every])
        if whole:                       # the spine comes from the same rollup: one scan
            by_day = kept(by_day, every)
        spine = self.spine(dwhere, by_day if whole else None).select(F.col("date").alias("_d"), *date_keys)
        # days, not fact rows, are counted twice: as themselves and 12 months later
        pair = F.array(F.struct(F.col("date").alias("_d"), F.lit(False).alias("_shift")),
                       F.struct(F.add_months("date", 12).alias("_d"), F.lit(True).alias("_shift")))
        daily = by_day.select(*pre_other, *every, F.inline(pair))
        if dims:
            daily = _filter(star.attach_dims(daily, set(other) | set(dim_where)), dim_where)
        j = daily.join(F.broadcast(spine), "_d", "inner")   # spine: one row per day
        cur, shifted = ~F.col("_shift"), F.col("_shift")
        g = j.groupBy(*keys).agg(
            *[F.sum(F.when(cur, F.col(p))).alias(p) for p in sorted(parts)],
            *[F.sum(F.when(shifted, F.col(p))).alias(f"{p}__py") for p in py_parts],
            F.max(cur.cast("int")).alias("_cur"))
        if keys:
            g = g.where(F.col("_cur") == 1)
        return _zero_counts(g.drop("_cur"), keys, parts)

    def prior_year(self, part: str, keys: list[str], where: Mapping | None) -> DataFrame:
        """The part over the visible dates shifted back one year.  The fact
        is rolled up to days, the day moved forward 12 months (29 Feb -> 28 Feb), and
        inner-joined to the visible spine, so dates past the end of data drop out."""
        fwhere, dwhere = self.split_where(where)
        date_keys = [k for k in keys if k in DATE_ATTRS]
        other = [k for k in keys if k not in DATE_ATTRS]
        daily = self.rollup([*other, "date"], [part], fwhere).withColumnRenamed(part, "_v")
        shifted = daily.withColumn("date", F.add_months("date", 12))
        spine = self.spine(dwhere).select("date", *date_keys)
        j = shifted.join(F.broadcast(spine), "date", "inner")   # spine: one row per day
        return j.groupBy(*keys).agg(F.sum("_v").alias(f"{part}__py"))

    def with_trailing_12m(self, keys: list[str], parts, where: Mapping | None) -> DataFrame:
        """The parts per group and M44: spend over (end - 12 months, end], end = last visible
        date of the group.  One daily rollup serves all: the parts, the spine, and the running
        totals along the days, of which a group's answer is the difference at two places, its end
        and 12 months before.  Additive parts only."""
        fwhere, dwhere = self.split_where(where)
        date_keys = [k for k in keys if k in DATE_ATTRS]
        other = [k for k in keys if k not in DATE_ATTRS]
        every = sorted(set(parts) | {"spend"})
        # (days without a date are on no spine; said here, the condition is the same for all readers)
        daily = self.rollup([*other, "date"], every, fwhere).where(F.col("date").isNotNull())
        daily = kept(daily, [*other, "date", *every])
        days = self.spine(dwhere, None if fwhere else daily).select("date", *date_keys)
        ends = F.max("date").over(Window.partitionBy(*date_keys)) if date_keys else None
        spine = days.withColumn("_end", ends) if date_keys else with_scalars(days, days.agg(F.max("date").alias("_end")))
        agg = daily.join(F.broadcast(spine), "date").groupBy(*keys).agg(
            *[F.sum(p).alias(p) for p in every], F.max("_end").alias("_end"))
        # marks of each group among the days: its end, and the place 12 months before; they carry
        # the group's parts, so nothing is joined back
        marks = agg.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[F.col(p).alias(f"__p_{p}") for p in every],
                           *other, F.inline(F.array(
                               F.struct(F.col("_end").alias("date"), F.lit(1).alias("_sign")),
                               F.struct(F.add_months("_end", -12).alias("date"), F.lit(-1).alias("_sign")))))
        line = daily.select(*other, "date", F.col("spend").alias("_v")).unionByName(marks, allowMissingColumns=True)
        # a partition has a row a day and two per group of days at most, however large the fact is
        upto = Window.partitionBy(*other).orderBy("date").rangeBetween(Window.unboundedPreceding, Window.currentRow)
        placed = line.withColumns({"_run": F.coalesce(F.sum("_v").over(upto), F.lit(0)), "_seen": F.count("_v").over(upto)})
        g = placed.where(F.col("_sign").isNotNull()).groupBy(*[F.col(f"__k_{k}").alias(k) for k in keys]).agg(
            *[F.max(f"__p_{p}").alias(p) for p in every], F.sum(F.col("_sign") * F.col("_run")).alias("_sum"),
            F.sum(F.col("_sign") * F.col("_seen")).alias("_rows"))
        g = g.select(*keys, *every, F.when(F.col("_rows") > 0, F.col("_sum")).alias("spend_12m"))
        return _zero_counts(g, keys, every)

    @staticmethod
    def _divided(wide: DataFrame, keys: list[str], parts, where: Mapping) -> DataFrame:
        """The parts per group of the rows of a rollup that meet ``where``, by conditional sums: as
        a filter the condition would sink below the rollup and no other reader could share it."""
        held = F.lit(True)
        for col, val in where.items():
            held = held & slicers.condition(col, val)
        agg = wide.groupBy(*keys).agg(*[F.sum(F.when(held, F.col(p))).alias(p) for p in sorted(parts)],
                                      F.max(held).alias("_held"))
        agg = agg.where("_held") if keys else agg
        return _zero_counts(agg.drop("_held"), keys, parts)

    def _attach_share_total(self, agg, special, part, cleared, keys, where, wide=None):
        """Denominator of a context share: the part with the cleared dimensions' group keys
        and filters removed.  ``wide``: a rollup without any filter that a share clears."""
        rest = [k for k in keys if k not in cleared]
        name = f"{special}__total"
        if wide is not None:
            left = {k: v for k, v in where.items() if k not in cleared and k in wide.columns}
            tot = self._divided(wide, rest, [part], left).withColumnRenamed(part, name)
        elif not set((where or {}).keys()) & cleared:
            if rest:                 # the total over the aggregated rows: no second scan
                return agg.withColumn(name, F.sum(part).over(Window.partitionBy(*rest)))
            tot = agg.groupBy().agg(F.sum(part).alias(name))
        else:
            kept_where = {k: v for k, v in (where or {}).items() if k not in cleared}
            tot = self.rollup(rest, [part], kept_where).withColumnRenamed(part, name)
        return join_keys(agg, tot, rest)


def query(spark: SparkSession, src: str, group_by=(), measures=(), where=None,
          order_by=None, top=None) -> DataFrame:
    return Model(spark, src).evaluate(group_by, measures, where, order_by, top)
