"""The card-transaction star, bound to the driver's TPC-H-like tables.

Fact grain: one lineitem row = one card transaction attempt.

    date            CAST(o_orderdate AS DATE)
    hour            (l_orderkey + 3 * l_linenumber) % 24   (the order timestamps are midnights)
    client_key      o_custkey                      (Client  = customer)
    card_key        l_suppkey                      (Card    = supplier, s_acctbal = credit limit)
    mcc             l_partkey                      (Merchant category = part: p_brand, group p_type)
    channel         o_orderpriority                (5 channels)
    channel_type    'Card not present' for 1-URGENT / 2-HIGH, else 'Card present'
    errors          null when o_orderstatus <> 'P', else by l_linenumber % 4:
                    Insufficient Balance / Bad PIN / Technical Glitch / two errors joined
    fraud_key       l_returnflag: N = 0 not labelled, A = 1 clean, R = 2 fraud
    amount          CAST(l_extendedprice AS DECIMAL(12,2)), negated when l_quantity <= 2
    merchant_state  null for the online channel and for line 7 (not recorded); a US state
                    code (rule: code list[c_custkey % 51]) for AMERICA customers; else n_name

Dimensions are joined only when a query asks for one of their columns, so a
query over channel and amount reads two tables.  The lineitem-orders join is the
one shuffle every fact query pays; it is keyed on the order key, which is unique
on the orders side, so it cannot skew.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendframe.functions import constants as K
from spendframe.functions.scalar import MONEY, band
from spendframe.operators.joins import join_dim
from spendframe.sources.tables import Tables

# ---- FIXED VALUES: binding choices for the driver tables ----
ONLINE_CHANNEL = "1-URGENT"
CHIP_CHANNEL = "3-MEDIUM"
NOT_PRESENT_CHANNELS = ["1-URGENT", "2-HIGH"]
ERROR_BY_LINE = ["Bad PIN,Insufficient Balance", "Insufficient Balance", "Bad PIN",
                 "Technical Glitch"]           # index = l_linenumber % 4
NOT_RECORDED_LINE = 7
STATE_REGION = "AMERICA"

BASE_COLS = {"date", "year", "client_key", "card_key", "mcc", "channel", "channel_type",
             "errors", "is_approved", "ok", "outcome_key", "outcome", "outcome_class",
             "fraud_key", "fraud_status", "is_labelled", "is_fraud", "lab", "fr", "amount",
             "month_no", "month_year", "month_year_sort", "month_start", "month", "quarter",
             "quarter_key", "order_key", "line_number", "timestamp", "hour"}
PART_COLS = {"category", "category_group"}
GEO_COLS = {"merchant_state", "location", "location_type", "state_code", "country"}
CLIENT_COLS = {"merchant_state", "location", "location_type", "state_code", "country",
               "credit_score", "credit_score_band", "credit_score_band_sort", "income_band",
               "income_band_sort", "age_band", "age_band_sort"}
CARD_COLS = {"credit_limit", "credit_limit_band", "credit_limit_band_sort", "card_brand",
             "card_type", "has_chip"}
DATE_DIM_COLS = {"in_lfl", "is_complete_year"}


def outcome_columns(errors) -> dict:
    """Error text -> outcome key/label/class (P10).  Blank = approved; a known single
    error maps through the fixed table; anything else (several errors, unknown text)
    is 'Multiple errors'."""
    e = F.coalesce(errors, F.lit(""))
    key = F.when(e == "", F.lit(0))
    label = F.when(e == "", F.lit(K.APPROVED_OUTCOME[0]))
    cls = F.when(e == "", F.lit(K.APPROVED_OUTCOME[1]))
    for i, (raw, lab, c) in enumerate(K.ERROR_CLASS, start=1):
        key = key.when(e == raw, F.lit(i))
        label = label.when(e == raw, F.lit(lab))
        cls = cls.when(e == raw, F.lit(c))
    multi = len(K.ERROR_CLASS) + 1
    return {"outcome_key": key.otherwise(F.lit(multi)),
            "outcome": label.otherwise(F.lit(K.MULTIPLE_OUTCOME[0])),
            "outcome_class": cls.otherwise(F.lit(K.MULTIPLE_OUTCOME[1]))}


def location_columns(state, channel, state_names: DataFrame | None = None) -> dict:
    """Classify the mixed merchant_state column.  Two characters = a state code
    (a US state when the code is known, else International); a longer text = a
    country; null + online channel = 'Online'; other nulls = 'Not recorded'."""
    s = state
    is_code = s.isNotNull() & (F.length(s) == 2)
    name = F.col("_state_name")
    loc = (F.when(s.isNull() & (channel == ONLINE_CHANNEL), F.lit("Online"))
           .when(s.isNull(), F.lit("Not recorded"))
           .when(is_code & name.isNotNull(), name)
           .otherwise(s))
    ltype = (F.when(s.isNull() & (channel == ONLINE_CHANNEL), F.lit("Online"))
             .when(s.isNull(), F.lit("Not recorded"))
             .when(is_code & name.isNotNull(), F.lit("US state"))
             .otherwise(F.lit("International")))
    code = F.when(is_code & name.isNotNull(), s).otherwise(F.lit(""))
    country = (F.when(s.isNull() & (channel == ONLINE_CHANNEL), F.lit("United States"))
               .when(s.isNull(), F.lit(""))
               .when(is_code & name.isNotNull(), F.lit("United States"))
               .otherwise(s))
    return {"location": loc, "location_type": ltype, "state_code": code, "country": country}


class Star:
    """Fact and dimensions of the card model over one driver directory."""

    def __init__(self, spark: SparkSession, src: str):
        self.spark, self.src = spark, src
        self.t = Tables(spark, src)
        self._mat = _MATERIALIZED.get((id(spark._jsparkSession), src))

    # ------------------------------------------------------------------ fixed lookups
    @cached_property
    def state_names(self) -> DataFrame:
        return self.spark.createDataFrame(K.US_STATES, "_state_code string, _state_name string")

    # ------------------------------------------------------------------ fact
    @staticmethod
    def raw_expressions() -> dict:
        """Columns computed straight from lineitem + orders (first projection)."""
        date = F.col("o_orderdate").cast("date")
        price = F.col("l_extendedprice").cast(MONEY)
        errors = F.when(F.col("o_orderstatus") != "P", F.lit(None).cast("string")).otherwise(
            F.element_at(F.array(*[F.lit(e) for e in ERROR_BY_LINE]),
                         (F.pmod(F.col("l_linenumber"), F.lit(4)) + 1).cast("int")))
        rf = F.col("l_returnflag")
        fk = F.when(rf == "R", F.lit(2)).when(rf == "A", F.lit(1)).otherwise(F.lit(0))
        return {
            "order_key": F.col("l_orderkey"),
            "line_number": F.col("l_linenumber"),
            "date": date,
            "timestamp": F.col("o_orderdate"),
            "hour": F.pmod(F.col("l_orderkey") + 3 * F.col("l_linenumber"), F.lit(24)).cast("bigint"),
            "client_key": F.col("o_custkey"),
            "card_key": F.col("l_suppkey"),
            "mcc": F.col("l_partkey"),
            "channel": F.col("o_orderpriority"),
            "channel_type": F.when(F.col("o_orderpriority").isin(*NOT_PRESENT_CHANNELS),
                                   F.lit("Card not present")).otherwise(F.lit("Card present")),
            "errors": errors,
            "fraud_key": fk,
            "amount": F.when(F.col("l_quantity") <= 2, -price).otherwise(price),
        }

    @staticmethod
    def derived_groups() -> dict[str, dict]:
        """Columns derived from the first projection, by what they are functions of."""
        oc = outcome_columns(F.col("errors"))
        ok = F.coalesce(F.col("errors"), F.lit("")) == ""
        fk = F.col("fraud_key")
        status = (F.when(fk == 2, K.FRAUD_STATUS[2][1]).when(fk == 1, K.FRAUD_STATUS[1][1])
                  .otherwise(K.FRAUD_STATUS[0][1]))
        d = F.col("date")
        return {
            "errors": {
                **oc,
                "is_approved": F.when(ok, "Yes").otherwise("No"),
                "ok": ok,
            },
            "fraud_key": {
                "lab": fk > 0,
                "fr": fk == 2,
                "fraud_status": status,
                "is_labelled": F.when(fk > 0, "Yes").otherwise("No"),
                "is_fraud": F.when(fk == 2, "Yes").otherwise("No"),
            },
            "date": {
                "year": F.year(d).cast("bigint"),
                "month_no": F.month(d).cast("bigint"),
                "month_year": F.date_format(d, "MMM yyyy"),
                "month_year_sort": (F.year(d) * 100 + F.month(d)).cast("bigint"),
                "month_start": F.trunc(d, "MM"),
                "month": F.date_format(d, "yyyy-MM"),
                "quarter": F.concat(F.lit("Q"), F.quarter(d).cast("string")),
                "quarter_key": (F.year(d) * 10 + F.quarter(d)).cast("bigint"),
            },
        }

    @classmethod
    def derived_expressions(cls) -> dict:
        return {c: e for group in cls.derived_groups().values() for c, e in group.items()}

    DERIVED_NEEDS = {"errors", "fraud_key", "date"}

    def base(self, cols=None) -> DataFrame:
        """lineitem JOIN orders projected to the requested base columns (all if None):
        two projections, so the error text is computed once per row."""
        if self._mat is not None:
            m = self._mat[0]
            return m.select(*[c for c in m.columns if c in BASE_COLS and (cols is None or c in cols)])
        li = self.t.lineitem
        o = self.t.orders
        n = self.join_partitions()
        if n:
            li, o = li.repartition(n, "l_orderkey"), o.repartition(n, "o_orderkey")
        f = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
        raw, der = self.raw_expressions(), self.derived_expressions()
        want_der = [c for c in der if cols is None or c in cols]
        want_raw = [c for c in raw if cols is None or c in cols or
                    (want_der and c in self.DERIVED_NEEDS)]
        f = f.select(*[raw[c].alias(c) for c in want_raw])
        if want_der:
            keep = [c for c in want_raw if cols is None or c in cols]
            f = f.select(*keep, *[der[c].alias(c) for c in want_der])
        return f

    def join_partitions(self) -> int:
        """Partitions of the fact join, by its tables' scan size, so what a task sorts, explodes or
        counts does not grow with the data (AQE would coalesce them by their compressed
        size); 0 leaves the number to the session, where twice the cores are enough."""
        from spendframe.session import partitions_by_size
        n = partitions_by_size(self.spark, self.src)
        return n if n > 2 * self.spark.sparkContext.defaultParallelism else 0

    # foreign keys (and fact columns) each dimension join reads
    DIM_KEYS = {"part": {"mcc"}, "client": {"client_key", "channel", "line_number"},
                "card": {"card_key"}}
    DIM_COLS = {"part": PART_COLS, "client": CLIENT_COLS, "card": CARD_COLS}

    def foreign_keys(self, dims, need) -> set[str]:
        """Fact columns the joins of ``dims`` read for the columns in ``need``: the client
        key alone for client attributes, plus channel and line number for a location."""
        keys = set()
        for d in dims:
            keys |= self.DIM_KEYS[d]
        if "client" in dims and not set(need) & GEO_COLS:
            keys -= {"channel", "line_number"}
        return keys

    def dims_for(self, need) -> list[str]:
        """The dimensions (part, client, card) whose columns ``need`` touches."""
        return [d for d, cols in self.DIM_COLS.items() if set(need) & cols]

    def dim_is_large(self, dim: str) -> bool:
        """The broadcast size check of ``join_dim`` (base scan x expansion > limit)."""
        from spendframe.operators.joins import BROADCAST_LIMIT_BYTES, EXPANSION, estimated_bytes
        proxy = {"part": lambda: self.t.part.select("p_partkey", "p_brand", "p_type"),
                 "client": self.client_proxy, "card": self.card_proxy}[dim]()
        size = estimated_bytes(proxy)
        return size is None or size * EXPANSION > BROADCAST_LIMIT_BYTES

    def fact(self, need=None) -> DataFrame:
        """Enriched fact.  ``need``: column names the caller will use (None = all)."""
        need = set(need) if need is not None else (BASE_COLS | PART_COLS | CLIENT_COLS |
                                                     CARD_COLS | DATE_DIM_COLS)
        base_cols = need & BASE_COLS
        for d in self.dims_for(need):
            base_cols |= self.DIM_KEYS[d]
        if need & DATE_DIM_COLS:
            base_cols.add("date")
        if self._mat is not None:           # imported model: prune the in-memory star
            return self._mat[0]
        f = self.base(base_cols or {"order_key"})
        f = self.attach_dims(f, need)
        if need & DATE_DIM_COLS:
            dd = self.date_dim().select("date", "in_lfl", "is_complete_year")
            f = join_dim(f, dd, "date", how="inner", bounded=True)
        return f

    def attach_dims(self, f: DataFrame, need) -> DataFrame:
        """Join the part / client / card dimensions ``need`` touches onto ``f``, which
        holds their foreign keys (fact rows, or fact rows pre-aggregated by those keys)."""
        need = set(need)
        if need & PART_COLS:
            f = join_dim(f, self.category_dim().select("mcc", "category", "category_group"), "mcc",
                         size_proxy=self.t.part.select("p_partkey", "p_brand", "p_type"))
        if need & CLIENT_COLS:
            f = self._with_client(f, geo=bool(need & GEO_COLS))
        if need & CARD_COLS:
            f = join_dim(f, self.card_dim().select(
                "card_key", "credit_limit", "credit_limit_band", "credit_limit_band_sort",
                "card_brand", "card_type", "has_chip"), "card_key", size_proxy=self.card_proxy())
        return f

    def _with_client(self, f: DataFrame, geo: bool = True) -> DataFrame:
        """Client attributes; with ``geo`` also the transaction location, which reads the
        channel and line number of ``f`` besides the client's home state."""
        cl = self.client_geo()
        f = join_dim(f, cl, "client_key", size_proxy=self.client_proxy())
        if not geo:
            return f.drop("_home_state")
        st = (F.when(F.col("channel") == ONLINE_CHANNEL, F.lit(None).cast("string"))
              .when(F.col("line_number") == NOT_RECORDED_LINE, F.lit(None).cast("string"))
              .otherwise(F.col("_home_state")))
        f = f.withColumn("merchant_state", st).drop("_home_state")
        f = join_dim(f, self.state_names, f.merchant_state == F.col("_state_code"), bounded=True)
        loc = location_columns(F.col("merchant_state"), F.col("channel"))
        return f.select("*", *[v.alias(k) for k, v in loc.items()]).drop("_state_code",
                                                                         "_state_name")

    # ------------------------------------------------------------------ dimensions
    def client_proxy(self) -> DataFrame:
        """Size proxy of the client dimension (its base scan) for the broadcast check."""
        return self.t.customer.select("c_custkey", "c_nationkey", "c_acctbal")

    def card_proxy(self) -> DataFrame:
        return self.t.supplier.select("s_suppkey", "s_nationkey", "s_acctbal")

    def client_geo(self) -> DataFrame:
        """Client attributes + home location code (one row per customer)."""
        c = self.t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
        n = self.t.nation.select("n_nationkey", "n_name", "n_regionkey")
        r = self.t.region.select("r_regionkey", "r_name")
        geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
        codes = F.array(*[F.lit(code) for code, _ in K.US_STATES])
        c = join_dim(c, geo, c.c_nationkey == geo.n_nationkey, how="left", bounded=True)
        home = (F.when(F.col("r_name") == STATE_REGION,
                       F.element_at(codes, (F.pmod(F.col("c_custkey"), F.lit(len(K.US_STATES))) + 1)
                                    .cast("int")))
                .otherwise(F.col("n_name")))
        score = (F.lit(350) + F.floor(F.col("c_acctbal") / 20)).cast("int")
        income = ((F.col("c_acctbal") + 1000) * 12).cast(MONEY)
        age = (F.lit(18) + F.pmod(F.col("c_custkey"), F.lit(70))).cast("int")
        sb, sbs = band(score, K.CREDIT_SCORE_EDGES, K.CREDIT_SCORE_LABELS)
        ib, ibs = band(income, K.INCOME_EDGES, K.INCOME_LABELS)
        ab, abs_ = band(age, K.AGE_EDGES, K.AGE_LABELS)
        return c.select(F.col("c_custkey").alias("client_key"), home.alias("_home_state"),
                        age.alias("age"), income.alias("yearly_income"),
                        score.alias("credit_score"), sb.alias("credit_score_band"),
                        sbs.alias("credit_score_band_sort"), ib.alias("income_band"),
                        ibs.alias("income_band_sort"), ab.alias("age_band"),
                        abs_.alias("age_band_sort"))

    def client_dim(self) -> DataFrame:
        return self.client_geo().drop("_home_state")

    def card_dim(self) -> DataFrame:
        s = self.t.supplier.select("s_suppkey", "s_nationkey", "s_acctbal")
        n = self.t.nation.select("n_nationkey", "n_regionkey")
        r = self.t.region.select("r_regionkey", "r_name")
        geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
        s = join_dim(s, geo, s.s_nationkey == geo.n_nationkey, bounded=True)
        limit = F.col("s_acctbal").cast(MONEY)
        lb, lbs = band(limit, K.LIMIT_EDGES, K.LIMIT_LABELS)
        ctype = (F.when(F.col("s_acctbal") >= 5000, "Credit").when(F.col("s_acctbal") >= 0, "Debit")
                 .otherwise("Debit (Prepaid)"))
        chip = F.when(F.pmod(F.col("s_suppkey"), F.lit(7)) == 0, "No chip").otherwise("Chip")
        return s.select(F.col("s_suppkey").alias("card_key"), limit.alias("credit_limit"),
                        lb.alias("credit_limit_band"), lbs.alias("credit_limit_band_sort"),
                        F.col("r_name").alias("card_brand"), ctype.alias("card_type"),
                        chip.alias("has_chip"))

    def category_dim(self) -> DataFrame:
        return self.t.part.select(F.col("p_partkey").alias("mcc"),
                                  F.col("p_brand").alias("category"),
                                  F.col("p_type").alias("category_group"))

    # ------------------------------------------------------------------ date spine
    def date_bounds(self) -> DataFrame:
        """One row: first and last transaction date (a global aggregate)."""
        return self.base({"date"}).agg(F.min("date").alias("first"), F.max("date").alias("last"))

    def date_dim(self) -> DataFrame:
        """The day spine.  Its bounds need a pass over the fact's dates; an imported star
        has it written beside the fact."""
        return self._mat[1] if self._mat is not None else self._date_dim()

    def _date_dim(self) -> DataFrame:
        """Contiguous day spine first..last with calendar attributes.  Its size is
        the number of days in the range, not the number of transactions."""
        b = self.date_bounds()
        spine = b.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day")))
                         .alias("date"), "last")
        return date_attributes(spine)


_MATERIALIZED: dict = {}    # (session, source) -> the star imported by ``materialize``, until ``release``


def materialize(spark: SparkSession, src: str,
                written: bool = False) -> tuple[DataFrame, DataFrame]:
    """Import the star once (the model refresh); every later ``Star`` over the same source
    reads it instead of re-joining the raw tables.

    * default: the enriched fact and the day spine are persisted in memory (spilling to
      disk) - the in-memory model of the original; lost blocks are recomputed from lineage;
    * ``written=True``: the scale form.  The fact is written as parquet, one directory per
      year, sorted on (date, card), with the day spine beside it, into the cluster's shared
      checkpoint folder, and read back: queries then prune year directories and columns at
      the scan, skip the lineitem-orders shuffle, and a lost executor loses nothing."""
    from pyspark import StorageLevel
    star = Star(spark, src)
    star._mat = None
    fact = star.fact(None)
    if written:
        from spendframe.sources.raw import write_fact_by_year
        from spendframe.session import ensure_checkpoint_dir
        import os
        import uuid
        # a path of its own for every build: readers of an earlier one keep their files
        base = os.path.join(ensure_checkpoint_dir(spark), f"import-{uuid.uuid4().hex}")
        dd = star.date_dim()
        write_fact_by_year(fact, f"{base}/fact", years_overwrite=False)
        dd.write.mode("overwrite").parquet(f"{base}/date")
        # read back with the exact in-memory schema (year stays bigint and is the
        # partition column, so a year filter prunes directories)
        fact = (spark.read.schema(fact.schema).option("basePath", f"{base}/fact")
                .parquet(f"{base}/fact").select(*fact.columns))
        dd = spark.read.schema(dd.schema).parquet(f"{base}/date")
    else:
        # Lay the imported star out for parallel reads: a range on (date, card, row hash)
        # gives even partitions however hot a card or a day is (the hash is a function of
        # the row, so a retried task rebuilds the same partition), and date-clustered
        # partitions let the columnar cache's batch min/max skip batches on date filters.
        h = F.xxhash64(*[F.col(c) for c in fact.columns])
        fact = (fact.repartitionByRange(import_partitions(star), "date", "card_key", h)
                .persist(StorageLevel.MEMORY_AND_DISK))
        dd = star.date_dim().persist(StorageLevel.MEMORY_AND_DISK)
        fact.count()
        dd.count()
    _MATERIALIZED[(id(spark._jsparkSession), src)] = (fact, dd)
    return fact, dd


# In-memory bytes per imported partition.
IMPORT_PARTITION_BYTES = 128 * 1024 * 1024


def import_partitions(star: Star) -> int:
    """Partitions of the imported fact: the lineitem scan size (compressed, times the
    in-memory expansion) over IMPORT_PARTITION_BYTES, at least twice the cores."""
    from spendframe.operators.joins import EXPANSION, estimated_bytes
    size = estimated_bytes(star.t.lineitem) or 0
    by_size = -(-size * EXPANSION // IMPORT_PARTITION_BYTES)
    return int(max(2 * star.spark.sparkContext.defaultParallelism, by_size))


def refresh(spark: SparkSession, src: str, written: bool = False) -> tuple[DataFrame, DataFrame]:
    """Drop the imported star and import it anew from the source as it is now."""
    release(spark, src)
    return materialize(spark, src, written)


def release(spark: SparkSession, src: str) -> None:
    """Forget the imported star; later queries read the raw tables."""
    mat = _MATERIALIZED.pop((id(spark._jsparkSession), src), None)
    if mat:
        for df in mat:
            df.unpersist()


def date_attributes(spine: DataFrame) -> DataFrame:
    """Calendar columns of a spine with columns (date, last)."""
    d, last = F.col("date"), F.col("last")
    return spine.select(
        d,
        F.year(d).cast("bigint").alias("year"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string"), F.lit(" "), F.year(d).cast("string"))
         .alias("quarter_year"),
        (F.year(d) * 10 + F.quarter(d)).cast("bigint").alias("quarter_key"),
        F.month(d).cast("bigint").alias("month_no"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short"),
        F.date_format(d, "MMM yyyy").alias("month_year"),
        (F.year(d) * 100 + F.month(d)).cast("bigint").alias("month_year_sort"),
        F.trunc(d, "MM").alias("month_start"),
        F.date_format(d, "yyyy-MM").alias("month"),
        (F.weekday(d) + 1).cast("bigint").alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.when(F.weekday(d) >= 5, "Weekend").otherwise("Weekday").alias("is_weekend"),
        F.when(F.month(d) <= F.month(last), "Yes").otherwise("No").alias("in_lfl"),
        F.when((F.month(d) < F.month(last)) |
               ((F.month(d) == F.month(last)) & (F.dayofmonth(d) <= F.dayofmonth(last))), "Yes")
         .otherwise("No").alias("in_lfl_day"),
        F.when(F.year(d) < F.year(last), "Yes").otherwise("No").alias("is_complete_year"),
    )
