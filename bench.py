"""Benchmark: the ten star benchmark queries (q01-q10) and their flat twins.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints ONE JSON line.  Three states; the reference measures queries over a built model:

* ``cold``: every query from the raw parquet tables (the lineitem-orders join and
  dimension joins included), median of ``BENCH_RUNS`` runs;
* ``cached``: the same queries after the star is imported into the cache
  (``materialize``: enriched fact + day spine persisted); ``refresh_sec`` is that import;
* ``queries`` (the headline ``value``): q01-q10 over the star written once as parquet by
  year into the shared checkpoint folder - the import as it runs at scale
  (``materialize(written=True)``); ``write_sec`` is its build time.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

STAR = ["q01_total_spend", "q02_spend_by_year", "q03_spend_by_channel", "q04_spend_by_category",
        "q05_fraud_by_channel", "q06_distinct_counts", "q07_spend_yoy", "q08_card_by_year",
        "q09_cards_by_month", "q10_top_cards"]
FLAT = ["f01_total_spend", "f02_spend_by_year", "f03_spend_by_channel", "f04_spend_by_category",
        "f05_fraud_by_channel", "f06_distinct_counts", "f07_spend_yoy", "f08_card_by_year",
        "f09_cards_by_month", "f10_card_detail"]


def main() -> None:
    src = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from spendframe.plans import registry
    from spendframe.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus * 2)
    from spendframe.session import size_shuffles
    size_shuffles(spark, src)                             # unchanged at sf0.1 (2 x cores)
    registry.load_all()
    qs = registry.QUERIES
    qs["q01_total_spend"](spark, src).collect()          # JVM / reader warm-up, not timed

    def timed(names):
        out_t, out_rows = {}, {}
        for name in names:
            ts = []
            for _ in range(runs):
                t0 = time.perf_counter()
                out = qs[name](spark, src)
                out.write.format("noop").mode("overwrite").save()
                ts.append(time.perf_counter() - t0)
            out_t[name] = round(statistics.median(ts), 4)
            out_rows[name] = out.count()
        return out_t, out_rows

    cold, rows = timed(STAR + FLAT)
    from spendframe.plans.binding import materialize
    t0 = time.perf_counter()
    materialize(spark, src)
    refresh = round(time.perf_counter() - t0, 4)
    qs["q01_total_spend"](spark, src).collect()
    warm, warm_rows = timed(STAR + FLAT)
    assert warm_rows == rows, (warm_rows, rows)
    star_total = round(sum(warm[q] for q in STAR), 4)

    # the scale form of the import: the star written by year into the shared folder
    from spendframe.plans.binding import release
    release(spark, src)
    t0 = time.perf_counter()
    materialize(spark, src, written=True)
    write_sec = round(time.perf_counter() - t0, 4)
    written, written_rows = timed(STAR)
    assert all(written_rows[q] == rows[q] for q in STAR), (written_rows, rows)

    # Star vs flat timing comparison with the harness noise floor (ms)
    from spendframe.functions.constants import NOISE_FLOOR_MS
    from spendframe.operators.reconcile import bench_compare
    tab = "query string, cold_ms double, warm_ms double"
    st = spark.createDataFrame([(q[:3].replace("q", ""), cold[q] * 1000, warm[q] * 1000)
                                for q in STAR], tab)
    nv = spark.createDataFrame([(f[:3].replace("f", ""), cold[f] * 1000, warm[f] * 1000)
                                for f in FLAT], tab)
    compare = {r["query"]: {"cold_delta_ms": r["cold_delta_ms"], "warm_delta_ms": r["warm_delta_ms"],
                            "separable": r["cold_separable"]}
               for r in bench_compare(st, nv, NOISE_FLOOR_MS).collect()}
    sf = os.path.basename(os.path.normpath(src)).replace("sf", "")
    written_total = round(sum(written[q] for q in STAR), 4)
    print(json.dumps({
        "metric": "star_q01_q10_median_total_written_star", "value": written_total,
        "unit": "sec",
        "queries": {q[:3]: written[q] for q in STAR},
        "cached_total": star_total,
        "cached": {q[:3]: warm[q] for q in STAR},
        "flat_queries": {q[:3]: warm[q] for q in FLAT},
        "cold_total": round(sum(cold[q] for q in STAR), 4),
        "cold": {q[:3]: cold[q] for q in STAR + FLAT},
        "refresh_sec": refresh, "star_vs_flat": compare,
        "write_sec": write_sec,
        "rows": rows, "runs": runs, "cpus": cpus, "sf": sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
