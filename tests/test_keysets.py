"""Key sets as bitmaps, seeded samples, and multiset comparison by fingerprints."""
import hashlib
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from spendframe.operators import keysets as K
from spendframe.operators import reconcile as R
from spendframe.plans.etl import panel, population

from conftest import SF_SMALL
from test_rollups import static_plan


@pytest.mark.parametrize("seed", range(3))
def test_compared_key_sets(spark, seed):
    rng = random.Random(seed)
    a = {rng.choice([-5, 0, 7, 10**6, 10**12, 3 * 10**9]) + rng.randint(0, 70000) for _ in range(400)}
    b = set(rng.sample(sorted(a), 100)) | {rng.randint(-10**5, 10**5) for _ in range(300)}
    df = lambda keys: spark.createDataFrame([(k,) for k in [*keys, *list(keys)[:50], None]], "k bigint").repartition(3)
    got = K.compared(K.key_set(df(a), "k"), K.key_set(df(b), "k")).first()
    assert tuple(got) == (len(a), len(b), len(a & b))
    parts = K.merged(K.key_set(df(a), "k"), K.key_set(df(b), "k"))
    assert K.compared(parts, K.key_set(df(b), "k")).first()[:3] == (len(a | b), len(b), len(b))
    none = K.key_set(df(a).where("false"), "k")
    assert tuple(K.compared(none, K.key_set(df(b), "k")).first()) == (0, len(b), 0)


def test_bottom_k_merges_and_is_stable(spark):
    df = spark.range(1000).select((F.col("id") % 300).alias("k")).union(spark.createDataFrame([(None,)], "k bigint"))
    want = sorted(range(300), key=lambda k: hashlib.md5(f"42:{k}".encode()).hexdigest())[:25]
    got = {r.k for r in K.bottom_k(df.repartition(7), "k", 25, 42).collect()}
    assert got == set(want)
    halves = [K.bottom_k(df.where(c), "k", 25, 42) for c in ("k < 100", "k >= 100")]
    assert {r.k for r in K.bottom_k(halves[0].union(halves[1]), "k", 25, 42).collect()} == got
    assert K.bottom_k(df, "k", 999, 1).count() == 300
    plan = K.bottom_k(df, "k", 25, 42)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_panel_is_master_and_seen(spark):
    """Clients that are on no master are never drawn; counts and sample against sets by hand."""
    clients = spark.createDataFrame([(i,) for i in range(1, 41)], "client_key bigint")
    cards = spark.createDataFrame([(i,) for i in range(1, 31)], "card_key bigint")
    rows = [(c, c % 11 + 1, c % 3 + 1) for c in range(21, 61)] + [(25, 29, 4), (None, 5, 2), (26, None, 1)]
    pairs = spark.createDataFrame(rows, "client_key bigint, card_key bigint, n bigint")
    drawn = lambda p: K.bottom_k(p.join(clients.withColumnRenamed("client_key", "_m"), F.col("client_key").eqNullSafe(
        F.col("_m")), "left_semi"), "client_key", 6, 42)
    sample = sorted(range(21, 41), key=lambda k: hashlib.md5(f"42:{k}".encode()).hexdigest())[:6]
    r = population(clients, cards, pairs, drawn).first()
    assert (r.population_clients, r.population_clients_with_transactions, r.population_clients_never_transacting) == (40, 20, 20)
    used = {c for _, c, _ in rows if c}
    assert r.population_cards_never_transacting == len(set(range(1, 31)) - used)
    assert r.sample_clients == 6 and r.population_transactions == sum(n for *_, n in rows)
    assert r.sample_transactions == sum(n for c, _, n in rows if c in sample)
    assert r.sample_cards_active == len({k for c, k, _ in rows if c in sample and k})
    assert panel(spark, SF_SMALL).count() == 100


def test_one_read_for_population_and_comparisons(spark):
    for name, scans in (("population_counts", 1), ("multiset_match", 2), ("reconcile_figures", 2)):
        plan = static_plan(spark, lambda: E.queries()[name](spark, SF_SMALL))
        assert plan.count("lineitem.parquet") == scans, name


def agree(a, b, step):
    """Sorted, paired by position, each pair within the tolerance (in hundredths)."""
    return len(a) == len(b) and all(abs(x - y) <= step for x, y in zip(sorted(a), sorted(b)))


@pytest.mark.parametrize("seed", range(6))
def test_fingerprints_do_not_change_the_comparison(spark, monkeypatch, seed):
    """Buckets so small that pairs cross their borders, and runs of values a tolerance apart."""
    monkeypatch.setattr(R, "BUCKET_CENTS", 5)
    rng = random.Random(seed)
    pairs, want = {}, {}
    for i in range(8):
        a = [rng.randint(0, 60) for _ in range(rng.randint(1, 30))]
        b = list(a)
        for _ in range(rng.randint(0, 3)):
            j = rng.randrange(len(b))
            b[j] += rng.choice([-3, -2, -1, 1, 2, 3])
        if rng.random() < 0.3:      # a chain: each value may pair with the next
            b = a = list(range(0, 40, 2))
            a, b = a + [40], [-2 + rng.choice([0, 0, -1])] + b
        if rng.random() < 0.2:
            b = b[:-1]
        df = lambda v: spark.createDataFrame([(x / 100,) for x in v], "x double")
        pairs[f"p{i}"] = (df(a), df(b), None, None)
        want[f"p{i}"] = agree(a, b, 2)
    unlike = {r.name for r in R.multiset_diffs(pairs, 0.02).select("name").distinct().collect()}
    assert {n: n not in unlike for n in want} == want
