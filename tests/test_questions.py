import random
import re

import pytest

from cartwise.operators import HierarchyTooDeep, league_points, nearest_ancestor, top_pairs, topk_sum_at_least


def test_league_points(spark):
    teams = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "time_id int, time_nome string")
    games = spark.createDataFrame([(1, 2, 2, 1), (2, 1, 0, 0), (1, 2, None, 1)],
                                  "mandante_time int, visitante_time int, mandante_gols int, visitante_gols int")
    assert [tuple(r) for r in league_points(teams, games).collect()] == [(1, "A", 4), (2, "B", 1), (3, "C", 0)]


def test_topk_sum(spark):
    rows = [(1, 1024.0), (2, 300.0), (2, 300.0), (2, 300.0), (2, 300.0), (3, None), (3, 500.0), (3, 400.0),
            (3, 200.0), (4, None), (4, 1024.0)]
    df = spark.createDataFrame(rows, "vendedor long, valor double")
    assert [r[0] for r in topk_sum_at_least(df, "vendedor", "valor", 3, 1024).collect()] == [1, 3, 4]


def test_nearest_ancestor_chain(spark):
    df = spark.createDataFrame([(1, None, 1000.0), (2, 1, 500.0), (3, 2, 260.0), (4, 3, 100.0), (5, 3, 260.0)],
                               "id long, lider_id long, salario double")
    assert [tuple(r) for r in nearest_ancestor(df).collect()] == [(1, None), (2, 1), (3, 1), (4, 3), (5, 1)]


def test_nearest_ancestor_cycle_raises(spark):
    df = spark.createDataFrame([(1, 2, 10.0), (2, 1, 10.0)], "id long, lider_id long, salario double")
    with pytest.raises(HierarchyTooDeep):
        nearest_ancestor(df, max_depth=16).collect()


def test_nearest_ancestor_matches_walk_up(spark):
    rng = random.Random(3)
    rows = [(1, None, 5000.0)]
    for i in range(2, 300):
        rows.append((i, rng.randint(max(1, i - 12), i - 1), float(rng.choice([None, 10, 50, 100, 200, 400, 900]) or 0)
                     if rng.random() > 0.05 else None))
    rows.append((300, 999, 5.0))  # parent missing from the table
    df = spark.createDataFrame(rows, "id long, lider_id long, salario double")
    above, pay = {i: p for i, p, _ in rows}, {i: v for i, _, v in rows}

    def first_paid_enough(i):
        boss = above[i]
        while boss in above:
            if pay[i] is not None and pay[boss] is not None and pay[boss] >= 2 * pay[i]:
                return boss
            boss = above[boss]
        return None

    want = [(i, first_paid_enough(i)) for i in sorted(above)]
    got = [tuple(r) for r in nearest_ancestor(df).collect()]
    assert got == want


def _brute_pairs(baskets, n):
    from collections import Counter
    from itertools import combinations

    c = Counter()
    for prods in baskets.values():
        for a, b in combinations(sorted(set(prods)), 2):
            c[(a, b)] += 1
    return sorted(((a, b, k) for (a, b), k in c.items()), key=lambda t: (-t[2], t[0], t[1]))[:n]


def test_pairs_heavy_baskets_exact(spark):
    rng = random.Random(11)
    baskets = {cid: [rng.randint(1, 40) for _ in range(rng.randint(1, 5))] for cid in range(300)}
    baskets[1000] = list(range(1, 120))  # one heavy basket with many distinct products
    baskets[1001] = list(range(50, 90)) * 2
    rows = [(cid, p) for cid, ps in baskets.items() for p in ps]
    items = spark.createDataFrame(rows, "cart_id long, product_id long")
    want = _brute_pairs(baskets, 25)
    for block, mat in ((500, True), (8, True), (8, False), (1, False)):
        got = [tuple(r) for r in top_pairs(items, 25, materialize=mat, block=block).collect()]
        assert got == want, (block, mat)


def test_pairs_of_a_huge_basket_are_spread(spark):
    """One basket of 5,000 products: block keys, many of them, each with a bounded number of pairs."""
    from pyspark.sql import functions as F

    from cartwise.operators.pairs import pair_counts

    big = spark.range(5000).select(F.lit(1).cast("long").alias("cart_id"), F.col("id").alias("product_id"))
    more = spark.createDataFrame([(2, 7), (2, 9), (3, 7), (3, 9), (4, 9), (4, 7)], "cart_id long, product_id long")
    items = big.unionByName(more)
    got = [tuple(r) for r in top_pairs(items, 3, materialize=False).collect()]
    assert got == [(7, 9, 4), (0, 1, 1), (0, 2, 1)]
    counts = pair_counts(items, block=500)
    assert counts.agg(F.sum("abandoned_carts")).first()[0] == 5000 * 4999 // 2 + 3
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Join Inner, .*_basket#\d+L? = _basket#\d+L?.*_i#\d+ = _i#\d+.*_j#\d+ = _j#\d+", plan)


def test_top_carts_one_plan_for_every_n(spark):
    from cartwise.plans import reports
    from cartwise.plans.prepare import prepare_all
    from cartwise.plans.views import cart_items
    from cartwise.sources import driver
    from conftest import SF_SMALL

    p = prepare_all(driver.source_tables(spark, SF_SMALL))
    items = cart_items(p["tb_cartentries"])
    shapes, rows = set(), {}
    for n in (5, 50, 20_000):
        df = reports.top_carts(p, items, n)
        shapes.add(re.sub(r"#\d+L?|plan_id=\d+|\b\d+\b", "", df._jdf.queryExecution().optimizedPlan().toString()))
        rows[n] = [tuple(r) for r in df.collect()]
    assert len(shapes) == 1
    assert rows[50][:len(rows[5])] == rows[5] and rows[20_000][:len(rows[50])] == rows[50]
