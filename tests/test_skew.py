"""Hot keys: one key holding a third of the rows must give the same answer as a brute force."""

import random

from cartwise.operators import dedup_by_key, topk_sum_at_least


def test_dedup_hot_key(spark):
    rng = random.Random(5)
    rows = [(7, rng.randint(0, 10_000), rng.choice(["a", "b", None])) for _ in range(3000)]
    rows += [(k, rng.randint(0, 10_000), "c") for k in range(6000)]
    df = spark.createDataFrame(rows, "k long, x long, s string").repartition(8)
    got = {r.k: (r.x, r.s) for r in dedup_by_key(df, "k").collect()}
    hot = sorted(((x, s is None, s) for k, x, s in rows if k == 7))[0]
    assert got[7] == (hot[0], hot[2])
    assert len(got) == 6000


def test_topk_sum_hot_group(spark):
    rows = [(1, float(v)) for v in range(5000)] + [(2, 10.0), (2, 5.0)]
    df = spark.createDataFrame(rows, "vendedor long, valor double").repartition(8)
    # 4999 + 4998 + 4997 = 14994
    assert [r[0] for r in topk_sum_at_least(df, "vendedor", "valor", 3, 14994.0).collect()] == [1]
    assert [r[0] for r in topk_sum_at_least(df, "vendedor", "valor", 3, 14995.0).collect()] == []


def test_null_foreign_keys_are_spread(spark):
    """90 % of carts without a user: the join's exchange deals them over all partitions, without AQE's help."""
    from pyspark.sql import functions as F

    from cartwise.plans.views import cart_enriched

    carts = spark.range(20_000).selectExpr(
        "id as pk", "cast('2024-01-01' as timestamp_ntz) as createdts", "cast(1 as decimal(18,4)) as p_totalprice",
        "if(id % 10 = 0, id % 7, null) as p_user", "id as p_paymentmode", "id as p_paymentinfo", "id as p_site", "id as p_paymentaddress")
    users = spark.range(7).selectExpr("id as pk", "concat('u', id) as p_uid").where("pk is not null")
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = cart_enriched({"tb_carts": carts, "tb_users": users}, need=["user_uid"])
        rows = out.select("cart_id", "user_uid", F.spark_partition_id().alias("p")).collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(rows) == 20_000 and all(r["user_uid"] == (f"u{r['cart_id'] % 7}" if r["cart_id"] % 10 == 0 else None) for r in rows)
    sizes = [sum(r["p"] == p for r in rows) for p in range(8)]
    assert max(sizes) < 4_000
