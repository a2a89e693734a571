import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwise.operators import dedup_by_key, insert_if_absent, load_batches
from cartwise.plans.prepare import prepare
from cartwise.specs import SPECS


def test_winner_independent_of_partitioning(spark):
    rows = [(1, "b", 2), (1, "a", 9), (1, None, 1), (2, "z", 1), (None, "q", 0), (3, "c", None), (3, "c", 5)]
    results = []
    for parts in (1, 3, 8):
        shuffled = rows[:]
        random.Random(parts).shuffle(shuffled)
        df = spark.createDataFrame(shuffled, "k long, a string, b int").repartition(parts)
        results.append(sorted(tuple(r) for r in dedup_by_key(df, "k").collect()))
    assert results[0] == results[1] == results[2]
    # ascending over the remaining columns, NULLs last; NULL key dropped
    assert results[0] == [(1, "a", 9), (2, "z", 1), (3, "c", 5)]


def test_agg_equals_window(spark):
    rng = random.Random(7)
    rows = [(rng.randint(0, 30), rng.choice(["x", "y", None]), rng.randint(0, 5)) for _ in range(400)]
    df = spark.createDataFrame(rows, "k long, a string, b int")
    a = sorted(tuple(r) for r in dedup_by_key(df, "k").collect())
    w = Window.partitionBy("k").orderBy(F.col("a").asc_nulls_last(), F.col("b").asc_nulls_last())
    b = sorted(tuple(r) for r in df.withColumn("n", F.row_number().over(w)).where("n = 1").drop("n").collect())
    assert a == b


def test_key_that_coerces_to_null_is_dropped(spark):
    spec = SPECS["tb_users"]
    raw = spark.createDataFrame([("1", "u1"), ("x", "u2"), (None, "u3"), ("1.0", "u0")], "pk string, p_uid string")
    out = sorted(tuple(r) for r in prepare(raw, spec).collect())
    assert out == [(1, "u0")]


def test_insert_if_absent(spark):
    b1 = spark.createDataFrame([(1, "a")], "k long, v string")
    b2 = spark.createDataFrame([(1, "b"), (2, "c")], "k long, v string")
    out = sorted(tuple(r) for r in insert_if_absent(b1, b2, "k").collect())
    assert out == [(1, "a"), (2, "c")]
    out = sorted(tuple(r) for r in load_batches([b1, b2, b2], "k").collect())
    assert out == [(1, "a"), (2, "c")]


def test_load_many_batches_in_one_exchange(spark):
    batches = [spark.createDataFrame([(i % 5, f"v{i}")], "k long, v string") for i in range(12)]
    loaded = load_batches(batches, "k")
    plan = loaded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    out = sorted(tuple(r) for r in loaded.collect())
    assert out == [(0, "v0"), (1, "v1"), (2, "v2"), (3, "v3"), (4, "v4")]


def test_load_metrics_counts(spark):
    from cartwise.operators import load_metrics, table_counts

    spec = SPECS["tb_users"]
    raw = spark.createDataFrame([("1", "a"), ("1", "b"), ("x", "c"), (None, "d"), ("2.5", "e"), ("3", None)],
                                "pk string, p_uid string")
    m = load_metrics(raw, spec).first().asDict()
    assert m == {"table_name": "tb_users", "rows_read": 6, "null_keys": 3, "duplicates": 1,
                 "rejected_values": 2, "rows_kept": 2}
    counts = {r.table_name: r.row_count for r in table_counts({"users": prepare(raw, spec)}).collect()}
    assert counts == {"users": 2}
