from cartwise.specs import SPECS
from cartwise.streaming.ingest import first_batch_wins_sink, start_ingest, stored_table


def _rows(df):
    return sorted(tuple(r) for r in df.select("pk", "p_uid").collect())


def test_first_batch_wins_and_replay_is_idempotent(spark, tmp_path):
    spec = SPECS["tb_users"]
    target = str(tmp_path / "users")
    sink = first_batch_wins_sink(spec, target)
    b0 = spark.createDataFrame([("1", "a"), ("1", "z")], "pk string, p_uid string")
    b1 = spark.createDataFrame([("1", "b"), ("2", "c"), (None, "n")], "pk string, p_uid string")
    sink(b0, 0)
    sink(b1, 1)
    sink(b1, 1)  # replay after a failure
    assert _rows(stored_table(spark, target, spec)) == [(1, "a"), (2, "c")]


def test_stream_over_arriving_files(spark, tmp_path):
    spec = SPECS["tb_users"]
    src = tmp_path / "incoming"
    schema = "pk string, p_uid string"
    spark.createDataFrame([("1", "a")], schema).coalesce(1).write.parquet(str(src / "0001"))
    spark.createDataFrame([("1", "b"), ("2", "c")], schema).coalesce(1).write.parquet(str(src / "0002"))
    q = start_ingest(spark, f"{src}/*", spark.createDataFrame([], schema).schema, spec, str(tmp_path / "t"),
                     str(tmp_path / "ck"), files_per_batch=1)
    q.awaitTermination()
    assert _rows(stored_table(spark, str(tmp_path / "t"), spec)) == [(1, "a"), (2, "c")]


def test_stream_over_csv_files(spark, tmp_path):
    from pyspark.sql import types as T

    spec = SPECS["tb_users"]
    src = tmp_path / "csv"
    src.mkdir()
    (src / "a.csv").write_text('"PK"|"p_uid"\n1|a\n', encoding="utf-8")
    schema = T.StructType([T.StructField("pk", T.StringType()), T.StructField("p_uid", T.StringType())])
    q = start_ingest(spark, str(src), schema, spec, str(tmp_path / "t"), str(tmp_path / "ck"), fmt="csv")
    q.awaitTermination()
    assert _rows(stored_table(spark, str(tmp_path / "t"), spec)) == [(1, "a")]


def test_unreadable_target_fails_the_batch(spark, tmp_path):
    import pytest

    spec = SPECS["tb_users"]
    target = tmp_path / "users"
    sink = first_batch_wins_sink(spec, str(target))
    assert _rows(stored_table(spark, str(target), spec)) == []
    sink(spark.createDataFrame([("1", "first")], "pk string, p_uid string").coalesce(1), 0)
    part = next(target.glob("*/_batch=0/part-*"))
    whole = part.read_bytes()
    for crc in target.glob("*/_batch=0/.*.crc"):
        crc.unlink()
    part.write_bytes(whole[:-8] + b"\0" * 8)  # the footer is gone
    later = spark.createDataFrame([("1", "second"), ("2", "b")], "pk string, p_uid string")
    with pytest.raises(Exception):
        sink(later, 1)
    part.write_bytes(whole)
    assert _rows(stored_table(spark, str(target), spec)) == [(1, "first")]
    sink(later, 1)
    assert _rows(stored_table(spark, str(target), spec)) == [(1, "first"), (2, "b")]


def test_a_batch_reads_only_its_own_slots(spark, tmp_path):
    """What a batch reads of the target does not grow with the target's history."""
    from cartwise.streaming import ingest

    spec = SPECS["tb_users"]
    target = str(tmp_path / "users")
    sink = first_batch_wins_sink(spec, target, slot_width=100)
    batch = lambda start: spark.range(start, start + 100).selectExpr("cast(id as string) as pk", f"'{start}' as p_uid")
    read = []
    for i in range(6):
        sink(batch(100 * i), i)
        table = spark.read.schema(ingest.target_schema(spec)).parquet(target)
        known = ingest.known_keys(table, i + 1, spec, [i])
        assert "SubqueryBroadcast" not in str(known._jdf.queryExecution().executedPlan())
        read.append((len(known.inputFiles()) and known.count(), ingest.known_keys(table, i + 1, spec, None).count()))
    assert [few for few, _ in read] == [100] * 6 and [every for _, every in read] == [100 * (i + 1) for i in range(6)]
    files = ingest.known_keys(table, 6, spec, [3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_batch" in files and "(_slot" in files.split("PushedFilters")[0]
    sink(batch(250), 6)  # half known, half known: nothing new
    sink(spark.createDataFrame([("-1", "low"), ("599", "late"), ("600", "new")], "pk string, p_uid string"), 7)
    got = dict(_rows(stored_table(spark, target, spec)))
    assert len(got) == 602 and got[-1] == "low" and got[599] == "500" and got[600] == "new" and got[250] == "200"


def test_more_slots_than_a_filter_names(spark, tmp_path, monkeypatch):
    from cartwise.streaming import ingest

    monkeypatch.setattr(ingest, "MAX_SLOTS", 2)
    spec = SPECS["tb_users"]
    sink = first_batch_wins_sink(spec, str(tmp_path / "users"), slot_width=1)
    rows = lambda uid: spark.createDataFrame([(str(i), uid) for i in range(5)], "pk string, p_uid string")
    sink(rows("a"), 0)
    sink(rows("b"), 1)
    assert _rows(stored_table(spark, str(tmp_path / "users"), spec)) == [(i, "a") for i in range(5)]
