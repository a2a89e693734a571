import glob
import os

from cartwise.plans.job import EXPORT_NAME, REPORTS, run_job
from cartwise.sources import driver
from conftest import SF_SMALL


def test_run_job_end_to_end(spark, tmp_path):
    out = str(tmp_path / "out")
    kept = run_job(spark, data_dir=None, output_dir=out, top_limit=5, stage_dir=str(tmp_path / "stage"),
                   raw_tables=driver.source_tables(spark, SF_SMALL))
    assert kept["tb_regions"]["rows_kept"] == 25 and kept["tb_paymentmodes"]["rows_kept"] == 5
    pm = kept["tb_paymentmodes"]
    assert pm["rows_read"] == pm["rows_kept"] + pm["duplicates"] + pm["null_keys"] and pm["duplicates"] > 0
    assert kept["tb_cartentries"]["rejected_values"] == 0
    # the metrics equal the registered load_metrics query
    from cartwise.plans.suite import q_load_metrics

    for r in q_load_metrics(spark, SF_SMALL).collect():
        m = kept[r["table_name"]]
        assert (m["rows_read"], m["null_keys"], m["duplicates"], m["rejected_values"], m["rows_kept"]) == (
            r["rows_read"], r["null_keys"], r["duplicates"], r["rejected_values"], r["rows_kept"]), r["table_name"]
    for name in REPORTS:
        parts = glob.glob(os.path.join(out, f"{name}.csv", "part-*"))
        assert parts, name
        with open(sorted(parts)[0]) as f:
            assert f.readline().strip()  # header line
    lines = []
    for part in sorted(glob.glob(os.path.join(out, EXPORT_NAME, "part-*"))):
        with open(part) as f:
            lines += f.read().splitlines()
    heads = [ln for ln in lines if ln.count("|") == 9]
    assert len(heads) == 5
    assert all(ln.endswith("|") and ln.count("|") == 3 for ln in lines if ln.count("|") != 9)
    # bounded reports are single files
    assert len(glob.glob(os.path.join(out, "top_produtos_abandonados.csv", "part-*"))) == 1


def _write_sources(spark, data):
    from fixtures import ROWS, SCHEMAS

    from cartwise.specs import SPECS

    data.mkdir()
    for name, spec in SPECS.items():
        df = spark.createDataFrame(ROWS[name], SCHEMAS[name]).toDF(*spec.columns)
        if spec.fmt == "csv":
            lines = ["|".join(f'"{c}"' for c in spec.columns)]
            lines += ["|".join("" if v is None else (f'"{v}"' if "|" in str(v) else str(v)) for v in r) for r in ROWS[name]]
            (data / spec.file).write_text("\n".join(lines) + "\n", encoding="utf-8")
        else:
            df.coalesce(1).write.parquet(str(data / spec.file))


def test_cli_prepare_then_reports(spark, tmp_path, capsys):
    from cartwise.plans.job import main

    _write_sources(spark, tmp_path / "data")
    stage, out = str(tmp_path / "stage"), str(tmp_path / "out")
    main(["prepare", "--data-dir", str(tmp_path / "data"), "--stage-dir", stage])
    rows = [line.split("\t") for line in capsys.readouterr().out.strip().splitlines()]
    counts = {r[0]: r[1] for r in rows[1:]}
    assert rows[0][:2] == ["table", "rows_kept"]
    assert counts["tb_carts"] == "4" and counts["tb_regions"] == "1"
    main(["counts", "--stage-dir", stage])
    assert "tb_carts: 4" in capsys.readouterr().out.splitlines()
    main(["reports", "--stage-dir", stage, "--output-dir", out, "--top-limit", "2"])
    for name in REPORTS:
        assert glob.glob(os.path.join(out, f"{name}.csv", "part-*")), name


def test_run_job_from_source_files(spark, tmp_path):
    """The catalogue path: 4 pipe-delimited CSV and 4 Parquet files in source spelling."""
    from fixtures import ROWS, SCHEMAS

    from cartwise.specs import SPECS

    data = tmp_path / "data"
    data.mkdir()
    for name, spec in SPECS.items():
        df = spark.createDataFrame(ROWS[name], SCHEMAS[name]).toDF(*spec.columns)
        if spec.fmt == "csv":
            lines = ["|".join(f'"{c}"' for c in spec.columns)]
            lines += ["|".join("" if v is None else (f'"{v}"' if "|" in str(v) else str(v)) for v in r) for r in ROWS[name]]
            (data / spec.file).write_text("\n".join(lines) + "\n", encoding="utf-8")
        else:
            df.coalesce(1).write.parquet(str(data / spec.file))
    out = str(tmp_path / "out")
    kept = run_job(spark, str(data), out, top_limit=4, stage_dir=str(tmp_path / "stage"))
    assert kept["tb_users"]["rows_kept"] == 2
    assert kept["tb_cartentries"]["rows_kept"] == len(ROWS["tb_cartentries"])
    assert kept["tb_carts"]["rows_read"] == 4 and kept["tb_carts"]["null_keys"] == 0
    lines = []
    for part in sorted(glob.glob(os.path.join(out, EXPORT_NAME, "part-*"))):
        with open(part) as f:
            lines += f.read().splitlines()
    assert lines[0] == '10|2024-01-05 10:00:00|100.0000|"u|1"|1-URGENT|3|site one|01000|7.0000|4'
    assert len(lines) == 8


def test_named_views_and_no_table_left(spark, tmp_path):
    run_job(spark, None, str(tmp_path / "out"), 5, raw_tables=driver.source_tables(spark, SF_SMALL), register=True)
    assert spark.sql("select count(*) from cart_enriched").first()[0] == spark.table("prepared_tb_carts").count()
    assert spark.sql("select sum(item_count) from cart_item_summary").first()[0] == spark.table("cart_items").count()
    assert [t.name for t in spark.catalog.listTables() if not t.isTemporary] == []
    for name in ("cart_items", "cart_item_summary", "cart_enriched", *(f"prepared_{t}" for t in driver.source_tables(spark, SF_SMALL))):
        spark.catalog.dropTempView(name)


def test_staged_pairs_keep_a_splittable_exchange(spark, tmp_path):
    from cartwise.operators.pairs import pair_counts
    from cartwise.plans.job import prepare_to, staged_tables

    stage = str(tmp_path / "stage")
    assert prepare_to(spark, None, stage, driver.source_tables(spark, SF_SMALL), metrics=False) == {}
    items = staged_tables(spark, stage)["cart_items"].select("cart_id", "product_id").distinct()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = pair_counts(items)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange hashpartitioning(_basket" in plan and "Join" not in plan and "Bucketed: true" not in plan


def test_sources_are_scanned_once_for_tables_and_metrics(spark, tmp_path):
    """The staged table carries its counts per key; metrics read it and not the source."""
    from cartwise.operators.metrics import load_metrics, staged_metrics
    from cartwise.plans.job import prepare_to, staged_tables
    from cartwise.plans.prepare import prepare, prepare_counted
    from cartwise.specs import SPECS

    spec = SPECS["tb_users"]
    source, stage = str(tmp_path / "source"), str(tmp_path / "stage")
    rows = [("1", "a"), ("1", "b"), ("1.0", "a"), ("x", "c"), (None, "d"), ("2", None), ("3", "e")]
    spark.createDataFrame(rows, "pk string, p_uid string").write.parquet(source)
    raw = spark.read.parquet(source)
    got = prepare_to(spark, None, stage, {**driver.source_tables(spark, SF_SMALL), "tb_users": raw})["tb_users"]
    assert got == {"rows_read": 7, "null_keys": 2, "duplicates": 2, "rejected_values": 1, "rows_kept": 3}
    assert load_metrics(raw, spec).first().asDict() == {"table_name": "tb_users", **got}
    users = staged_tables(spark, stage)["tb_users"]
    assert users.columns == list(spec.normalized) and sorted(map(tuple, users.collect()), key=repr) == sorted(map(tuple, prepare(raw, spec).collect()), key=repr)
    plan = prepare_counted(raw, spec)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    read = staged_metrics(spark.read.parquet(f"{stage}/tb_users"), spec)
    assert read.inputFiles() and all(f"{stage}/tb_users" in f for f in read.inputFiles())


def test_work_runs_side_by_side_and_fails_by_name(spark):
    import threading

    import pytest

    from cartwise.plans.job import together

    meet = threading.Barrier(3, timeout=30)  # passes only if three are under way at once
    assert together(spark, {str(i): lambda i=i: (meet.wait(), i)[1] for i in range(3)}) == {"0": 0, "1": 1, "2": 2}
    ended = []

    def broken():
        raise ValueError("no such column")

    with pytest.raises(RuntimeError, match="daily failed: no such column"):
        together(spark, {"by_state": lambda: ended.append(1), "daily": broken, "top": lambda: ended.append(2)})
    assert sorted(ended) == [1, 2]


def test_report_lines_are_numbered_without_one_window(spark, tmp_path):
    from cartwise.plans.suite import _numbered
    from pyspark.sql import functions as F

    for i, lines in enumerate((["h", "a", "b"], ["h"], ["h", "c"])):
        (tmp_path / f"part-{i}.csv").write_text("\n".join(lines) + "\n")
    lines = spark.read.text(str(tmp_path)).select("value", "_metadata.file_name", F.monotonically_increasing_id().alias("at"))
    out = _numbered(lines, 1)
    assert sorted(map(tuple, out.collect())) == [(1, "a"), (2, "b"), (3, "c")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(file_name" in plan.replace("#", " ").replace("file_name ", "file_name", 1) and plan.count("Window [") == 1


def test_lines_of_a_file_read_by_several_tasks_are_not_shuffled(spark, tmp_path):
    from cartwise.plans.suite import _numbered
    from pyspark.sql import functions as F

    want = []
    for i, n in enumerate((40, 1, 25)):
        (tmp_path / f"part-{i}.csv").write_text("header\n" + "".join(f"line {i} {j}\n" for j in range(n)))
        want += [f"line {i} {j}" for j in range(n)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = spark.read.text(str(tmp_path)).select("value", "_metadata.file_name", F.monotonically_increasing_id().alias("at"))
        assert lines.rdd.getNumPartitions() > 6
        out = _numbered(lines, 1)
        assert sorted(map(tuple, out.collect())) == list(enumerate(want, 1))
        assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_the_job_writes_entries_once(spark, tmp_path):
    """``cart_items`` is a projection of the staged entries, and the shared sums are the only other table by product."""
    stage = tmp_path / "stage"
    run_job(spark, None, str(tmp_path / "out"), 5, stage_dir=str(stage), raw_tables=driver.source_tables(spark, SF_SMALL))
    names = {p.name for p in stage.iterdir()}
    assert not names & {"cart_items", "basket_products"} and names >= {"basket_months", "product_month_stats", "cart_rollup"}


def test_lookups_are_broadcast_by_rows_not_by_compressed_bytes(spark, tmp_path, monkeypatch):
    """Staged tables are a few bytes a row on disk and over a hundred in the driver, so only counted ones are broadcast."""
    from cartwise.plans import reports, views
    from cartwise.plans.job import prepare_to, staged_tables

    n = 3000  # its files are far below the planner's threshold
    raw = {k: v for k, v in driver.source_tables(spark, SF_SMALL).items()}
    raw["tb_addresses"] = spark.range(n).selectExpr("id as pk", "cast(id % 31 as bigint) as p_region", "'12345' as p_postalcode")
    raw["tb_users"] = spark.range(n).selectExpr("id as pk", "concat('u', id) as p_uid")
    prepare_to(spark, None, str(tmp_path / "stage"), raw, metrics=False)

    def answers():
        staged = staged_tables(spark, str(tmp_path / "stage"))
        items = staged.pop("cart_items")
        need = ("cart_id", "user_uid", "state", "postal_code", "site_name")
        df = views.cart_enriched(staged, items, need=need)
        plan = df._jdf.queryExecution().executedPlan().toString()
        export = reports.top_carts(staged, items, 5)
        return staged.rows, plan, sorted(map(str, df.collect())), list(map(str, export.collect()))

    rows, small_plan, whole, export = answers()
    assert rows["tb_users"] == rows["tb_addresses"] == n and rows["tb_regions"] == 25
    assert small_plan.count("BroadcastHashJoin") == 4
    monkeypatch.setattr(views, "MAX_LOOKUP_ROWS", n - 1)
    _, plan, got, again = answers()
    assert plan.count("SortMergeJoin") == plan.count("BroadcastHashJoin") == 2  # users and addresses; regions and sites
    assert got == whole and again == export and len(got) > 0
