"""Plan shape guards: the properties the design relies on, read from explain()."""

import pytest

import __spark_entry__ as E
from cartwise.plans.suite import QUERIES
from conftest import SF_SMALL

SKIP = {"stream_ingest", "delimited_roundtrip", "ragged_rows", "source_files", "report_files"}  # these write files while being built


def _plan(df, capsys) -> str:
    capsys.readouterr()
    df.explain(mode="formatted")
    return capsys.readouterr().out


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP))
def test_no_cartesian_or_nested_loop(spark, capsys, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL), capsys)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_topk_sum_limits_map_side(spark, capsys):
    plan = _plan(E.queries()["topk_sum_at_least"](spark, SF_SMALL), capsys)
    assert "WindowGroupLimit" in plan


def test_entry_scan_is_pruned(spark, capsys):
    plan = _plan(E.queries()["top_products"](spark, SF_SMALL), capsys)
    read = [ln for ln in plan.splitlines() if ln.strip().startswith("ReadSchema")]
    assert read and all("l_returnflag" not in ln and "l_comment" not in ln for ln in read)
