"""Cross-report invariants on the driver tables and coercion properties."""

from decimal import Decimal, InvalidOperation

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.functions.coerce import to_integer
from cartwise.operators import dedup_by_key
from cartwise.plans import reports
from cartwise.plans.views import cart_enriched, cart_items
from cartwise.sources import driver
from cartwise.plans.prepare import prepare_all
from conftest import SF_SMALL


def _sum(df, c):
    return df.agg(F.sum(c)).first()[0]


def test_report_totals_agree(spark):
    p = prepare_all(driver.source_tables(spark, SF_SMALL))
    items = cart_items(p["tb_cartentries"])
    enr = cart_enriched(p, items, need=reports.ROLLUP_NEED)
    n_carts = p["tb_carts"].count()
    assert _sum(reports.product_month(items), "abandoned_items") == _sum(items, "quantity")
    assert _sum(reports.daily(enr), "abandoned_carts") == n_carts
    assert _sum(reports.by_state(enr), "abandoned_carts") == n_carts
    assert _sum(reports.by_state(enr), "unrealized_revenue") == _sum(p["tb_carts"], "p_totalprice")


def test_dedup_idempotent(spark):
    p = prepare_all(driver.source_tables(spark, SF_SMALL))
    once = p["tb_cartentries"]
    twice = dedup_by_key(once, "pk")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def _expected(text):
    try:
        d = Decimal(text.strip())
    except InvalidOperation:
        return None
    if not d.is_finite() or d.adjusted() > 30:  # far beyond bigint; avoids huge ints
        return None
    if d != d.to_integral_value():
        return None
    v = int(d)
    return v if -(2 ** 63) <= v < 2 ** 63 else None


integer_texts = st.one_of(
    st.integers(-(2 ** 70), 2 ** 70).map(str),
    st.decimals(allow_nan=False, allow_infinity=False, places=2, min_value=-10 ** 6, max_value=10 ** 6).map(str),
    st.text(alphabet=" 0123456789.eE-+x", min_size=1, max_size=8),
)


@settings(max_examples=3, deadline=None)
@given(st.lists(integer_texts, min_size=50, max_size=120))
def test_integer_coercion_matches_exact_rule(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(to_integer("s", T.StringType())).collect()]
    bad = [(t, g, _expected(t)) for t, g in zip(texts, got) if g != _expected(t)]
    assert not bad, bad[:5]
