import datetime as dt
from decimal import Decimal as D

from fixtures import prepared

from cartwise.plans import reports
from cartwise.plans.export import ordered_lines, top_cart_lines
from cartwise.plans.views import cart_enriched, cart_item_summary, cart_items


def _items(spark):
    return cart_items(prepared(spark)["tb_cartentries"])


def test_cart_items_and_summary(spark):
    items = _items(spark)
    ids = sorted(r.entry_id for r in items.collect())
    assert 6 not in ids and 5 in ids and len(ids) == 13
    e7 = items.where("entry_id = 7").first()
    assert e7.quantity == D("0.0000") and e7.total_price == D("0.0000")
    assert items.where("entry_id = 1").first().month == dt.date(2024, 1, 1)
    s = {r.cart_id: (r.item_quantity_sum, r.item_count) for r in cart_item_summary(items).collect()}
    assert s[10] == (D("7.0000"), 4) and s[11] == (D("0.0000"), 1) and s[99] == (D("1.0000"), 1)


def test_enriched(spark):
    p = prepared(spark)
    e = {r.cart_id: r for r in cart_enriched(p, cart_items(p["tb_cartentries"])).collect()}
    assert sorted(e) == [10, 11, 12, 13]  # the orphan cart 99 is not a cart
    assert (e[10].state, e[10].user_uid, e[10].installments, e[10].site_name) == ("SP", "u|1", 3, "site one")
    assert e[11].state is None and e[11].site_name is None and e[11].installments is None
    assert e[12].postal_code is None and e[12].cart_total_price == D("0.0000")
    assert (e[12].item_quantity_sum, e[12].item_count) == (D("0.0000"), 0)
    assert e[13].cart_date is None and e[10].month == dt.date(2024, 1, 1)
    # pruned form: only the requested columns, same values
    slim = cart_enriched(p, cart_items(p["tb_cartentries"]), need=("cart_id", "state"))
    assert slim.columns == ["cart_id", "state"]
    assert {r.cart_id: r.state for r in slim.collect()} == {k: v.state for k, v in e.items()}


def test_top_products_order(spark):
    rows = [tuple(r) for r in reports.top_products(_items(spark), 50).collect()]
    assert [r[0] for r in rows] == [700, 501, 500, None]
    assert rows[1] == (501, 3, D("2.0000"), D("6.0000"))  # orphan cart 99 counted; NULL price as 0


def test_top_pairs_counts_once_per_cart(spark):
    rows = [tuple(r) for r in reports.top_pairs(_items(spark), 50).collect()]
    assert rows == [(500, 501, 1)]


def test_rising_products_month_gap(spark):
    rows = [tuple(r) for r in reports.rising_products(_items(spark), 50).collect()]
    assert rows == [(700, dt.date(2024, 4, 1), 2, 5, 3, D("150.00"))]


def test_first_month_and_product_month(spark):
    fm = {r.product_id: tuple(r)[1:] for r in reports.first_month(_items(spark)).collect()}
    assert set(fm) == {500, 501, 700}  # NULL product has no launch
    assert fm[501] == (dt.date(2024, 1, 1), 3, D("2.0000"), D("6.0000"))
    pm = [(r.product_id, r.month) for r in reports.product_month(_items(spark)).collect()]
    jan, apr = dt.date(2024, 1, 1), dt.date(2024, 4, 1)
    assert pm == [(500, jan), (501, jan), (700, jan), (None, jan), (700, apr)]


def test_state_and_daily(spark):
    p = prepared(spark)
    enr = cart_enriched(p, cart_items(p["tb_cartentries"]), need=reports.ROLLUP_NEED)
    st = [tuple(r) for r in reports.by_state(enr).collect()]
    assert st == [("SP", 3, D("7.0000"), D("150.0000")), ("SEM_UF", 1, D("0.0000"), D("100.0000"))]
    days = [r.cart_date for r in reports.daily(enr).collect()]
    assert days == [dt.date(2024, 1, 5), dt.date(2024, 1, 6), dt.date(2024, 2, 1), None]


def test_top_carts_ties_and_items(spark):
    p = prepared(spark)
    rows = reports.top_carts(p, cart_items(p["tb_cartentries"]), 2).collect()
    assert [(r.cart_id, r.entry_number) for r in rows] == [(10, 1), (10, 2), (10, 3), (10, 4), (11, 1)]


def test_export_lines(spark):
    p = prepared(spark)
    lines = [r.line for r in ordered_lines(top_cart_lines(p, cart_items(p["tb_cartentries"]), 4)).collect()]
    assert lines == [
        '10|2024-01-05 10:00:00|100.0000|"u|1"|1-URGENT|3|site one|01000|7.0000|4',
        "500|1.0000|10.0000|",
        "500|2.0000|20.0000|",
        "501|1.0000|5.0000|",
        "11|2024-01-06 00:00:00.500000|100.0000|u2|1-URGENT|||02000|0.0000|1",
        "501|0.0000|0.0000|",
        '13||50.0000|"u|1"|1-URGENT|3|site one|01000|0.0000|0',
        "12|2024-02-01 00:00:00|0.0000|\"u|1\"|1-URGENT|3|site one||0.0000|0",
    ]


def test_top_carts_rows_and_line_order(spark):
    p = prepared(spark)
    items = cart_items(p["tb_cartentries"])
    assert len(reports.top_carts(p, items, 3).collect()) == 6
    assert [r.line for r in ordered_lines(top_cart_lines(p, items, 4)).collect()][0].startswith("10|")


def test_reports_from_basket_months(spark):
    """R1, R2 and the product months made from the written sums equal those made from the entries, with one exchange by product and cart."""
    p = prepared(spark)
    items = cart_items(p["tb_cartentries"])
    again = items.unionByName(items.selectExpr(
        "cart_id", "entry_id + 100 as entry_id", "product_id", "quantity", "total_price", "entry_number", "entry_created_ts",
        "cast(add_months(month, 1) as date) as month"))  # products that a cart holds in two months
    months = reports.basket_months(again)
    assert reports.top_product_totals(months, 50).dtypes == reports.top_products(again, 50).dtypes
    assert reports.top_product_totals(months, 50).collect() == reports.top_products(again, 50).collect()
    assert reports.top_pairs(months.where("first"), 50, distinct=True).collect() == reports.top_pairs(again, 50).collect()
    stats = reports.product_month_totals(months)
    assert stats.dtypes == reports.product_month_stats(again).dtypes
    assert sorted(stats.collect(), key=repr) == sorted(reports.product_month_stats(again).collect(), key=repr)
    plan = reports.basket_months(again)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(product_id") == 1
