"""Literal basket tables covering the edge cases (orphans, NULLs, ties, month gaps)."""

import datetime as dt
from decimal import Decimal as D

from cartwise.plans.prepare import LazyTables

ENTRIES = [
    (1, dt.datetime(2024, 1, 10), 10, 1, 500, D("1"), D("10")),
    (2, dt.datetime(2024, 1, 11), 10, 2, 500, D("2"), D("20")),  # same product twice in a cart
    (3, dt.datetime(2024, 1, 12), 10, 3, 501, D("1"), D("5")),
    (4, dt.datetime(2024, 1, 12), 10, 4, None, D("3"), D("7")),  # NULL product
    (5, dt.datetime(2024, 1, 13), 99, 1, 501, D("1"), D("1")),  # orphan entry (no cart 99)
    (6, dt.datetime(2024, 1, 13), None, 1, 501, D("1"), D("1")),  # NULL cart reference
    (7, dt.datetime(2024, 1, 14), 11, 1, 501, None, None),  # NULL quantity and price
    (8, dt.datetime(2024, 1, 15), 20, 1, 700, D("1"), D("1")),
    (9, dt.datetime(2024, 1, 16), 21, 1, 700, D("1"), D("1")),
] + [(10 + i, dt.datetime(2024, 4, 1 + i), 30 + i, 1, 700, D("1"), D("1")) for i in range(5)]  # month gap

CARTS = [
    (10, dt.datetime(2024, 1, 5, 10, 0, 0), D("100"), 1, 1, 1, 1, 1),
    (11, dt.datetime(2024, 1, 6, 0, 0, 0, 500000), D("100"), 2, 2, 1, 2, 9),  # tie on price; unknown site/info
    (12, dt.datetime(2024, 2, 1), None, 3, 1, 1, 1, 1),  # no entries, NULL price, postal 'nan'
    (13, None, D("50"), 1, 1, 1, 1, 1),  # NULL date
]

SCHEMAS = {
    "tb_cartentries": "pk long, createdts timestamp_ntz, p_order long, p_entrynumber int, p_product long, "
                      "p_quantity decimal(18,4), p_totalprice decimal(18,4)",
    "tb_carts": "pk long, createdts timestamp_ntz, p_totalprice decimal(18,4), p_paymentaddress long, "
                "p_paymentinfo long, p_paymentmode long, p_user long, p_site long",
    "tb_users": "pk long, p_uid string",
    "tb_paymentmodes": "pk long, p_code string",
    "tb_paymentinfos": "pk long, p_installments int",
    "tb_cmssitelp": "itempk long, p_name string",
    "tb_addresses": "pk long, p_region long, p_postalcode string",
    "tb_regions": "pk long, p_isocode string, p_isocodeshort string",
}

ROWS = {
    "tb_cartentries": ENTRIES,
    "tb_carts": CARTS,
    "tb_users": [(1, "u|1"), (2, "u2")],
    "tb_paymentmodes": [(1, "1-URGENT")],
    "tb_paymentinfos": [(1, 3)],
    "tb_cmssitelp": [(1, "site one")],
    "tb_addresses": [(1, 5, "01000"), (2, 77, "02000"), (3, 5, "nan")],
    "tb_regions": [(5, "BR-SP", "SP")],
}


def prepared(spark):
    return LazyTables({k: (lambda k=k: spark.createDataFrame(ROWS[k], SCHEMAS[k])) for k in ROWS})
