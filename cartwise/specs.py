"""Declared source tables.

Each ``TableSpec`` drives reading (file, format, source column spelling),
normalisation (renames, lower case), lenient coercion (target types) and
one-row-per-key de-duplication (key).
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Target type names understood by ``cartwise.functions.coerce``.
BIGINT, INT, DEC, TS, STR = "bigint", "int", "decimal(18,4)", "timestamp_ntz", "string"


@dataclass(frozen=True)
class TableSpec:
    name: str
    fmt: str  # "csv" or "parquet"
    file: str
    columns: tuple[str, ...]  # source spelling, in file order
    types: dict = field(default_factory=dict)  # normalised name -> target type
    key: str = "pk"

    @property
    def normalized(self) -> tuple[str, ...]:
        return tuple(normalize_name(c) for c in self.columns)

    def target_type(self, column: str) -> str:
        return self.types.get(column, STR)


def normalize_name(column: str) -> str:
    return column.lower()


# The 8 source tables, their files, columns, keys and column types.
SPECS: dict[str, TableSpec] = {
    s.name: s
    for s in (
        TableSpec("tb_regions", "csv", "tb_regions.csv", ("PK", "p_isocode", "p_isocodeshort"), {"pk": BIGINT}),
        TableSpec("tb_paymentmodes", "csv", "tb_paymentmodes.csv", ("PK", "p_code"), {"pk": BIGINT}),
        TableSpec("tb_cmssitelp", "csv", "tb_cmssitelp.csv", ("ITEMPK", "p_name"), {"itempk": BIGINT}, key="itempk"),
        TableSpec("tb_users", "csv", "tb_users.csv", ("PK", "p_uid"), {"pk": BIGINT}),
        TableSpec(
            "tb_paymentinfos", "parquet", "tb_paymentinfos.parquet", ("PK", "p_installments"),
            {"pk": BIGINT, "p_installments": INT},
        ),
        TableSpec(
            "tb_addresses", "parquet", "tb_addresses.parquet", ("PK", "p_region", "p_postalcode"),
            {"pk": BIGINT, "p_region": BIGINT},
        ),
        TableSpec(
            "tb_carts", "parquet", "tb_carts.parquet",
            ("PK", "createdTS", "p_totalprice", "p_paymentaddress", "p_paymentinfo", "p_paymentmode", "p_user", "p_site"),
            {
                "pk": BIGINT, "createdts": TS, "p_totalprice": DEC, "p_paymentaddress": BIGINT,
                "p_paymentinfo": BIGINT, "p_paymentmode": BIGINT, "p_user": BIGINT, "p_site": BIGINT,
            },
        ),
        TableSpec(
            "tb_cartentries", "parquet", "tb_cartentries.parquet",
            ("PK", "createdTS", "p_order", "p_entrynumber", "p_product", "p_quantity", "p_totalprice"),
            {
                "pk": BIGINT, "createdts": TS, "p_order": BIGINT, "p_entrynumber": INT,
                "p_product": BIGINT, "p_quantity": DEC, "p_totalprice": DEC,
            },
        ),
    )
}

