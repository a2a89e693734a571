"""Prepared tables: normalised names, lenient types, one row per key."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import COERCED, coerce_frame, q, with_coerced
from ..operators.dedup import dedup_by_key
from ..operators.metrics import REJECTED, ROWS, rejected_sql
from ..specs import SPECS, TableSpec


def prepare(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Coerce, drop rows whose (coerced) key is NULL, keep the first row per key.

    The winner among rows sharing a key is the smallest in the order of the
    remaining declared columns (NULLs last), so reruns and different partition
    counts pick the same row.
    """
    return dedup_by_key(coerce_frame(raw, spec), spec.key)


def prepare_counted(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """As ``prepare``, but with the row of the NULL key, and with each key's number of rows and of rejected values: the load
    metrics are sums over it, so the source is read once for both."""
    both = with_coerced(raw, spec).selectExpr(*[f"{q(COERCED + n)} as {q(n)}" for n in spec.normalized], f"{rejected_sql(spec)} as _rej")
    counts = (F.count(F.lit(1)).alias(ROWS), F.sum("_rej").alias(REJECTED))
    return dedup_by_key(both, spec.key, drop_null_keys=False, extra=counts, measures=("_rej",))


def without_counts(counted: DataFrame, spec: TableSpec) -> DataFrame:
    """The prepared table in ``prepare_counted``'s result."""
    return counted.where(F.col(spec.key).isNotNull()).select(*spec.normalized)


class LazyTables(Mapping):
    """Name -> DataFrame, each built on first access (plans only, nothing runs).

    A report that needs two of the eight tables never analyses the other six.
    """

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def prepare_all(raw_tables: Mapping[str, DataFrame]) -> LazyTables:
    return LazyTables({name: (lambda n=name: prepare(raw_tables[n], SPECS[n])) for name in raw_tables})
