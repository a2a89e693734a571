"""Insert-if-absent across load batches: the first batch that holds a key wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import dedup_by_key


def insert_if_absent(
    target: DataFrame, batch: DataFrame, keys: str | Sequence[str], order: Sequence[str] | None = None
) -> DataFrame:
    """``target`` plus the rows of ``batch`` whose key is not in ``target``.

    ``batch`` is first reduced to one row per key (NULL keys dropped). Keys that
    already exist are found with a semi join of the target against the batch's
    keys — when the batch is small the planner broadcasts those keys and the
    target is scanned once without a shuffle — and then removed with an anti
    join against that (at most batch-sized) set.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    fresh = dedup_by_key(batch, keys, order)
    existing = target.select(*keys).join(fresh.select(*keys), keys, "left_semi")
    new_rows = fresh.join(existing, keys, "left_anti")
    return target.unionByName(new_rows)


BATCH_SEQ = "_batch_seq"


def load_batches(batches: Sequence[DataFrame], keys: str | Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """The table that ``insert_if_absent`` builds from a known list of batches in arrival order.

    The first batch that holds a key wins, so a row's batch number is simply the first thing that rows of one
    key are ordered by: one union, one aggregate, one exchange, for any number of batches.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = list(order) if order is not None else [c for c in batches[0].columns if c not in keys]
    tagged = [b.withColumn(BATCH_SEQ, F.lit(i)) for i, b in enumerate(batches)]
    whole = tagged[0]
    for b in tagged[1:]:
        whole = whole.unionByName(b)
    return dedup_by_key(whole, keys, [BATCH_SEQ, *rest]).drop(BATCH_SEQ)
