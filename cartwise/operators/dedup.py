"""One row per key with a deterministic winner.

The winner is the first row in ascending order of ``order`` columns (default:
every non-key column in schema order), NULLs last. It is computed as an
aggregate, ``min(struct(...))`` per key, rather than a ``row_number`` window:
the aggregate is split into a map-side partial and a final step, so a key that
holds a large share of the rows is collapsed before the shuffle instead of
landing whole in one sort task. The result does not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def dedup_by_key(
    df: DataFrame,
    keys: str | Sequence[str],
    order: Sequence[str] | None = None,
    drop_null_keys: bool = True,
    extra: Sequence[Column] = (),
    measures: Sequence[str] = (),
) -> DataFrame:
    """``extra`` are further aggregates over the rows of a key (with aliases), appended as columns; ``measures`` are the columns
    of ``df`` that only they read."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = df.columns
    unread = set(measures)
    rest = [c for c in cols if c not in keys and c not in unread]
    order = list(order) if order is not None else rest
    payload = [c for c in rest if c not in order]
    # (is_null, value) pairs give ascending order with NULLs last.
    fields = [f"{_q(c)} is null as _n{i}, {_q(c)} as _v{i}" for i, c in enumerate(order)]
    fields += [f"{_q(c)} as _p{j}" for j, c in enumerate(payload)]
    names = {c: f"_v{i}" for i, c in enumerate(order)} | {c: f"_p{j}" for j, c in enumerate(payload)}
    if drop_null_keys:
        df = df.where(" and ".join(f"{_q(k)} is not null" for k in keys))
    best = df.groupBy(*keys).agg(F.expr(f"min(struct({', '.join(fields)}))").alias("_w"), *extra)
    more = [_q(c) for c in best.columns[len(keys) + 1:]]
    return best.selectExpr(*[_q(c) if c in keys else f"_w.{names[c]} as {_q(c)}" for c in cols if c not in unread], *more)

