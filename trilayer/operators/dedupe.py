"""De-duplication that always keeps the same row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``order_by``, then by the other columns.

    The survivor is a ``min`` over a struct, so every task first reduces its own
    rows to one per key. A key that owns a third of the table therefore sends one
    row per task through the shuffle, where a ``row_number`` window would sort
    all of its rows in a single task.
    """
    keys = list(keys)
    ranked = list(order_by) + [c for c in df.columns if c not in keys and c not in order_by]
    if not ranked:
        return df.distinct()
    kept = df.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("_kept"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"_kept.{c}").alias(c) for c in df.columns])
