"""Bounded samples of labelled rows for fitting, and the split that keeps some of them out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def held_out(doc_id: str = "doc_id") -> Column:
    """True for a third of all documents, by the CRC-32 of the id as text; nothing is fitted on them.

    A null id counts as held out.
    """
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def training_sample(labelled: DataFrame, most: int, key: str = "doc_id") -> DataFrame:
    """At most ``most`` rows that are not held out, picked by a hash of their id.

    A threshold set from the row count leaves about four times as many before the sort.
    """
    rows, steps = labelled.where(~held_out(key)), 1 << 30
    chance = 4 * most / max(1, rows.count())
    order = F.xxhash64(F.col(key).cast("string"), F.lit("sample"))
    if chance < 1:
        rows = rows.where(F.pmod(order, F.lit(steps)) < int(chance * steps))
    return rows.orderBy(order, key).limit(most)
