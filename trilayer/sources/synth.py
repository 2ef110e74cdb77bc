"""Synthetic tables whose values depend only on seed, column and row number.

Every value is a hash, so a table is the same however it is partitioned and
whichever task is run again, and all rows are made in parallel.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

ROW = "_row"

# A column rule gets the row number and a source of independent 64-bit hashes.
Draw = Callable[[int], Column]
Rule = Callable[[Column, Draw], Column]


def _draws(seed: int, column: str) -> Draw:
    stream = zlib.crc32(column.encode())
    keys = lambda n: [F.lit(v).cast("bigint") for v in (seed, stream, n)]
    return lambda n: F.xxhash64(*keys(n), F.col(ROW))


# --- rules ------------------------------------------------------------------------


def numbered(start: int = 1, prefix: str = "", width: int = 0) -> Rule:
    """start, start+1, ...; with a prefix as text, zero-padded to ``width``."""

    def rule(row: Column, draw: Draw) -> Column:
        if not prefix:
            return (row + start).cast("int")
        digits = (row + start).cast("string")
        # Numbers longer than the width stay whole.
        return F.concat(F.lit(prefix), F.repeat(F.lit("0"), F.lit(width) - F.length(digits)), digits)

    return rule


def whole(low: int, high: int, type_: str = "bigint") -> Rule:
    """Uniform in [low, high)."""
    return lambda row, draw: (low + F.pmod(draw(0), F.lit(high - low))).cast(type_)


def amount(low: float, high: float, digits: int = 2) -> Rule:
    """Uniform in [low, high] with a fixed number of digits, as double."""
    unit = 10**digits
    first, last = round(low * unit), round(high * unit)
    return lambda row, draw: (first + F.pmod(draw(0), F.lit(last - first + 1))) / F.lit(unit)


def pick(*values, weights: Sequence[float] = (), type_: str = "string") -> Rule:
    """One of ``values``, equally likely unless weighted; None gives NULL."""

    def rule(row: Column, draw: Draw) -> Column:
        if not weights:
            at = F.pmod(draw(0), F.lit(len(values))).cast("int") + 1
            return F.element_at(F.array(*[F.lit(v).cast(type_) for v in values]), at)
        point, reached, out = F.pmod(draw(0), F.lit(1_000_000)), 0, None
        for value, weight in zip(values, weights):
            reached += round(weight * 1_000_000)
            out = (F if out is None else out).when(point < reached, F.lit(value).cast(type_))
        return out.otherwise(F.lit(values[-1]).cast(type_))

    return rule


def day(first: str, last: str) -> Rule:
    """A date in [first, last)."""
    days = (date.fromisoformat(last) - date.fromisoformat(first)).days
    return lambda row, draw: F.date_add(F.lit(first).cast("date"), F.pmod(draw(0), F.lit(days)).cast("int"))


def constant(value, type_: str = "string") -> Rule:
    return lambda row, draw: F.lit(value).cast(type_)


def text(rule: Rule) -> Rule:
    return lambda row, draw: rule(row, draw).cast("string")


def some_null(rule: Rule, percent: int = 5) -> Rule:
    return lambda row, draw: F.when(F.pmod(draw(1), F.lit(100)) >= percent, rule(row, draw))


# --- tables -----------------------------------------------------------------------


def synth_table(spark: SparkSession, rules: Mapping[str, Rule], rows: int, seed: int = 42) -> DataFrame:
    made = spark.range(rows).withColumnRenamed("id", ROW)
    return made.select(*[rule(F.col(ROW), _draws(seed, c)).alias(c) for c, rule in rules.items()])


def sample_keys(
    parent: DataFrame, key: str, identity: str, size: int, parent_rows: int, seed: int = 42
) -> DataFrame:
    """``size`` rows' keys drawn without replacement, numbered from 0 in ``_slot``.

    ``identity`` is unique per row of ``parent``, which has ``parent_rows`` rows. The smallest
    hashes win; every row of ``parent`` can. Only ``size`` rows a task reach the last sort.
    """
    drawn = F.xxhash64(F.lit(seed).cast("bigint"), F.col(identity).cast("bigint"))
    best = parent.select(F.col(key).alias("_key"), F.col(identity).alias("_id"), drawn.alias("_draw"))
    best = best.orderBy("_draw", "_id").limit(size)
    return best.select("_key", (F.row_number().over(Window.orderBy("_draw", "_id")) - 1).cast("bigint").alias("_slot"))


def with_parent_key(child: DataFrame, sample: DataFrame, size: int, column: str, on: str, seed: int = 42) -> DataFrame:
    """Give every row of ``child`` one of the sampled parent keys, chosen by its own ``on`` number."""
    keys = [F.lit(seed).cast("bigint"), F.lit(zlib.crc32(column.encode())).cast("bigint")]
    slot = F.pmod(F.xxhash64(*keys, F.col(on).cast("bigint")), F.lit(size))
    return (
        child.withColumn("_slot", slot)
        .join(sample.withColumnRenamed("_key", column), "_slot", "left")
        .drop("_slot")
    )
