"""Left join for large fact tables whose keys may be skewed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

_PORTION = "_portion"
#: Setting under which tables that lie by a ``Spread`` are not shuffled again for joins that compare more columns than the spread is made of.
KEEP_SPREADS = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
#: A key is hot from so many rows, and from this share of all; its rows are dealt into so many portions.
HOT_ROWS, HOT_SHARE, PORTIONS = 1_000_000, 1 / 1000, 64


def keyed_left_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], split: bool = True) -> DataFrame:
    """``left`` left-joined to ``right`` on pairs of column names, skew included.

    The join also compares a hash of the key. It never changes a match (equal keys
    have equal hashes), but it makes the right side shuffle for the join even
    where it has just been aggregated on the same key. Adaptive execution splits an
    oversized partition only when both inputs of a join are fresh shuffles,
    so without the hash one hot key of ``left`` would end in one task. The hash
    stands in the condition alone: as a column it would be shuffled with every row.

    Without ``split`` the keys alone are compared. This is for keys that few rows share: inputs that already
    lie by them are not shuffled again.
    """
    conditions = [F.col(l) == F.col(r) for l, r in on]
    if split:
        conditions.insert(0, _key_hash(left, [l for l, _ in on]) == _key_hash(right, [r for _, r in on]))
    return left.join(right, reduce(and_, conditions), "left")


def spread_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` shuffled by ``keys``, all of them in their order in the join.

    Several tables that are projections of ``df`` then share this one shuffle, and a join without ``split`` adds none.
    """
    return df.repartition(*[F.col(k) for k in keys])


@dataclass(frozen=True)
class Spread:
    """How tables that meet on one key are shuffled, once for several joins: by the key, the rows of a hot key in portions.

    A row's portion follows from a second column, so rows that share both columns stay together. Which keys are hot decides where rows
    lie and never which rows match. Write what is joined so under ``KEEP_SPREADS``; without it the result is the same, after more shuffles.
    """

    hot: tuple = ()

    @classmethod
    def of(cls, keys: DataFrame) -> Spread:
        """For the keys in the only column of ``keys``. All rows are read, into a small sketch of frequent values in each task."""
        [c] = keys.columns
        top = f"approx_top_k({c}, {round(1 / HOT_SHARE)}, {round(10 / HOT_SHARE)})"
        found = keys.where(F.col(c).isNotNull()).agg(F.count("*").alias("n"), F.expr(top).alias("top")).first()
        least = max(HOT_ROWS, found["n"] * HOT_SHARE)
        return cls(tuple(sorted(r["item"] for r in found["top"] or () if r["count"] >= least)))

    def places(self, df: DataFrame, key: str, within: str) -> list[Column]:
        if not self.hot:
            return [_key_hash(df, [key])]
        portion = F.pmod(_key_hash(df, [within]), F.lit(PORTIONS)).cast("int")
        return [_key_hash(df, [key]), F.when(F.col(key).isin(*self.hot), portion).otherwise(0)]

    def lay(self, df: DataFrame, key: str, within: str) -> DataFrame:
        return df.repartition(*self.places(df, key, within))

    def left_join(self, left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], within: tuple[str, str | None]) -> DataFrame:
        """``left``, which lies by the first column of ``on``, left-joined to ``right``, which is shuffled to meet it.

        ``within`` are the columns of both that portions follow from. A right side without one has its rows copied to each portion of a hot key.
        """
        (l_key, r_key), (l_within, r_within) = on[0], within
        here = self.places(left, l_key, l_within)
        if r_within:
            there = self.places(right, r_key, r_within)
        else:
            there = [_key_hash(right, [r_key])]
            if self.hot:
                every, one = F.array(*[F.lit(i) for i in range(PORTIONS)]), F.array(F.lit(0))
                right = right.withColumn(_PORTION, F.explode(F.when(F.col(r_key).isin(*self.hot), every).otherwise(one)))
                there.append(F.col(_PORTION))
        conditions = [h == t for h, t in zip(here, there)] + [F.col(l) == F.col(r) for l, r in on]
        return left.join(right.repartition(*there), reduce(and_, conditions), "left").drop(_PORTION)


def _key_hash(df: DataFrame, keys: Sequence[str]):
    # Both sides must hash one type: 7 as int and 7 as bigint hash differently.
    whole = {"tinyint", "smallint", "int", "bigint"}
    types = dict(df.dtypes)
    return F.xxhash64(*[F.col(k).cast("bigint") if types[k] in whole else F.col(k) for k in keys])
