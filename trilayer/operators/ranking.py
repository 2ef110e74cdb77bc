"""Exact ranks over a whole table without moving it into one task.

A window without ``partitionBy`` sorts every row in a single task. Here Spark's own
range partitioning orders the rows over many tasks ("slices"); each slice numbers
its rows and only one small row per slice is ever brought together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Window, functions as F

from trilayer.operators.joins import keyed_left_join
from trilayer.operators.settle import settle

_SLICE, _AT, _BASE, _PLACE, _KEY = "_slice", "_at", "_base", "_place", "_tile_key"
#: Up to so many tiles, rows find theirs by comparing themselves with the rows that open tiles.
IN_PLACE = 64

# An order is a column name, or (column name, "desc"). As in Spark, ascending puts
# NULLs first and descending puts them last.
Order = str | tuple[str, str]


def _parts(order: Sequence[Order]) -> list[tuple[str, bool]]:
    return [(o, False) if isinstance(o, str) else (o[0], o[1] == "desc") for o in order]


def _sort(order: Sequence[Order]) -> list[Column]:
    return [
        F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_first()
        for c, down in _parts(order)
    ]


def _sliced(df: DataFrame, order: Sequence[Order]) -> DataFrame:
    """``df`` in range-partitioned order with slice number and position in the slice.

    ``order`` ends in a unique column, so even a value shared by most rows is
    spread over slices. The ids are written down before use: a
    recomputed range shuffle may choose other cut points.
    """
    ordered = df.repartitionByRange(*_sort(order)).sortWithinPartitions(*_sort(order))
    numbered = ordered.withColumn(_SLICE, F.spark_partition_id()).withColumn(
        # The lower 33 bits count the rows of the partition, the upper ones are its id.
        _AT, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    )
    return settle(numbered)


def _with_base(sliced: DataFrame, bases: DataFrame) -> DataFrame:
    """Attach a per-slice number. ``bases`` has one row per shuffle partition, so it is broadcast."""
    return sliced.join(F.broadcast(bases), _SLICE, "left")


def _with_position(sliced: DataFrame, name: str) -> DataFrame:
    """0-based position of every row of a sliced table."""
    before = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    bases = sliced.groupBy(_SLICE).agg(F.count("*").alias("_rows")).select(
        _SLICE, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias(_BASE)
    )
    return _with_base(sliced, bases).withColumn(name, F.col(_BASE) + F.col(_AT)).drop(_SLICE, _AT, _BASE)


def global_row_index(df: DataFrame, order: Sequence[Order], tiebreak: str, name: str = "row_index") -> DataFrame:
    """0-based position of every row in the whole order; ``tiebreak`` must be unique."""
    return _with_position(_sliced(df, [*order, tiebreak]), name)


def global_ntile(
    df: DataFrame, k: int, order: Sequence[Order], tiebreak: str, name: str = "tile"
) -> DataFrame:
    """``ntile(k)`` over the whole table; ``tiebreak`` (unique, never NULL) settles ties.

    Only the ordering columns are sorted. Up to ``IN_PLACE`` tiles, every row then finds its own by halving among the
    k-1 rows that open tiles 2..k, so ``df`` itself is not shuffled. For more tiles each row gets its own by a join on ``tiebreak``.
    """
    return global_ntiles(df, k, {name: order}, tiebreak)


def global_ntiles(
    df: DataFrame, k: int, orders: Mapping[str, Sequence[Order]], tiebreak: str
) -> DataFrame:
    """Several ``global_ntile`` columns of one table; their sorts run side by side."""
    if k < 1:
        raise ValueError(f"tiles must be 1 or more: {k}")
    one = _tile if k <= IN_PLACE else _tiles_by_key
    column = lambda order: one(df, k, [*order, tiebreak])
    with ThreadPoolExecutor(max_workers=len(orders)) as pool:
        started = [pool.submit(inheritable_thread_target(df.sparkSession)(column), order) for order in orders.values()]
        tiles = dict(zip(orders, [s.result() for s in started]))
    if k <= IN_PLACE:
        return df.withColumns(tiles)
    own = _comparable(df, [tiebreak])[tiebreak]
    for name, keyed in tiles.items():
        df = keyed_left_join(df.withColumn(_BASE, own), keyed.withColumnRenamed(_PLACE, name), [(_BASE, _KEY)]).drop(_BASE, _KEY)
    return df


def _comparable(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """As a Python value a timestamp loses which of two equal local hours it is in; as a number it does not."""
    types = dict(df.dtypes)
    return {c: F.unix_micros(c) if types[c] == "timestamp" else F.col(c) for c in columns}


def _tile(df: DataFrame, k: int, order: Sequence[Order]) -> Column:
    value = _comparable(df, [c for c, _ in _parts(order)])
    sliced = _sliced(df.select(*[v.alias(c) for c, v in value.items()]), order)
    # One row per slice, then at most k-1 rows, come to the driver.
    sizes = sliced.groupBy(_SLICE).count().orderBy(_SLICE).collect()
    openings = _tile_openings([(r[_SLICE], r["count"]) for r in sizes], k)
    if not openings:
        return F.lit(1)
    is_opening = F.lit(False)
    for slice_id, at in openings:
        is_opening = is_opening | ((F.col(_SLICE) == slice_id) & (F.col(_AT) == at))
    opens = sliced.where(is_opening).orderBy(_SLICE, _AT).collect()

    def among(low: int, high: int) -> Column:
        """The tile of a row known to be in one of these; row t - 2 opens tile t."""
        if low == high:
            return F.lit(low)
        middle = (low + high + 1) // 2
        return F.when(_at_or_after(order, opens[middle - 2], value), among(middle, high)).otherwise(among(low, middle - 1))

    return among(1, len(opens) + 1)


def _tiles_by_key(df: DataFrame, k: int, order: Sequence[Order]) -> DataFrame:
    """Key (the last ordering column) and tile of every row; the tile follows from the position."""
    value = _comparable(df, [c for c, _ in _parts(order)])
    placed = settle(_with_position(_sliced(df.select(*[v.alias(c) for c, v in value.items()]), order), _PLACE))
    small, extra = divmod(placed.count(), k)
    wide = extra * (small + 1)
    at = F.col(_PLACE)
    later = F.lit(extra) + F.floor((at - wide) / max(1, small))
    tile = F.when(at < wide, F.floor(at / (small + 1))).otherwise(later) + 1
    return placed.select(F.col(_parts(order)[-1][0]).alias(_KEY), tile.cast("int").alias(_PLACE))


def _tile_openings(sizes: Sequence[tuple[int, int]], k: int) -> list[tuple[int, int]]:
    """Slice and position of the rows that open tiles 2..k; the first tiles take the remainder."""
    total = sum(n for _, n in sizes)
    small, extra = divmod(total, k)
    wanted = [i for i in (t * small + min(t, extra) for t in range(1, k)) if i < total]
    found, start = [], 0
    for slice_id, n in sizes:
        found += [(slice_id, i - start) for i in wanted if start <= i < start + n]
        start += n
    return found


def _at_or_after(order: Sequence[Order], row, values: Mapping[str, Column]) -> Column:
    reached = F.lit(True)
    for c, down in reversed(_parts(order)):
        own, value = values[c], row[c]
        if value is None:
            past = F.lit(False) if down else own.isNotNull()
        elif down:
            past = own.isNull() | (own < F.lit(value))
        else:
            past = F.coalesce(own > F.lit(value), F.lit(False))
        reached = past | (own.eqNullSafe(F.lit(value)) & reached)
    return reached


def global_dense_rank(df: DataFrame, order: Sequence[Order], name: str = "dense_rank") -> DataFrame:
    """``dense_rank()`` over the whole table by ``order``.

    Only the distinct values are sorted: the rank of a value is its place among them. Tasks reduce their rows to distinct
    values before these are shuffled, so a value held by a third of the rows costs one row per task. The rows of ``df`` then meet their
    rank by value, their one shuffle, in which a hot value is split; where the values are few they are broadcast and ``df`` stays
    where it is. ``df`` is read twice, so pass a stored table.
    """
    columns = [c for c, _ in _parts(order)]
    ranked = _with_position(_sliced(df.select(*columns).distinct(), order), _PLACE)
    values = ranked.select(*[F.col(c).alias(f"_value_{i}") for i, c in enumerate(columns)], (F.col(_PLACE) + 1).cast("int").alias(name))
    same = F.lit(True)
    for i, c in enumerate(columns):
        same = same & F.col(c).eqNullSafe(F.col(f"_value_{i}"))
    return df.join(values, same, "left").drop(*[f"_value_{i}" for i in range(len(columns))])


def share_of_total(df: DataFrame, c: str, digits: int, name: str, stored: DataFrame | None = None) -> DataFrame:
    """``c`` in percent of its sum over the whole table.

    The total is a scalar subquery over ``stored``, a stored table with the same values of ``c``. Without it, ``df`` is read twice.
    """
    total = (df if stored is None else stored).agg(F.sum(c)).scalar()
    return df.withColumn(name, F.round(F.col(c) / total * 100, digits))
