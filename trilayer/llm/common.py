"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from trilayer.operators import discard, keyed_left_join, settle

#: The characters between words, as a Java or Python class.
SPACES = r"\x20\x09-\x0D"
WORD = f"[^{SPACES}]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Rows, and numbers in their arrays, up to which a stored table is broadcast (about 100 MB at most).
BROADCAST_ROWS, BROADCAST_NUMBERS = 1_000_000, 8_000_000


def joined_by_size(rows: DataFrame, found: DataFrame, on: list[tuple[str, str]], numbers: str) -> DataFrame:
    """``rows`` left-joined to a stored table with an array ``numbers``: broadcast if it is small, else by a keyed join."""
    n, total = found.agg(F.count("*"), F.sum(F.size(numbers))).first()
    if n <= BROADCAST_ROWS and (total or 0) <= BROADCAST_NUMBERS:
        condition = F.lit(True)
        for a, b in on:
            condition = condition & (F.col(a) == F.col(b))
        return rows.join(F.broadcast(found), condition, "left")
    return keyed_left_join(rows, found, on)


def unused(df: DataFrame, name: str) -> str:
    """``name``, made longer until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that Python objects exist for few rows at a time."""
    for batch in batches:
        per_row = max(1, batch.nbytes // max(1, batch.num_rows))
        step = max(1, min(rows, most_bytes // per_row))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def distinct_edges(edges: DataFrame) -> DataFrame:
    """Undirected edges ``(a, b)`` once each, as ``u > v``; loops go."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of an edge: the smallest node it can reach.

    Alternating large-star and small-star steps turn the graph into stars in a number of
    rounds that grows with the logarithm of its size. Each round is written to the shared
    folder. Joins are keyed so that a node with very many links is split over tasks.
    ``edges`` has two bigint columns ``a`` and ``b``.
    """
    stars, before = settle(distinct_edges(edges)), None
    for _ in range(rounds):
        now = tuple(stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if now == before:
            break
        before = now
        both = stars.select("u", "v").unionAll(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("w")).agg(F.least(F.min("v"), F.col("w")).alias("m"))
        large = keyed_left_join(both.where("v > u"), least, [("u", "w")])
        large = settle(large.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        least = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        small = keyed_left_join(large, least, [("u", "w")])
        pairs = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))
        older, stars = stars, settle(small.select(F.inline(pairs)).where("u <> v").distinct())
        discard(older, large)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def powers(n: int, _kept: dict = {}) -> tuple[np.ndarray, np.ndarray]:
    """``B**j`` and its inverse modulo 2**64 for j below n."""
    if _kept.get("n", 0) < n:
        size = 1 << max(16, (n - 1).bit_length())
        base = 0x9E3779B97F4A7C15 | 1
        inverse = pow(base, -1, 1 << 64)
        for name, b in (("up", base), ("down", inverse)):
            steps = np.full(size, b, dtype=np.uint64)
            steps[0] = 1
            _kept[name] = np.multiply.accumulate(steps)
        _kept["n"] = size
    return _kept["up"][:n], _kept["down"][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finalizer of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def rolling(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial hash over bytes, with the inverse powers to shift them."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums, down


def span_hashes(sums: np.ndarray, down: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte span, equal for equal bytes wherever they stand."""
    return mixed((sums[ends] - sums[starts]) * down[starts])
