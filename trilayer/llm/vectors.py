"""Embedding near-duplicates by sorted projection passes.

Each pass concatenates the signs of random projections into one key, sorts the vectors of a label by it
and compares every vector with a bounded window of its successors. Verified pairs of all passes
join vectors into components; the links of a vector are then counted exactly inside its component, block against block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from trilayer.llm.common import components, read, slices
from trilayer.operators import keyed_left_join, settle


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``vec_id, label, unit`` with the unit vector as doubles, or null where there is none."""
    for batch in slices(batches, rows=4096):
        found = []
        for values in batch.column(2).to_pylist():
            v = np.array(values if values is not None and None not in values else [], float)
            with np.errstate(all="ignore"):
                # Scaled first, so that very large or small components neither overflow nor vanish.
                top = np.abs(v).max(initial=0.0)
                v = v / top if top > 0 and np.isfinite(top) else v[:0]
                found.append((v / np.linalg.norm(v)).tobytes() if len(v) else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], ["vec_id", "label", "unit"])


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), float).reshape(len(column), -1)


def _forest(pairs: Iterator[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Those pairs that join what the pairs before did not."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    for a, b in pairs:
        if (x := root(a)) != (y := root(b)):
            up[y] = x
            yield a, b


def found_pairs(classes: DataFrame, threshold: float, passes: int, window: int, seed: int) -> DataFrame:
    """Pairs ``a, b`` of classes with a cosine of ``threshold`` or more met in the windows, enough to join all that were met."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in slices(batches, rows=2048):
            units = batch.column(3).to_pylist()
            for width in {len(u) for u in units}:
                rows = [i for i, u in enumerate(units) if len(u) == width]
                if width not in planes:
                    planes[width] = np.random.default_rng([seed, width]).standard_normal((passes, width // 8, 62))
                x, some = _matrix([units[i] for i in rows]), batch.take(pa.array(rows))
                for p in range(passes):
                    key = ((x @ planes[width][p]) > 0).astype(np.int64) @ (1 << np.arange(61, -1, -1, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p] * len(rows), pa.int32()), some.column(1), pa.array([width] * len(rows), pa.int32()), pa.array(key), some.column(0), some.column(3)],
                        ["pass", "label", "width", "key", "id", "unit"],
                    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def met() -> Iterator[tuple[int, int]]:
            held = None
            for batch in slices(batches, rows=4096):
                columns = [batch.column(i) for i in range(6)] if held is None else [
                    pa.concat_arrays([h, batch.column(i)]) for i, h in enumerate(held)
                ]
                groups = pd.DataFrame({i: columns[i].to_numpy(zero_copy_only=False) for i in range(3)})
                first = groups.ne(groups.shift()).any(axis=1).cumsum().to_numpy()
                ids, units = columns[4].to_numpy(), columns[5].to_pylist()
                new = len(ids) - batch.num_rows
                for g in np.unique(first):
                    rows = np.flatnonzero(first == g)
                    x, own = _matrix([units[i] for i in rows]), ids[rows]
                    for step in range(1, min(window, len(rows) - 1) + 1):
                        close = np.flatnonzero(np.einsum("ij,ij->i", x[:-step], x[step:]) >= threshold)
                        # Pairs of rows that the last batch already held were compared with it.
                        for i in close[rows[close + step] >= new]:
                            yield int(own[i]), int(own[i + step])
                held = [c[-window:] if len(c) > window else c for c in columns]

        edges = list(_forest(met()))
        yield pa.RecordBatch.from_arrays([pa.array([e[i] for e in edges], pa.int64()) for i in (0, 1)], ["a", "b"])

    schema = "pass int, label string, width int, key bigint, id bigint, unit binary"
    rows = classes.select("id", F.col("label").cast("string").alias("label"), "n", "unit").mapInArrow(keyed, schema)
    by = ["pass", "label", "width", "key", "id"]
    return settle(rows).repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(compared, "a bigint, b bigint")


def _count_links(threshold: float):
    def count(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        left, right = (rows[rows["block"] == b] for b in key[1:3])
        near = _matrix(left["unit"]) @ _matrix(right["unit"]).T >= threshold
        own = near @ right["n"].to_numpy()
        if key[1] == key[2]:
            own -= np.where(np.diag(near), left["n"].to_numpy(), 0)
            return pd.DataFrame({"id": left["id"], "links": own.astype("int64")})
        other = near.T @ left["n"].to_numpy()
        return pd.DataFrame({"id": pd.concat([left["id"], right["id"]]), "links": np.concatenate([own, other]).astype("int64")})

    return count


def link_vectors(
    vectors: DataFrame, threshold: float = 0.98, passes: int = 16, window: int = 24, block: int = 1024, seed: int = 7
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for ``vectors`` (``vec_id``, ``label``, ``embedding``).

    Two vectors link when their labels are equal and not null and their cosine, in double
    precision, reaches ``threshold``. Equal vectors of a label are one class with a count, so a group of copies costs one row.
    Vectors that are null, empty, zero or not finite, and rows without a label, link with nothing. Rows with a null ``vec_id`` are
    returned unlinked. Which components are found depends on the passes (recall is measured in the tests); links
    inside a component are all counted. A large component is compared in pairs of blocks, each a task's work of bounded size. Other columns are ignored.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint"), "label", "embedding")
    kind = dict(rows.dtypes)["label"]
    units = settle(rows.mapInArrow(_unit, f"vec_id bigint, label {kind}, unit binary"))
    usable = units.where("unit is not null and label is not null and vec_id is not null")
    classes = settle(usable.groupBy("label", "unit").agg(F.min("vec_id").alias("id"), F.count("*").alias("n")).select("id", "label", "n", "unit"))
    joined = components(found_pairs(classes, threshold, passes, window, seed))
    member = settle(keyed_left_join(classes, joined, [("id", "node")]).where("component is not null").select("id", "component", "n", "unit"))
    sizes = member.groupBy("component").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).withColumnRenamed("component", "c")
    placed = keyed_left_join(member, sizes, [("component", "c")]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    met = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "id", "n", "unit"
    )
    links = met.groupBy("component", "i", "j").applyInPandas(_count_links(threshold), "id bigint, links bigint").groupBy("id").agg(F.sum("links").alias("links"))
    labelled = keyed_left_join(classes, joined, [("id", "node")]).select("id", "label", "unit", "n", F.coalesce("component", "id").alias("component"))
    counted = keyed_left_join(labelled, links.withColumnRenamed("id", "l"), [("id", "l")]).select(
        F.col("label").alias("_label"), F.col("unit").alias("_unit"), "component", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links")
    )
    back = keyed_left_join(units, counted, [("label", "_label"), ("unit", "_unit")])
    linked = F.col("vec_id").isNotNull()
    return back.select(
        "vec_id", F.when(linked, F.coalesce("links", F.lit(0))).otherwise(0).cast("bigint").alias("n_links"),
        F.when(linked, F.coalesce("component", "vec_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op2_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(read(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL),
usable AS (SELECT * FROM v WHERE label IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
near AS (SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reached AS (SELECT a AS vec_id, b AS other FROM near UNION SELECT r.vec_id, near.b FROM reached r JOIN near ON r.other = near.a),
least AS (SELECT vec_id, min(other) AS other FROM reached GROUP BY vec_id),
links AS (SELECT a AS vec_id, count(*) AS n FROM near GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(other, vec_id)) AS component_id, least(vec_id, coalesce(other, vec_id)) = vec_id AS kept
FROM v LEFT JOIN least USING (vec_id) LEFT JOIN links USING (vec_id)
"""
