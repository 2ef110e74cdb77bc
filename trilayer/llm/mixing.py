"""Mixing sources to target weights.

Every document gets a hash-random key. Documents are range-sorted within their source by that
key, running word counts are formed slice by slice and shifted by the totals of the slices
before, and each source is cut where its budget ends. A budget above the source's size begins
another epoch over the same order.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from trilayer.llm.common import WORD, read, unused
from trilayer.operators import keyed_left_join, settle

def words(c: str) -> Column:
    """Number of words; null texts have none."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), share_pct: int = 150, most: int = 2
) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)``.

    Sources in order of code points, null last, take the weights in turn and share
    ``share_pct`` percent of all words. A target stops at ``most`` times its source's size and
    the excess is shared again by weight. Sources are filled in order of limit per weight: the
    first one that the common level does not fill ends the search, so no loop is needed. The
    windows order one row per source, never documents.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), turn + 1).cast("bigint")
    limited = per_source.withColumn("w", weight).withColumn("most", F.lit(most) * F.col("source_size"))
    limited = limited.withColumn("fills_at", F.col("most") / F.col("w"))
    filling = Window.orderBy("fills_at", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).partitionBy()
    # The level if exactly the sources before this one were full.
    level = (
        F.lit(share_pct) / 100 * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(filling), F.lit(0))
    ) / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(filling), F.lit(0)))
    levelled = limited.withColumn("level", level).withColumn(
        "level", F.max(F.when(F.col("level") <= F.col("fills_at"), F.col("level"))).over(everything)
    )
    target = F.least(F.col("most").cast("double"), F.coalesce(F.col("level") * F.col("w"), F.col("most").cast("double")))
    return levelled.select("source", "source_size", target.alias("target"))


def _running(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Words before each row among the rows of its source in this slice."""
    sums: dict[str, int] = {}
    part = TaskContext.get().partitionId()
    for rows in batches:
        # Rows come in order of source, so only what the last batch held can go on.
        key = ("s" + rows["source"]).fillna("")
        upto = rows["size"].groupby(key).cumsum() + key.map(sums).fillna(0).astype("int64")
        sums = upto.groupby(key).last().to_dict()
        yield rows.assign(slice=part, before=upto - rows["size"])


def _key(seed: str) -> Column:
    own = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.md5(F.concat_ws(":", F.lit(seed), own, F.md5(F.coalesce("text", F.lit("")))))


def mix_plan(
    docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share_pct: int = 150, most: int = 2, seed: str = "mix"
) -> DataFrame:
    """How many words of each document the mix takes: ``doc_id, source, key, size, source_size, target, taken``.

    Keys are the MD5 of seed, ``doc_id`` and the text's MD5, so every run gives the same mix; rows that agree in all of
    these are told apart by nothing and share one place in the order in any arrangement.
    The last document of a source is cut at the exact budget (rounded down to whole
    words). Null or blank texts have size 0 and nothing taken; a null source is a source of
    its own, the last. A null ``doc_id`` counts as an empty one in the key. An empty table
    gives no rows. Other columns are ignored.
    """
    # Stored before the range sort, which would count the words again for its sample.
    keyed = settle(docs.select(F.col("doc_id").cast("bigint"), "source", words("text").alias("size"), _key(seed).alias("key")))
    by = [F.col("source").isNull(), "source", "key"]
    sorted_ = keyed.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = settle(sorted_.mapInPandas(_running, "doc_id bigint, source string, size bigint, key string, slice int, before bigint"))
    # One row per slice and source from here on.
    part = placed.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    part = part.withColumn("ahead", F.coalesce(F.sum("words").over(ahead), F.lit(0)))
    targets = source_targets(part.withColumnRenamed("words", "size"), weights, share_pct, most)
    same = F.col("p.source").eqNullSafe(F.col("t.source"))
    part = part.alias("p").join(targets.alias("t"), same).select(
        F.col("p.source").alias("_source"), F.col("slice").alias("_slice"), "ahead", "source_size", "target"
    )
    here = (F.col("slice") == F.col("_slice")) & F.col("source").eqNullSafe(F.col("_source"))
    budget = F.floor("target")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - whole * F.col("source_size")
    from_rest = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("ahead") - F.col("before")))
    return placed.join(part, here, "left").select(
        "doc_id", "source", "key", "size", "source_size", "target",
        (whole * F.col("size") + from_rest).cast("bigint").alias("taken"),
    )


def mixed_documents(docs: DataFrame, seed: str = "mix", **options) -> DataFrame:
    """The rows of ``docs`` in the mix: a document appears once for each epoch that reaches it.

    Documents are kept whole: one that is cut by the budget still appears with its whole text. Rows
    that agree in id, source and text share their turns evenly, rounded up. All columns stay.
    """
    none = F.lit("\0")
    own, src, times, epoch, key, source = (unused(docs, f"_mix_{c}") for c in ("own", "src", "times", "epoch", "key", "source"))
    turns = F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(F.lit(0))
    plan = mix_plan(docs, seed=seed, **options).groupBy(F.col("key").alias(key), F.coalesce("source", none).alias(source))
    plan = plan.agg(F.ceil(F.sum(turns) / F.count("*")).cast("int").alias(times)).where(F.col(times) > 0)
    keyed = docs.withColumns({own: _key(seed), src: F.coalesce("source", none)})
    joined = keyed_left_join(keyed, plan, [(own, key), (src, source)]).where(F.col(times).isNotNull())
    return joined.withColumn(epoch, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_plan(read(spark, sf_dir, "documents")).drop("source", "key")


SQL = r"""
WITH d AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
        md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS key
    FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, 2 * source_size AS most,
        [3, 1, 2][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT] AS w FROM s),
f AS (SELECT *, most / w AS fills_at FROM w),
l AS (SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM s)
        - coalesce(sum(most) OVER (ORDER BY fills_at, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / ((SELECT sum(w) FROM w)
        - coalesce(sum(w) OVER (ORDER BY fills_at, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM f),
v AS (SELECT max(level) FILTER (WHERE level <= fills_at) AS level FROM l),
t AS (SELECT source, source_size, least(most::DOUBLE, coalesce((SELECT level FROM v) * w, most::DOUBLE)) AS target FROM f),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
        sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key ROWS UNBOUNDED PRECEDING) - d.size AS before
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (CASE WHEN source_size = 0 THEN 0 ELSE
    (budget // source_size) * size + greatest(0, least(size, budget % source_size - before)) END)::BIGINT AS taken FROM p
"""
