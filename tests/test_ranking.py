from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from tests.conftest import rows
from trilayer.operators import global_dense_rank, global_ntile, global_ntiles, global_row_index, settle, share_of_total


def table(spark, n, kind):
    """n rows with unique ``k`` and a value ``v``; a third of the values are one hot value."""
    i = F.col("id")
    value = {
        "hot": F.when(i % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(1000))),
        "ties": i % 4,
        "nulls": F.when(i % 3 != 0, F.pmod(F.xxhash64("id"), F.lit(50))),
        "one": F.lit(1),
    }[kind].cast("decimal(20,2)")
    return spark.range(n).select(F.col("id").alias("k"), value.alias("v")).repartition(5)


def window(descending):
    return Window.orderBy(F.col("v").desc() if descending else F.col("v").asc(), "k")


@pytest.mark.parametrize("kind", ["hot", "ties", "nulls", "one"])
@pytest.mark.parametrize("descending", [False, True])
def test_ranks_match_the_single_task_window(spark, many_slices, kind, descending):
    df = table(spark, 997, kind)
    order = [("v", "desc")] if descending else ["v"]
    got = global_ntile(df, 5, order, "k", "tile")
    got = global_dense_rank(got, order, "rank")
    got = global_row_index(got, order, "k", "position").select("k", "tile", "rank", "position")
    value_only = Window.orderBy(F.col("v").desc() if descending else F.col("v").asc())
    want = df.select(
        "k",
        F.ntile(5).over(window(descending)),
        F.dense_rank().over(value_only),
        F.row_number().over(window(descending)) - 1,
    )
    assert rows(got) == rows(want)


@pytest.mark.parametrize("n", [0, 1, 3, 5, 6, 11])
def test_few_rows(spark, many_slices, n):
    df = table(spark, n, "ties")
    got = global_ntile(df, 5, [("v", "desc")], "k").select("k", "tile")
    assert rows(got) == rows(df.select("k", F.ntile(5).over(window(True))))
    ranked = global_dense_rank(df, ["v"]).select("k", "dense_rank")
    assert rows(ranked) == rows(df.select("k", F.dense_rank().over(Window.orderBy("v"))))


@pytest.mark.parametrize("type_, make", [
    ("date", lambda i: date(2000, 1, 1 + i % 20)), ("string", lambda i: f"s{i % 7}"), ("double", lambda i: i % 9 / 3),
])
def test_other_types(spark, many_slices, type_, make):
    df = spark.createDataFrame([(i, make(i) if i % 6 else None) for i in range(60)], f"k int, v {type_}")
    for descending in (False, True):
        order = [("v", "desc")] if descending else ["v"]
        got = global_ntile(df, 4, order, "k").select("k", "tile")
        assert rows(got) == rows(df.select("k", F.ntile(4).over(window(descending))))


def test_tile_sizes_differ_by_at_most_one(spark, many_slices):
    sizes = [r["count"] for r in global_ntile(table(spark, 1003, "hot"), 7, ["v"], "k").groupBy("tile").count().collect()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1


def test_a_hot_value_spreads_over_slices(spark, many_slices):
    from trilayer.operators import ranking

    sliced = ranking._sliced(table(spark, 2000, "one"), ["v", "k"])
    sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 2000 / 3


@pytest.mark.parametrize("values", [[1, 2, 3], [5], [None, 2, 2], [-1, 4], [None]])
def test_share_of_total(spark, values):
    df = spark.createDataFrame([(i, None if v is None else Decimal(v)) for i, v in enumerate(values)], "k int, v decimal(33,2)")
    total = F.sum("v").over(Window.partitionBy())
    want = df.withColumn("share", F.round(F.col("v") / total * 100, 4))
    got = share_of_total(df, "v", 4, "share")
    assert rows(got) == rows(want) and got.dtypes == want.dtypes


def test_rank_inputs_are_never_moved_into_one_task(spark, many_slices):
    """Only the table with one row per slice may pass through a single partition."""
    df = table(spark, 500, "hot")
    tiled = global_ntile(df, 5, ["v"], "k")
    assert "SinglePartition" not in tiled._jdf.queryExecution().executedPlan().toString()
    # Rows of the table are shuffled once, by value; what passes through one task has a row per slice.
    wide = settle(df.withColumn("text", F.lit("x")))
    plan = global_dense_rank(wide, ["v"])._jdf.queryExecution().executedPlan().toString()
    assert len([line for line in plan.splitlines() if "Exchange" in line and "text" in line]) <= 1
    assert plan.count("Exchange SinglePartition") <= 1 and "rangepartitioning" not in plan


@pytest.mark.parametrize("k", [1, 2, 63, 64, 65, 1000])
@pytest.mark.parametrize("n", [0, 7, 700])
def test_any_number_of_tiles(spark, many_slices, k, n):
    df = table(spark, n, "nulls")
    got = global_ntiles(df, k, {"up": ["v"], "down": [("v", "desc")]}, "k").select("k", "up", "down")
    want = df.select("k", F.ntile(k).over(window(False)), F.ntile(k).over(window(True)))
    assert rows(got) == rows(want) and got.dtypes[1:] == [("up", "int"), ("down", "int")]


@pytest.mark.parametrize("k", [0, -1])
def test_no_tiles_are_refused(spark, k):
    with pytest.raises(ValueError, match="tiles"):
        global_ntile(table(spark, 3, "one"), k, ["v"], "k")


def test_dense_rank_by_several_columns(spark, many_slices):
    df = spark.range(300).select("id", (F.col("id") % 7).cast("double").alias("a"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("s"), F.col("id") % 5)).alias("b"))
    df = df.withColumn("a", F.when(F.col("id") % 11 > 0, F.when(F.col("id") % 13 == 0, F.lit(-0.0)).otherwise(F.col("a"))))
    got = global_dense_rank(df, [("a", "desc"), "b"], "place").select("id", "place")
    assert rows(got) == rows(df.select("id", F.dense_rank().over(Window.orderBy(F.col("a").desc(), "b"))))


def test_tiles_of_timestamps_in_the_repeated_hour(spark, settings):
    settings(**{"spark__sql__session__timeZone": "America/New_York"})
    # 01:00 to 02:00 comes twice on this day.
    df = spark.range(40).select("id", F.timestamp_seconds(1_698_553_800 + F.col("id") * 180).alias("at"))
    tiled = global_ntile(df, 7, ["at"], "id")
    want = df.select("id", "at", F.ntile(7).over(Window.orderBy("at", "id")).alias("tile"))
    assert rows(tiled.select("id", "tile")) == rows(want.select("id", "tile"))
