from pyspark.sql import functions as F

from tests.conftest import rows
from trilayer.channels import STORE
from trilayer.operators import KEEP_SPREADS, Spread, dedupe, joins, keyed_left_join, session_settings, spread_by_key
from trilayer.plans import gold


def test_left_join_keeps_null_keys_and_mixes_integer_types(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (None, "d")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (None, "y")], "r bigint, w string")
    got = keyed_left_join(left, right, [("k", "r")])
    assert got.columns == ["k", "v", "r", "w"]
    assert rows(got) == rows(left.join(right, F.col("k") == F.col("r"), "left"))


def hot_sales(spark, n):
    """A third of all sales lines share one ticket and item."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, n, 1, 8).select(
        F.when(hot, 7).otherwise(F.col("id")).alias("ss_ticket_number"),
        F.when(hot, 7).otherwise(F.col("id") % 100).cast("int").alias("ss_item_sk"),
        F.xxhash64("id").alias("line"),
    )


def test_a_hot_key_is_split_although_the_right_side_is_an_aggregate(spark, settings, tmp_path):
    settings(**{
        "spark__sql__shuffle__partitions": "64",
        "spark__sql__autoBroadcastJoinThreshold": "-1",
        "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
        "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "100KB",
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": "100KB",
    })
    sales = hot_sales(spark, 600_000)
    returns = spark.range(100_000).select(
        F.col("id").alias("sr_ticket_number"), (F.col("id") % 100).cast("int").alias("sr_item_sk"),
        F.lit(1).cast("decimal(12,2)").alias("sr_return_amt"), F.lit(1).cast("bigint").alias("sr_return_quantity"),
        F.lit(1).cast("decimal(12,2)").alias("sr_net_loss"),
    )
    # Stored first: a range knows its partitioning and its rollup would need no shuffle of its own.
    returns.write.parquet(str(tmp_path / "returns"))
    returns = spark.read.parquet(str(tmp_path / "returns"))
    rollup = gold.returns_rollup(returns, STORE)
    joined = keyed_left_join(sales, rollup, list(zip(STORE.sales_key, STORE.returns_key)))
    out = joined.agg(F.count("*").alias("n"), F.sum("return_qty").alias("q"), F.max("line"))
    got = out.collect()[0]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan
    plain = sales.join(
        rollup, (F.col("ss_ticket_number") == F.col("sr_ticket_number")) & (F.col("ss_item_sk") == F.col("sr_item_sk")), "left"
    ).agg(F.count("*"), F.sum("return_qty"), F.max("line"))
    want = plain.collect()[0]
    assert "skew=true" not in plain._jdf.queryExecution().executedPlan().toString()
    assert (got.n, got.q) == tuple(want)[:2] and got.n == 600_000


def test_dedupe_reduces_in_every_task_before_the_shuffle(spark):
    df = hot_sales(spark, 9_000)
    kept = dedupe(df, ["ss_ticket_number", "ss_item_sk"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan
    best = df.groupBy("ss_ticket_number", "ss_item_sk").agg(F.min("line"))
    assert rows(kept) == rows(best)


def test_dedupe_order_and_column_order(spark):
    df = spark.createDataFrame([(2, 1, "b"), (1, 1, "z"), (None, 1, "a")], "n int, k int, v string")
    assert rows(dedupe(df, ["k"])) == [(None, 1, "a")]
    assert rows(dedupe(df.where("n is not null"), ["k"], ["v"])) == [(2, 1, "b")]
    assert rows(dedupe(df.select("k"), ["k"])) == [(1,)]


def test_the_hash_of_a_key_is_not_shuffled(spark, settings):
    settings(**{"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__enabled": "false"})
    left = spark.createDataFrame([(1, "a")], "k int, v string")
    plan = keyed_left_join(left, left.toDF("r", "w"), [("k", "r")])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(xxhash64(" in plan and not [l for l in plan.splitlines() if "Project" in l and "xxhash64" in l]


def test_tables_spread_by_key_are_not_shuffled_again(spark, settings):
    settings(**{"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__enabled": "false"})
    left = hot_sales(spark, 3_000)
    right = dedupe(left.select(F.col("ss_ticket_number").alias("t"), F.col("ss_item_sk").alias("i"), F.col("line").alias("w")), ["t", "i"])
    on = [("ss_ticket_number", "t"), ("ss_item_sk", "i")]
    got = keyed_left_join(spread_by_key(left, ["ss_ticket_number", "ss_item_sk"]), right, on, split=False)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    assert rows(got) == rows(keyed_left_join(left, right, on))


def test_a_spread_serves_two_joins_and_deals_a_hot_key_into_portions(spark, settings, monkeypatch):
    settings(**{"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__enabled": "false", "spark__sql__shuffle__partitions": "16"})
    monkeypatch.setattr(joins, "HOT_ROWS", 1_000)
    sales = spark.range(0, 6_000, 1, 8).select(
        F.col("id").alias("ticket"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).cast("int").alias("item"),
    )
    sales.createOrReplaceTempView("sold")
    found = Spread.of(sales.select("item"))
    assert found.hot == (7,) and Spread.of(sales.select("item").limit(0)).hot == ()
    back = spark.sql("SELECT ticket AS t, item AS i, min(ticket % 5) AS q FROM sold WHERE ticket % 2 = 0 GROUP BY ALL")
    named = spark.sql("SELECT CAST(item AS BIGINT) AS k, max('n' || item) AS name FROM sold GROUP BY ALL UNION ALL SELECT NULL, 'none'")
    for spread in (found, Spread()):
        laid = spread.lay(sales, "item", "ticket")
        got = spread.left_join(laid, back, [("item", "i"), ("ticket", "t")], within=("ticket", "t"))
        got = spread.left_join(got, named, [("item", "k")], within=("ticket", None))
        want = sales.join(back, (F.col("item") == F.col("i")) & (F.col("ticket") == F.col("t")), "left").join(named, F.col("item") == F.col("k"), "left")
        assert got.columns == want.columns and rows(got) == rows(want)
        with session_settings(spark, KEEP_SPREADS):
            kept = got.select("*")
            plan = kept._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning(xxhash64(cast(item#") == 1
            assert rows(kept) == rows(want)
        places = laid.where("item = 7").select(F.spark_partition_id()).distinct().count()
        assert places > 8 if spread.hot else places == 1
