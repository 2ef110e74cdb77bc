"""Every registered query against its SQL on the smallest data, and the plans of the large ones."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import check_oracles
from __spark_entry__ import entry, oracle_sql
from trilayer.plans import gold
from workload.queries import fact, queries, silver_tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in check_oracles.TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def test_every_query_has_sql():
    # Queries of trilayer.llm are tested beside it.
    assert set(queries()) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(queries()))
def test_query_matches_sql(spark, db, name):
    ok, note = check_oracles.compare(spark, db, SF, name, oracle_sql()[name])
    assert ok, note


def test_entry(spark):
    assert entry(spark).columns == ["position", "channel", "transactions", "gross_sales", "avg_return_pct"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_plan_runs_python(spark):
    for name in ("gold_sales_fact", "gold_customer_360", "gold_product_performance", "silver_item", "dedupe_by_key"):
        text = plan(queries()[name](spark, SF))
        assert "Python" not in text and "Pandas" not in text, name


def test_the_fact_is_never_gathered_or_cross_joined(spark):
    text = plan(fact(spark, SF))
    for word in ("SinglePartition", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_sales_silver_is_a_narrow_plan(spark):
    """Cleansing sales adds no shuffle to reading them."""
    cleaned = silver_tables(spark, SF)["store_sales"]
    # The mapping joins orders, which are broadcast; no other exchange may be there.
    assert not re.search("(?<!Broadcast)(?<!Reused)Exchange", plan(cleaned))


def test_reports_join_no_dimension_they_do_not_show(spark):
    # Orders belong to the lines themselves; the calendar is made of their dates alone.
    text = plan(queries()["channel_report"](spark, SF))
    assert "/part.parquet" not in text and "o_orderdate" not in text
    assert "/customer.parquet" not in plan(queries()["segment_report"](spark, SF))


def test_product_rows_are_shuffled_once_for_their_rank(spark):
    text = plan(queries()["gold_product_performance"](spark, SF))
    assert len([line for line in text.splitlines() if "Exchange hashpartitioning" in line]) <= 2 and "rangepartitioning" not in text


def test_reports_come_in_order(spark):
    for name in ("channel_report", "segment_report"):
        got = [r.position for r in queries()[name](spark, SF).collect()]
        assert got == list(range(1, len(got) + 1)) and got


def test_unused_columns_are_not_read(spark):
    text = plan(fact(spark, SF).groupBy("channel").sum("gross_sales_amt"))
    schemas = [line for line in text.splitlines() if "ReadSchema" in line and "lineitem" in line]
    assert schemas and all("l_linestatus" not in s and "l_linenumber" not in s for s in schemas)


@pytest.fixture
def without_broadcast(settings):
    settings(**{
        "spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
        "spark__sql__adaptive__enabled": "false",
    })


def shuffles(df, by=""):
    return [line for line in plan(df).splitlines() if f"Exchange hashpartitioning({by}" in line and "Reused" not in line]


def test_channels_share_the_shuffles_of_their_lines(spark, without_broadcast):
    """Lines and orders, the lines again for their returns, the returns of each channel, the sums by channel."""
    assert len(shuffles(queries()["channel_report"](spark, SF))) <= 7


def test_the_fact_is_shuffled_for_items_without_calendar(spark, without_broadcast):
    lines = plan(fact(spark, SF)).splitlines()
    at = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(xxhash64(item_sk" in line)
    below = next(line for line in lines[at + 1:] if "Project" in line or "Union" in line)
    assert "d_day_name" not in below and "net_sales_amt" not in below


def test_leading_channels_store_no_fact_and_read_no_returns(spark, without_broadcast):
    for name in ("preferred_channels", "top_channels"):
        assert "l_returnflag" not in plan(queries()[name](spark, SF)), name


def test_union_of_channels_shuffles_orders_once(spark, without_broadcast):
    assert len(shuffles(queries()["union_of_channels"](spark, SF), by="o_orderkey")) == 1


def test_all_channels_of_the_fact_share_one_shuffle_by_item(spark, without_broadcast):
    """Lines meet their orders once and lie by item once; neither returns nor items shuffle the lines of a channel again."""
    df = queries()["gold_sales_fact"](spark, SF)
    assert len(shuffles(df, by="l_orderkey")) == 1
    by_item = [line for line in shuffles(df) if re.search(r"hashpartitioning\(xxhash64\((ss_|cs_|ws_)?item_sk", line)]
    assert len(by_item) == 1
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_product_sums_read_the_lines_of_an_item_in_one_place(spark, settings, monkeypatch):
    settings(**{"spark__sql__adaptive__enabled": "false"})
    stored = []
    settle_fact = gold.settle_fact
    monkeypatch.setattr(gold, "settle_fact", lambda *a, **b: stored.append(settle_fact(*a, **b)) or stored[-1])
    queries()["gold_product_performance"](spark, SF)
    files = stored[0].select("item_sk", F.input_file_name().alias("file")).distinct().groupBy("item_sk").count()
    # At most one file of each channel.
    assert files.agg(F.max("count")).first()[0] <= 3
