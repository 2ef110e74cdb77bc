from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from trilayer.channels import STORE, WEB
from trilayer.plans import gold, reports

SALES = (
    "ss_sold_date_sk bigint, ss_item_sk bigint, ss_customer_sk bigint, ss_store_sk bigint, ss_ticket_number bigint, "
    "ss_quantity bigint, ss_sales_price decimal(12,2), ss_ext_sales_price decimal(14,2), ss_ext_discount_amt double, "
    "ss_ext_tax double, ss_net_profit decimal(12,2), ss_coupon_amt double, ss_discount_pct double"
)


def sale(ticket, item, amount="10.00", quantity=2):
    return (20000101, item, 1, 1, ticket, quantity, D("5.00"), D(amount), 0.0, 0.0, D("1.00"), 0.5, 3.0)


def returns(spark, values):
    return spark.createDataFrame(
        [(t, i, q, D(a), D("0.10")) for t, i, q, a in values],
        "sr_ticket_number bigint, sr_item_sk bigint, sr_return_quantity bigint, sr_return_amt decimal(12,2), sr_net_loss decimal(12,2)",
    )


def test_returns_attach_to_every_line_with_their_key(spark):
    sales = spark.createDataFrame([sale(1, 1), sale(1, 1, "20.00"), sale(2, 1)], SALES)
    rollup = gold.returns_rollup(returns(spark, [(1, 1, 1, "4.00"), (1, 1, 2, "2.00"), (9, 9, 1, "1.00")]), STORE)
    got = gold.channel_rows(sales, rollup, STORE)
    assert sorted((r.transaction_id, r.gross_sales_amt, r.return_amt, r.return_qty, r.net_sales_amt) for r in got.collect()) == [
        (1, D("10.00"), D("6.00"), 3, D("4.00")),
        (1, D("20.00"), D("6.00"), 3, D("14.00")),
        (2, D("10.00"), D("0.00"), 0, D("10.00")),
    ]
    types = dict(got.dtypes)
    assert (types["return_amt"], types["return_qty"], types["net_sales_amt"]) == ("decimal(22,2)", "bigint", "decimal(23,2)")


def test_the_web_has_no_coupon_and_no_discount(spark):
    web = spark.createDataFrame([sale(1, 1)], SALES).toDF(
        "ws_sold_date_sk", "ws_item_sk", "ws_bill_customer_sk", "ws_web_site_sk", "ws_order_number", "ws_quantity",
        "ws_sales_price", "ws_ext_sales_price", "ws_ext_discount_amt", "ws_ext_tax", "ws_net_profit", "x", "y",
    )
    back = returns(spark, []).toDF("wr_order_number", "wr_item_sk", "wr_return_quantity", "wr_return_amt", "wr_net_loss")
    got = gold.channel_rows(web, gold.returns_rollup(back, WEB), WEB).first()
    assert (got.channel, got.coupon_amt, got.discount_pct) == ("WEB", D("0.00"), 0.0)


FACT = (
    "channel string, customer_sk bigint, item_sk bigint, gross_sales_amt decimal(14,2), net_sales_amt decimal(23,2), "
    "return_amt decimal(22,2), return_qty bigint, net_profit decimal(12,2), quantity bigint, unit_price decimal(12,2), "
    "discount_pct double, d_date date, is_returned boolean, return_rate_pct double"
)


def line(channel, customer, item, gross, d=date(2000, 1, 1), returned=0, quantity=2):
    return (channel, customer, item, D(gross), D(gross), D(returned), returned, D(1), quantity, D(gross), 1.5, d, returned > 0, 0.0)


@pytest.mark.parametrize("sums, parity, zero", [
    ((5, None, None), "WEB", "STORE"), ((None, 5, None), "WEB", "CATALOG"), ((None, None, 5), "WEB", "WEB"),
    ((5, 5, 5), "STORE", "STORE"), ((4, 5, 5), "CATALOG", "CATALOG"), ((4, 4, 5), "WEB", "WEB"),
    ((None, 5, 5), "CATALOG", "CATALOG"), ((5, 4, None), "WEB", "STORE"),
])
def test_leading_channel(spark, sums, parity, zero):
    df = spark.createDataFrame([sums], "store_x int, catalog_x int, web_x int")
    got = df.select(gold.leading_channel("x"), gold.leading_channel("x", null_as_zero=True)).first()
    assert tuple(got) == (parity, zero)


def test_customer_value(spark):
    fact = spark.createDataFrame([
        line("STORE", 1, 1, "10.00", date(2000, 1, 1)), line("STORE", 1, 2, "5.00", date(2000, 1, 1), returned=1),
        line("WEB", 1, 1, "1.00", None), line("WEB", None, 1, "9.00"), line("CATALOG", 2, 1, "2.00", None),
    ], FACT)
    got = {r.customer_sk: r for r in gold.customer_value(fact, date(2000, 1, 11)).collect()}
    one, two = got[1], got[2]
    assert set(got) == {1, 2}
    assert (one.total_transactions, one.unique_purchase_days, one.days_since_last_purchase, one.total_returned_txns) == (3, 1, 10, 1)
    assert (one.store_sales_amt, one.catalog_sales_amt, one.web_sales_amt) == (D("15.00"), None, D("1.00"))
    assert one.avg_transaction_value == D("5.333333")
    assert (two.unique_purchase_days, two.days_since_last_purchase) == (0, None)


def test_customers_of_a_fact_by_item_are_shuffled_before_they_are_summed(spark):
    fact = spark.createDataFrame([
        line("STORE", k % 5 or None, k, f"{k}.50", date(2000, 1, 1 + k % 3) if k % 7 else None) for k in range(1, 40)
    ], FACT)
    day = date(2000, 1, 11)
    got = gold.customer_value(fact, day, by_item=True)
    assert rows(got) == rows(gold.customer_value(fact, day)) and got.count() == 4
    assert "REPARTITION_BY_COL" in got._jdf.queryExecution().executedPlan().toString()


def test_rfm_direction_and_option(spark):
    value = spark.createDataFrame(
        [(k, k, 10 * k, D(k)) for k in range(1, 11)],
        "customer_sk int, days_since_last_purchase int, total_transactions bigint, lifetime_net_sales decimal(33,2)",
    )
    plain = {r.customer_sk: r for r in gold.rfm_scores(value).collect()}
    assert (plain[1].recency_score, plain[1].frequency_score, plain[1].monetary_score) == (1, 5, 5)
    assert (plain[10].recency_score, plain[10].frequency_score, plain[10].monetary_score) == (5, 1, 1)
    turned = {r.customer_sk: r for r in gold.rfm_scores(value, best_is_high=True).collect()}
    assert (turned[1].recency_score, turned[10].monetary_score) == (5, 5)


@pytest.mark.parametrize("score, segment", [
    (3, "Churned"), (5, "Churned"), (6, "At Risk"), (8, "Potential Loyalists"), (10, "Loyal Customers"), (13, "Champions"), (15, "Champions"),
])
def test_segments(spark, score, segment):
    from trilayer.functions import bucket

    assert spark.range(1).select(bucket(F.lit(score), gold.RFM_SEGMENTS, "Churned")).first()[0] == segment


ITEM = (
    "i_item_sk bigint, i_item_id string, i_product_name string, i_category string, i_brand string, i_class string, "
    "i_current_price decimal(10,2), i_wholesale_cost decimal(10,2), i_margin_pct decimal(18,2), i_color string, i_size string"
)


def test_product_performance(spark):
    fact = spark.createDataFrame([
        line("STORE", 1, 1, "30.00", date(2000, 1, 1), returned=1), line("STORE", 1, 1, "30.00", date(2000, 1, 2)),
        line("WEB", 2, 2, "60.00"), line("WEB", None, 3, "40.00", None, quantity=None), line("WEB", 2, None, "5.00"),
    ], FACT)
    item = spark.createDataFrame([(1, "I1", "p", "c", "b", "k", D(10), D(5), D("50.00"), "red", "1")], ITEM)
    got = {r.item_sk: r for r in gold.product_performance(fact, item).collect()}
    assert set(got) == {1, 2, 3}
    assert [(k, got[k].revenue_rank, got[k].revenue_pct_of_total) for k in (1, 2, 3)] == [
        (1, 1, D("37.5000")), (2, 1, D("37.5000")), (3, 2, D("25.0000")),
    ]
    assert (got[1].i_item_id, got[1].margin_tier, got[2].i_item_id, got[2].margin_tier) == ("I1", "Premium", None, "Loss Leader")
    assert (got[1].daily_sales_velocity, got[1].return_rate_pct, got[1].unique_customers) == (2.0, 25.0, 1)
    assert (got[3].daily_sales_velocity, got[3].return_rate_pct, got[3].unique_customers, got[3].active_selling_days) == (0.0, 0.0, 0, 0)


def test_two_separate_distinct_counts_equal_the_single_aggregate(spark):
    fact = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40).alias("item_sk"),
        F.when(F.col("id") % 9 != 0, F.col("id") % 83).alias("customer_sk"),
    )
    got = gold._distinct_per(fact, "item_sk", "customer_sk", "n")
    assert rows(got) == rows(fact.groupBy("item_sk").agg(F.count_distinct("customer_sk")))


def test_types_of_the_models(spark):
    fact = spark.createDataFrame([line("STORE", 1, 1, "1.00")], FACT)
    value = dict(gold.customer_value(fact, date(2000, 1, 1)).dtypes)
    assert (value["lifetime_gross_sales"], value["lifetime_net_sales"], value["avg_transaction_value"]) == (
        "decimal(24,2)", "decimal(33,2)", "decimal(18,6)",
    )
    item = spark.createDataFrame([], ITEM)
    product = dict(gold.product_performance(fact, item).dtypes)
    assert (product["avg_selling_price"], product["revenue_pct_of_total"], product["revenue_rank"]) == (
        "decimal(16,6)", "decimal(37,4)", "int",
    )


def test_reports(spark):
    fact = spark.createDataFrame([
        ("STORE", D("1234567.00"), 1.0), ("STORE", D("1.00"), 2.0), ("WEB", D("2000000.00"), 0.0)],
        "channel string, gross_sales_amt decimal(14,2), return_rate_pct double",
    )
    assert [tuple(r) for r in reports.channel_report(fact).collect()] == [
        (1, "WEB", "1", "$2.00M", 0.0), (2, "STORE", "2", "$1.23M", 1.5),
    ]
    people = spark.createDataFrame([("A", D("1.00")), ("A", D("2.00")), ("B", D("9.00"))], "rfm_segment string, lifetime_net_sales decimal(33,2)")
    assert [tuple(r) for r in reports.segment_report(people).collect()] == [(1, "B", "1", D("9.00")), (2, "A", "2", D("1.50"))]


def test_status_rollup(spark):
    ledger = spark.createDataFrame(
        [("raw", "a", "ok"), ("raw", "b", "error"), ("raw", "b", "error"), ("raw", "c", "skipped"), ("gold", "d", "created")],
        '`layer` string, `table` string, status string',
    )
    got = {r.layer: tuple(r)[1:] for r in reports.run_status_rollup(ledger).collect()}
    assert got == {"raw": (1, 1, 2, ["b"]), "gold": (1, 0, 0, [])}


def test_models_match_the_plain_formulation_on_skewed_data(spark, many_slices):
    """A third of the lines belong to one customer, one item and one day; money is heavily tied."""
    i = F.col("id")
    hot = i % 3 == 0
    mixed = lambda n: F.pmod(F.xxhash64("id", F.lit(n)), F.lit(n))
    gross = (mixed(5) * 10).cast("decimal(14,2)")
    fact = spark.range(6000).select(
        F.element_at(F.array(*[F.lit(c) for c in ("STORE", "CATALOG", "WEB")]), (mixed(3) + 1).cast("int")).alias("channel"),
        F.when(hot, 1).when(i % 7 != 0, mixed(97)).cast("bigint").alias("customer_sk"),
        F.when(hot, 2).when(i % 11 != 0, mixed(53)).cast("bigint").alias("item_sk"),
        gross.alias("gross_sales_amt"), gross.cast("decimal(23,2)").alias("net_sales_amt"),
        F.lit(0).cast("decimal(22,2)").alias("return_amt"), (mixed(2)).alias("return_qty"),
        F.lit(1).cast("decimal(12,2)").alias("net_profit"), mixed(9).alias("quantity"),
        F.lit(1).cast("decimal(12,2)").alias("unit_price"), F.lit(1.5).alias("discount_pct"),
        F.when(hot, F.lit(date(2000, 1, 1))).when(i % 5 != 0, F.date_add(F.lit(date(2000, 1, 1)), mixed(40).cast("int"))).alias("d_date"),
        (mixed(2) > 0).alias("is_returned"),
    )
    fact.createOrReplaceTempView("skewed_fact")
    value = """SELECT customer_sk, count(*) AS n, sum(net_sales_amt) AS net, count(DISTINCT d_date) AS days,
        datediff(DATE '2001-01-01', max(d_date)) AS age FROM skewed_fact WHERE customer_sk IS NOT NULL GROUP BY customer_sk"""
    want = spark.sql(f"""SELECT customer_sk, n, net, days, age, ntile(5) OVER (ORDER BY age, customer_sk) AS r,
        ntile(5) OVER (ORDER BY n DESC, customer_sk) AS f, ntile(5) OVER (ORDER BY net DESC, customer_sk) AS m FROM ({value})""")
    got = gold.rfm_scores(gold.customer_value(fact, date(2001, 1, 1))).select(
        "customer_sk", "total_transactions", "lifetime_net_sales", "unique_purchase_days", "days_since_last_purchase",
        "recency_score", "frequency_score", "monetary_score",
    )
    assert rows(got) == rows(want)

    want = spark.sql("""SELECT *, dense_rank() OVER (ORDER BY net DESC) AS rank, round(net / sum(net) OVER () * 100, 4) AS share FROM (
        SELECT item_sk, sum(net_sales_amt) AS net, count(DISTINCT customer_sk) AS buyers, count(DISTINCT d_date) AS days
        FROM skewed_fact WHERE item_sk IS NOT NULL GROUP BY item_sk)""")
    got = gold.product_performance(fact, spark.createDataFrame([], ITEM)).select(
        "item_sk", "total_net_sales", "unique_customers", "active_selling_days", "revenue_rank", "revenue_pct_of_total"
    )
    assert rows(got) == rows(want)
