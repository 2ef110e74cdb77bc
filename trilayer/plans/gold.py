"""Gold layer: the cross-channel sales fact, customer 360 and product performance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from trilayer.channels import CHANNELS, Channel
from trilayer.functions import bucket, guarded_pct
from trilayer.operators import (
    FREE_SHUFFLES,
    KEEP_SPREADS,
    Spread,
    global_dense_rank,
    global_ntiles,
    keyed_left_join,
    session_settings,
    settle,
    share_of_total,
)

# Attributes that the fact takes from the calendar and the item table.
DATE_COLUMNS = (
    "d_date_sk d_date d_year d_moy d_dom d_qoy d_quarter_name d_day_name "
    "d_is_weekend d_is_holiday d_season d_half_year"
).split()
ITEM_COLUMNS = (
    "i_item_sk i_item_id i_product_name i_category i_brand i_class i_current_price "
    "i_wholesale_cost i_margin_pct i_color i_size i_units"
).split()
PRODUCT_COLUMNS = (
    "i_item_id i_product_name i_category i_brand i_class i_current_price "
    "i_wholesale_cost i_margin_pct i_color i_size"
).split()
CUSTOMER_COLUMNS = (
    "c_customer_sk c_full_name c_email_address c_birth_year c_birth_country "
    "c_preferred_cust_flag c_current_addr_sk c_salutation"
).split()
# Sums per customer and per item, and what they add up.
CUSTOMER_SUMS = {
    "lifetime_gross_sales": "gross_sales_amt",
    "lifetime_net_sales": "net_sales_amt",
    "lifetime_returns": "return_amt",
    "lifetime_net_profit": "net_profit",
}
PRODUCT_SUMS = {
    "total_gross_sales": "gross_sales_amt",
    "total_net_sales": "net_sales_amt",
    "total_net_profit": "net_profit",
    "total_units_sold": "quantity",
    "total_returns": "return_amt",
    "total_return_units": "return_qty",
}
# What the channel report and the two models on top of the fact read of it.
REPORT_COLUMNS = "channel gross_sales_amt return_rate_pct".split()
VALUE_COLUMNS = (
    "channel customer_sk gross_sales_amt net_sales_amt return_amt net_profit d_date is_returned"
).split()
PRODUCT_INPUTS = (
    "channel item_sk customer_sk d_date quantity unit_price discount_pct gross_sales_amt net_sales_amt "
    "net_profit return_amt return_qty"
).split()
ADDRESS_COLUMNS = "ca_address_sk ca_city ca_state ca_zip ca_country".split()

# Segment and tier floors.
RFM_SEGMENTS = [(13, "Champions"), (10, "Loyal Customers"), (8, "Potential Loyalists"), (6, "At Risk")]
MARGIN_TIERS = [(50, "Premium"), (30, "Standard"), (10, "Low Margin")]


# --- sales fact ---------------------------------------------------------------


def returns_rollup(returns: DataFrame, channel: Channel) -> DataFrame:
    """Returned money and units per transaction and item."""
    return returns.groupBy(*channel.returns_key).agg(
        F.sum(channel.return_amount).alias("return_amt"),
        F.sum(channel.r("return_quantity")).alias("return_qty"),
        F.sum(channel.r("net_loss")).alias("return_net_loss"),
    )


def channel_rows(
    sales: DataFrame, rollup: DataFrame, channel: Channel, split: bool = True, spread: Spread | None = None
) -> DataFrame:
    """Every sales line of a channel in the common schema, with what came back of it.

    A rollup row attaches to each line that shares its transaction and item. ``split`` is that of the join; with ``spread`` the
    sales lie by item in that way.
    """
    keys = list(zip(channel.sales_key, channel.returns_key))
    if spread:
        joined = spread.left_join(sales, rollup, keys[::-1], within=keys[0])
    else:
        joined = keyed_left_join(sales, rollup, keys, split)
    returned = F.coalesce("return_amt", F.lit(0))
    if channel.has_discount:
        coupon, discount = F.col(channel.s("coupon_amt")), F.col(channel.s("discount_pct"))
    else:
        coupon, discount = F.lit(0).cast("decimal(12,2)"), F.lit(0.0)
    common = {
        "channel": F.lit(channel.name),
        "sold_date_sk": F.col(channel.s("sold_date_sk")),
        "item_sk": F.col(channel.s("item_sk")),
        "customer_sk": F.col(channel.customer),
        "location_sk": F.col(channel.location),
        "transaction_id": F.col(channel.s(channel.transaction)),
        "quantity": F.col(channel.s("quantity")),
        "unit_price": F.col(channel.s("sales_price")),
        "gross_sales_amt": F.col(channel.s("ext_sales_price")),
        "discount_amt": F.col(channel.s("ext_discount_amt")),
        "tax_amt": F.col(channel.s("ext_tax")),
        "net_profit": F.col(channel.s("net_profit")),
        "coupon_amt": coupon,
        "discount_pct": discount,
        "return_amt": returned,
        "return_qty": F.coalesce("return_qty", F.lit(0)),
    }
    return joined.select(*[c.alias(name) for name, c in common.items()]).withColumn("net_sales_amt", net_sales())


def net_sales() -> Column:
    return F.col("gross_sales_amt") - F.col("return_amt")


def sales_fact(
    silver: Mapping[str, DataFrame], columns: Sequence[str] | None = None, split: bool = True, spread: Spread | None = None
) -> DataFrame:
    """All channels in one table with calendar and item attributes, one row per sales line.

    With ``columns`` the fact has just these, and a dimension none of them comes from is not joined: each line has at most one row of
    it, so leaving it out changes no other column. Sales that already lie by transaction and item, few lines to each, keep that
    without ``split``. Sales that already lie by item have the ``spread`` that they were shuffled with.

    Where items are joined, the lines of a channel are shuffled once, by item, before they meet their returns; both joins keep that
    shuffle, in which the lines of a hot item are dealt into portions. Lines of all channels with the amounts that came back would be
    shuffled for the items in several times the bytes. The calendar comes last and without a hint: Spark
    broadcasts a dimension whose size it knows to be small, and beyond that it is a keyed join, which splits hot and NULL keys.
    """
    described = columns is None or bool(set(columns) & set(ITEM_COLUMNS))
    sales = {c: silver[c.sales_table] for c in CHANNELS}
    if described and not spread:
        spread = Spread.of(reduce(DataFrame.union, [sales[c].select(F.col(c.s("item_sk")).alias("item_sk")) for c in CHANNELS]))
        sales = {c: spread.lay(t, c.s("item_sk"), c.s(c.transaction)) for c, t in sales.items()}
    lines = None
    for channel in CHANNELS:
        rollup = returns_rollup(silver[channel.returns_table], channel)
        rows = channel_rows(sales[channel], rollup, channel, split, spread)
        own = rows.columns
        # Added again below: as wide as two amounts, it need not be shuffled with them.
        rows = rows.drop("net_sales_amt")
        if described:
            items = silver["item"].select(*ITEM_COLUMNS)
            rows = spread.left_join(rows, items, [("item_sk", "i_item_sk")], within=("transaction_id", None))
        lines = rows if lines is None else lines.unionByName(rows)
    if columns is None or set(columns) & set(DATE_COLUMNS):
        lines = keyed_left_join(lines, silver["date_dim"].select(*DATE_COLUMNS), [("sold_date_sk", "d_date_sk")])
    lines = lines.withColumn("net_sales_amt", net_sales())
    lines = lines.select(*own, *[c for c in DATE_COLUMNS + ITEM_COLUMNS if c in lines.columns])
    fact = lines.withColumns({
        "return_rate_pct": guarded_pct(F.col("return_qty"), F.col("quantity")),
        "is_returned": F.col("return_qty") > 0,
    })
    return fact if columns is None else fact.select(*columns)


# --- shared by the two models on top of the fact -------------------------------


def settle_fact(fact: DataFrame, by_item: bool = False) -> DataFrame:
    """The fact stored for the models that read it several times, in few bytes: without the net sales, which follow from
    other columns, and packed harder than tables that are kept. One whose lines were spread ``by_item`` keeps that while it is written,
    and leaves no shuffle files.
    """
    with session_settings(fact.sparkSession, KEEP_SPREADS | FREE_SHUFFLES if by_item else {}):
        stored = settle(fact.drop("net_sales_amt"), compression="zstd")
    return stored.withColumn("net_sales_amt", net_sales()).select(*fact.columns)


def _sums(sums: Mapping[str, str]) -> list[Column]:
    return [F.sum(source).alias(name) for name, source in sums.items()]


def _sum_by_channel(suffix: str) -> list[Column]:
    """Gross sales per channel; NULL where a channel sold nothing."""
    return [
        F.sum(F.when(F.col("channel") == c.name, F.col("gross_sales_amt"))).alias(f"{c.name.lower()}_{suffix}")
        for c in CHANNELS
    ]


def _distinct_per(rows: DataFrame, key: str, c: str, name: str) -> DataFrame:
    """Distinct non-NULL values of ``c`` per key.

    Kept apart from the sums: sums shrink to one row per key before the shuffle, while
    a distinct count in the same aggregate would drag all of them through a
    shuffle of (key, value) pairs, and a second one would copy every row.
    """
    pairs = rows.where(F.col(c).isNotNull()).select(key, c).distinct()
    return pairs.groupBy(key).agg(F.count("*").alias(name))


def leading_channel(suffix: str, null_as_zero: bool = False) -> Column:
    """The channel with the largest sum; ties go to STORE, then CATALOG.

    By default a channel without sales is NULL and no comparison with it holds, so a
    customer of the store alone is reported under WEB. ``null_as_zero``
    compares such a channel as 0 instead.
    """
    sums = [F.col(f"{c.name.lower()}_{suffix}") for c in CHANNELS]
    if null_as_zero:
        sums = [F.coalesce(c, F.lit(0)) for c in sums]
    leader = F
    for i, channel in enumerate(CHANNELS[:-1]):
        beats_the_rest = reduce(and_, [sums[i] >= other for other in sums[i + 1:]])
        leader = leader.when(beats_the_rest, F.lit(channel.name))
    return leader.otherwise(F.lit(CHANNELS[-1].name))


# --- customer 360 --------------------------------------------------------------


def customer_value(fact: DataFrame, analysis_date: date, by_item: bool = False) -> DataFrame:
    """Lifetime sums, dates and counts per known customer.

    ``fact`` is read twice, so pass a stored table. Of one that lies ``by_item``, each task holds a line or two of a customer, and partial
    sums would be wider than the lines and nearly as many; so the lines are shuffled by customer before they are summed.
    """
    bought = summed = fact.where(F.col("customer_sk").isNotNull())
    if by_item:
        lines = bought.select(*VALUE_COLUMNS).drop("net_sales_amt")
        summed = Spread.of(lines.select("customer_sk")).lay(lines, "customer_sk", "d_date").withColumn("net_sales_amt", net_sales())
    totals = summed.groupBy("customer_sk").agg(
        F.count("*").alias("total_transactions"),
        *_sums(CUSTOMER_SUMS),
        F.avg("gross_sales_amt").alias("avg_transaction_value"),
        F.max("d_date").alias("last_purchase_date"),
        F.min("d_date").alias("first_purchase_date"),
        *_sum_by_channel("sales_amt"),
        F.count_if("is_returned").alias("total_returned_txns"),
    )
    days = _distinct_per(bought, "customer_sk", "d_date", "unique_purchase_days")
    return totals.join(days, "customer_sk", "left").withColumns({
        "unique_purchase_days": F.coalesce("unique_purchase_days", F.lit(0)),
        "days_since_last_purchase": F.datediff(F.lit(analysis_date), "last_purchase_date"),
    })


def rfm_scores(value: DataFrame, best_is_high: bool = False) -> DataFrame:
    """Quintiles of recency, frequency and money over all customers, their sum and the segment.

    By default tile 1 holds the most recent, most frequent and highest-spending
    customers while the highest sum is called Champions; ``best_is_high`` reverses
    the three orders. ``value`` is read several times, so pass a stored table.
    """
    orders = {
        "recency_score": ("days_since_last_purchase", best_is_high),
        "frequency_score": ("total_transactions", not best_is_high),
        "monetary_score": ("lifetime_net_sales", not best_is_high),
    }
    orders = {score: [(c, "desc") if down else c] for score, (c, down) in orders.items()}
    tiled = global_ntiles(value, 5, orders, tiebreak="customer_sk")
    total = F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
    return tiled.withColumn("rfm_score", total).withColumn(
        "rfm_segment", bucket("rfm_score", RFM_SEGMENTS, "Churned")
    )


def customer_360(
    fact: DataFrame,
    customer: DataFrame,
    address: DataFrame,
    analysis_date: date,
    best_is_high: bool = False,
    null_as_zero: bool = False,
    by_item: bool = False,
) -> DataFrame:
    """Customers with purchases: value, RFM segment, preferred channel, person and address. ``by_item`` says how the fact lies."""
    scored = rfm_scores(settle(customer_value(fact, analysis_date, by_item)), best_is_high).withColumns({
        "preferred_channel": leading_channel("sales_amt", null_as_zero),
        "return_rate_pct": guarded_pct(F.col("total_returned_txns"), F.col("total_transactions")),
    })
    people = keyed_left_join(scored, customer.select(*CUSTOMER_COLUMNS), [("customer_sk", "c_customer_sk")])
    return keyed_left_join(people, address.select(*ADDRESS_COLUMNS), [("c_current_addr_sk", "ca_address_sk")])


# --- product performance -------------------------------------------------------


def product_value(fact: DataFrame, item: DataFrame) -> DataFrame:
    """Sums and distinct counts per known item, with the item's attributes.

    Items are aggregated on their key alone and described afterwards, so
    the scan of the fact reads no item text. ``fact`` is read three times, so
    pass a stored table.
    """
    sold = fact.where(F.col("item_sk").isNotNull())
    totals = sold.groupBy("item_sk").agg(
        F.count("*").alias("num_transactions"),
        *_sums(PRODUCT_SUMS),
        F.avg("unit_price").alias("avg_selling_price"),
        # Summed as decimals: the order of the rows cannot change the result.
        # A rate that does not fit counts in neither part of the mean.
        (F.sum(F.col("discount_pct").try_cast("decimal(18,2)")).cast("double") / F.count(F.col("discount_pct").try_cast("decimal(18,2)")))
        .alias("avg_discount_pct"),
        *_sum_by_channel("revenue"),
    )
    buyers = _distinct_per(sold, "item_sk", "customer_sk", "unique_customers")
    days = _distinct_per(sold, "item_sk", "d_date", "active_selling_days")
    described = item.select(F.col("i_item_sk").alias("item_sk"), *PRODUCT_COLUMNS)
    out = totals.join(buyers, "item_sk", "left").join(days, "item_sk", "left").join(described, "item_sk", "left")
    return out.select(
        "item_sk", *PRODUCT_COLUMNS,
        *PRODUCT_SUMS, "num_transactions", "avg_selling_price", "avg_discount_pct",
        F.coalesce("unique_customers", F.lit(0)).alias("unique_customers"),
        "store_revenue", "catalog_revenue", "web_revenue",
        F.coalesce("active_selling_days", F.lit(0)).alias("active_selling_days"),
    )


def margin_tier(c: Column | str = "i_margin_pct") -> Column:
    """An unknown margin counts as the lowest tier."""
    return bucket(c, MARGIN_TIERS, "Loss Leader")


def sales_velocity(units: Column, days: Column) -> Column:
    """Units sold per day with sales."""
    return F.when(days > 0, F.round(units / days, 2)).otherwise(F.lit(0.0))


def product_performance(fact: DataFrame, item: DataFrame, null_as_zero: bool = False) -> DataFrame:
    """Margin tier, velocity, return rate, top channel, revenue rank and share per item."""
    # Read three times below: for the distinct values, for the total and for the rows.
    products = settle(product_value(fact, item).withColumns({
        "return_rate_pct": guarded_pct(F.col("total_return_units"), F.col("total_units_sold")),
        "daily_sales_velocity": sales_velocity(F.col("total_units_sold"), F.col("active_selling_days")),
        "margin_tier": margin_tier(),
        "top_channel": leading_channel("revenue", null_as_zero),
    }))
    ranked = global_dense_rank(products, [("total_net_sales", "desc")], "revenue_rank")
    return share_of_total(ranked, "total_net_sales", 4, "revenue_pct_of_total", stored=products)
