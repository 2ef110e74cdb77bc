"""The given test tables in the column names the library expects.

Each channel sells every line of ``lineitem``; which customers it knows and
the rebate it grants differ per channel, so channel comparisons have an
answer. The expressions also put in what the test tables lack and the
cleansing rules look for: NULL keys, zero prices, bad flags and states.
"""

from __future__ import annotations

from collections.abc import Callable
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trilayer.channels import CHANNELS, Channel
from trilayer.operators import Spread, spread_by_key

# Per channel: the place of its rebate on a line (discount, tax, 0.05), the customer residues it does not
# know, and the flag of the lines that come back.
_REBATE = {"STORE": 1, "CATALOG": 2, "WEB": 3}
_UNKNOWN = {"STORE": (1, 2), "CATALOG": (2, 3), "WEB": (1, 3)}
_RETURN_FLAG = {"STORE": "R", "CATALOG": "A", "WEB": "N"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def _dec(c: Column | str, p: int = 12, s: int = 2) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(f"decimal({p},{s})")


def _amount(c: Column, p: int = 12) -> Column:
    return c.cast(f"decimal({p},2)").cast("double")


def _date_sk(c: str) -> Column:
    return F.year(c) * 10000 + F.month(c) * 100 + F.day(c)


def _known(condition: Column, value: Column | str) -> Column:
    """``value`` except where ``condition`` holds; there NULL."""
    return F.when(~condition, F.col(value) if isinstance(value, str) else value)


def _item() -> Column:
    return _known(F.col("l_partkey") % 211 == 0, "l_partkey")


def item_spread(spark: SparkSession, sf_dir: str) -> Spread:
    """Which items are hot among the lines that every channel sells."""
    return Spread.of(lines(spark, sf_dir).select(_item().alias("item_sk")))


def sold_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of known orders, which every channel sells, with order's customer and the item."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = lines(spark, sf_dir).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.withColumn("item_sk", _item())


def sales(spark: SparkSession, sf_dir: str, channel: Channel, spread: bool | Spread = False) -> DataFrame:
    """Sales lines of a channel. With ``spread`` they are shuffled for the join with the returns; all channels share that shuffle.

    True shuffles them by order and item; an order holds a part once or twice, so no key is hot. A ``Spread`` shuffles them by item. The
    rebate is looked up in a list that is the
    same in every channel, so that all channels need the same columns of a line and can share shuffles. For the same reason the
    tax stands in a list with the coupon, which the fact does not take from the web.
    """
    sold = sold_lines(spark, sf_dir)
    if spread:
        sold = sold.where("item_sk is not null")
        sold = spread_by_key(sold, ["l_orderkey", "item_sk"]) if spread is True else spread.lay(sold, "item_sk", "l_orderkey")
    order, price = F.col("l_orderkey"), _dec("l_extendedprice")
    # A line without a price has no amounts, whatever its rebate. Spark 4.1 cannot compile the choice of an entry that is never NULL.
    fixed = F.when(price.isNotNull(), _dec(F.lit(0.05), 4))
    rebate = F.element_at(F.array(_dec("l_discount", 4), _dec("l_tax", 4), fixed), _REBATE[channel.name])
    coupon = F.col("l_linenumber").cast("double")
    columns = {
        channel.s("sold_date_sk"): _known(order % 20 == 1, _date_sk("l_shipdate")),
        channel.s("item_sk"): F.col("item_sk"),
        channel.customer: _known(
            (order % 20 == 0) | (F.col("o_custkey") % 10).isin(*_UNKNOWN[channel.name]), "o_custkey"
        ),
        channel.location: F.col("l_suppkey"),
        channel.s(channel.transaction): order,
        channel.s("quantity"): F.when(F.col("l_partkey") % 97 == 0, F.lit(0).cast("bigint")).otherwise(
            F.col("l_quantity").cast("bigint")
        ),
        channel.s("list_price"): F.when(F.col("l_partkey") % 89 == 0, F.lit(0.0)).otherwise(F.col("l_extendedprice")),
        channel.s("sales_price"): _amount(price * (1 - rebate)),
        channel.s("ext_discount_amt"): _amount(price * rebate),
        channel.s("ext_sales_price"): _amount(price * (1 - rebate), 14),
        channel.s("ext_tax"): F.element_at(F.array(_amount(price * _dec("l_tax", 4)), coupon), 1),
        channel.s("coupon_amt"): coupon,
        channel.s("net_profit"): _amount(price * (_dec(F.lit(0.05), 4) - _dec("l_discount", 4))),
    }
    return sold.select(*[c.alias(name) for name, c in columns.items()])


def returns(spark: SparkSession, sf_dir: str, channel: Channel) -> DataFrame:
    price = _dec("l_extendedprice")
    quantity = F.when(F.col("l_quantity") < F.col("l_linenumber"), 1).otherwise(F.col("l_linenumber"))
    columns = {
        channel.r("returned_date_sk"): _date_sk("l_shipdate"),
        channel.r("item_sk"): _item(),
        channel.r(channel.transaction): F.col("l_orderkey"),
        channel.r("return_quantity"): quantity.cast("bigint"),
        channel.return_amount: _amount(price * _dec(F.lit(0.5), 2, 1)),
        channel.r("net_loss"): _amount(price * _dec(F.lit(0.1), 2, 1)),
    }
    returned = lines(spark, sf_dir).where(F.col("l_returnflag") == _RETURN_FLAG[channel.name])
    return returned.select(*[c.alias(name) for name, c in columns.items()])


def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order date; lines that ship after the last order have no date row."""
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    month_day = F.date_format("d", "MM-dd")
    columns = {
        "d_date_sk": _date_sk("d"),
        "d_date": F.col("d"),
        "d_year": F.year("d"),
        "d_moy": F.month("d"),
        "d_dom": F.day("d"),
        "d_qoy": F.quarter("d"),
        "d_quarter_name": F.concat(F.year("d").cast("string"), F.lit("Q"), F.quarter("d").cast("string")),
        "d_day_name": F.date_format("d", "EEEE"),
        "d_weekend": F.when(F.weekday("d") >= 5, "Y").otherwise("N"),
        "d_holiday": F.when(month_day.isin("12-25", "01-01"), "Y").otherwise("N"),
    }
    return days.select(*[c.alias(name) for name, c in columns.items()])


def item(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, price = F.col("p_partkey"), F.col("p_retailprice")
    cost = _amount(_dec(price, 10) * _dec(key % 10, 2, 0) * _dec(F.lit(0.1), 2, 1), 10)
    columns = {
        "i_item_sk": key,
        "i_item_id": F.concat(F.lit("ITEM"), key.cast("string")),
        "i_product_name": F.col("p_name"),
        "i_category": F.concat(F.lit("  "), F.lower("p_type"), F.lit(" ")),
        "i_brand": F.upper("p_brand"),
        "i_class": F.col("p_type"),
        "i_current_price": F.when(key % 50 == 0, F.lit(0.0)).otherwise(price),
        "i_wholesale_cost": F.when(key % 40 == 1, F.lit(-1.0)).otherwise(cost),
        "i_color": F.split_part("p_name", F.lit(" "), F.lit(1)),
        "i_size": F.col("p_size").cast("string"),
        "i_units": F.lit("Each"),
    }
    return table(spark, sf_dir, "part").select(*[c.alias(name) for name, c in columns.items()])


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    flag = key % 5
    columns = {
        "c_customer_sk": key,
        "c_salutation": F.lit("Dr."),
        "c_first_name": F.col("c_mktsegment"),
        "c_last_name": _known(key % 30 == 0, F.lower(F.split_part("c_name", F.lit("#"), F.lit(1)))),
        "c_email_address": F.concat(F.lit("  USER"), key.cast("string"), F.lit("@EXAMPLE.COM ")),
        "c_birth_year": 1890 + key % 140,
        "c_birth_country": F.lit("UNITED STATES"),
        "c_preferred_cust_flag": F.when(flag == 0, "Y").when(flag == 1, "N").when(flag == 2, "y").when(flag == 4, "X"),
        "c_current_addr_sk": _known(key % 25 == 0, key),
    }
    return table(spark, sf_dir, "customer").select(*[c.alias(name) for name, c in columns.items()])


def customer_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    state = key % 6
    columns = {
        "ca_address_sk": key,
        "ca_city": F.lit("Dallas"),
        "ca_state": F.when(state == 0, "CA").when(state == 1, "TX").when(state == 2, "ca")
        .when(state == 3, "ZZ").when(state == 4, "DC"),
        "ca_zip": F.when(key % 7 == 0, "123").otherwise((10000 + key % 90000).cast("string")),
        "ca_country": F.lit("  united STATES "),
    }
    return table(spark, sf_dir, "customer").select(*[c.alias(name) for name, c in columns.items()])


def raw_table(spark: SparkSession, sf_dir: str, name: str, spread: bool | Spread = False) -> DataFrame:
    for channel in CHANNELS:
        if name == channel.sales_table:
            return sales(spark, sf_dir, channel, spread)
        if name == channel.returns_table:
            return returns(spark, sf_dir, channel)
    dimensions: dict[str, Callable] = {
        "date_dim": date_dim, "item": item, "customer": customer, "customer_address": customer_address,
    }
    return dimensions[name](spark, sf_dir)
