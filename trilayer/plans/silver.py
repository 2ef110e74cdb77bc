"""Silver layer: one cleansing function per raw table.

Sales are never de-duplicated and need no shuffle. Dimensions and returns are
reduced to one row per key; rows without a key are dropped before that.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from trilayer.channels import CATALOG, STORE, WEB, Channel
from trilayer.config import PASSTHROUGH_TABLES
from trilayer.functions import (
    fixed_length,
    guarded_pct,
    money,
    null_if_nonpositive,
    null_outside,
    one_of,
    proper_case,
)
from trilayer.operators import dedupe

# The states that count as valid, 50 states and DC.
VALID_STATES = (
    "AL AK AZ AR CA CO CT DE FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO "
    "MT NE NV NH NJ NM NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY DC"
).split()

# Plausible years of birth.
FIRST_BIRTH_YEAR, LAST_BIRTH_YEAR = 1900, 2010

# Months of the seasons; all others are Fall.
SEASONS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8)}


def _keyed(df: DataFrame, key: str) -> DataFrame:
    return dedupe(df.where(F.col(key).isNotNull()), [key])


def clean_customer(raw: DataFrame) -> DataFrame:
    names = [F.initcap("c_first_name"), F.initcap("c_last_name")]
    return _keyed(raw, "c_customer_sk").withColumns({
        "c_full_name": F.trim(F.concat_ws(" ", *names)),
        "c_email_address": F.trim(F.lower("c_email_address")),
        "c_birth_year": null_outside("c_birth_year", FIRST_BIRTH_YEAR, LAST_BIRTH_YEAR),
        "c_preferred_cust_flag": one_of("c_preferred_cust_flag", ("Y", "N"), "N"),
    })


def clean_customer_address(raw: DataFrame) -> DataFrame:
    """States are compared as written, so a lower-case code counts as unknown."""
    return _keyed(raw, "ca_address_sk").withColumns({
        "ca_state": one_of("ca_state", VALID_STATES, "UNK"),
        "ca_zip": fixed_length("ca_zip", 5),
        "ca_country": proper_case("ca_country"),
    })


def clean_item(raw: DataFrame) -> DataFrame:
    priced = _keyed(raw, "i_item_sk").withColumns({
        c: money(null_if_nonpositive(c), 10) for c in ("i_current_price", "i_wholesale_cost")
    })
    price, cost = F.col("i_current_price"), F.col("i_wholesale_cost")
    # A cost that rounded down to 0.00 has no margin; a missing price or cost leaves NULL.
    return priced.withColumns({
        "i_margin_pct": F.when(cost > 0, guarded_pct(price - cost, price, default=None)),
        "i_category": proper_case("i_category"),
        "i_brand": proper_case("i_brand"),
    })


def clean_date_dim(raw: DataFrame) -> DataFrame:
    month = F.col("d_moy")
    season = F
    for name, months in SEASONS.items():
        season = season.when(month.isin(*months), F.lit(name))
    # A missing month falls through to Fall and H2.
    return _keyed(raw, "d_date_sk").withColumns({
        "d_is_weekend": F.col("d_weekend") == "Y",
        "d_is_holiday": F.col("d_holiday") == "Y",
        "d_season": season.otherwise(F.lit("Fall")),
        "d_half_year": F.when(month <= 6, F.lit("H1")).otherwise(F.lit("H2")),
    })


def clean_sales(raw: DataFrame, channel: Channel) -> DataFrame:
    """Sales lines that name an item and a transaction, with money as decimals."""
    has_key = F.col(channel.s("item_sk")).isNotNull() & F.col(channel.s(channel.transaction)).isNotNull()
    price, listed = channel.s("sales_price"), F.col(channel.s("list_price"))
    rules = {
        price: money(price),
        channel.s("net_profit"): money(channel.s("net_profit")),
        channel.s("ext_sales_price"): money(channel.s("ext_sales_price"), 14),
    }
    if channel.cleans_quantity:
        rules[channel.s("quantity")] = null_if_nonpositive(channel.s("quantity"))
    cleaned = raw.where(has_key).withColumns(rules)
    if channel.has_discount:
        cleaned = cleaned.withColumn(channel.s("discount_pct"), guarded_pct(listed - F.col(price), listed))
    return cleaned


def clean_returns(raw: DataFrame, channel: Channel) -> DataFrame:
    """One return per transaction and item; only the item must be known."""
    kept = dedupe(raw.where(F.col(channel.r("item_sk")).isNotNull()), channel.returns_key)
    rules = {channel.return_amount: money(channel.return_amount)}
    if channel.decimal_net_loss:
        rules[channel.r("net_loss")] = money(channel.r("net_loss"))
    return kept.withColumns(rules)


def clean_store_sales(raw: DataFrame) -> DataFrame:
    return clean_sales(raw, STORE)


def clean_catalog_sales(raw: DataFrame) -> DataFrame:
    return clean_sales(raw, CATALOG)


def clean_web_sales(raw: DataFrame) -> DataFrame:
    return clean_sales(raw, WEB)


def clean_store_returns(raw: DataFrame) -> DataFrame:
    return clean_returns(raw, STORE)


def clean_catalog_returns(raw: DataFrame) -> DataFrame:
    return clean_returns(raw, CATALOG)


def clean_web_returns(raw: DataFrame) -> DataFrame:
    return clean_returns(raw, WEB)


CLEANSED: dict[str, Callable[[DataFrame], DataFrame]] = {
    "customer": clean_customer,
    "customer_address": clean_customer_address,
    "item": clean_item,
    "store_sales": clean_store_sales,
    "catalog_sales": clean_catalog_sales,
    "web_sales": clean_web_sales,
    "store_returns": clean_store_returns,
    "catalog_returns": clean_catalog_returns,
    "web_returns": clean_web_returns,
    "date_dim": clean_date_dim,
}

SILVER_TABLES = (*CLEANSED, *PASSTHROUGH_TABLES)
