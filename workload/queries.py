"""The registered queries: library functions over the given tables.

Results leave as plain types: money as double, dates as text, no audit time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date
from types import MappingProxyType

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from trilayer.channels import CHANNELS
from trilayer.operators import KEEP_SPREADS, Spread, session_beside, settle
from trilayer.plans import gold, reports
from trilayer.plans.silver import CLEANSED
from trilayer.sources.storage import add_audit
from workload import adapters, operators

ANALYSIS_DATE = date(2001, 12, 31)

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    casts = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            casts[f.name] = F.col(f.name).cast("double")
        elif isinstance(f.dataType, T.DateType):
            casts[f.name] = F.date_format(f.name, "yyyy-MM-dd")
    return df.withColumns(casts) if casts else df


def silver_tables(spark: SparkSession, sf_dir: str, spread: bool | Spread = False) -> Mapping[str, DataFrame]:
    return MappingProxyType({t: clean(adapters.raw_table(spark, sf_dir, t, spread)) for t, clean in CLEANSED.items()})


def fact(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None, spread: bool = True, by_item: bool = False
) -> DataFrame:
    """With ``spread`` the lines are shuffled once for the returns of all channels, else for each channel whose returns are asked for.

    They are shuffled by order and item; ``by_item``, and where items are described, by item alone.
    """
    if spread and (by_item or columns is None or set(columns) & set(gold.ITEM_COLUMNS)):
        items = adapters.item_spread(spark, sf_dir)
        return gold.sales_fact(silver_tables(spark, sf_dir, items), columns, spread=items)
    return gold.sales_fact(silver_tables(spark, sf_dir, spread), columns, split=not spread)


def _silver(name: str) -> Query:
    return lambda spark, sf_dir: plain(CLEANSED[name](adapters.raw_table(spark, sf_dir, name)))


def _passthrough_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_audit(adapters.table(spark, sf_dir, "nation"), "silver").drop("_silver_processed_at")


def _rollup(channel) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        returns = CLEANSED[channel.returns_table](adapters.returns(spark, sf_dir, channel))
        return plain(gold.returns_rollup(returns, channel))

    return run


def _channel_rows(channel) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sales = CLEANSED[channel.sales_table](adapters.sales(spark, sf_dir, channel))
        returns = CLEANSED[channel.returns_table](adapters.returns(spark, sf_dir, channel))
        rows = gold.channel_rows(sales, gold.returns_rollup(returns, channel), channel)
        return plain(rows.withColumn("coupon_amt", F.col("coupon_amt").cast("double")))

    return run


def _sales_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(fact(session_beside(spark, KEEP_SPREADS), sf_dir))


def _customer_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = gold.settle_fact(fact(spark, sf_dir, gold.VALUE_COLUMNS))
    return gold.customer_value(stored, ANALYSIS_DATE)


def _customer_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = silver_tables(spark, sf_dir)
    stored = gold.settle_fact(fact(spark, sf_dir, gold.VALUE_COLUMNS))
    return gold.customer_360(stored, silver["customer"], silver["customer_address"], ANALYSIS_DATE)


def _product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = silver_tables(spark, sf_dir)
    # The lines of an item lie together, so that tasks add up most of them.
    stored = gold.settle_fact(fact(spark, sf_dir, gold.PRODUCT_INPUTS, by_item=True), by_item=True)
    return gold.product_performance(stored, silver["item"])


def _leaders(suffix: str) -> list[Column]:
    """The leading channel in both ways of comparing a channel without sales."""
    return [gold.leading_channel(suffix).alias("null_loses"), gold.leading_channel(suffix, null_as_zero=True).alias("null_is_zero")]


def _preferred_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Gross sales alone need no returns and are read once, so nothing is stored.
    value = gold.customer_value(fact(spark, sf_dir, gold.VALUE_COLUMNS, spread=False), ANALYSIS_DATE)
    return value.select("customer_sk", *_leaders("sales_amt"))


def _top_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    # As above: no count and no attribute of an item is asked for.
    value = gold.product_value(fact(spark, sf_dir, gold.PRODUCT_INPUTS, spread=False), silver_tables(spark, sf_dir)["item"])
    return value.select("item_sk", *_leaders("revenue"))


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {f"silver_{name}": _silver(name) for name in CLEANSED}
    out["passthrough_nation"] = _passthrough_nation
    for channel in CHANNELS:
        out[f"returns_rollup_{channel.name.lower()}"] = _rollup(channel)
        out[f"channel_rows_{channel.name.lower()}"] = _channel_rows(channel)
    out["gold_sales_fact"] = _sales_fact
    out["customer_value"] = lambda s, d: plain(_customer_value(s, d))
    out["rfm_scores"] = lambda s, d: plain(gold.rfm_scores(settle(_customer_value(s, d))))
    out["gold_customer_360"] = lambda s, d: plain(_customer_360(s, d))
    out["gold_product_performance"] = lambda s, d: plain(_product_performance(s, d))
    out["rfm_scores_best_is_high"] = lambda s, d: plain(gold.rfm_scores(settle(_customer_value(s, d)), best_is_high=True))
    out["preferred_channels"] = _preferred_channels
    out["top_channels"] = _top_channels
    out["channel_report"] = lambda s, d: reports.channel_report(fact(s, d, gold.REPORT_COLUMNS))
    # The segments need no person and no address.
    out["segment_report"] = lambda s, d: plain(reports.segment_report(gold.rfm_scores(settle(_customer_value(s, d)))))
    return out | operators.QUERIES
