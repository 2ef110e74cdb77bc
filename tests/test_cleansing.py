from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from trilayer.functions import bucket, fixed_length, guarded_pct, money, null_if_nonpositive, null_outside, one_of
from trilayer.plans import silver


def column(spark, values, type_, expression):
    """The expression over every value of a one-column table, in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    return [r.out for r in df.orderBy("i").select(expression.alias("out")).collect()]


def test_null_outside_keeps_both_ends(spark):
    got = column(spark, [1899, 1900, 2010, 2011, None], "bigint", null_outside("v", 1900, 2010))
    assert got == [None, 1900, 2010, None, None]


def test_null_if_nonpositive(spark):
    assert column(spark, [-1, 0, 1, None], "bigint", null_if_nonpositive("v")) == [None, None, 1, None]


def test_one_of(spark):
    assert column(spark, ["Y", "N", "y", "X", None], "string", one_of("v", ("Y", "N"), "N")) == ["Y", "N", "N", "N", "N"]


def test_fixed_length(spark):
    assert column(spark, ["1234", "12345", "123456", None], "string", fixed_length("v", 5)) == [None, "12345", None, None]


def test_bucket_takes_the_highest_floor_reached(spark):
    label = bucket("v", [(50, "a"), (30, "b"), (10, "c")], "d")
    values = [50.0, 49.99, 30.0, 29.99, 10.0, 9.99, -5.0, None]
    assert column(spark, values, "double", label) == ["a", "b", "b", "c", "c", "d", "d", "d"]


def test_money_rounds_half_up_and_never_fails(spark):
    got = column(spark, [1.005, 2.345, -2.345, 1e12, None], "double", money("v"))
    assert got == [Decimal("1.01"), Decimal("2.35"), Decimal("-2.35"), None, None]


def test_guarded_pct(spark):
    pct = guarded_pct(F.lit(1.0), F.col("v"))
    assert column(spark, [4.0, 0.0, -4.0, None], "double", pct) == [25.0, 0.0, 0.0, 0.0]


CUSTOMER = (
    "c_customer_sk int, c_first_name string, c_last_name string, c_email_address string, c_birth_year bigint, "
    "c_preferred_cust_flag string"
)


@pytest.mark.parametrize("first, last, full", [
    ("ann", "LEE", "Ann Lee"), (None, "lee", "Lee"), ("ann", None, "Ann"), (None, None, ""),
    ("mc-DONALD", "o'neil", "Mc-donald O'neil"), ("mary ann", "lee", "Mary Ann Lee"),
])
def test_customer_name(spark, first, last, full):
    raw = spark.createDataFrame([(1, first, last, " A@B.C ", 1950, "Y")], CUSTOMER)
    got = silver.clean_customer(raw).first()
    assert (got.c_full_name, got.c_email_address) == (full, "a@b.c")


def test_customer_keeps_one_row_per_key_and_no_null_key(spark):
    raw = spark.createDataFrame([
        (1, "b", "x", None, 1950, "Y"), (1, "a", "x", None, 1950, "Y"), (None, "c", "x", None, 1950, "Y"),
    ], CUSTOMER)
    assert [(r.c_customer_sk, r.c_first_name) for r in silver.clean_customer(raw).collect()] == [(1, "a")]


def test_address(spark):
    raw = spark.createDataFrame(
        [(1, "CA", "12345", " united STATES "), (2, "ca", "1234", None), (3, "ZZ", "123456", ""), (4, "DC", None, "x"), (5, None, "", "x")],
        "ca_address_sk int, ca_state string, ca_zip string, ca_country string",
    )
    got = {r.ca_address_sk: (r.ca_state, r.ca_zip, r.ca_country) for r in silver.clean_customer_address(raw).collect()}
    assert got == {
        1: ("CA", "12345", "United States"), 2: ("UNK", None, None), 3: ("UNK", None, ""), 4: ("DC", None, "X"), 5: ("UNK", None, "X"),
    }
    assert len(silver.VALID_STATES) == len(set(silver.VALID_STATES)) == 51


def test_item_margin(spark):
    cases = [
        (1, 10.0, 4.0), (2, 0.0, 4.0), (3, -1.0, 4.0), (4, None, 4.0), (5, 10.0, 0.0), (6, 10.0, None), (7, 10.0, 15.0),
        (8, 1e9, 4.0), (9, 0.004, 4.0), (10, 10.0, 0.004),
    ]
    raw = spark.createDataFrame(
        [(k, p, c, " home GOODS ", "BRAND a") for k, p, c in cases],
        "i_item_sk int, i_current_price double, i_wholesale_cost double, i_category string, i_brand string",
    )
    df = silver.clean_item(raw)
    got = {r.i_item_sk: r.i_margin_pct for r in df.collect()}
    assert got == {
        1: Decimal("60.00"), 2: None, 3: None, 4: None, 5: None, 6: None, 7: Decimal("-50.00"), 8: None, 9: None, 10: None,
    }
    assert {(r.i_category, r.i_brand) for r in df.collect()} == {("Home Goods", "Brand A")}
    types = dict(df.dtypes)
    assert (types["i_current_price"], types["i_margin_pct"]) == ("decimal(10,2)", "decimal(18,2)")


def sales_row(spark, channel, **values):
    columns = {
        channel.s(c): t for c, t in {
            channel.transaction: "bigint", "item_sk": "int", "quantity": "bigint", "list_price": "double",
            "sales_price": "double", "ext_sales_price": "double", "net_profit": "double",
        }.items()
    }
    row = {channel.transaction: 1, "item_sk": 1, "quantity": 1, "list_price": 10.0, "sales_price": 8.0, "ext_sales_price": 8.0, "net_profit": 1.0}
    row.update(values)
    schema = ", ".join(f"{c} {t}" for c, t in columns.items())
    return spark.createDataFrame([tuple(row[c.split("_", 1)[1]] for c in columns)], schema)


@pytest.mark.parametrize("values, quantity, pct", [
    ({}, 1, 20.0), ({"quantity": 0}, None, 20.0), ({"quantity": -1}, None, 20.0), ({"quantity": None}, None, 20.0),
    ({"list_price": 0.0}, 1, 0.0), ({"list_price": None}, 1, 0.0), ({"sales_price": 12.0}, 1, -20.0),
])
def test_store_sales(spark, values, quantity, pct):
    got = silver.clean_store_sales(sales_row(spark, silver.STORE, **values)).first()
    assert (got.ss_quantity, got.ss_discount_pct) == (quantity, pct)


def test_sales_without_key_are_dropped(spark):
    for channel, clean in ((silver.STORE, silver.clean_store_sales), (silver.CATALOG, silver.clean_catalog_sales), (silver.WEB, silver.clean_web_sales)):
        for missing in ("item_sk", channel.transaction):
            assert clean(sales_row(spark, channel, **{missing: None})).count() == 0


def test_only_the_store_cleans_quantities_and_only_the_web_has_no_discount(spark):
    catalog = silver.clean_catalog_sales(sales_row(spark, silver.CATALOG, quantity=0)).first()
    web = silver.clean_web_sales(sales_row(spark, silver.WEB, quantity=0))
    assert (catalog.cs_quantity, catalog.cs_discount_pct) == (0, 20.0)
    assert web.first().ws_quantity == 0 and "ws_discount_pct" not in web.columns


def test_returns(spark):
    raw = spark.createDataFrame(
        [(1, 1, 5.0, 1.0), (1, 1, 3.0, 1.0), (None, 1, 2.0, 1.0), (None, 1, 4.0, 1.0), (2, None, 1.0, 1.0), (3, 1, None, 1e12)],
        "sr_ticket_number bigint, sr_item_sk int, sr_return_amt double, sr_net_loss double",
    )
    got = {r.sr_ticket_number: r.sr_return_amt for r in silver.clean_store_returns(raw).collect()}
    assert got == {1: Decimal("3.00"), None: Decimal("2.00"), 3: None}
    renamed = raw.toDF("cr_order_number", "cr_item_sk", "cr_return_amount", "cr_net_loss")
    assert dict(silver.clean_catalog_returns(renamed).dtypes)["cr_net_loss"] == "double"


def test_date_dim(spark):
    raw = spark.createDataFrame(
        [(m or 0, m, "Y", None) for m in [*range(1, 13), None]], "d_date_sk int, d_moy bigint, d_weekend string, d_holiday string"
    )
    got = {r.d_moy: r for r in silver.clean_date_dim(raw).collect()}
    seasons = [got[m].d_season for m in range(1, 13)]
    assert seasons == ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Fall"] * 3 + ["Winter"]
    assert [got[m].d_half_year for m in (1, 6, 7, 12)] == ["H1", "H1", "H2", "H2"]
    assert (got[None].d_season, got[None].d_half_year) == ("Fall", "H2")
    assert got[1].d_is_weekend is True and got[1].d_is_holiday is None
