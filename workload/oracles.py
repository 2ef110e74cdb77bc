"""Independent SQL for every registered query, run by DuckDB over the same tables."""

from __future__ import annotations


# --- SQL pieces -------------------------------------------------------------------


def rounded_ratio(num: str, den: str) -> str:
    """num / den rounded half away from zero, in whole numbers, for a positive den."""
    return (
        f"(CASE WHEN ({num}) >= 0 THEN (2 * ({num}) + ({den})) // (2 * ({den})) "
        f"ELSE -((-2 * ({num}) + ({den})) // (2 * ({den}))) END)"
    )


def cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS HUGEINT)"


def initcap(x: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({x}), ' '), "
        "lambda w: concat(upper(w[1:1]), w[2:])), ' ')"
    )


def dec(x: str, p: int = 12, s: int = 2) -> str:
    return f"CAST({x} AS DECIMAL({p},{s}))"


def date_sk(x: str) -> str:
    return f"CAST(year({x}) * 10000 + month({x}) * 100 + day({x}) AS INTEGER)"


# --- the raw tables -----------------------------------------------------------------

# channel: prefix of sales and returns, transaction, customer, location, return amount,
# rebate, unknown customer residues, flag of returned lines
CHANNEL = {
    "STORE": ("ss", "sr", "ticket_number", "ss_customer_sk", "ss_store_sk", "sr_return_amt", "l_discount", "1, 2", "R"),
    "CATALOG": ("cs", "cr", "order_number", "cs_bill_customer_sk", "cs_call_center_sk", "cr_return_amount", "l_tax", "2, 3", "A"),
    "WEB": ("ws", "wr", "order_number", "ws_bill_customer_sk", "ws_web_site_sk", "wr_return_amt", "0.05", "1, 3", "N"),
}


def src_sales(ch: str) -> str:
    s, _, txn, cust, loc, _, rebate, unknown, _ = CHANNEL[ch]
    price, reb = dec("l_extendedprice"), dec(rebate, 4)
    return f"""src_{s} AS (SELECT
      CASE WHEN l_orderkey % 20 = 1 THEN NULL ELSE {date_sk('l_shipdate')} END AS {s}_sold_date_sk,
      CASE WHEN l_partkey % 211 = 0 THEN NULL ELSE l_partkey END AS {s}_item_sk,
      CASE WHEN l_orderkey % 20 = 0 OR o_custkey % 10 IN ({unknown}) THEN NULL ELSE o_custkey END AS {cust},
      l_suppkey AS {loc}, l_orderkey AS {s}_{txn},
      CASE WHEN l_partkey % 97 = 0 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS {s}_quantity,
      CASE WHEN l_partkey % 89 = 0 THEN 0.0::DOUBLE ELSE l_extendedprice END AS {s}_list_price,
      CAST(CAST({price} * (1 - {reb}) AS DECIMAL(12,2)) AS DOUBLE) AS {s}_sales_price,
      CAST(CAST({price} * {reb} AS DECIMAL(12,2)) AS DOUBLE) AS {s}_ext_discount_amt,
      CAST(CAST({price} * (1 - {reb}) AS DECIMAL(14,2)) AS DOUBLE) AS {s}_ext_sales_price,
      CAST(CAST({price} * {dec('l_tax', 4)} AS DECIMAL(12,2)) AS DOUBLE) AS {s}_ext_tax,
      CAST(l_linenumber AS DOUBLE) AS {s}_coupon_amt,
      CAST(CAST({price} * ({dec('0.05', 4)} - {dec('l_discount', 4)}) AS DECIMAL(12,2)) AS DOUBLE) AS {s}_net_profit
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def src_returns(ch: str) -> str:
    _, r, txn, _, _, amount, _, _, flag = CHANNEL[ch]
    price = dec("l_extendedprice")
    return f"""src_{r} AS (SELECT
      {date_sk('l_shipdate')} AS {r}_returned_date_sk,
      CASE WHEN l_partkey % 211 = 0 THEN NULL ELSE l_partkey END AS {r}_item_sk,
      l_orderkey AS {r}_{txn},
      CAST(CASE WHEN l_quantity < l_linenumber THEN 1 ELSE l_linenumber END AS BIGINT) AS {r}_return_quantity,
      CAST(CAST({price} * {dec('0.5', 2, 1)} AS DECIMAL(12,2)) AS DOUBLE) AS {amount},
      CAST(CAST({price} * {dec('0.1', 2, 1)} AS DECIMAL(12,2)) AS DOUBLE) AS {r}_net_loss
      FROM lineitem WHERE l_returnflag = '{flag}')"""


SRC_DATE = f"""src_date AS (SELECT {date_sk('d')} AS d_date_sk, d AS d_date, year(d)::INT AS d_year, month(d)::INT AS d_moy,
      day(d)::INT AS d_dom, quarter(d)::INT AS d_qoy, concat(year(d), 'Q', quarter(d)) AS d_quarter_name, dayname(d) AS d_day_name,
      CASE WHEN isodow(d) >= 6 THEN 'Y' ELSE 'N' END AS d_weekend,
      CASE WHEN (month(d) = 12 AND day(d) = 25) OR (month(d) = 1 AND day(d) = 1) THEN 'Y' ELSE 'N' END AS d_holiday
      FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders))"""

SRC_ITEM = f"""src_item AS (SELECT p_partkey AS i_item_sk, concat('ITEM', p_partkey) AS i_item_id, p_name AS i_product_name,
      concat('  ', lower(p_type), ' ') AS i_category, upper(p_brand) AS i_brand, p_type AS i_class,
      CASE WHEN p_partkey % 50 = 0 THEN 0.0::DOUBLE ELSE p_retailprice END AS i_current_price,
      CASE WHEN p_partkey % 40 = 1 THEN -1.0::DOUBLE ELSE CAST(CAST({dec('p_retailprice', 10)}
        * CAST(p_partkey % 10 AS DECIMAL(2,0)) * {dec('0.1', 2, 1)} AS DECIMAL(10,2)) AS DOUBLE) END AS i_wholesale_cost,
      split_part(p_name, ' ', 1) AS i_color, CAST(p_size AS VARCHAR) AS i_size, 'Each' AS i_units FROM part)"""

SRC_CUSTOMER = """src_customer AS (SELECT c_custkey AS c_customer_sk, 'Dr.' AS c_salutation, c_mktsegment AS c_first_name,
      CASE WHEN c_custkey % 30 = 0 THEN NULL ELSE lower(split_part(c_name, '#', 1)) END AS c_last_name,
      concat('  USER', c_custkey, '@EXAMPLE.COM ') AS c_email_address, 1890 + c_custkey % 140 AS c_birth_year,
      'UNITED STATES' AS c_birth_country,
      CASE c_custkey % 5 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' WHEN 2 THEN 'y' WHEN 3 THEN NULL ELSE 'X' END AS c_preferred_cust_flag,
      CASE WHEN c_custkey % 25 = 0 THEN NULL ELSE c_custkey END AS c_current_addr_sk FROM customer)"""

SRC_ADDRESS = """src_address AS (SELECT c_custkey AS ca_address_sk, 'Dallas' AS ca_city,
      CASE c_custkey % 6 WHEN 0 THEN 'CA' WHEN 1 THEN 'TX' WHEN 2 THEN 'ca' WHEN 3 THEN 'ZZ' WHEN 4 THEN 'DC' END AS ca_state,
      CASE WHEN c_custkey % 7 = 0 THEN '123' ELSE CAST(10000 + c_custkey % 90000 AS VARCHAR) END AS ca_zip,
      '  united STATES ' AS ca_country FROM customer)"""


# --- silver ---------------------------------------------------------------------------


def silver_sales(ch: str) -> str:
    s, _, txn, *_ = CHANNEL[ch]
    quantity = f"CASE WHEN {s}_quantity > 0 THEN {s}_quantity END" if ch == "STORE" else f"{s}_quantity"
    pct = "" if ch == "WEB" else f""",
      CASE WHEN {s}_list_price > 0 THEN round(({s}_list_price - CAST({dec(f'{s}_sales_price')} AS DOUBLE)) / {s}_list_price * 100, 2)
        ELSE 0.0 END AS {s}_discount_pct"""
    return f"""sil_{s} AS (SELECT * REPLACE ({quantity} AS {s}_quantity, {dec(f'{s}_sales_price')} AS {s}_sales_price,
      {dec(f'{s}_net_profit')} AS {s}_net_profit, {dec(f'{s}_ext_sales_price', 14)} AS {s}_ext_sales_price){pct}
      FROM src_{s} WHERE {s}_item_sk IS NOT NULL AND {s}_{txn} IS NOT NULL)"""


def silver_returns(ch: str) -> str:
    _, r, txn, _, _, amount, *_ = CHANNEL[ch]
    loss = dec(f"{r}_net_loss") if ch == "STORE" else f"{r}_net_loss"
    return f"""sil_{r} AS (SELECT * REPLACE ({dec(amount)} AS {amount}, {loss} AS {r}_net_loss) FROM (
      SELECT * FROM src_{r} WHERE {r}_item_sk IS NOT NULL QUALIFY row_number() OVER (
        PARTITION BY {r}_{txn}, {r}_item_sk ORDER BY {r}_returned_date_sk NULLS FIRST, {r}_return_quantity NULLS FIRST,
        {amount} NULLS FIRST, {r}_net_loss NULLS FIRST) = 1))"""


SIL_DATE = """sil_date AS (SELECT *, d_weekend = 'Y' AS d_is_weekend, d_holiday = 'Y' AS d_is_holiday,
      CASE WHEN d_moy IN (12, 1, 2) THEN 'Winter' WHEN d_moy IN (3, 4, 5) THEN 'Spring' WHEN d_moy IN (6, 7, 8) THEN 'Summer'
        ELSE 'Fall' END AS d_season, CASE WHEN d_moy <= 6 THEN 'H1' ELSE 'H2' END AS d_half_year FROM src_date)"""

_PRICED = f"""priced AS (SELECT * REPLACE (CASE WHEN i_current_price > 0 THEN {dec('i_current_price', 10)} END AS i_current_price,
      CASE WHEN i_wholesale_cost > 0 THEN {dec('i_wholesale_cost', 10)} END AS i_wholesale_cost) FROM src_item)"""
_MARGIN = rounded_ratio(
    f"({cents('i_current_price')} - {cents('i_wholesale_cost')}) * 10000", cents("i_current_price")
)
SIL_ITEM = f"""{_PRICED}, sil_item AS (SELECT * REPLACE ({initcap('trim(i_category)')} AS i_category,
      {initcap('trim(i_brand)')} AS i_brand),
      CASE WHEN i_current_price IS NOT NULL AND i_wholesale_cost > 0 THEN CAST({_MARGIN} AS DOUBLE) / 100 END AS i_margin_pct
      FROM priced)"""

SIL_CUSTOMER = f"""sil_customer AS (SELECT * REPLACE (lower(trim(c_email_address)) AS c_email_address,
      CASE WHEN c_birth_year < 1900 OR c_birth_year > 2010 THEN NULL ELSE c_birth_year END AS c_birth_year,
      CASE WHEN c_preferred_cust_flag IN ('Y', 'N') THEN c_preferred_cust_flag ELSE 'N' END AS c_preferred_cust_flag),
      trim(concat_ws(' ', {initcap('c_first_name')}, {initcap('c_last_name')})) AS c_full_name FROM src_customer)"""

_STATES = (
    "AL AK AZ AR CA CO CT DE FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC ND "
    "OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY DC"
)
SIL_ADDRESS = f"""sil_address AS (SELECT * REPLACE (
      CASE WHEN list_contains(string_split('{_STATES}', ' '), ca_state) THEN upper(ca_state) ELSE 'UNK' END AS ca_state,
      CASE WHEN length(ca_zip) = 5 THEN ca_zip END AS ca_zip, {initcap('trim(ca_country)')} AS ca_country) FROM src_address)"""


# --- gold ------------------------------------------------------------------------------


def rollup(ch: str) -> str:
    _, r, txn, _, _, amount, *_ = CHANNEL[ch]
    return f"""roll_{r} AS (SELECT {r}_{txn}, {r}_item_sk, sum({amount}) AS return_amt,
      CAST(sum({r}_return_quantity) AS BIGINT) AS return_qty, sum({r}_net_loss) AS return_net_loss
      FROM sil_{r} GROUP BY ALL)"""


def channel(ch: str) -> str:
    s, r, txn, cust, loc, *_ = CHANNEL[ch]
    coupon, pct = ("0.0::DOUBLE", "0.0::DOUBLE") if ch == "WEB" else (f"{s}_coupon_amt", f"{s}_discount_pct")
    return f"""rows_{s} AS (SELECT '{ch}' AS channel, {s}_sold_date_sk AS sold_date_sk, {s}_item_sk AS item_sk,
      {cust} AS customer_sk, {loc} AS location_sk, {s}_{txn} AS transaction_id, {s}_quantity AS quantity,
      {s}_sales_price AS unit_price, {s}_ext_sales_price AS gross_sales_amt, {s}_ext_discount_amt AS discount_amt,
      {s}_ext_tax AS tax_amt, {s}_net_profit AS net_profit, {coupon} AS coupon_amt, {pct} AS discount_pct,
      coalesce(return_amt, 0) AS return_amt, coalesce(return_qty, 0) AS return_qty,
      {s}_ext_sales_price - coalesce(return_amt, 0) AS net_sales_amt
      FROM sil_{s} LEFT JOIN roll_{r} ON {s}_{txn} = {r}_{txn} AND {s}_item_sk = {r}_item_sk)"""


def channel_ctes(ch: str) -> list[str]:
    return [src_sales(ch), src_returns(ch), silver_sales(ch), silver_returns(ch), rollup(ch), channel(ch)]


FACT = """fact AS (SELECT f.*, d.* EXCLUDE (d_weekend, d_holiday), i.*,
      CASE WHEN quantity > 0 THEN round(return_qty / quantity::DOUBLE * 100, 2) ELSE 0.0 END AS return_rate_pct,
      return_qty > 0 AS is_returned
      FROM (SELECT * FROM rows_ss UNION ALL SELECT * FROM rows_cs UNION ALL SELECT * FROM rows_ws) f
      LEFT JOIN sil_date d ON sold_date_sk = d_date_sk LEFT JOIN sil_item i ON item_sk = i_item_sk)"""

FACT_CTES = [c for ch in CHANNEL for c in channel_ctes(ch)] + [SRC_DATE, SIL_DATE, SRC_ITEM, SIL_ITEM, FACT]


def by_channel(suffix: str) -> str:
    return ", ".join(
        f"sum(CASE WHEN channel = '{ch}' THEN gross_sales_amt END) AS {ch.lower()}_{suffix}" for ch in CHANNEL
    )


def leading(suffix: str, null_as_zero: bool = False) -> str:
    st, ca, we = (f"coalesce({ch.lower()}_{suffix}, 0)" if null_as_zero else f"{ch.lower()}_{suffix}" for ch in CHANNEL)
    return f"CASE WHEN {st} >= {ca} AND {st} >= {we} THEN 'STORE' WHEN {ca} >= {we} THEN 'CATALOG' ELSE 'WEB' END"


CUSTOMER_VALUE = f"""customer_value AS (SELECT customer_sk, count(*) AS total_transactions,
      sum(gross_sales_amt) AS lifetime_gross_sales, sum(net_sales_amt) AS lifetime_net_sales,
      sum(return_amt) AS lifetime_returns, sum(net_profit) AS lifetime_net_profit,
      CAST({rounded_ratio(cents('sum(gross_sales_amt)') + ' * 10000', 'count(gross_sales_amt)')} AS DOUBLE) / 1000000
        AS avg_transaction_value,
      max(d_date) AS last_purchase_date, min(d_date) AS first_purchase_date,
      count(DISTINCT d_date) AS unique_purchase_days, {by_channel('sales_amt')},
      CAST(sum(CASE WHEN is_returned THEN 1 ELSE 0 END) AS BIGINT) AS total_returned_txns,
      CAST(DATE '2001-12-31' - max(d_date) AS INTEGER) AS days_since_last_purchase
      FROM fact WHERE customer_sk IS NOT NULL GROUP BY customer_sk)"""

RFM = """tiles AS (SELECT *,
      CAST(ntile(5) OVER (ORDER BY days_since_last_purchase ASC NULLS FIRST, customer_sk) AS INTEGER) AS recency_score,
      CAST(ntile(5) OVER (ORDER BY total_transactions DESC NULLS LAST, customer_sk) AS INTEGER) AS frequency_score,
      CAST(ntile(5) OVER (ORDER BY lifetime_net_sales DESC NULLS LAST, customer_sk) AS INTEGER) AS monetary_score FROM customer_value),
    rfm AS (SELECT *, recency_score + frequency_score + monetary_score AS rfm_score,
      CASE WHEN recency_score + frequency_score + monetary_score >= 13 THEN 'Champions'
        WHEN recency_score + frequency_score + monetary_score >= 10 THEN 'Loyal Customers'
        WHEN recency_score + frequency_score + monetary_score >= 8 THEN 'Potential Loyalists'
        WHEN recency_score + frequency_score + monetary_score >= 6 THEN 'At Risk' ELSE 'Churned' END AS rfm_segment
      FROM tiles)"""

BEST_IS_HIGH = (
    RFM.replace("days_since_last_purchase ASC NULLS FIRST", "days_since_last_purchase DESC NULLS LAST")
    .replace("total_transactions DESC NULLS LAST", "total_transactions ASC NULLS FIRST")
    .replace("lifetime_net_sales DESC NULLS LAST", "lifetime_net_sales ASC NULLS FIRST")
)

C360 = f"""c360 AS (SELECT r.*, {leading('sales_amt')} AS preferred_channel,
      CASE WHEN total_transactions > 0 THEN round(total_returned_txns / total_transactions::DOUBLE * 100, 2) ELSE 0.0 END
        AS return_rate_pct,
      c_customer_sk, c_full_name, c_email_address, c_birth_year, c_birth_country, c_preferred_cust_flag, c_current_addr_sk,
      c_salutation, ca_address_sk, ca_city, ca_state, ca_zip, ca_country
      FROM rfm r LEFT JOIN sil_customer ON customer_sk = c_customer_sk
      LEFT JOIN sil_address ON c_current_addr_sk = ca_address_sk)"""

PEOPLE_CTES = [SRC_CUSTOMER, SIL_CUSTOMER, SRC_ADDRESS, SIL_ADDRESS]
C360_CTES = FACT_CTES + [CUSTOMER_VALUE, RFM] + PEOPLE_CTES + [C360]

PRODUCT = f"""product AS (SELECT item_sk, i_item_id, i_product_name, i_category, i_brand, i_class, i_current_price,
      i_wholesale_cost, i_margin_pct, i_color, i_size,
      sum(gross_sales_amt) AS total_gross_sales, sum(net_sales_amt) AS total_net_sales,
      sum(net_profit) AS total_net_profit, CAST(sum(quantity) AS BIGINT) AS total_units_sold, count(*) AS num_transactions,
      sum(return_amt) AS total_returns, CAST(sum(return_qty) AS BIGINT) AS total_return_units,
      CAST({rounded_ratio(cents('sum(unit_price)') + ' * 10000', 'count(unit_price)')} AS DOUBLE) / 1000000 AS avg_selling_price,
      CAST(sum({dec('discount_pct', 18)}) AS DOUBLE) / count(discount_pct) AS avg_discount_pct,
      count(DISTINCT customer_sk) AS unique_customers, {by_channel('revenue')},
      count(DISTINCT d_date) AS active_selling_days
      FROM fact WHERE item_sk IS NOT NULL GROUP BY ALL)"""

_SHARE = rounded_ratio(cents("total_net_sales") + " * 1000000", "sum(" + cents("total_net_sales") + ") OVER ()")
PERFORMANCE = f"""performance AS (SELECT *,
      CASE WHEN total_units_sold > 0 THEN round(total_return_units / total_units_sold::DOUBLE * 100, 2) ELSE 0.0 END AS return_rate_pct,
      CASE WHEN active_selling_days > 0 THEN round(total_units_sold / active_selling_days::DOUBLE, 2) ELSE 0.0 END AS daily_sales_velocity,
      CASE WHEN i_margin_pct >= 50 THEN 'Premium' WHEN i_margin_pct >= 30 THEN 'Standard' WHEN i_margin_pct >= 10 THEN 'Low Margin'
        ELSE 'Loss Leader' END AS margin_tier,
      {leading('revenue')} AS top_channel,
      CAST(dense_rank() OVER (ORDER BY total_net_sales DESC NULLS LAST) AS INTEGER) AS revenue_rank,
      CAST({_SHARE} AS DOUBLE) / 10000 AS revenue_pct_of_total FROM product)"""


def query(ctes: list[str], relation: str, doubles: str = "", dates: str = "", where: str = "") -> str:
    """SELECT * with the named decimal columns as DOUBLE and the named dates as text."""
    casts = [f"CAST({c} AS DOUBLE) AS {c}" for c in doubles.split()]
    casts += [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in dates.split()]
    replace = f" REPLACE ({', '.join(casts)})" if casts else ""
    head = f"WITH {', '.join(ctes)} " if ctes else ""
    return f"{head}SELECT *{replace} FROM {relation} {where}"


FACT_DOUBLES = (
    "unit_price gross_sales_amt net_profit return_amt net_sales_amt i_current_price i_wholesale_cost"
)
VALUE_DOUBLES = (
    "lifetime_gross_sales lifetime_net_sales lifetime_returns lifetime_net_profit "
    "store_sales_amt catalog_sales_amt web_sales_amt"
)
VALUE_DATES = "last_purchase_date first_purchase_date"
PRODUCT_DOUBLES = (
    "total_gross_sales total_net_sales total_net_profit total_returns store_revenue catalog_revenue web_revenue "
    "i_current_price i_wholesale_cost"
)


def _silver_sales_query(ch: str) -> str:
    s = CHANNEL[ch][0]
    return query([src_sales(ch), silver_sales(ch)], f"sil_{s}", f"{s}_sales_price {s}_net_profit {s}_ext_sales_price")


def _silver_returns_query(ch: str) -> str:
    r, amount = CHANNEL[ch][1], CHANNEL[ch][5]
    loss = f" {r}_net_loss" if ch == "STORE" else ""
    return query([src_returns(ch), silver_returns(ch)], f"sil_{r}", amount + loss)


def oracle_sql() -> dict[str, str]:
    out = {
        "silver_customer": query([SRC_CUSTOMER, SIL_CUSTOMER], "sil_customer"),
        "silver_customer_address": query([SRC_ADDRESS, SIL_ADDRESS], "sil_address"),
        "silver_item": query([SRC_ITEM, SIL_ITEM], "sil_item", "i_current_price i_wholesale_cost"),
        "silver_date_dim": query([SRC_DATE, SIL_DATE], "sil_date", dates="d_date"),
        "passthrough_nation": "SELECT *, 'silver' AS _source_layer FROM nation",
        "gold_sales_fact": query(FACT_CTES, "fact", FACT_DOUBLES, "d_date"),
        "customer_value": query(FACT_CTES + [CUSTOMER_VALUE], "customer_value", VALUE_DOUBLES, VALUE_DATES),
        "rfm_scores": query(FACT_CTES + [CUSTOMER_VALUE, RFM], "rfm", VALUE_DOUBLES, VALUE_DATES),
        "gold_customer_360": query(C360_CTES, "c360", VALUE_DOUBLES, VALUE_DATES),
        "gold_product_performance": query(FACT_CTES + [PRODUCT, PERFORMANCE], "performance", PRODUCT_DOUBLES),
        "rfm_scores_best_is_high": query(FACT_CTES + [CUSTOMER_VALUE, BEST_IS_HIGH], "rfm", VALUE_DOUBLES, VALUE_DATES),
        "preferred_channels": f"WITH {', '.join(FACT_CTES + [CUSTOMER_VALUE])} SELECT customer_sk, {leading('sales_amt')} AS null_loses, "
            f"{leading('sales_amt', True)} AS null_is_zero FROM customer_value",
        "top_channels": f"WITH {', '.join(FACT_CTES + [PRODUCT])} SELECT item_sk, {leading('revenue')} AS null_loses, "
            f"{leading('revenue', True)} AS null_is_zero FROM product",
        "channel_report": f"""WITH {', '.join(FACT_CTES)} SELECT CAST(row_number() OVER (ORDER BY sum(gross_sales_amt) DESC) AS INTEGER) AS position, channel, format('{{:,}}', count(*)) AS transactions,
            concat('$', format('{{:,.2f}}', CAST(sum(gross_sales_amt) AS DOUBLE) / 1e6), 'M') AS gross_sales,
            CAST({rounded_ratio(cents('sum(' + dec('return_rate_pct', 18) + ')'), 'count(return_rate_pct)')} AS DOUBLE) / 100 AS avg_return_pct
            FROM fact GROUP BY channel""",
        "segment_report": f"""WITH {', '.join(C360_CTES)} SELECT
            CAST(row_number() OVER (ORDER BY sum(lifetime_net_sales) / count(lifetime_net_sales) DESC) AS INTEGER) AS position, rfm_segment, format('{{:,}}', count(*)) AS customers,
            CAST({rounded_ratio(cents('sum(lifetime_net_sales)'), 'count(lifetime_net_sales)')} AS DOUBLE) / 100 AS avg_ltv
            FROM c360 GROUP BY rfm_segment""",
    }
    for ch, (s, r, *_) in CHANNEL.items():
        name = ch.lower()
        out[f"silver_{name}_sales"] = _silver_sales_query(ch)
        out[f"silver_{name}_returns"] = _silver_returns_query(ch)
        out[f"returns_rollup_{name}"] = query(
            [src_returns(ch), silver_returns(ch), rollup(ch)], f"roll_{r}", "return_amt return_net_loss"
        )
        out[f"channel_rows_{name}"] = query(
            channel_ctes(ch), f"rows_{s}", "unit_price gross_sales_amt net_profit return_amt net_sales_amt"
        )
    return out
