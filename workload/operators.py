"""Queries on single operators, each next to the SQL it is checked against."""

from __future__ import annotations

import uuid
import zlib
from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from trilayer import files
from trilayer.channels import CHANNELS
from trilayer.config import GOLD, RAW, SILVER, LayerConfig
from trilayer.functions import (
    bucket,
    fixed_length,
    guarded_pct,
    money,
    null_if_nonpositive,
    null_outside,
    one_of,
    proper_case,
)
from trilayer.operators import (
    dedupe,
    global_dense_rank,
    global_ntile,
    global_ntiles as ntiles,
    global_row_index,
    keyed_left_join,
    share_of_total,
)
from trilayer.operators.reconcile import (
    explode_roles,
    name_conflicts,
    next_roles,
    next_workspaces,
    provision,
    provision_summary,
    reconcile_roles,
    reconcile_workspaces,
    resolve_ids,
    role_transition,
    validate_specs,
)
from trilayer.operators.settle import FREE_SHUFFLES, run_scope, scratch_path, session_settings
from trilayer.plans import refresh, reports, runlog
from trilayer.plans.silver import CLEANSED
from trilayer.sources import storage, synth, versions
from trilayer.sources.calendar import build_date_dim, build_income_bands, build_time_dim
from workload import oracles
from workload.adapters import raw_table, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def registered(sql: str):
    def add(run):
        QUERIES[run.__name__] = run
        SQL[run.__name__] = sql
        return run

    return add


# --- cleansing rules --------------------------------------------------------------


@registered("""SELECT l_orderkey, l_linenumber, l_partkey,
    CASE WHEN l_quantity < 5 OR l_quantity > 45 THEN NULL ELSE l_quantity END AS quantity,
    CASE WHEN l_discount <= 0 THEN NULL ELSE l_discount END AS discount FROM lineitem""")
def null_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        null_outside("l_quantity", 5, 45).alias("quantity"),
        null_if_nonpositive("l_discount").alias("discount"),
    )


@registered("""SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN p_type ELSE 'OTHER' END AS type_or_other,
    CASE WHEN length(p_name) = 10 THEN p_name END AS name_of_ten,
    CASE WHEN p_size >= 40 THEN 'large' WHEN p_size >= 20 THEN 'medium' WHEN p_size >= 10 THEN 'small' ELSE 'tiny' END AS size_label,
    p_size = 7 AS is_size_seven, p_size >= 10 AND p_size < 20 OR p_type = 'PROMO' AS small_or_promo FROM part""")
def membership_and_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        one_of("p_type", ("ECONOMY", "PROMO"), "OTHER").alias("type_or_other"),
        fixed_length("p_name", 10).alias("name_of_ten"),
        bucket("p_size", [(40, "large"), (20, "medium"), (10, "small")], "tiny").alias("size_label"),
        (size == 7).alias("is_size_seven"),
        ((size >= 10) & (size < 20) | (F.col("p_type") == "PROMO")).alias("small_or_promo"),
    )


@registered("""SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS total,
    CAST(TRY_CAST(o_totalprice AS DECIMAL(7,2)) AS DOUBLE) AS fits_seven_digits,
    datediff('day', CAST(o_orderdate AS DATE), DATE '2003-12-31')::INT AS age_days, 'ORDER' AS kind,
    coalesce(TRY_CAST(TRY_CAST(o_totalprice AS DECIMAL(7,2)) AS DOUBLE), 0) AS total_or_zero FROM orders""")
def casts_and_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        money(total).cast("double").alias("total"),
        money(total, 7).cast("double").alias("fits_seven_digits"),
        F.datediff(F.lit("2003-12-31").cast("date"), F.to_date("o_orderdate")).alias("age_days"),
        F.lit("ORDER").alias("kind"),
        F.coalesce(money(total, 7).cast("double"), F.lit(0.0)).alias("total_or_zero"),
    )


@registered(f"""SELECT c_custkey, {oracles.initcap("trim(lower(c_mktsegment))")} AS segment,
    lower(trim(concat(' ', c_name, ' '))) AS lower_name, upper(c_mktsegment) AS upper_segment,
    concat_ws(' ', CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END, c_mktsegment) AS joined,
    concat('$', format('{{:,.2f}}', c_acctbal)) AS shown, length(c_name)::INT AS name_length FROM customer""")
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    maybe_name = F.when(F.col("c_custkey") % 3 != 0, F.col("c_name"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        proper_case("c_mktsegment").alias("segment"),
        F.lower(F.trim(F.concat(F.lit(" "), "c_name", F.lit(" ")))).alias("lower_name"),
        F.upper("c_mktsegment").alias("upper_segment"),
        F.concat_ws(" ", maybe_name, "c_mktsegment").alias("joined"),
        F.concat(F.lit("$"), F.format_number("c_acctbal", 2)).alias("shown"),
        F.length("c_name").alias("name_length"),
    )


_STORE_SALES = f"WITH {oracles.src_sales('STORE')}"


@registered(_STORE_SALES + """ SELECT count(*) AS all_lines, count(ss_item_sk) AS with_item,
    count(*) FILTER (ss_item_sk IS NOT NULL AND ss_customer_sk IS NOT NULL) AS with_item_and_customer FROM src_ss""")
def key_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    item, customer = F.col("ss_item_sk").isNotNull(), F.col("ss_customer_sk").isNotNull()
    return raw_table(spark, sf_dir, "store_sales").agg(
        F.count("*").alias("all_lines"), F.count_if(item).alias("with_item"), F.count_if(item & customer).alias("with_item_and_customer")
    )


@registered("""SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1""")
def dedupe_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedupe(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    return kept.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


# --- joins -------------------------------------------------------------------------


@registered(_STORE_SALES + f""", {oracles.SRC_DATE}, {oracles.SIL_DATE}, {oracles.SRC_ITEM}, {oracles.SIL_ITEM}
    SELECT ss_ticket_number, ss_item_sk, ss_sold_date_sk, d_date_sk, d_season, i_item_sk, i_brand, ss_quantity, ss_coupon_amt
    FROM src_ss LEFT JOIN sil_date ON ss_sold_date_sk = d_date_sk LEFT JOIN sil_item ON ss_item_sk = i_item_sk""")
def star_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales, dates, items = (raw_table(spark, sf_dir, t) for t in ("store_sales", "date_dim", "item"))
    dates = CLEANSED["date_dim"](dates).select("d_date_sk", "d_season")
    items = CLEANSED["item"](items).select("i_item_sk", "i_brand")
    joined = keyed_left_join(keyed_left_join(sales, dates, [("ss_sold_date_sk", "d_date_sk")]), items, [("ss_item_sk", "i_item_sk")])
    return joined.select(
        "ss_ticket_number", "ss_item_sk", "ss_sold_date_sk", "d_date_sk", "d_season", "i_item_sk", "i_brand",
        "ss_quantity", "ss_coupon_amt",
    )


@registered(f"""WITH {', '.join(oracles.PEOPLE_CTES)}, spent AS (
      SELECT o_custkey, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS spent FROM orders GROUP BY 1)
    SELECT o_custkey, orders, spent, c_customer_sk, c_full_name, c_current_addr_sk, ca_address_sk, ca_state
    FROM spent LEFT JOIN sil_customer ON o_custkey = c_customer_sk LEFT JOIN sil_address ON c_current_addr_sk = ca_address_sk""")
def customer_and_address_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    spent = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("orders"), F.sum(money("o_totalprice")).cast("double").alias("spent")
    )
    people = CLEANSED["customer"](raw_table(spark, sf_dir, "customer"))
    places = CLEANSED["customer_address"](raw_table(spark, sf_dir, "customer_address"))
    known = keyed_left_join(
        spent, people.select("c_customer_sk", "c_full_name", "c_current_addr_sk"), [("o_custkey", "c_customer_sk")]
    )
    return keyed_left_join(known, places.select("ca_address_sk", "ca_state"), [("c_current_addr_sk", "ca_address_sk")])


@registered(f"""WITH {', '.join(oracles.src_sales(ch) for ch in oracles.CHANNEL)}, lines AS (
      SELECT 'STORE' AS channel, ss_quantity AS quantity, ss_coupon_amt AS coupon_amt FROM src_ss
      UNION ALL SELECT 'CATALOG', cs_quantity, cs_coupon_amt FROM src_cs UNION ALL SELECT 'WEB', ws_quantity, 0 FROM src_ws)
    SELECT channel, count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS units, sum(coupon_amt) AS coupons FROM lines GROUP BY 1""")
def union_of_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = None
    for c in CHANNELS:
        coupon = F.col(c.s("coupon_amt")) if c.has_discount else F.lit(0).cast("decimal(12,2)")
        rows = raw_table(spark, sf_dir, c.sales_table).select(
            F.lit(c.name).alias("channel"), F.col(c.s("quantity")).alias("quantity"), coupon.alias("coupon_amt")
        )
        lines = rows if lines is None else lines.unionByName(rows)
    return lines.groupBy("channel").agg(
        F.count("*").alias("lines"), F.sum("quantity").alias("units"), F.sum("coupon_amt").alias("coupons")
    )


# --- aggregates ---------------------------------------------------------------------


@registered("""SELECT l_orderkey, l_suppkey, count(*) AS lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) AS gross,
    CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units,
    strftime(min(l_shipdate), '%Y-%m-%d') AS first_ship, strftime(max(l_shipdate), '%Y-%m-%d') AS last_ship
    FROM lineitem GROUP BY l_orderkey, l_suppkey""")
def sums_by_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(
        F.count("*").alias("lines"),
        F.sum(money("l_extendedprice", 14)).cast("double").alias("gross"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("units"),
        day(F.min("l_shipdate")).alias("first_ship"),
        day(F.max("l_shipdate")).alias("last_ship"),
    )


@registered(f"""SELECT l_partkey, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT CAST(l_shipdate AS DATE)) AS days,
    CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(14,2)) END) AS DOUBLE) AS returned_gross,
    CAST(sum(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS discounted,
    CAST({oracles.rounded_ratio(oracles.cents("sum(CAST(l_extendedprice AS DECIMAL(14,2)))"), "count(*)")} AS DOUBLE) / 100 AS mean_price
    FROM lineitem GROUP BY l_partkey""")
def distinct_and_conditional_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, lines = money("l_extendedprice", 14), table(spark, sf_dir, "lineitem")
    sums = lines.groupBy("l_partkey").agg(
        F.sum(F.when(F.col("l_returnflag") == "R", price)).cast("double").alias("returned_gross"),
        F.sum(F.when(F.col("l_discount") > 0.05, 1).otherwise(0)).alias("discounted"),
        F.round(F.avg(price), 2).cast("double").alias("mean_price"),
    )
    # Two distinct counts beside sums in one aggregate would send every line through the shuffle three times.
    suppliers = lines.select("l_partkey", "l_suppkey").distinct().groupBy(F.col("l_partkey").alias("s")).agg(F.count("l_suppkey").alias("suppliers"))
    days = lines.select("l_partkey", F.to_date("l_shipdate").alias("day")).distinct()
    days = days.groupBy(F.col("l_partkey").alias("d")).agg(F.count("day").alias("days"))
    return sums.join(suppliers, F.col("l_partkey").eqNullSafe(F.col("s"))).join(days, F.col("l_partkey").eqNullSafe(F.col("d"))).drop("s", "d")


@registered("""SELECT p_partkey, p_name, p_brand, p_type, p_size, count(*) AS lines,
    round(CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) * 100, 2) AS returned_pct
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""")
def wide_group_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Counted by the key alone, then described and brought together by all five columns.
    counts = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.count("*").alias("lines"), F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("_returned")
    )
    described = counts.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    counts = described.groupBy("p_partkey", "p_name", "p_brand", "p_type", "p_size").agg(
        F.sum("lines").alias("lines"), F.sum("_returned").alias("_returned")
    )
    return counts.withColumn("returned_pct", guarded_pct(F.col("_returned"), F.col("lines"))).drop("_returned")


@registered(f"""SELECT o_orderpriority, format('{{:,}}', count(*)) AS orders,
    CAST({oracles.rounded_ratio(oracles.cents("sum(CAST(o_totalprice AS DECIMAL(12,2)))"), "count(*)")} AS DOUBLE) / 100 AS mean_total
    FROM orders GROUP BY 1""")
def sorted_by_hidden_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = money("o_totalprice")
    per_priority = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(
        F.format_number(F.count("*"), 0).alias("orders"),
        F.round(F.avg(total), 2).cast("double").alias("mean_total"),
        F.sum(total).alias("_total"),
    )
    return per_priority.orderBy(F.col("_total").desc()).drop("_total")


# --- whole-table ranks -----------------------------------------------------------------


@registered("""SELECT o_orderkey, ntile(7) OVER (ORDER BY o_totalprice DESC NULLS LAST, o_orderkey)::INT AS by_price,
    ntile(5) OVER (ORDER BY o_orderdate ASC NULLS FIRST, o_orderkey)::INT AS by_date FROM orders""")
def global_ntiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    tiled = global_ntile(orders, 7, [("o_totalprice", "desc")], "o_orderkey", "by_price")
    return ntiles(tiled, 5, {"by_date": ["o_orderdate"]}, "o_orderkey").select("o_orderkey", "by_price", "by_date")


@registered("""SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderdate DESC NULLS LAST) AS INTEGER) AS date_rank FROM orders""")
def global_dense_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return global_dense_rank(orders, [("o_orderdate", "desc")], "date_rank").drop("o_orderdate")


@registered("""SELECT l_orderkey, l_linenumber, CAST(dense_rank() OVER (ORDER BY l_returnflag NULLS FIRST, l_extendedprice DESC NULLS LAST) AS INTEGER) AS place
    FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS l_returnflag, l_extendedprice FROM lineitem)""")
def dense_ranks_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By two columns; half of the lines have NULL in the first."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("l_returnflag"), "l_extendedprice"
    )
    return global_dense_rank(lines, ["l_returnflag", ("l_extendedprice", "desc")], "place").select("l_orderkey", "l_linenumber", "place")


@registered("""SELECT o_orderkey, ntile(1000) OVER (ORDER BY o_totalprice DESC NULLS LAST, o_orderkey)::INT AS by_price,
    ntile(1000) OVER (ORDER BY o_orderdate ASC NULLS FIRST, o_orderkey)::INT AS by_date FROM orders""")
def thousand_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    tiled = ntiles(orders, 1000, {"by_price": [("o_totalprice", "desc")], "by_date": ["o_orderdate"]}, "o_orderkey")
    return tiled.select("o_orderkey", "by_price", "by_date")


@registered("""SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_orderdate DESC, o_orderkey) - 1 AS position FROM orders""")
def global_row_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    order = ["o_orderpriority", ("o_orderdate", "desc")]
    return global_row_index(orders, order, "o_orderkey", "position").select("o_orderkey", "position")


_PART_CENTS = "CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 100 AS HUGEINT)"


@registered(f"""SELECT p_partkey,
    CAST({oracles.rounded_ratio(f"{_PART_CENTS} * 1000000", f"sum({_PART_CENTS}) OVER ()")} AS DOUBLE) / 10000 AS share FROM part""")
def shares_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    # As wide as the totals of the gold layer, so the quotient keeps the same six digits.
    price = money("p_retailprice").cast("decimal(33,2)")
    priced = table(spark, sf_dir, "part").select("p_partkey", price.alias("price"))
    shared = share_of_total(priced, "price", 4, "share", stored=priced)
    return shared.select("p_partkey", F.col("share").cast("double").alias("share"))


# --- storage ---------------------------------------------------------------------------


def _own_lakehouse(spark: SparkSession) -> tuple[LayerConfig, str]:
    root = scratch_path(spark, "lakehouse")
    return LayerConfig(root=root, database=f"retail_{uuid.uuid4().hex}"), f"{root}/landing"


def _without_names(spark: SparkSession, cfg: LayerConfig) -> None:
    """Drop the database of a query; the tables' folders stay, since its result reads them."""
    spark.sql(f"DROP DATABASE {cfg.database} CASCADE")


def _without_layer(spark: SparkSession, cfg: LayerConfig, layer: str) -> None:
    files.delete(spark, f"{cfg.root}/{cfg.bases[layer]}")


@registered("SELECT * FROM supplier")
def recursive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return storage.read_files(spark, f"{sf_dir}/supplier.parquet")


@registered("SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate) FROM orders")
def ingested_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg, landing = _own_lakehouse(spark)
    storage.write_files(table(spark, sf_dir, "orders"), f"{landing}/orders")
    refresh.ingest(spark, cfg, landing, ("orders",))
    stored = storage.read_table(spark, cfg, RAW, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    _without_names(spark, cfg)
    return stored


@registered("""SELECT r.r_regionkey, r_name, count(n_nationkey) AS nations, 'old' AS started, 2 AS published FROM region r LEFT JOIN nation USING (r_regionkey) GROUP BY ALL
    UNION ALL SELECT r.r_regionkey, r_name, -count(n_nationkey), 'new', 2 FROM region r LEFT JOIN nation USING (r_regionkey) GROUP BY ALL"""
    .replace("LEFT JOIN nation USING (r_regionkey)", "LEFT JOIN nation ON n_regionkey = r_regionkey"))
def refreshed_beside_readers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced twice: a reader that started before the second refresh, and one that started after it."""
    cfg, _ = _own_lakehouse(spark)
    storage.create_database(spark, cfg)
    nations = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.count("*").alias("nations"))
    rows = keyed_left_join(table(spark, sf_dir, "region"), nations, [("r_regionkey", "n_regionkey")])
    rows = rows.select("r_regionkey", "r_name", F.coalesce("nations", F.lit(0)).alias("nations"))
    storage.write_layer(rows, cfg, GOLD, "regions", audit=False)
    by_path, by_name = storage.read_layer(spark, cfg, GOLD, "regions"), storage.read_table(spark, cfg, GOLD, "regions")
    storage.write_layer(rows.withColumn("nations", -F.col("nations")), cfg, GOLD, "regions", audit=False)
    # Both ways of reading give the same rows, so of the two each gives one half here.
    old = by_path.where("r_regionkey % 2 = 0").unionByName(by_name.where("r_regionkey % 2 = 1")).withColumn("started", F.lit("old"))
    new = storage.read_layer(spark, cfg, GOLD, "regions").where("r_regionkey % 2 = 0")
    new = new.unionByName(storage.read_table(spark, cfg, GOLD, "regions").where("r_regionkey % 2 = 1")).withColumn("started", F.lit("new"))
    published = versions.versions(spark, cfg.path(GOLD, "regions"))[-1][0]
    _without_names(spark, cfg)
    return old.unionByName(new).withColumn("published", F.lit(published))


@registered("SELECT * FROM lineitem")
def appended_in_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines appended flag by flag, every chunk twice; the second time nothing is written."""
    path = scratch_path(spark, "lakehouse")
    lines = table(spark, sf_dir, "lineitem")
    flags = [r[0] for r in lines.select("l_returnflag").distinct().collect()]
    for flag in flags * 2:
        versions.append_chunk(lines.where(F.col("l_returnflag").eqNullSafe(F.lit(flag))), path, f"flag={flag}", rows_per_file=100_000)
    return storage.read_files(spark, path)


@registered("""SELECT 'raw' AS layer, 'customer' AS "table", 'ok' AS status, count(*) AS "rows", 1 AS attempts FROM customer
    UNION ALL SELECT 'raw', 'part', 'ok', count(*), 2 FROM part UNION ALL SELECT 'raw', 'store', 'skipped', 0, 2
    UNION ALL SELECT 'raw', 'supplier', 'ok', count(*), 1 FROM supplier""")
def restarted_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run whose first attempt finds no parts: the second writes these and nothing it wrote before. One table never lands."""
    cfg, landing = _own_lakehouse(spark)
    wanted = ("customer", "part", "store", "supplier")
    for t in ("customer", "supplier"):
        storage.write_files(table(spark, sf_dir, t), f"{landing}/{t}")
    refresh.ingest(spark, cfg, landing, wanted, log=runlog.RunLog(spark, cfg, "run"))
    storage.write_files(table(spark, sf_dir, "part"), f"{landing}/part")
    log = runlog.RunLog(spark, cfg, "run")
    refresh.ingest(spark, cfg, landing, wanted, log=log)
    _without_names(spark, cfg)
    return log.statuses().drop("error")


@registered("""SELECT 'raw' AS layer, 'customer' AS "table", 'ok' AS status, count(*) AS "rows" FROM customer
    UNION ALL SELECT 'raw', 'part', 'ok', count(*) FROM part UNION ALL SELECT 'raw', 'store', 'skipped', 0
    UNION ALL SELECT 'silver', 'customer', 'ok', count(*) FROM customer
    UNION ALL SELECT 'silver', 'warehouse', 'error', 0
    UNION ALL SELECT 'raw', 'part', 'skipped', NULL UNION ALL SELECT 'raw', 'customer', 'skipped', NULL
    UNION ALL SELECT 'raw', 'part', 'refreshed', NULL UNION ALL SELECT 'raw', 'inventory', 'error', NULL""")
def run_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest, copy on and register; one table has no source and two are not there."""
    # The ledger does not read the tables, so these go.
    with run_scope(spark):
        cfg, landing = _own_lakehouse(spark)
        for t in ("customer", "part"):
            storage.write_files(table(spark, sf_dir, t), f"{landing}/{t}")
        rows = refresh.ingest(spark, cfg, landing, ("customer", "part", "store"))
        rows = rows.unionByName(refresh.passthrough(spark, cfg, ("customer", "warehouse")))
        rows = rows.unionByName(storage.register(spark, cfg, RAW, ("part", "customer")))
        rows = rows.unionByName(storage.register(spark, cfg, RAW, ("part", "inventory"), refresh=True))
        _without_names(spark, cfg)
    return rows.select("layer", "table", "status", "rows")


@registered("""WITH ledger AS (SELECT o_orderpriority AS layer, concat('table_', o_custkey % 24) AS "table",
      CASE WHEN o_custkey % 24 < 6 AND o_orderkey % 50 = 0 THEN 'error' WHEN o_orderkey % 5 = 1 THEN 'skipped'
        WHEN o_orderkey % 5 = 2 THEN 'created' WHEN o_orderkey % 5 = 3 THEN 'refreshed' ELSE 'ok' END AS status FROM orders)
    SELECT layer, count(*) FILTER (status IN ('ok', 'created', 'refreshed')) AS done, count(*) FILTER (status = 'skipped') AS skipped,
      count(*) FILTER (status = 'error') AS failed,
      coalesce(string_agg(DISTINCT "table", ',' ORDER BY "table") FILTER (status = 'error'), '') AS failed_tables
    FROM ledger GROUP BY layer""")
def run_status_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, order = F.col("o_custkey") % 24, F.col("o_orderkey")
    status = (
        F.when((name < 6) & (order % 50 == 0), "error").when(order % 5 == 1, "skipped")
        .when(order % 5 == 2, "created").when(order % 5 == 3, "refreshed").otherwise("ok")
    )
    ledger = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("layer"),
        F.concat(F.lit("table_"), name.cast("string")).alias("table"),
        status.alias("status"),
    )
    return reports.run_status_rollup(ledger).withColumn("failed_tables", F.array_join("failed_tables", ","))


def _rebuilt_lakehouse(spark: SparkSession, sf_dir: str) -> LayerConfig:
    """Landed files to raw, silver and gold; the files lie in nested folders whose names mean nothing.

    The lakehouse is the query's own, so what the next layer has been made of goes: landed files table by table, sales and returns when the fact
    is written.
    """
    cfg, landing = _own_lakehouse(spark)
    cfg = replace(cfg, analysis_date=date(2001, 12, 31))
    for t in CLEANSED:
        with session_settings(spark, FREE_SHUFFLES):
            storage.write_files(raw_table(spark, sf_dir, t), f"{landing}/{t}/batch=1/part")
        refresh.ingest(spark, cfg, landing, (t,))
        files.delete(spark, f"{landing}/{t}")
    refresh.refresh_silver(spark, cfg)
    _without_layer(spark, cfg, RAW)
    refresh.refresh_gold(spark, cfg, tables=("sales_fact",))
    for t in set(refresh.GOLD_INPUTS["sales_fact"]) - {"item"}:
        files.delete(spark, cfg.path(SILVER, t))
    refresh.refresh_gold(spark, cfg, tables=("customer_360", "product_performance"))
    _without_layer(spark, cfg, SILVER)
    _without_names(spark, cfg)
    return cfg


@registered(oracles.oracle_sql()["channel_report"])
def lakehouse_channel_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = _rebuilt_lakehouse(spark, sf_dir)
    return reports.channel_report(storage.read_layer(spark, cfg, GOLD, "sales_fact"))


@registered(oracles.oracle_sql()["segment_report"])
def lakehouse_segment_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = _rebuilt_lakehouse(spark, sf_dir)
    report = reports.segment_report(storage.read_layer(spark, cfg, GOLD, "customer_360"))
    return report.withColumns({f.name: F.col(f.name).cast("double") for f in report.schema.fields if f.dataType.typeName() == "decimal"})


# --- calendar, clock and bands ------------------------------------------------------------


@registered("""WITH span AS (SELECT min(CAST(o_orderdate AS DATE)) AS low, max(CAST(o_orderdate AS DATE)) AS high FROM orders),
    days AS (SELECT low, CAST(unnest(generate_series(low, high, INTERVAL 1 DAY)) AS DATE) AS d FROM span),
    sold AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1)
    SELECT CAST(2415022 + (d - low) AS INTEGER) AS d_date_sk, strftime(d, 'AAAAAA%Y%m%d') AS d_date_id, strftime(d, '%Y-%m-%d') AS d_date,
      (year(d) - 1900) * 12 + month(d) AS d_month_seq, dayofyear(d) // 7 + 1 AS d_week_seq,
      quarter(d) + (year(d) - 1998) * 4 AS d_quarter_seq, year(d) AS d_year, isodow(d) - 1 AS d_dow, month(d) AS d_moy, day(d) AS d_dom,
      quarter(d) AS d_qoy, year(d) AS d_fy_year, quarter(d) AS d_fy_quarter_seq, dayofyear(d) // 7 + 1 AS d_fy_week_seq,
      dayname(d) AS d_day_name, concat(year(d), 'Q', quarter(d)) AS d_quarter_name,
      CASE WHEN strftime(d, '%m-%d') IN ('01-01', '12-25') THEN 'Y' ELSE 'N' END AS d_holiday,
      CASE WHEN isodow(d) >= 6 THEN 'Y' ELSE 'N' END AS d_weekend,
      CASE WHEN strftime(d - 1, '%m-%d') IN ('01-01', '12-25') THEN 'Y' ELSE 'N' END AS d_following_holiday,
      dayofyear(date_trunc('month', d)) AS d_first_dom, dayofyear(date_trunc('month', d) + INTERVAL 1 MONTH) AS d_last_dom,
      CAST(2415022 + (d - low) - 365 AS INTEGER) AS d_same_day_ly, CAST(2415022 + (d - low) - 91 AS INTEGER) AS d_same_day_lq,
      CASE WHEN d = DATE '2001-07-30' THEN 'Y' ELSE 'N' END AS d_current_day,
      CASE WHEN date_trunc('week', d) = date_trunc('week', DATE '2001-07-30') THEN 'Y' ELSE 'N' END AS d_current_week,
      CASE WHEN date_trunc('month', d) = DATE '2001-07-01' THEN 'Y' ELSE 'N' END AS d_current_month,
      CASE WHEN date_trunc('quarter', d) = DATE '2001-07-01' THEN 'Y' ELSE 'N' END AS d_current_quarter,
      CASE WHEN year(d) = 2001 THEN 'Y' ELSE 'N' END AS d_current_year, coalesce(n, 0) AS orders
    FROM days LEFT JOIN sold ON d = day""")
def calendar_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"))
    span = days.agg(F.min("day").alias("low"), F.max("day").alias("high")).first()
    today = span.high.replace(year=2001, month=7, day=30)
    calendar = build_date_dim(spark, span.low, (span.high - span.low + timedelta(days=1)).days, today=today)
    sold = days.groupBy("day").agg(F.count("*").alias("orders"))
    joined = calendar.join(sold, F.col("d_date") == F.col("day"), "left").drop("day")
    return joined.withColumns({
        "orders": F.coalesce("orders", F.lit(0)), "d_date": F.date_format("d_date", "yyyy-MM-dd"),
    })


@registered("""WITH seconds AS (SELECT range AS s FROM range(86400)),
    busy AS (SELECT hour(ts) * 3600 + minute(ts) * 60 + CAST(second(ts) AS INTEGER) AS s, count(*) AS n FROM events GROUP BY 1)
    SELECT CAST(s // 3600 AS INTEGER) AS t_hour, CAST(s % 3600 // 60 AS INTEGER) AS t_minute, CASE WHEN s // 3600 < 12 THEN 'AM' ELSE 'PM' END AS t_am_pm,
      CASE WHEN s // 3600 < 8 THEN 'first' WHEN s // 3600 < 16 THEN 'second' ELSE 'third' END AS t_shift,
      min('T' || lpad(CAST(s AS VARCHAR), 8, '0')) AS first_id, CAST(max(s % 60) AS INTEGER) AS last_second,
      count(*) AS seconds, CAST(coalesce(sum(n), 0) AS BIGINT) AS events
    FROM seconds LEFT JOIN busy USING (s) GROUP BY ALL""")
def clock_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    second = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    busy = table(spark, sf_dir, "events").groupBy(second.alias("t")).agg(F.count("*").alias("n"))
    clock = build_time_dim(spark).join(busy, F.col("t_time") == F.col("t"), "left")
    return clock.groupBy("t_hour", "t_minute", "t_am_pm", "t_shift").agg(
        F.min("t_time_id").alias("first_id"), F.max("t_second").alias("last_second"),
        F.count("*").alias("seconds"), F.coalesce(F.sum("n"), F.lit(0)).alias("events"),
    )


@registered("""WITH bands AS (SELECT CAST(range + 1 AS INTEGER) AS ib_income_band_sk, CAST(range * 1000 AS INTEGER) AS ib_lower_bound,
      CAST((range + 1) * 1000 AS INTEGER) AS ib_upper_bound
      FROM range((SELECT CAST(greatest(0, coalesce(floor(max(c_acctbal) / 1000), -1) + 1) AS BIGINT) FROM customer))),
    counts AS (SELECT CASE WHEN c_acctbal >= 0 THEN CAST(floor(c_acctbal / 1000) + 1 AS INTEGER) END AS band, count(*) AS n FROM customer GROUP BY 1)
    SELECT bands.*, coalesce(n, 0) AS customers FROM bands FULL JOIN counts ON ib_income_band_sk = band""")
def income_bands_of_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many bands as the largest balance needs; a row without a band counts the customers outside all."""
    band = F.when(F.col("c_acctbal") >= 0, (F.floor(F.col("c_acctbal") / 1000) + 1).cast("int"))
    counts = table(spark, sf_dir, "customer").groupBy(band.alias("band")).agg(F.count("*").alias("customers"))
    bands = build_income_bands(spark, counts.agg(F.coalesce(F.max("band"), F.lit(0))).first()[0], 1000)
    return bands.join(counts, F.col("ib_income_band_sk") == F.col("band"), "full").select(
        *bands.columns, F.coalesce("customers", F.lit(0)).alias("customers")
    )


# --- synthetic rows ---------------------------------------------------------------------------


_U64 = "18446744073709551616::UHUGEINT"
_P = {
    1: "11400714785074694791::UHUGEINT", 2: "14029467366897019727::UHUGEINT", 3: "1609587929392839161::UHUGEINT",
    4: "9650029242287828579::UHUGEINT", 5: "2870177450012600261::UHUGEINT",
}


def _xxhash64_round(rel: str, x: str) -> str:
    """Replace ``h`` by the 64-bit hash of ``x`` with seed ``h``; every step is one SELECT."""
    mul = lambda a, b: f"({a} * {b}) % {_U64}"
    rotl = lambda v, n: f"(({v} * {1 << n}::UHUGEINT) % {_U64} + {v} // {1 << (64 - n)}::UHUGEINT)"
    xor = lambda a, b: f"CAST(xor(CAST({a} AS UBIGINT), CAST({b} AS UBIGINT)) AS UHUGEINT)"
    shift = lambda v, n: f"({v} // {1 << n}::UHUGEINT)"
    unsigned = f"CAST(CASE WHEN {x} < 0 THEN CAST({x} AS HUGEINT) + 18446744073709551616 ELSE {x} END AS UHUGEINT)"
    steps = [
        ("k", mul(unsigned, _P[2])), ("k", mul(rotl("k", 31), _P[1])),
        ("h", f"(h + {_P[5]} + 8::UHUGEINT) % {_U64}"), ("h", xor("h", "k")),
        ("h", f"({mul(rotl('h', 27), _P[1])} + {_P[4]}) % {_U64}"),
        ("h", xor("h", shift("h", 33))), ("h", mul("h", _P[2])), ("h", xor("h", shift("h", 29))),
        ("h", mul("h", _P[3])), ("h", xor("h", shift("h", 32))),
    ]
    for name, expression in steps:
        rel = f"(SELECT * REPLACE ({expression} AS {name}) FROM {rel})"
    return rel


def _hashed(rel: str, words: list[str], out: str) -> str:
    """``rel`` with the signed hash of the words in ``out``, seeded with 42 as Spark's xxhash64 is."""
    rel = f"(SELECT *, 42::UHUGEINT AS h, 0::UHUGEINT AS k FROM {rel})"
    for word in words:
        rel = _xxhash64_round(rel, word)
    signed = "CAST(CASE WHEN h >= 9223372036854775808 THEN CAST(h AS HUGEINT) - 18446744073709551616 ELSE CAST(h AS HUGEINT) END AS BIGINT)"
    return f"(SELECT * EXCLUDE (h, k), {signed} AS {out} FROM {rel})"


def _draw(column: str, n: int = 0) -> list[str]:
    return ["42", str(zlib.crc32(column.encode())), str(n), "_row"]


def _pmod(h: str, n: str) -> str:
    return f"((({h} % {n}) + {n}) % {n})"


def _synth_sql() -> str:
    rel = "(SELECT range AS _row FROM range((SELECT count(*) FROM orders)))"
    for out, words in {
        "h_item": _draw("sr_item_sk"), "h_qty": _draw("sr_return_quantity"), "h_null": _draw("sr_return_quantity", 1),
        "h_amt": _draw("sr_return_amt"), "h_reason": _draw("reason"), "h_flag": _draw("flag"), "h_day": _draw("returned"),
        "h_slot": ["42", str(zlib.crc32(b"sr_ticket_number")), "_row + 1"],
    }.items():
        rel = _hashed(rel, words, out)
    parents = _hashed("orders", ["42", "o_orderkey"], "h_draw")
    size = "least(5000, (SELECT count(*) FROM orders))"
    return f"""WITH made AS MATERIALIZED {rel}, sample AS MATERIALIZED (SELECT o_orderkey, row_number() OVER (ORDER BY h_draw, o_orderkey) - 1 AS slot
        FROM {parents} QUALIFY slot < {size})
      SELECT CAST(_row + 1 AS INTEGER) AS sr_id, {_pmod('h_item', '2000')} + 1 AS sr_item_sk,
        CASE WHEN {_pmod('h_null', '100')} >= 5 THEN {_pmod('h_qty', '100')} + 1 END AS sr_return_quantity,
        ({_pmod('h_amt', '49901')} + 100) / 100.0::DOUBLE AS sr_return_amt,
        ['Damaged', 'Wrong size', 'Other'][{_pmod('h_reason', '3')} + 1] AS reason,
        CASE WHEN {_pmod('h_flag', '1000000')} < 50000 THEN 'Y' ELSE 'N' END AS flag,
        strftime(DATE '1998-01-01' + CAST({_pmod('h_day', '2190')} AS INTEGER), '%Y-%m-%d') AS returned, o_orderkey AS sr_ticket_number
      FROM made LEFT JOIN sample ON {_pmod('h_slot', size)} = slot"""


@registered(_synth_sql())
def synthetic_returns_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many made-up returns as there are orders, each of one of 5,000 sampled orders."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    rows = orders.count()
    size = min(5000, rows)
    made = synth.synth_table(spark, {
        "sr_id": synth.numbered(),
        "sr_item_sk": synth.whole(1, 2001),
        "sr_return_quantity": synth.some_null(synth.whole(1, 101)),
        "sr_return_amt": synth.amount(1, 500),
        "reason": synth.pick("Damaged", "Wrong size", "Other"),
        "flag": synth.pick("Y", "N", weights=(0.05, 0.95)),
        "returned": synth.text(synth.day("1998-01-01", "2003-12-31")),
    }, rows)
    sample = synth.sample_keys(orders, "o_orderkey", "o_orderkey", size, rows)
    return synth.with_parent_key(made, sample, size, "sr_ticket_number", "sr_id")


# --- desired and current state --------------------------------------------------------------------


def _guid(x) -> F.Column:
    h = F.md5(x.cast("string"))
    part = lambda start, n: F.substring(h, start, n)
    return F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12))


def _guid_sql(x: str) -> str:
    h = f"md5(CAST({x} AS VARCHAR))"
    return f"concat_ws('-', substr({h}, 1, 8), substr({h}, 9, 4), substr({h}, 13, 4), substr({h}, 17, 4), substr({h}, 21, 12))"


@registered(f"""WITH directory AS (SELECT min(s_suppkey) AS first, concat('NATION_', s_nationkey) AS name FROM supplier GROUP BY 2),
    specs AS (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN {_guid_sql('c_custkey')} WHEN 1 THEN concat('NATION_', c_nationkey)
      WHEN 2 THEN concat('nation_', c_nationkey) WHEN 3 THEN '' END AS capacity FROM customer)
    SELECT c_custkey, capacity, CASE WHEN c_custkey % 5 = 0 THEN capacity WHEN first IS NOT NULL THEN {_guid_sql('first')} END AS capacity_id,
      CASE WHEN c_custkey % 5 IN (1, 2) AND first IS NULL THEN concat('not found by display name: ''', capacity, '''') END AS capacity_id_error
    FROM specs LEFT JOIN directory ON capacity = name""")
def resolve_capacity_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, nation = F.col("c_custkey") % 5, F.col("c_nationkey").cast("string")
    specs = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(kind == 0, _guid(F.col("c_custkey"))).when(kind == 1, F.concat(F.lit("NATION_"), nation))
        .when(kind == 2, F.concat(F.lit("nation_"), nation)).when(kind == 3, F.lit("")).alias("capacity"),
    )
    directory = table(spark, sf_dir, "supplier").select(
        _guid(F.col("s_suppkey")).alias("id"),
        F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string")).alias("display_name"),
        F.col("s_suppkey").alias("ordinal"),
    )
    return resolve_ids(specs, directory, "capacity", "capacity_id", "ordinal")


_GROUPS = {"platform_admins": 3, "data_product_owners": 5, "data_engineers": 7, "data_viewers": 11}


def _group_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    group = lambda n: F.when(key % n == 1, F.lit("")).when(key % n != 0, F.concat(F.lit("g"), (key % n).cast("string")))
    return table(spark, sf_dir, "customer").select(key, *[group(n).alias(f"group_{k}") for k, n in _GROUPS.items()])


_ROLE_ROWS = "roles AS (" + " UNION ALL ".join(
    f"""SELECT c_custkey, '{k}' AS role_key, '{role}' AS desired_role,
      CASE WHEN c_custkey % {_GROUPS[k]} = 1 THEN '' WHEN c_custkey % {_GROUPS[k]} <> 0 THEN concat('g', c_custkey % {_GROUPS[k]}) END AS group_name
      FROM customer"""
    for k, role in [("platform_admins", "Admin"), ("data_product_owners", "Member"), ("data_engineers", "Contributor"), ("data_viewers", "Viewer")]
) + """), outcomes AS (SELECT *, CASE WHEN group_name IS NULL OR group_name = '' THEN concat('Missing group mapping for key ''', role_key, '''') END AS reason FROM roles)"""


@registered(f"WITH {_ROLE_ROWS} SELECT * FROM outcomes")
def explode_group_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_roles(_group_specs(spark, sf_dir), "c_custkey")


def _map_sql(value: str, condition: str) -> str:
    picks = ", ".join(f"max(CASE WHEN role_key = '{k}' AND {condition} THEN concat('{k}=', {value}) END)" for k in _GROUPS)
    return f"concat_ws(';', {picks})"


def _shown(c: str) -> F.Column:
    return F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")


@registered(f"""WITH {_ROLE_ROWS} SELECT c_custkey, {_map_sql("'id-' || group_name", 'reason IS NULL')} AS roles_assigned,
    {_map_sql('reason', 'reason IS NOT NULL')} AS roles_failed FROM outcomes GROUP BY c_custkey""")
def provision_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = explode_roles(_group_specs(spark, sf_dir), "c_custkey").withColumn(
        "principal_id", F.concat(F.lit("id-"), "group_name")
    )
    summary = provision_summary(outcomes, "c_custkey")
    return summary.withColumns({c: _shown(c) for c in ("roles_assigned", "roles_failed")})


# A loose id, a known name, an unknown name, and a name that is missing for every third workspace.
_LOOSE = "concat(md5(CAST({0} AS VARCHAR)), '----')"
_PROVISION = f"""WITH directory AS (SELECT concat('NATION_', s_nationkey) AS name, min(s_suppkey) AS first FROM supplier GROUP BY 1),
    roles AS (SELECT c_custkey, role_key, desired_role, CASE role_key WHEN 'platform_admins' THEN {_LOOSE.format('c_custkey')}
        WHEN 'data_product_owners' THEN concat('NATION_', c_nationkey) WHEN 'data_engineers' THEN concat('nation_', c_nationkey)
        WHEN 'data_viewers' THEN CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat('NATION_', (c_nationkey + 1) % 25) END END AS group_name
      FROM customer, (VALUES ('platform_admins', 'Admin'), ('data_product_owners', 'Member'), ('data_engineers', 'Contributor'), ('data_viewers', 'Viewer')) r(role_key, desired_role)),
    found AS (SELECT roles.*, CASE WHEN role_key = 'platform_admins' THEN group_name WHEN first IS NOT NULL THEN {_guid_sql('first')} END AS principal_id,
      CASE WHEN group_name = '' THEN concat('Missing group mapping for key ''', role_key, '''')
        WHEN role_key <> 'platform_admins' AND first IS NULL THEN concat('not found by display name: ''', group_name, '''') END AS reason
      FROM roles LEFT JOIN directory ON group_name = name),
    held AS (SELECT c_custkey AS ws, {_LOOSE.format('c_custkey')} AS principal, CASE WHEN c_custkey % 4 = 0 THEN 'Admin' ELSE 'Viewer' END AS current_role
      FROM customer WHERE c_custkey % 2 = 0),
    outcomes AS (SELECT c_custkey, role_key, desired_role, group_name, principal_id, reason, current_role, CASE WHEN reason IS NOT NULL THEN NULL
      WHEN current_role IS NULL THEN 'add' WHEN current_role = desired_role THEN 'unchanged' ELSE 'update' END AS action
      FROM found LEFT JOIN held ON c_custkey = ws AND principal_id = principal)"""


def _provisioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    loose = F.concat(F.md5(key.cast("string")), F.lit("----"))
    named = lambda prefix, n: F.concat(F.lit(prefix), n.cast("string"))
    customers = table(spark, sf_dir, "customer")
    specs = customers.select(
        key, loose.alias("group_platform_admins"), named("NATION_", nation).alias("group_data_product_owners"),
        named("nation_", nation).alias("group_data_engineers"),
        F.when(key % 3 == 0, F.lit("")).otherwise(named("NATION_", (nation + 1) % 25)).alias("group_data_viewers"),
    )
    groups = table(spark, sf_dir, "supplier").select(
        _guid(F.col("s_suppkey")).alias("id"), named("NATION_", F.col("s_nationkey")).alias("display_name"), F.col("s_suppkey").alias("ordinal")
    )
    current = customers.where(key % 2 == 0).select(
        key.alias("workspace_id"), loose.alias("principal_id"),
        F.when(key % 4 == 0, F.lit("Admin")).otherwise(F.lit("Viewer")).alias("role"), key.alias("ordinal"),
    )
    return provision(specs, groups, current, "c_custkey", "ordinal")


@registered(_PROVISION + " SELECT * FROM outcomes")
def provision_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _provisioned(spark, sf_dir)


@registered(_PROVISION + f""" SELECT c_custkey, {_map_sql('principal_id', 'reason IS NULL')} AS roles_assigned,
    {_map_sql('reason', 'reason IS NOT NULL')} AS roles_failed FROM outcomes GROUP BY c_custkey""")
def provision_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain; groups that cannot be resolved end in ``roles_failed``."""
    summary = provision_summary(_provisioned(spark, sf_dir), "c_custkey")
    return summary.withColumns({c: _shown(c) for c in ("roles_assigned", "roles_failed")})


_PRIORITY_ROLE = [("1-URGENT", "Admin"), ("2-HIGH", "Member"), ("3-MEDIUM", "Contributor")]
_LINE_ROLE = [(6, "Admin"), (4, "Member"), (2, "Contributor")]


_ORDER_ROLES = """WITH desired AS (SELECT o_custkey AS workspace_id, o_orderkey AS principal_id,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'Admin' WHEN '2-HIGH' THEN 'Member' WHEN '3-MEDIUM' THEN 'Contributor' ELSE 'Viewer' END AS desired_role
      FROM orders),
    held AS (SELECT o_custkey, l_orderkey, CASE WHEN l_linenumber >= 6 THEN 'Admin' WHEN l_linenumber >= 4 THEN 'Member'
      WHEN l_linenumber >= 2 THEN 'Contributor' ELSE 'Viewer' END AS current_role
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey * 10 + l_linenumber DESC) = 1)"""


def _order_roles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Desired and current roles."""
    orders = table(spark, sf_dir, "orders")
    role = F
    for priority, name in _PRIORITY_ROLE:
        role = role.when(F.col("o_orderpriority") == priority, F.lit(name))
    desired = orders.select(
        F.col("o_custkey").alias("workspace_id"), F.col("o_orderkey").alias("principal_id"),
        role.otherwise("Viewer").alias("desired_role"),
    )
    lines = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    current = lines.select(
        F.col("o_custkey").alias("workspace_id"), F.col("l_orderkey").alias("principal_id"),
        bucket("l_linenumber", _LINE_ROLE, "Viewer").alias("role"),
        (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("ordinal"),
    )
    return desired, current


@registered(_ORDER_ROLES + """ SELECT workspace_id, principal_id, desired_role, current_role,
      CASE WHEN current_role IS NULL THEN 'add' WHEN current_role = desired_role THEN 'unchanged' ELSE 'update' END AS action
    FROM desired LEFT JOIN held ON workspace_id = o_custkey AND principal_id = l_orderkey""")
def reconcile_order_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile_roles(*_order_roles(spark, sf_dir), "ordinal")

# Orders of one week that name one customer twice ask for several roles; what is held comes from the lines.
_WEEK_ROLES = """WITH desired AS (SELECT CAST(datediff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) // 7 AS INTEGER) AS workspace_id, o_custkey AS principal_id,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'Admin' WHEN '2-HIGH' THEN 'Member' WHEN '3-MEDIUM' THEN 'Contributor' ELSE 'Viewer' END AS desired_role
      FROM orders WHERE o_orderkey % 3 <> 0),
    held AS (SELECT CAST(datediff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) // 7 AS INTEGER) AS workspace_id, o_custkey AS principal_id,
      CASE WHEN o_orderkey % 2 = 0 THEN 'Admin' ELSE 'Viewer' END AS current_role FROM orders WHERE o_orderkey % 5 <> 0
      QUALIFY row_number() OVER (PARTITION BY workspace_id, principal_id ORDER BY o_orderkey DESC) = 1),
    asked AS (SELECT workspace_id, principal_id, list(DISTINCT desired_role ORDER BY desired_role) AS roles FROM desired GROUP BY ALL),
    moved AS (SELECT workspace_id, principal_id, current_role, array_to_string(roles, ',') AS desired_roles,
      CASE WHEN roles IS NULL THEN 'kept' WHEN len(roles) > 1 THEN 'conflict' WHEN current_role IS NULL THEN 'add'
        WHEN current_role = roles[1] THEN 'unchanged' ELSE 'update' END AS action, roles[1] AS single
      FROM asked FULL JOIN held USING (workspace_id, principal_id)),
    after AS (SELECT * EXCLUDE (single), CASE WHEN action IN ('add', 'update') THEN single ELSE current_role END AS next_role FROM moved)"""


def _week_roles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    week = F.floor(F.datediff(F.to_date("o_orderdate"), F.lit(date(1990, 1, 1))) / 7).cast("int").alias("workspace_id")
    who = F.col("o_custkey").alias("principal_id")
    role = F
    for priority, name in _PRIORITY_ROLE:
        role = role.when(F.col("o_orderpriority") == priority, F.lit(name))
    desired = orders.where("o_orderkey % 3 <> 0").select(week, who, role.otherwise("Viewer").alias("desired_role"))
    held = F.when(F.col("o_orderkey") % 2 == 0, "Admin").otherwise("Viewer").alias("role")
    return desired, orders.where("o_orderkey % 5 <> 0").select(week, who, held, F.col("o_orderkey").alias("ordinal"))


@registered(_WEEK_ROLES + " SELECT * FROM after")
def role_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = role_transition(*_week_roles(spark, sf_dir), "ordinal")
    return moved.withColumn("desired_roles", F.array_join("desired_roles", ","))


@registered(_WEEK_ROLES + """ SELECT workspace_id, principal_id, next_role AS role,
      CASE WHEN roles IS NULL THEN 'kept' WHEN len(roles) > 1 THEN 'conflict' ELSE 'unchanged' END AS action_again
    FROM after LEFT JOIN asked USING (workspace_id, principal_id) WHERE next_role IS NOT NULL""")
def roles_after_transition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next state, with what a second run would do to each of its rows."""
    desired, current = _week_roles(spark, sf_dir)
    after = next_roles(role_transition(desired, current, "ordinal"))
    again = role_transition(desired, after.withColumn("ordinal", F.lit(0)), "ordinal").where("current_role is not null")
    return again.select("workspace_id", "principal_id", F.col("next_role").alias("role"), F.col("action").alias("action_again"))


_CUSTOMER_WORKSPACES = """WITH desired AS (SELECT c_name AS name, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END AS description,
      CASE WHEN c_custkey % 6 <> 0 THEN concat('cap-', c_nationkey) END AS capacity_id, CASE WHEN c_custkey % 7 <> 0 THEN concat('dom-', c_nationkey % 3) END AS domain_id
      FROM customer),
    current AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN concat('other-', c_name) ELSE c_name END AS display_name,
      CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'MACHINERY' END AS description,
      CASE WHEN c_custkey % 10 = 1 THEN NULL ELSE concat('cap-', c_nationkey % 5) END AS capacity_id, 'dom-1' AS domain_id FROM customer)"""


def _customer_workspaces(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Desired and current workspaces."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    named = lambda prefix, x: F.concat(F.lit(prefix), x.cast("string"))
    customers = table(spark, sf_dir, "customer")
    desired = customers.select(
        F.col("c_name").alias("name"),
        F.when(key % 4 == 0, F.lit("")).otherwise(F.col("c_mktsegment")).alias("description"),
        F.when(key % 6 != 0, named("cap-", nation)).alias("capacity_id"),
        F.when(key % 7 != 0, named("dom-", nation % 3)).alias("domain_id"),
    )
    current = customers.select(
        key.alias("id"),
        F.when(key % 3 == 0, F.concat(F.lit("other-"), "c_name")).otherwise(F.col("c_name")).alias("display_name"),
        F.when(key % 5 != 0, F.lit("MACHINERY")).alias("description"),
        F.when(key % 10 != 1, named("cap-", nation % 5)).alias("capacity_id"),
        F.lit("dom-1").alias("domain_id"),
    )
    return desired, current


@registered(_CUSTOMER_WORKSPACES + """ SELECT name, d.description, d.capacity_id, d.domain_id, c_custkey AS workspace_id,
      CASE WHEN c_custkey IS NULL THEN 'create' WHEN d.description <> '' AND d.description IS DISTINCT FROM c.description THEN 'update' ELSE 'unchanged' END AS workspace_action,
      CASE WHEN d.capacity_id IS NULL THEN NULL WHEN c_custkey IS NULL THEN 'set_at_creation' WHEN d.capacity_id = c.capacity_id THEN 'unchanged' ELSE 'assign' END AS capacity_action,
      CASE WHEN d.domain_id IS NULL THEN NULL WHEN c_custkey IS NULL THEN 'assign' WHEN d.domain_id = c.domain_id THEN 'unchanged' ELSE 'assign' END AS domain_action
    FROM desired d LEFT JOIN current c ON name = display_name""")
def reconcile_customer_workspaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile_workspaces(*_customer_workspaces(spark, sf_dir), ordinal="id")

@registered(_CUSTOMER_WORKSPACES + """, twice AS (SELECT * FROM desired UNION ALL SELECT name, concat(description, '!'), capacity_id, domain_id FROM desired WHERE name LIKE '%7'),
    wanted AS (SELECT name, any_value(nullif(description, '')) AS description, any_value(capacity_id) AS capacity_id, any_value(domain_id) AS domain_id
      FROM twice GROUP BY name HAVING count(*) = 1)
    SELECT CAST(c.c_custkey AS VARCHAR) AS id, c.display_name, coalesce(w.description, c.description) AS description,
      coalesce(w.capacity_id, c.capacity_id) AS capacity_id, coalesce(w.domain_id, c.domain_id) AS domain_id,
      CASE WHEN w.description IS DISTINCT FROM c.description AND w.description IS NOT NULL OR w.capacity_id IS DISTINCT FROM c.capacity_id AND w.capacity_id IS NOT NULL
        OR w.domain_id IS DISTINCT FROM c.domain_id AND w.domain_id IS NOT NULL THEN 'changed' ELSE 'kept' END AS action, NULL::BIGINT AS specs
    FROM current c LEFT JOIN wanted w ON display_name = name
    UNION ALL SELECT regexp_replace(md5(name), '^(.{8})(.{4})(.{4})(.{4})', '\\1-\\2-\\3-\\4-'), name, w.description, w.capacity_id, w.domain_id, 'created', NULL
    FROM wanted w LEFT JOIN current ON display_name = name WHERE c_custkey IS NULL
    UNION ALL SELECT NULL, name, NULL, NULL, NULL, 'conflict', count(*) FROM twice GROUP BY name HAVING count(*) > 1""")
def workspaces_after_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next state; names that are asked for in two ways are listed beside it."""
    desired, current = _customer_workspaces(spark, sf_dir)
    desired = desired.unionByName(desired.where("name like '%7'").withColumn("description", F.concat("description", F.lit("!"))))
    current = current.withColumn("id", F.col("id").cast("string"))
    after = next_workspaces(desired, current, "id").withColumn("specs", F.lit(None).cast("bigint"))
    none = F.lit(None).cast("string")
    clashes = name_conflicts(desired).select(
        none.alias("id"), F.col("name").alias("display_name"), *[none.alias(c) for c in ("description", "capacity_id", "domain_id")],
        F.lit("conflict").alias("action"), "specs",
    )
    return after.unionByName(clashes)


@registered("""SELECT doc_id, concat_ws(';', CASE WHEN name IS NULL THEN 'name is required' END, CASE WHEN length(name) < 3 THEN 'name shorter than 3' END,
      CASE WHEN length(name) > 128 THEN 'name longer than 128' END, CASE WHEN length(text) > 1024 THEN 'description longer than 1024' END,
      CASE WHEN doc_id % 9 = 0 THEN 'group_data_engineers is required' END) AS violations
    FROM (SELECT doc_id, text, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE substr(source, 1, 2) || repeat('x', CAST(n_chars % 150 AS INTEGER)) END AS name FROM documents)""")
def validate_document_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("doc_id")
    name = F.concat(F.substring("source", 1, 2), F.repeat(F.lit("x"), (F.col("n_chars") % 150).cast("int")))
    specs = table(spark, sf_dir, "documents").select(
        key, F.when(key % 11 != 0, name).alias("name"), F.col("text").alias("description"),
        *[F.lit("g").alias(f"group_{k}") for k in _GROUPS if k != "data_engineers"],
        F.when(key % 9 != 0, F.lit("g")).alias("group_data_engineers"),
    )
    return validate_specs(specs).select("doc_id", F.array_join("violations", ";").alias("violations"))
