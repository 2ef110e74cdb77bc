from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from trilayer.config import GOLD, GOLD_TABLES, PASSTHROUGH_TABLES, RAW, RAW_TABLES, SILVER, LayerConfig
from trilayer.plans import refresh, reports
from trilayer.plans.silver import SILVER_TABLES
from trilayer.sources import storage
from trilayer.plans.silver import CLEANSED
from workload.adapters import raw_table

SF = "/root/testdata/sf0.001"


def lakehouse(tmp_path, database):
    return LayerConfig(root=str(tmp_path), database=database)


def statuses(ledger):
    return {r.table: r.status for r in ledger.collect()}


def test_paths(tmp_path):
    cfg = LayerConfig(root="/data/")
    assert cfg.path(RAW, "item") == "/data/raw/item"
    assert cfg.path(SILVER, "item") == "/data/silver/silver_item"
    assert cfg.qualified(GOLD, "sales_fact") == "retail.gold_sales_fact"
    with pytest.raises(ValueError, match="Unknown layer: bronze"):
        cfg.path("bronze", "item")


def test_files_are_found_recursively_without_partition_columns(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/t/day=1")
    spark.range(2).write.parquet(f"{tmp_path}/t/day=2/part=x")
    spark.range(4).coalesce(1).write.parquet(f"{tmp_path}/other")
    # A file need not be named as one.
    next((tmp_path / "other").glob("*.parquet")).rename(tmp_path / "t" / "rows-without-suffix")
    df = storage.read_files(spark, f"{tmp_path}/t")
    assert (df.columns, df.count()) == (["id"], 9)


def test_ingest_skips_what_is_not_there_and_goes_on(spark, tmp_path):
    cfg = lakehouse(tmp_path, "ingest_db")
    storage.write_files(spark.range(4), f"{tmp_path}/landing/item")
    (tmp_path / "landing" / "store").mkdir()
    (tmp_path / "landing" / "reason").mkdir()
    (tmp_path / "landing" / "reason" / "bad.parquet").write_text("not parquet")
    got = {r.table: (r.status, r.rows) for r in refresh.ingest(spark, cfg, f"{tmp_path}/landing", ("item", "store", "reason", "promotion")).collect()}
    assert got["item"] == ("ok", 4) and got["store"] == ("skipped", 0) and got["promotion"] == ("skipped", 0)
    assert got["reason"][0] == "error"


def test_write_replaces_counts_and_stamps(spark, tmp_path):
    cfg = lakehouse(tmp_path, "write_db")
    storage.create_database(spark, cfg)
    assert storage.write_layer(spark.range(5), cfg, SILVER, "t") == 5
    assert storage.write_layer(spark.range(3).withColumn("x", F.lit(1)), cfg, SILVER, "t") == 3
    stored = storage.read_table(spark, cfg, SILVER, "t")
    assert stored.columns == ["id", "x", "_silver_processed_at", "_source_layer"] and stored.count() == 3
    assert storage.read_layer(spark, cfg, SILVER, "t").count() == 3
    assert storage.drop_audit(stored).columns == ["id", "x"]
    assert storage.write_layer(spark.range(0), cfg, SILVER, "empty") == 0


def test_register(spark, tmp_path):
    cfg = lakehouse(tmp_path, "register_db")
    spark.range(3).write.parquet(cfg.path(GOLD, "a"))
    spark.range(1).createOrReplaceTempView("gold_a")  # a session's view is not a registered table
    assert storage.list_registered(spark, cfg) == {}
    assert statuses(storage.register(spark, cfg, GOLD, ["a", "missing"])) == {"a": "created", "missing": "error"}
    assert statuses(storage.register(spark, cfg, GOLD, ["a"])) == {"a": "skipped"}
    assert statuses(storage.register(spark, cfg, GOLD, ["a"], refresh=True)) == {"a": "refreshed"}
    assert storage.list_registered(spark, cfg) == {"gold_a": "register_db.gold_a"}
    assert storage.read_table(spark, cfg, GOLD, "a").count() == 3
    spark.catalog.dropTempView("gold_a")


def test_preflight_names_every_unreadable_input(spark, tmp_path):
    cfg = lakehouse(tmp_path, "preflight_db")
    spark.range(1).write.parquet(cfg.path(RAW, "item"))
    storage.preflight(spark, cfg, RAW, ["item"])
    with pytest.raises(RuntimeError, match="cannot read 2 raw table"):
        storage.preflight(spark, cfg, RAW, ["item", "store", "reason"])


def test_all_layers_from_files_to_gold(spark, tmp_path):
    cfg = lakehouse(tmp_path, "full_db")
    landing = f"{tmp_path}/landing"
    for t in RAW_TABLES:
        # In nested folders, as they land; tables that are passed through need no particular columns.
        df = raw_table(spark, SF, t) if t in CLEANSED else spark.range(3).withColumnRenamed("id", f"{t}_sk")
        storage.write_files(df, f"{landing}/{t}/day=1/part=x")
    raw = refresh.ingest(spark, cfg, landing)
    assert set(statuses(raw).values()) == {"ok"} and raw.count() == 24
    silver = refresh.refresh_silver(spark, cfg)
    assert sorted(statuses(silver)) == sorted(SILVER_TABLES) and set(statuses(silver).values()) == {"ok"}
    gold = refresh.refresh_gold(spark, cfg)
    counts = {r.table: r.rows for r in gold.collect()}
    assert set(counts) == set(GOLD_TABLES)

    # One row for each cleansed sales line.
    lines = sum(storage.read_layer(spark, cfg, SILVER, t).count() for t in CLEANSED if t.endswith("sales"))
    fact = storage.read_layer(spark, cfg, GOLD, "sales_fact")
    assert counts["sales_fact"] == fact.count() == lines
    assert len(storage.drop_audit(fact).columns) == 43
    totals = fact.agg(F.sum("net_sales_amt"), F.sum("gross_sales_amt"), F.sum("return_amt")).first()
    assert totals[0] == totals[1] - totals[2]
    shares = storage.read_layer(spark, cfg, GOLD, "product_performance").agg(F.sum("revenue_pct_of_total")).first()[0]
    assert abs(float(shares) - 100) < 1
    done = {r.layer: r.done for r in reports.run_status_rollup(raw.unionByName(silver).unionByName(gold)).collect()}
    assert done == {"raw": 24, "silver": 24, "gold": 3}

    # A second run gives the same data.
    before = {t: rows(storage.drop_audit(storage.read_layer(spark, cfg, GOLD, t))) for t in GOLD_TABLES[1:]}
    refresh.refresh_silver(spark, cfg)
    refresh.refresh_gold(spark, cfg)
    for t, wanted in before.items():
        assert rows(storage.drop_audit(storage.read_layer(spark, cfg, GOLD, t))) == wanted


def test_passthrough_reports_a_missing_table_and_goes_on(spark, tmp_path):
    cfg = lakehouse(tmp_path, "pass_db")
    storage.create_database(spark, cfg)
    storage.write_layer(spark.range(2), cfg, RAW, "reason", audit=False)
    got = statuses(refresh.passthrough(spark, cfg, ("store", "reason")))
    assert got == {"store": "error", "reason": "ok"}
    assert "time_dim" in PASSTHROUGH_TABLES


def test_the_table_format_is_a_setting(spark, tmp_path):
    cfg = LayerConfig(root=str(tmp_path), database="orc_db", table_format="orc")
    storage.create_database(spark, cfg)
    assert storage.write_layer(spark.range(4), cfg, GOLD, "t") == 4
    assert storage.read_layer(spark, cfg, GOLD, "t").count() == 4
    assert list((tmp_path / "gold" / "gold_t").rglob("*.orc"))


def test_failed_write_leaves_the_old_table(spark, tmp_path):
    cfg = lakehouse(tmp_path, "replace_db")
    storage.create_database(spark, cfg)
    storage.write_layer(spark.range(5), cfg, SILVER, "t")
    broken = spark.range(100, numPartitions=4).withColumn("id", F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("no more"))))
    with pytest.raises(Exception, match="no more"):
        storage.write_layer(broken, cfg, SILVER, "t")
    assert storage.read_table(spark, cfg, SILVER, "t").count() == 5
    assert storage.read_layer(spark, cfg, SILVER, "t").count() == 5
    assert [p.name for p in (tmp_path / "silver").iterdir()] == ["silver_t"]


def test_a_table_can_be_replaced_by_what_is_read_from_it(spark, tmp_path):
    cfg = lakehouse(tmp_path, "self_db")
    storage.create_database(spark, cfg)
    storage.write_layer(spark.range(5), cfg, SILVER, "t", audit=False)
    assert storage.write_layer(storage.read_layer(spark, cfg, SILVER, "t").where("id > 1"), cfg, SILVER, "t", audit=False) == 3
    assert storage.read_table(spark, cfg, SILVER, "t").count() == 3


def test_tables_are_packed_as_the_settings_say(spark, tmp_path):
    for compression in ("zstd", "gzip"):
        cfg = LayerConfig(root=str(tmp_path / compression), database=f"packed_{compression}", compression=compression)
        storage.create_database(spark, cfg)
        storage.write_layer(spark.range(10), cfg, "gold", "numbers")
        short = {"zstd": ".zstd.parquet", "gzip": ".gz.parquet"}[compression]
        assert all(f.endswith(short) for f in storage.read_layer(spark, cfg, "gold", "numbers").inputFiles())


def test_a_lakehouse_of_a_query_keeps_only_what_its_report_reads(spark):
    from pathlib import Path

    from trilayer.operators import run_scope
    from workload.operators import QUERIES

    with run_scope(spark) as folder:
        assert QUERIES["lakehouse_channel_report"](spark, "/root/testdata/sf0.001").count() == 3
        root = Path(folder.removeprefix("file:"))
        left = {f.relative_to(root).parts[1] for f in root.glob("lakehouse-*/**/*.parquet")}
    assert left == {"gold"}


def test_a_table_written_in_parts_is_one_table(spark, tmp_path):
    cfg = lakehouse(tmp_path, "parts_db")
    storage.create_database(spark, cfg)
    df = spark.range(10).withColumn("channel", F.when(F.col("id") < 3, "A").otherwise("B"))
    assert storage.write_layer(df, cfg, GOLD, "t", parts=[F.col("channel") == c for c in ("A", "B", "C")]) == 10
    got = storage.read_layer(spark, cfg, GOLD, "t")
    assert sorted(r.id for r in got.collect()) == list(range(10))
    assert got.select("_gold_processed_at").distinct().count() == 1 and storage.read_table(spark, cfg, GOLD, "t").count() == 10


def test_a_lakehouse_of_a_query_leaves_no_shuffle_files_of_its_layers(spark, settings):
    """What a layer's write shuffled is gone when the next begins, and sales are gone when the customers are described."""
    from trilayer.operators import run_scope
    from workload.operators import QUERIES

    settings(**{"spark__sql__autoBroadcastJoinThreshold": "-1"})
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {b for b in disk.getAllBlocks().mkString(" ").split() if b.startswith("shuffle_")}
    before, seen, write_layer = shuffled(), {}, refresh.write_layer

    def watched(df, cfg, layer, table, *a, **b):
        silver = {f.name for f in Path(cfg.root.removeprefix("file:")).glob("silver/*")}
        seen[layer, table] = (shuffled() - before, silver)
        return write_layer(df, cfg, layer, table, *a, **b)

    with run_scope(spark), pytest.MonkeyPatch.context() as patch:
        patch.setattr(refresh, "write_layer", watched)
        QUERIES["lakehouse_channel_report"](spark, "/root/testdata/sf0.001")
    assert not seen[GOLD, "sales_fact"][0] and not seen[GOLD, "customer_360"][0]
    assert "silver_store_sales" in seen[GOLD, "sales_fact"][1] and "silver_store_sales" not in seen[GOLD, "customer_360"][1]
