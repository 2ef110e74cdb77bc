"""Tables that change in one step, chunks that count once, runs that go on, and folders that go."""

from __future__ import annotations

import importlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from trilayer import files
from trilayer.config import GOLD, PASSTHROUGH_TABLES, RAW, RAW_TABLES, SILVER, LayerConfig
from trilayer.operators import expire_scratch, run_scope, settle
from trilayer.plans import refresh, runlog
from trilayer.plans.silver import CLEANSED
from trilayer.sources import storage, versions
from workload.adapters import raw_table

SF = "/root/testdata/sf0.001"
# The package has a function of the same name.
settling = importlib.import_module("trilayer.operators.settle")


def lakehouse(spark, tmp_path, database, **options):
    cfg = LayerConfig(root=str(tmp_path), database=database, **options)
    storage.create_database(spark, cfg)
    return cfg


@pytest.mark.parametrize("step", ["publish", "_point_name", "expire"])
def test_a_reader_between_the_steps_sees_all_old_or_all_new_rows(spark, tmp_path, monkeypatch, step):
    cfg = lakehouse(spark, tmp_path, f"between_{step.strip('_')}")
    storage.write_layer(spark.range(0, 50), cfg, SILVER, "t", audit=False)
    old, new = list(range(50)), list(range(100, 130))
    started = [storage.read_layer(spark, cfg, SILVER, "t"), storage.read_table(spark, cfg, SILVER, "t")]
    seen = []
    where = storage if step == "_point_name" else versions
    real = getattr(where, step)

    def look(*args, **kwargs):
        by_path = sorted(r.id for r in storage.read_layer(spark, cfg, SILVER, "t").collect())
        by_name = sorted(r.id for r in storage.read_table(spark, cfg, SILVER, "t").collect())
        seen.append((by_path, by_name))
        return real(*args, **kwargs)

    monkeypatch.setattr(where, step, look)
    storage.write_layer(spark.range(100, 130), cfg, SILVER, "t", audit=False)
    assert len(seen) == 1 and all(x in (old, new) for x in seen[0])
    # Who started before the refresh reads on.
    assert [sorted(r.id for r in df.collect()) for df in started] == [old, old]
    assert sorted(r.id for r in storage.read_layer(spark, cfg, SILVER, "t").collect()) == new
    assert sorted(r.id for r in storage.read_table(spark, cfg, SILVER, "t").collect()) == new


def test_a_write_that_stops_before_publishing_changes_nothing(spark, tmp_path, monkeypatch):
    cfg = lakehouse(spark, tmp_path, "stopped_db")
    storage.write_layer(spark.range(5), cfg, SILVER, "t", audit=False)

    def stop(*_):
        raise OSError("no more")

    with monkeypatch.context() as m:
        m.setattr(versions, "publish", stop)
        with pytest.raises(OSError):
            storage.write_layer(spark.range(9), cfg, SILVER, "t", audit=False)
    assert storage.read_layer(spark, cfg, SILVER, "t").count() == storage.read_table(spark, cfg, SILVER, "t").count() == 5
    # What it left goes when it is old enough.
    path = cfg.path(SILVER, "t")
    data = lambda: [n for n in files.names(spark, path) if n.startswith("data-")]
    assert len(data()) == 2
    assert versions.expire(spark, path) == 0 and versions.expire(spark, path, abandoned_hours=0) == 1
    assert len(data()) == 1 and storage.read_layer(spark, cfg, SILVER, "t").count() == 5


def test_old_versions_go(spark, tmp_path):
    cfg = lakehouse(spark, tmp_path, "expire_db", keep_versions=3)
    for n in range(1, 6):
        storage.write_layer(spark.range(n), cfg, GOLD, "t")
    path = cfg.path(GOLD, "t")
    assert [n for n, _ in versions.versions(spark, path)] == [3, 4, 5]
    assert len([n for n in files.names(spark, path) if n.startswith("data-")]) == 3
    with pytest.raises(ValueError):
        versions.expire(spark, path, keep=0)


def test_columns_may_change(spark, tmp_path):
    cfg = lakehouse(spark, tmp_path, "columns_db")
    write = lambda df: storage.write_layer(df, cfg, SILVER, "t", audit=False)
    write(spark.range(2))
    for df in (spark.range(3).withColumn("x", F.lit("a")), spark.range(4).select(F.lit(1).alias("y"), "id"), spark.range(5).select(F.col("id").cast("string"))):
        write(df)
        stored = storage.read_table(spark, cfg, SILVER, "t")
        assert stored.columns == df.columns and rows(stored) == rows(df) == rows(storage.read_layer(spark, cfg, SILVER, "t"))


def test_registered_names_follow_versions(spark, tmp_path):
    cfg = lakehouse(spark, tmp_path, "follow_db")
    storage.write_layer(spark.range(3), cfg, GOLD, "a", audit=False)
    folder = versions.new_folder(cfg.path(GOLD, "a"))
    spark.range(7).write.parquet(folder)
    versions.publish(spark, cfg.path(GOLD, "a"), folder)
    assert storage.read_table(spark, cfg, GOLD, "a").count() == 3
    assert storage.register(spark, cfg, GOLD, ["a"], refresh=True).first().status == "refreshed"
    assert storage.read_table(spark, cfg, GOLD, "a").count() == 7


def test_a_catalog_that_fails_is_reported(spark, tmp_path, monkeypatch):
    cfg = lakehouse(spark, tmp_path, "listing_db")

    def fails(*_):
        raise RuntimeError("catalog is down")

    monkeypatch.setattr(storage, "list_registered", fails)
    got = storage.register(spark, cfg, GOLD, ["a", "b"]).collect()
    assert [(r.status, r.error) for r in got] == [("error", "catalog is down")] * 2


def test_chunks_count_once(spark, tmp_path):
    path = f"{tmp_path}/t"
    part = lambda i: spark.range(i * 1000, i * 1000 + 1000, numPartitions=1)
    assert [versions.append_chunk(part(i), path, f"c{i}", rows_per_file=300) for i in (0, 1, 1, 2, 0)] == [True, True, False, True, False]
    assert sorted(r.id for r in storage.read_files(spark, path).collect()) == list(range(3000))
    sizes = [spark.read.parquet(str(f)).count() for f in (tmp_path / "t").rglob("*.parquet")]
    assert max(sizes) == 300 and len(sizes) == 12
    # Two writers of one chunk: both folders are complete, one counts.
    folder = versions.new_folder(path)
    part(1).write.parquet(folder)
    files.put_empty(spark, f"{path}/_chunks/c1@{folder.rsplit('/', 1)[-1]}")
    assert storage.read_files(spark, path).count() == 3000
    for bad in ("", "a/b", "a@b"):
        with pytest.raises(ValueError):
            versions.append_chunk(part(0), path, bad)


def test_a_chunk_that_fails_shows_nothing(spark, tmp_path):
    path = f"{tmp_path}/t"
    versions.append_chunk(spark.range(10), path, "a")
    broken = spark.range(1000, numPartitions=4).withColumn("id", F.when(F.col("id") < 900, F.col("id")).otherwise(F.raise_error(F.lit("no more"))))
    with pytest.raises(Exception, match="no more"):
        versions.append_chunk(broken, path, "b")
    assert storage.read_files(spark, path).count() == 10
    assert versions.append_chunk(spark.range(5), path, "b") and storage.read_files(spark, path).count() == 15


def test_a_scope_takes_its_folders_along(spark, tmp_path, monkeypatch):
    # A shared folder of its own, since folders of other tests must not go.
    monkeypatch.setattr(settling, "checkpoint_root", lambda _: str(tmp_path))
    held = lambda: files.names(spark, str(tmp_path))
    settle(spark.range(1))
    (tmp_path / "not-ours").mkdir()
    before = held()
    with run_scope(spark):
        assert settle(spark.range(4)).count() == 4
        with run_scope(spark):
            settle(spark.range(2))
        assert len(held()) == len(before) + 1
    assert held() == before
    with pytest.raises(ValueError):
        with run_scope(spark):
            settle(spark.range(1))
            raise ValueError
    assert held() == before
    settle(spark.range(1))
    assert expire_scratch(spark, hours=1) == 0 and len(held()) == 3
    assert expire_scratch(spark, hours=0) == 2 and held() == ["not-ours"]


def landed(spark, folder):
    for t in RAW_TABLES:
        storage.write_files(raw_table(spark, SF, t) if t in CLEANSED else spark.range(3).withColumnRenamed("id", f"{t}_sk"), f"{folder}/{t}")


def test_a_run_that_fails_halfway_goes_on(spark, tmp_path):
    cfg = lakehouse(spark, tmp_path, "halfway_db")
    landing = f"{tmp_path}/landing"
    landed(spark, landing)
    # One table lands with a column missing, so its cleansing fails.
    storage.write_files(raw_table(spark, SF, "item").drop("i_brand"), f"{landing}/item")
    scratch = files.names(spark, settling.checkpoint_root(spark))
    with pytest.raises(RuntimeError, match="item"):
        refresh.run(spark, cfg, landing, "r1")
    stands = {(r.layer, r.table): r for r in runlog.RunLog(spark, cfg, "r1").statuses().collect()}
    assert stands[SILVER, "item"].status == "error" and stands[SILVER, "customer"].status == "ok" and (GOLD, "sales_fact") not in stands
    # Mended in raw: the table has to land and to be cleansed again, nothing else.
    storage.write_layer(raw_table(spark, SF, "item"), cfg, RAW, "item", audit=False)
    again = {(r.layer, r.table): r for r in refresh.run(spark, cfg, landing, "r1").collect()}
    assert {r.status for r in again.values()} == {"ok"} and len(again) == 24 + 24 + 3
    assert {k for k, r in again.items() if r.attempts > 1} == {(SILVER, "item")}
    numbers = {t: [n for n, _ in versions.versions(spark, cfg.path(SILVER, t))] for t in (*CLEANSED, *PASSTHROUGH_TABLES)}
    assert set(map(tuple, numbers.values())) == {(1,)}
    # A third call has nothing left to do; another run does all of it.
    refresh.run(spark, cfg, landing, "r1")
    assert runlog.entries(spark, cfg).where("run_id = 'r1'").count() == len(again) + 1
    assert [n for n, _ in versions.versions(spark, cfg.path(GOLD, "sales_fact"))] == [1]
    assert files.names(spark, settling.checkpoint_root(spark)) == scratch


def test_a_folder_with_a_quote(spark, tmp_path):
    (tmp_path / "it's").mkdir()
    cfg = lakehouse(spark, tmp_path / "it's", "quote_db")
    for n in (2, 5):
        storage.write_layer(spark.range(n), cfg, SILVER, "t", audit=False)
        assert storage.read_table(spark, cfg, SILVER, "t").count() == storage.read_layer(spark, cfg, SILVER, "t").count() == n
