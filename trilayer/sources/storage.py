"""Reading, writing and registering the tables of a lakehouse."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from trilayer import files
from trilayer.config import LayerConfig
from trilayer.sources import versions

LEDGER_SCHEMA = "layer string, table string, status string, rows long, error string"

# Error conditions Spark raises for a source that holds no data.
_NO_SOURCE = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


class NoSourceError(Exception):
    """The source folder is missing or holds no parquet file."""


# --- reading --------------------------------------------------------------------


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Every data file below ``path`` whatever its name; folder names are not taken as partition values.

    Of a folder written in versions or chunks, those that count.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    try:
        return reader.parquet(*versions.current(spark, path))
    except AnalysisException as e:
        if e.getCondition() in _NO_SOURCE:
            raise NoSourceError(path) from e
        raise


def read_table(spark: SparkSession, cfg: LayerConfig, layer: str, table: str) -> DataFrame:
    """By catalog name."""
    return spark.table(cfg.qualified(layer, table))


def read_layer(spark: SparkSession, cfg: LayerConfig, layer: str, table: str) -> DataFrame:
    """By storage path: the version that is the newest now, which no later refresh changes."""
    return spark.read.format(cfg.table_format).load(versions.current(spark, cfg.path(layer, table)))


def preflight(spark: SparkSession, cfg: LayerConfig, layer: str, tables: Iterable[str]) -> None:
    """Open every input before any work starts; reads schemas only, no data."""
    problems = []
    for table in tables:
        try:
            read_layer(spark, cfg, layer, table)
        except Exception as e:  # whatever the storage layer raises is the finding
            problems.append(f"{table}: {first_line(e)}")
    if problems:
        raise RuntimeError(f"cannot read {len(problems)} {layer} table(s): " + "; ".join(problems))


# --- writing --------------------------------------------------------------------


def create_database(spark: SparkSession, cfg: LayerConfig) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {cfg.database}")


def add_audit(df: DataFrame, layer: str, at: Column | None = None) -> DataFrame:
    return df.withColumns({
        f"_{layer}_processed_at": F.current_timestamp() if at is None else at,
        "_source_layer": F.lit(layer),
    })


def drop_audit(df: DataFrame) -> DataFrame:
    audit = [c for c in df.columns if c == "_source_layer" or (c.startswith("_") and c.endswith("_processed_at"))]
    return df.drop(*audit)


def write_layer(
    df: DataFrame, cfg: LayerConfig, layer: str, table: str, audit: bool = True, parts: Sequence[Column] = ()
) -> int:
    """Replace a table's rows, point its name at them and return the rows written.

    The rows are counted while they are written, so nothing is read back. They go to a folder of their own, which becomes the
    table for readers by path when its version is published, and for readers by name when the name is moved. Each is one step, so a reader started at
    any moment gets all old or all new rows, and a write that fails changes nothing. ``cfg.keep_versions`` versions stay.
    With ``parts``, conditions of which each row meets exactly one, the rows of one part after the other are written.
    """
    spark = df.sparkSession
    path = cfg.path(layer, table)
    folder = versions.new_folder(path)
    now = spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0] if audit and parts else None
    out = add_audit(df, layer, F.timestamp_micros(F.lit(now)) if parts else None) if audit else df
    written = []
    try:
        for rows in [out.where(part) for part in parts] or [out]:
            written.append(Observation())
            writer = rows.observe(written[-1], F.count(F.lit(1)).alias("rows")).write.format(cfg.table_format).mode("append")
            (writer.option("compression", cfg.compression) if cfg.compression else writer).save(folder)
    except Exception:
        files.delete(spark, folder)
        raise
    versions.publish(spark, path, folder)
    _point_name(spark, cfg, layer, table, folder)
    versions.expire(spark, path, cfg.keep_versions)
    return sum(w.get["rows"] for w in written)


def _columns(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def _point_name(spark: SparkSession, cfg: LayerConfig, layer: str, table: str, folder: str) -> None:
    """Let a catalog name, new or old, mean ``folder``.

    Of an existing name only the location changes, then columns that are new at the end are added. Other changes of the columns leave no
    choice but to drop the name and create it again.
    """
    name = cfg.qualified(layer, table)
    if spark.catalog.tableExists(name):
        old = _columns(spark.table(name).schema)
        new = _columns(spark.read.format(cfg.table_format).load(folder).schema)
        if new[: len(old)] == old:
            quoted = folder.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{quoted}'")
            if new[len(old) :]:
                added = ", ".join(f"`{c}` {t}" for c, t in new[len(old) :])
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added})")
            return
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=folder, source=cfg.table_format)


def write_files(df: DataFrame, path: str, rows_per_file: int = 0) -> None:
    """Plain snappy parquet, the form in which raw files land; ``rows_per_file`` bounds each file if given."""
    df.write.mode("overwrite").option("compression", "snappy").option("maxRecordsPerFile", rows_per_file).parquet(path)


# --- ledger --------------------------------------------------------------------


def ledger(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), LEDGER_SCHEMA)


def first_line(e: Exception) -> str:
    return str(e).strip().splitlines()[0] if str(e).strip() else type(e).__name__


# --- catalog ---------------------------------------------------------------------


def list_registered(spark: SparkSession, cfg: LayerConfig) -> dict[str, str]:
    """Registered name to qualified name; empty where there is no such database. A catalog that cannot be listed is an error."""
    if not spark.catalog.databaseExists(cfg.database):
        return {}
    tables = [t for t in spark.catalog.listTables(cfg.database) if not t.isTemporary]
    return {t.name: f"{cfg.database}.{t.name}" for t in tables}


def register(
    spark: SparkSession, cfg: LayerConfig, layer: str, tables: Iterable[str], refresh: bool = False
) -> DataFrame:
    """Point catalog names at existing storage; only metadata is written. Returns the ledger.

    A name that exists is skipped, or moved to the newest version with ``refresh``.
    """
    tables = list(tables)
    try:
        create_database(spark, cfg)
        existing = list_registered(spark, cfg)
    except Exception as e:  # without the catalog nothing is known about any table
        return ledger(spark, [(layer, table, "error", None, first_line(e)) for table in tables])
    rows = []
    for table in tables:
        known = cfg.name(layer, table) in existing
        if known and not refresh:
            rows.append((layer, table, "skipped", None, None))
            continue
        try:
            read_layer(spark, cfg, layer, table)  # an unreadable location is an error, not an empty table
            _point_name(spark, cfg, layer, table, versions.current(spark, cfg.path(layer, table))[0])
            rows.append((layer, table, "refreshed" if known else "created", None, None))
        except Exception as e:  # recorded per table
            rows.append((layer, table, "error", None, first_line(e)))
    return ledger(spark, rows)
