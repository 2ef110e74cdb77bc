"""Cut lineage by writing a result to the cluster's shared checkpoint folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from trilayer import files

_SCOPE = "trilayer.run.folder"
#: Setting under which shuffle files go when the query that wrote them has ended, not when the driver happens to collect its garbage.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# What this library puts into the shared folder.
_OWN = ("run-", "settled-", "lakehouse-", "pipeline-")


@contextmanager
def session_settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    """These settings inside, the session's own afterwards."""
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def session_beside(spark: SparkSession, wanted: Mapping[str, str]) -> SparkSession:
    """A session with the settings of ``spark`` and these, for a result that is planned only when its reader asks for it."""
    beside = spark.newSession()
    for k, v in (dict(spark.conf.getAll) | wanted).items():
        if beside.conf.isModifiable(k):
            beside.conf.set(k, v)
    return beside


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where the setting is missing, a folder inside the warehouse is used: the warehouse is
    shared by driver and executors in every session, local or not.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_settled"


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new path in the shared folder, or in the folder of the run that this thread belongs to."""
    root = spark.sparkContext.getLocalProperty(_SCOPE) or checkpoint_root(spark)
    return f"{root}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def run_scope(spark: SparkSession) -> Iterator[str]:
    """The folder of one run. All that is settled inside goes there and is deleted at the end, also when the run fails.

    Results must be written or collected before the end: what still reads a settled table cannot outlive it. Threads
    started through ``inheritable_thread_target`` belong to the run of their parent; a run inside a run has a folder of its own.
    """
    context = spark.sparkContext
    outer, folder = context.getLocalProperty(_SCOPE), scratch_path(spark, "run")
    context.setLocalProperty(_SCOPE, folder)
    try:
        yield folder
    finally:
        context.setLocalProperty(_SCOPE, outer)
        files.delete(spark, folder)


def expire_scratch(spark: SparkSession, hours: float) -> int:
    """Delete what no scope owns or a killed driver left behind, once it has not changed for so long. Returns the number of folders.

    A folder's time is that of its own last entry, so ``hours`` must exceed the longest run.
    """
    root, gone = checkpoint_root(spark), 0
    for name in files.names(spark, root):
        if name.startswith(_OWN) and files.hours_since_change(spark, f"{root}/{name}") >= hours:
            files.delete(spark, f"{root}/{name}")
            gone += 1
    return gone


def settle(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet and return a scan of it.

    Later steps then re-read files instead of re-running the plan, which keeps
    results stable when an executor is lost, and the scan still prunes columns.
    Without ``compression`` the session's own setting stands.
    """
    path = scratch_path(df.sparkSession, "settled")
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*stored: DataFrame) -> None:
    """Delete settled tables that no later step reads."""
    for df in stored:
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            files.delete(df.sparkSession, folder)
