"""Session defaults and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

from pyspark.sql import SparkSession


def build_session(app_name: str = "tripmill", master: str | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings every job here relies on; the cluster's own settings win."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


OPEN_FILES = 24
OPEN_FILES_KEY = "spark.sql.maxConcurrentOutputFileWriters"


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session zone: wire timestamps are read and written as UTC everywhere.

    A task that writes to few folders keeps a file open for each instead of sorting its rows by folder,
    which spills; rows of more than ``OPEN_FILES`` folders are sorted. A number that the session has wins.
    A stream's file sink reads it when a batch runs, so it is set for the session.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if int(spark.conf.get(OPEN_FILES_KEY)) == 0:
        spark.conf.set(OPEN_FILES_KEY, str(OPEN_FILES))
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for what starts inside; a stream copies the session when it starts."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Several of them at once."""
    with ExitStack() as held:
        for key, value in values.items():
            held.enter_context(setting(spark, key, value))
        yield


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one machine, may leave it unset; the work
    then goes beside the session's own tables. Whoever starts the session clears the folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/work"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that nothing has used yet; the writer creates it."""
    return f"{shared_root(spark)}/tripmill-{purpose}-{uuid.uuid4().hex}"
