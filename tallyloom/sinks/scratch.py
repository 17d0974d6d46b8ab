"""Intermediate results that are read more than once.

They are written as Parquet to the shared folder of ``spark.checkpoint.dir``
and read back, which cuts the lineage, survives the loss of executors and lets
later scans read single columns.

What is written belongs to the innermost open scope and goes when that is closed.
Without a scope it stays, since only the caller knows when a result has been read.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from tallyloom.sinks.orc import orc_options


def scratch_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(
            "spark.checkpoint.dir is not set: name a folder that all executors share"
        )
    return _local_scratch_dir()


@cache
def _local_scratch_dir() -> str:
    return tempfile.mkdtemp(prefix="tallyloom-")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that it holds, in whatever file system it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@dataclass
class Scope:
    """Owner of scratch folders and of databases that were made for the time being."""

    spark: SparkSession
    paths: list[str] = field(default_factory=list)
    databases: list[str] = field(default_factory=list)

    def close(self) -> None:
        """Drop and delete all of it; results that read from it can be read no more."""
        while self.databases:
            self.spark.sql(f"DROP DATABASE IF EXISTS `{self.databases.pop()}` CASCADE")
        while self.paths:
            remove_path(self.spark, self.paths.pop())


_owner: ContextVar[Scope | None] = ContextVar("owner", default=None)


@contextmanager
def owned_by(scope: Scope) -> Iterator[Scope]:
    """What is written inside the block belongs to the scope, which stays open."""
    before = _owner.set(scope)
    try:
        yield scope
    finally:
        _owner.reset(before)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Scope]:
    """What is written inside the block is deleted at its end: read the results inside."""
    with owned_by(Scope(spark)) as scope:
        try:
            yield scope
        finally:
            scope.close()


def new_scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{scratch_dir(spark)}/tallyloom/{name}-{uuid.uuid4().hex}"
    if scope := _owner.get():
        scope.paths.append(path)
    return path


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``options`` are those of the Parquet writer."""
    spark = df.sparkSession
    path = new_scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def work_database(spark: SparkSession, name: str) -> Iterator[str]:
    """A database for temporary tables, dropped with its files at the end."""
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")
    spark.sql(f"CREATE DATABASE `{name}` LOCATION '{new_scratch_path(spark, name)}'")
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


def temporary_table(df: DataFrame, database: str, name: str) -> DataFrame:
    """Store an intermediate result as a table of a work database."""
    df.write.format("orc").options(**orc_options(df)).mode("overwrite").saveAsTable(f"`{database}`.`{name}`")
    return df.sparkSession.table(f"`{database}`.`{name}`")
