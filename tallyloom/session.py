"""Session settings the jobs are written for. All are public Spark settings."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import copy_context
from typing import TypeVar

from pyspark.sql import SparkSession

_Name = TypeVar("_Name")
_Result = TypeVar("_Result")

SETTINGS = {
    # Adaptive execution sizes shuffle partitions, switches to broadcast joins
    # by measured size and splits skewed partitions of joins and rebalances.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Shuffles start with so many partitions and are merged by size; they never
    # grow in number. At 100 TB take the shuffled bytes divided by 128 MB.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000",
    # dt is text and stays text when partitions are discovered from paths.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    app: str = "tallyloom", master: str | None = None, **extra: str
) -> SparkSession:
    """Session with the settings above; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def scoped(spark: SparkSession, settings: dict[str, object]) -> Iterator[None]:
    """Runtime settings for the actions inside the block, restored afterwards."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def together(action: Callable[[_Name], _Result], names: Iterable[_Name]) -> dict[_Name, _Result]:
    """Run independent jobs at the same time; those of one session share its executors."""
    names = list(names)
    contexts = [copy_context() for _ in names]  # threads know the open scratch scope
    with ThreadPoolExecutor(max(1, len(names))) as pool:
        return dict(zip(names, pool.map(lambda own, name: own.run(action, name), contexts, names)))
