"""Session settings the plans rely on, and steps run side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")

# Hot keys: Spark splits a shuffle partition that is far larger than the others. The last
# setting lets it do so also where the join's partitioning is used again, at the price of one
# more shuffle, and only when it finds such a partition.
SKEW_SAFE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Orders lie in buckets of their key alone; with it, joins and sums by order and product use them.
BUCKETED = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}

# What a task sorts or adds up grows with the shuffled bytes it takes: fewer for each, more tasks.
SMALL_TASKS = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}

# A time with a zone offset falls on its day in UTC, whatever the session's zone.
RUN = {**SKEW_SAFE, **BUCKETED, **SMALL_TASKS, "spark.sql.session.timeZone": "UTC"}


@contextmanager
def during(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """The settings for a while; what they were before comes back."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def together(steps: dict[str, Callable[[], T]]) -> dict[str, T]:
    """Runs independent steps at the same time, so that one's last tasks leave no core idle."""
    session = SparkSession.active()
    with ThreadPoolExecutor(len(steps)) as pool:
        started = {name: pool.submit(inheritable_thread_target(session)(step)) for name, step in steps.items()}
    return {name: step.result() for name, step in started.items()}
