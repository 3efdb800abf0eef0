"""Session options for a while."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


@contextmanager
def with_conf(spark: SparkSession, conf: dict | None = None, unset: tuple[str, ...] = ()) -> Iterator[SparkSession]:
    """Set and unset session options, and put the old values back afterwards."""
    conf = conf or {}
    before = {key: spark.conf.get(key, None) for key in [*conf, *unset]}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        for key in unset:
            spark.conf.unset(key)
        yield spark
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
