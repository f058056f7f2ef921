"""Sources and sinks beyond those Spark brings."""

from __future__ import annotations

from pyspark.sql import SparkSession


def register(spark: SparkSession) -> None:
    """Makes format("tidelog_binlog") and format("tidelog_queue") known to a session, whoever built it, with the setting that
    lets their filters be pushed down, and sends this package to the executors."""
    from tidelog.session import ship
    from tidelog.sources.binlog import BinlogSource
    from tidelog.sources.queue import QueueSource

    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BinlogSource)
    spark.dataSource.register(QueueSource)
