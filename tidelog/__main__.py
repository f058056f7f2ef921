"""python -m tidelog MODE --config settings.yaml …: the engine as a job.

run       applies binary log files to the tables under the settings' root, once or as they grow
queue     copies row and statement events from binary log files to a queue, and removes what is older than retention
optimize  compacts all tables, once or every optimize_seconds
monitor   prints how far the tables are and, with a log folder, how far the log is
read      prints a table, or what a query over tables named <database>_<table> gives, as JSON lines
"""

from __future__ import annotations

import argparse
import json
import signal
import sys
import time
from types import FrameType
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.config import Settings
from tidelog.session import session
from tidelog.sources import files, queue, register
from tidelog.sources.binlog import _Bounds, complete
from tidelog.streaming.replicate import Replica


def _arguments(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tidelog", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("mode", choices=["run", "queue", "optimize", "monitor", "read"])
    p.add_argument("--config", required=True, help="settings in YAML")
    p.add_argument("--log", help="folder of binary log files")
    p.add_argument("--table", help="database.table, for read")
    p.add_argument("--sql", help="query, for read")
    p.add_argument("--follow", action="store_true", help="go on until stopped")
    p.add_argument("--option", action="append", default=[], metavar="NAME=VALUE", help="option of the log source, such as startGtid=…")
    return p.parse_args(argv)


def _log(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    if not a.log:
        raise SystemExit("--log is missing")
    register(spark)
    return spark.readStream.format("tidelog_binlog").options(path=a.log, **dict(o.split("=", 1) for o in a.option)).load()


def to_queue(rows: DataFrame, root: str, rows_per_file: int) -> None:
    """Events of a binary log in the columns of a queue: rows as JSON lists of values, statements as their text."""
    kind = F.when(F.col("op") == "U", 1).when(F.col("op") == "D", 2).otherwise(3)
    image = F.coalesce("after", "before")
    values = F.to_json(F.array(F.map_values(F.from_json(image, "map<string,string>"))))
    events = rows.where(F.col("op").isNotNull()).select(
        "db_name", F.struct(F.concat(F.lit("bin."), F.col("file_no")).alias("file_name"), F.col("log_pos")).alias("transaction_id"), kind.alias("event_type"),
        "table_name", F.when(kind == 3, F.col("text")).otherwise(values).alias("records"), "file_no", "log_pos", "row_no",
    )
    ordered = events.repartitionByRange("file_no", "log_pos", "row_no").sortWithinPartitions("file_no", "log_pos", "row_no").drop("file_no", "log_pos", "row_no")
    ordered.write.format("tidelog_queue").options(path=root, rowsPerFile=rows_per_file).mode("append").save()


def _stream(a: argparse.Namespace, settings: Settings, rows: DataFrame, each: Any, name: str) -> None:
    writer = rows.writeStream.foreachBatch(each).option("checkpointLocation", files.joined(settings.root, "checkpoints", name))
    query = (writer.trigger(processingTime=f"{settings.flush_seconds} seconds") if a.follow else writer.trigger(availableNow=True)).start()

    def stop(_: int, __: FrameType | None) -> None:
        query.stop()  # the batch at hand ends or will be run again

    signal.signal(signal.SIGTERM, stop)
    query.awaitTermination()


def main(argv: list[str] | None = None) -> int:
    a = _arguments(sys.argv[1:] if argv is None else argv)
    with files.reading(a.config) as f:
        settings = Settings.load(f.read().decode())
    spark = session("tidelog")
    spark.sparkContext.setLogLevel(settings.log_level.upper().replace("WARNING", "WARN").replace("CRITICAL", "FATAL"))
    replica = Replica(spark, files.joined(settings.root, "tables"), settings)
    if a.mode == "run":
        _stream(a, settings, _log(spark, a), replica.apply, "run")
    elif a.mode == "queue":
        register(spark)
        root = files.joined(settings.root, "queue")

        def batch(rows: DataFrame, _: int) -> None:
            to_queue(rows, root, settings.rows_per_file)
            queue.remove_old(root, settings.retention_seconds)

        _stream(a, settings, _log(spark, a), batch, "queue")
    elif a.mode == "optimize":
        while True:
            for name in replica.optimize():
                print("compacted", ".".join(name))
            if not a.follow:
                break
            time.sleep(settings.optimize_seconds)
            replica = Replica(spark, replica.root, settings)
    elif a.mode == "monitor":
        report: dict[str, Any] = {"tables": len(replica.places), "applied": [replica.seen >> 32, replica.seen & 0xFFFFFFFF] if replica.seen >= 0 else None}
        if a.log and (listed := _Bounds(a.log).files()):
            number, path = listed[-1]
            report |= {"log": [number, complete(path)], "files_behind": number - (replica.seen >> 32 if replica.seen >= 0 else listed[0][0])}
        print(json.dumps(report))
    else:
        db, _, name = (a.table or "").partition(".")
        for row in (replica.sql(a.sql) if a.sql else replica.read(db, name)).toJSON().toLocalIterator():
            print(row)
    return 0


if __name__ == "__main__":
    sys.exit(main())
