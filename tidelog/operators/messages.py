"""Keeping one copy of each message that was delivered at least once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidelog.functions.names import file_number
from tidelog.session import bounded, kept
from tidelog.store.publish import Published

MESSAGE = ("source_id", "file_no", "log_pos")
#: Batches whose identifiers are put together.
COMPACTED = 32


def messages(log: DataFrame) -> DataFrame:
    """log with file_no and log_pos of its transaction_id; rows without a position are no message and are left out.

    A file_no or log_pos column that log has already is replaced.
    """
    return log.withColumns(
        {"file_no": file_number("transaction_id.file_name"), "log_pos": F.col("transaction_id.log_pos")}
    ).where("file_no IS NOT NULL AND log_pos IS NOT NULL")


def ranked_copies(df: DataFrame, key: Sequence[str], order: Sequence[Column], most: int, rank: str = "copy_no") -> DataFrame:
    """The first `most` copies of each message with their rank by `order`, ranks from 1.

    key identifies a message (null equals null). order must end in something unique, else ties fall by chance; rows
    equal in all of it are interchangeable. Spark cuts every group to `most` rows before the shuffle as well as after
    it (WindowGroupLimit), so a message with very many copies loads no single task. An empty input gives no row.
    """
    if rank in df.columns:
        raise ValueError(f"the input has a column {rank}; name the rank otherwise")
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= most)


def arrival(df: DataFrame) -> list[Column]:
    """Order of arrival: received_at, unknown times last, then delivery_no, which is unique."""
    return [F.col("received_at").asc_nulls_last(), F.col("delivery_no").asc_nulls_last()]


def first_copies(log: DataFrame) -> DataFrame:
    """Exactly one row per message, the first to arrive, with all columns of log besides file_no and log_pos."""
    return ranked_copies(messages(log), MESSAGE, arrival(log), 1).drop("copy_no")


def repeated_messages(log: DataFrame) -> DataFrame:
    """The messages with more than one row: source_id, file_no, log_pos, a row each."""
    slim = messages(log).select(*MESSAGE, "received_at", "delivery_no")
    return ranked_copies(slim, MESSAGE, arrival(slim), 2).where("copy_no = 2").select(*MESSAGE)


def append_new(batch: DataFrame, root: str) -> DataFrame:
    """Adds the messages of batch that the store at root doesn't hold yet; returns those added.

    The store keeps the identifiers seen so far, sorted, in a folder per batch, all named by its pointer, so a batch that
    is delivered or processed twice adds nothing the second time. A batch reads only identifiers of the file numbers it
    has itself (row groups of others are skipped by their ranges), and writes only its own; where its keys can be
    broadcast, the store isn't shuffled. After COMPACTED batches their identifiers are put together. Null source_ids are
    equal to each other.
    """
    spark = batch.sparkSession
    store = Published(spark, root)
    now, fresh = store.current(), first_copies(batch)
    parts, ids = (now["parts"], now["ids"]) if now else ([], [])
    version = store.stage()
    path = f"{store.root}/{version}"
    if ids:
        same = lambda a, b: [a[k].eqNullSafe(b[k]) for k in MESSAGE]
        fresh = kept(fresh, "first-copies")
        low, high = fresh.agg(F.min("file_no"), F.max("file_no")).first()
        seen = _ids(spark, store.root, ids).where(F.col("file_no").between(low, high))
        keys = bounded(fresh.select(*MESSAGE))
        met = seen.join(keys, same(seen, keys), "left_semi").select(*[F.col(k).alias(f"_{k}") for k in MESSAGE])
        fresh = fresh.join(met, [fresh[k].eqNullSafe(met[f"_{k}"]) for k in MESSAGE], "left_anti")
    fresh.write.parquet(f"{path}/rows")
    added = spark.read.schema(fresh.schema).parquet(f"{path}/rows")
    mine, together = added.select(*MESSAGE), len(ids) + 1 >= COMPACTED
    if together:
        mine = _ids(spark, store.root, ids).unionByName(mine)
    mine.repartitionByRange("file_no", "log_pos").sortWithinPartitions("file_no", "log_pos").write.parquet(f"{path}/ids")
    store.publish(version, parts=[*parts, version], ids=[version] if together else [*ids, version])
    return added


def _ids(spark: SparkSession, root: str, versions: Sequence[str]) -> DataFrame:
    return spark.read.schema("source_id string, file_no bigint, log_pos bigint").parquet(*[f"{root}/{v}/ids" for v in versions])


def stored_messages(spark: SparkSession, root: str, schema: str | StructType) -> DataFrame:
    """All messages that append_new() has added at root, under the columns of `schema`."""
    now = Published(spark, root).current()
    return spark.read.schema(schema).parquet(*[f"{root}/{p}/rows" for p in now["parts"]]) if now else spark.createDataFrame([], schema)
