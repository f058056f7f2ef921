"""Copying a table in parts: pages by key, shards by hash, partitions for JDBC."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def after_key(key: Sequence[str], last: Sequence[Any]) -> Column:
    """(k1, k2, …) > (v1, v2, …), written so that the scan gets it: k1 >= v1 AND (k1 > v1 OR k2 > v2 …)."""
    first, value = F.col(key[0]), F.lit(last[0])
    if len(key) == 1:
        return first > value
    return (first >= value) & ((first > value) | after_key(key[1:], last[1:]))


def page(df: DataFrame, key: Sequence[str], size: int, last: Sequence[Any] | None = None) -> DataFrame:
    """The next `size` rows in key order after `last`: a top-k, not a sort of the table."""
    return (df if last is None else df.where(after_key(key, last))).orderBy(*key).limit(size)


def last_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row with the greatest key, part by part in order."""
    return df.agg(F.max(F.struct(*key)).alias("k")).select("k.*")


def shard(key: Sequence[str], shards: int) -> Column:
    """A row's shard, 0 to shards - 1: CRC-32 of the key's texts joined by '|', null being empty."""
    return F.crc32(F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])) % shards


def bucket(c: Column | str, width: int = 4_294_967) -> Column:
    """The partition of an integer key in ranges of `width`; rounds towards 0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.call_function("div", c, F.lit(width))


def jdbc(spark: SparkSession, url: str, table: str, key: Sequence[str], shards: int, **options: str) -> DataFrame:
    """A table over JDBC, read in `shards` parallel parts by the source's own CRC-32; needs the driver's jar."""
    joined = ", ".join(f"COALESCE(`{k}`, '')" for k in key)
    parts = [f"CRC32(CONCAT_WS('|', {joined})) % {shards} = {i}" for i in range(shards)]
    return spark.read.jdbc(url, table, predicates=parts, properties=options)
