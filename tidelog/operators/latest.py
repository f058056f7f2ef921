"""The newest row of each key, and what follows from it: current state, deleted keys, replay, truncation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.operators.ordered import laid_out, running


def newest(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the one greatest in `order`; null keys are equal to each other.

    An aggregation: tasks send one row per key, so keys with many versions cost no shuffle. Rows equal in all of
    `order` are told apart by their other columns. Columns keep their order.
    """
    rest = [c for c in df.columns if c not in key]
    best = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.struct(*order)).alias("_row")
    return df.groupBy(*key).agg(best).select(*[F.col(f"`{c}`") if c in key else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def newest_by_window(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The same by ranking: tasks cut each key to one row before the shuffle, and rows aren't packed into structs."""
    w = Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def current(df: DataFrame, key: Sequence[str], order: Sequence[str], deleted: Column | str, ignore_deletes: bool = False) -> DataFrame:
    """The living rows: newest of each key unless that is a delete. With ignore_deletes, deletes are no changes at all."""
    gone = F.expr(deleted) if isinstance(deleted, str) else deleted
    if ignore_deletes:
        return newest(df.where(~F.coalesce(gone, F.lit(False))), key, order)
    return newest(df.withColumn("_gone", F.coalesce(gone, F.lit(False))), key, order).where("NOT _gone").drop("_gone")


def deleted_keys(df: DataFrame, key: Sequence[str], order: Sequence[str], deleted: Column | str) -> DataFrame:
    gone = F.expr(deleted) if isinstance(deleted, str) else deleted
    slim = df.select(*key, *[c for c in order if c not in key], gone.alias("_gone"))
    return newest(slim, key, order).where("_gone").select(*key)


def after_truncate(df: DataFrame, scope: Sequence[str], order: str, marker: Column | str) -> DataFrame:
    """Rows that follow the last marker of their scope; the markers themselves are left out.

    The last marker is an aggregate joined back, not a window over all rows of a scope.
    """
    marks = F.expr(marker) if isinstance(marker, str) else marker
    last = df.where(marks).groupBy(*scope).agg(F.max(order).alias("_cut"))
    return df.where(~marks).join(last, list(scope), "left").where(F.col("_cut").isNull() | (F.col(order) > F.col("_cut"))).drop("_cut")


def segments(df: DataFrame, order: str, barriers: Sequence[int]) -> list[DataFrame]:
    """The feed cut at the positions of schema statements: each part is applied under the schema valid in it."""
    edges = [None, *sorted(barriers), None]
    out = []
    for lo, hi in zip(edges, edges[1:], strict=False):
        part = df if lo is None else df.where(F.col(order) > lo)
        out.append(part if hi is None else part.where(F.col(order) < hi))
    return out


def versioned(df: DataFrame, key: Sequence[str], order: Sequence[str], last: int = 0, version: str = "_version") -> DataFrame:
    """Versions from last + 1 upwards per key in the given order, which must be unique per key."""
    laid = laid_out(df, key, order)
    return running(laid, key, order, version, F.lit(1), "sum").withColumn(version, (F.col(version) + last).cast("bigint")).drop("_part")
