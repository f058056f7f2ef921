"""Running aggregates along an order, without gathering a group or the whole in one task.

Rows are range-partitioned by (group, order), so a group may span many tasks. Each task runs along its own part; what the
parts before it hold of the same group is a few rows per task, summed up and joined to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.session import bounded, kept


def laid_out(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """df range-partitioned by (by, order), each row with the number of its part in _part.

    Rows equal in all of (by, order) share a part. The layout is written, since a part's rows must not change later.
    """
    if "_part" in df.columns:
        raise ValueError("the input has a column _part")
    return kept(df.repartitionByRange(*by, *order).withColumn("_part", F.spark_partition_id()), "laid-out")


def running(df: DataFrame, by: Sequence[str], order: Sequence[str], out: str, value: Column, how: str, inclusive: bool = True) -> DataFrame:
    """df, as from laid_out, with `out`: the sum, max or last known value over the rows of its group up to each row.

    With inclusive=False the row itself is left out. Null where no row before has a value; by may hold nulls.
    """
    groups, n = [F.col(c) for c in by], len(by)
    df = df.withColumn("_value", value)
    within = Window.partitionBy("_part", *by).orderBy(*order)
    frame = within.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    fold = {"sum": F.sum, "max": F.max}.get(how)
    local = fold("_value").over(frame) if fold else F.last("_value", ignorenulls=True).over(frame)
    if fold:
        parts = df.groupBy("_part", *by).agg(fold("_value").alias("_all"))
    else:
        at = F.max_by("_value", F.struct(*order)).alias("_all")
        parts = df.where("_value IS NOT NULL").groupBy("_part", *by).agg(at)
    # A group that lies in one part needs nothing from others, so only groups in several parts are carried on.
    spread = df.groupBy(*by).agg(F.min("_part").alias("_from"), F.max("_part").alias("_to")).where("_from < _to")
    names = [f"_by{i}" for i in range(n)]
    spread = spread.select(*[c.alias(m) for c, m in zip(groups, names, strict=True)], "_from", "_to", F.explode(F.sequence("_from", "_to")).alias("_at"))
    parts = parts.select(*[c.alias(f"_p{i}") for i, c in enumerate(groups)], F.col("_part").alias("_src"), "_all")
    same = [F.col(m).eqNullSafe(F.col(f"_p{i}")) for i, m in enumerate(names)]
    every = spread.join(parts, [*same, F.col("_at") == F.col("_src")], "left")
    before = Window.partitionBy(*names).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    carry = fold("_all").over(before) if fold else F.last("_all", ignorenulls=True).over(before)
    carried = every.select(*names, "_at", carry.alias("_carry"))
    on = [*[c.eqNullSafe(F.col(m)) for c, m in zip(groups, names, strict=True)], F.col("_part") == F.col("_at")]
    joined = df.withColumn("_local", local).join(bounded(carried), on, "left")
    if how == "sum":
        total = F.when(F.col("_local").isNull() & F.col("_carry").isNull(), None).otherwise(F.coalesce("_local", F.lit(0)) + F.coalesce("_carry", F.lit(0)))
    elif how == "max":
        total = F.greatest("_local", "_carry")
    else:
        total = F.coalesce("_local", "_carry")
    return joined.withColumn(out, total).drop("_value", "_local", "_carry", "_at", *names)
