"""Exact order statistics per key where a few keys hold most rows.

The value at a rank is found by narrowing an interval: rows inside it are counted into equal bins, the bin that holds
the rank becomes the next interval, until it holds one value. A round moves counts only (keys times bins, added up
before the shuffle as after it), so neither a key's values nor its rows ever meet in one task.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.names import file_number, plain_name
from tidelog.session import BROADCAST_ROWS, kept

#: Bins of a round, and parts at least that a key's values are dealt to where the intervals are too many to broadcast.
BINS, SALTS = 256, 32


def order_statistics(df: DataFrame, keys: list[str], value: str, ranks: Mapping[str, Column], bins: int = BINS) -> DataFrame:
    """Per key: rows, known (rows whose value isn't null), and the value at each named rank.

    value is a bigint column. ranks maps a result column to an expression over `known` that gives a rank from 1, such
    as ceil(known / 2) for the lower median; ranks outside 1..known are moved to the nearest end. Keys may be null.
    A key without any value has null at each rank. An empty input gives no row. Ties need no care: equal values share
    the bin to the end. Other columns of df are ignored.
    """
    clash = {"rows", "known", *ranks} & set(keys)
    if clash:
        raise ValueError(f"key columns {sorted(clash)} clash with result columns")
    spark = df.sparkSession
    slim = df.select(*keys, F.col(value).cast("bigint").alias("_v"), F.lit(1).cast("bigint").alias("_c"))
    totals = kept(
        slim.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.count("_v").alias("known"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")),
        "totals",
    )
    named = F.explode(F.array(*[F.struct(F.lit(n).alias("_name"), r.cast("bigint").alias("_rank")) for n, r in ranks.items()]))
    open_ = totals.where("known > 0").select(*keys, "known", "_lo", "_hi", named.alias("_r"))
    rank = F.least(F.greatest("_r._rank", F.lit(1)), "known").cast("bigint")
    # The first and the last rank are the interval's ends, known already.
    open_ = kept(
        open_.select(
            *keys, F.when(rank == F.col("known"), F.col("_hi")).otherwise(F.col("_lo")).alias("_lo"),
            F.when(rank == 1, F.col("_lo")).otherwise(F.col("_hi")).alias("_hi"), "_r._name", rank.alias("_rank"),
        ).withColumn("_hi", F.greatest("_lo", "_hi")),
        "open",
    )
    done = []
    while True:
        # An interval of one value is resolved.
        done.append(open_.where("_lo = _hi"))
        open_ = open_.where("_lo < _hi")
        if not open_.limit(1).count():
            break
        open_ = kept(_narrowed(slim, open_, keys, bins), "narrowed")
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    wide = found.groupBy(*keys).agg(*[F.max(F.when(F.col("_name") == n, F.col("_lo"))).alias(n) for n in ranks])
    on = [totals[k].eqNullSafe(wide[k]) for k in keys]
    return totals.join(wide, on, "left").select(*[totals[k] for k in keys], "rows", "known", *ranks)


def _narrowed(slim: DataFrame, open_: DataFrame, keys: list[str], bins: int) -> DataFrame:
    """The next interval of each open one, with the rank that remains inside it.

    Ranks that share an interval share its histogram. Bins begin at multiples of the step, so that no difference of two
    values is taken: it might not fit a bigint.
    """
    step = F.ceil((F.col("_hi").cast("decimal(20,0)") - F.col("_lo") + 1) / F.lit(bins))
    step = F.least(step.cast("decimal(20,0)"), F.lit(str(2**63 - 1)).cast("decimal(20,0)")).cast("bigint")
    group = [f"_k{i}" for i in range(len(keys))]
    renamed = [F.col(k).alias(g) for k, g in zip(keys, group, strict=True)]
    ranked = open_.select(*renamed, "_lo", "_hi", "_name", "_rank")
    spans = open_.withColumn("_step", step).select(*renamed, "_lo", "_hi", "_step").distinct()
    on = [F.col(k).eqNullSafe(F.col(g)) for k, g in zip(keys, group, strict=True)]
    if spans.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        rows, spans = slim, F.broadcast(spans)
    else:
        # A value of a key is one row with its count, so however many rows a key has, the salt deals its values evenly.
        salts = max(SALTS, int(slim.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
        rows = slim.groupBy(*keys, "_v").agg(F.sum("_c").alias("_c")).withColumn("_salt", F.pmod(F.xxhash64("_v"), F.lit(salts)).cast("int"))
        spans = spans.withColumn("_at", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        on.append(F.col("_salt") == F.col("_at"))
    inside = rows.where("_v IS NOT NULL").join(spans, on).where("_v BETWEEN _lo AND _hi")
    floor = F.expr("_v div _step - CASE WHEN _v % _step < 0 THEN 1 ELSE 0 END").alias("_bin")
    counted = inside.groupBy(*group, "_lo", "_hi", floor).agg(F.sum("_c").alias("_n"), F.min("_v").alias("_first"), F.max("_v").alias("_last"))
    up_to = F.sum("_n").over(Window.partitionBy(*group, "_lo", "_hi").orderBy("_bin"))
    counted = counted.withColumn("_upto", up_to).select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_lo").alias("_from"), F.col("_hi").alias("_to"), "_n", "_first", "_last", "_upto")
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)] + [F.col("_lo") == F.col("_from"), F.col("_hi") == F.col("_to")]
    hit = ranked.join(counted, same).where("_upto >= _rank AND _upto - _n < _rank")
    # Counts carry the least and greatest value of their bin, so the next interval is as tight as the data.
    return hit.select(
        *[F.col(g).alias(k) for k, g in zip(keys, group, strict=True)], F.col("_first").alias("_lo"), F.col("_last").alias("_hi"), "_name",
        (F.col("_rank") - (F.col("_upto") - F.col("_n"))).alias("_rank"),
    )


def delivery_profile(log: DataFrame) -> DataFrame:
    """Per (db_name, table_name): deliveries, messages, records, first_logged_at, last_logged_at and the medians.

    deliveries counts rows; messages distinct (source_id, file number, position); records the rows that distinct
    messages carry; delay_median and delay_p95 are exact, in microseconds from logged_at to received_at. Names are in
    their plain form; rows without names come out under null. All of it holds however unevenly rows fall to keys.
    """
    keys = ["db_name", "table_name"]
    rows = log.select(
        plain_name("db_name").alias("db_name"),
        plain_name("table_name").alias("table_name"),
        "source_id",
        file_number("transaction_id.file_name").alias("file_no"),
        F.col("transaction_id.log_pos").alias("log_pos"),
        F.when(F.col("event_type").isin(1, 2), F.coalesce(F.json_array_length("records"), F.lit(0))).otherwise(0).alias("held"),
        _micros("logged_at").alias("logged"),
        (_micros("received_at") - _micros("logged_at")).alias("delay"),
    )
    rows = kept(rows, "deliveries")
    wanted = [
        ("logged", {"first_at": F.lit(1), "last_at": F.col("known"), "middle_at": F.ceil(F.col("known") / 2)}),
        ("delay", {"delay_median": F.ceil(F.col("known") / 2), "delay_p95": F.ceil(F.col("known") * 0.95)}),
    ]
    with ThreadPoolExecutor(2) as pool:  # rounds of one fill the cores that the other's leave idle
        at, late = pool.map(lambda w: order_statistics(rows, keys, *w), wanted)
    # Distinct in two steps: the first groups by message, which no key dominates; the second adds numbers.
    single = rows.where("file_no IS NOT NULL AND log_pos IS NOT NULL").groupBy(*keys, "source_id", "file_no", "log_pos").agg(F.max("held").alias("held"))
    distinct = single.groupBy(*keys).agg(F.count(F.lit(1)).alias("messages"), F.sum("held").cast("bigint").alias("records"))
    same = lambda a, b: [a[k].eqNullSafe(b[k]) for k in keys]
    joined = at.join(distinct, same(at, distinct), "left").join(late, same(at, late), "left")
    moment = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    return joined.select(
        *[at[k] for k in keys], at["rows"].alias("deliveries"), F.coalesce("messages", F.lit(0)).alias("messages"),
        F.coalesce("records", F.lit(0)).alias("records"), moment("first_at").alias("first_logged_at"),
        moment("last_at").alias("last_logged_at"), moment("middle_at").alias("median_logged_at"), "delay_median", "delay_p95",
    )


def heavy_keys(log: DataFrame, share: float = 0.05) -> DataFrame:
    """(db_name, table_name, rows) of the keys that hold at least `share` (above 0, at most 1) of all rows of log.

    Put all rows in an order in which a key's rows are neighbours: a key with at least n rows covers a rank that is a
    multiple of n. So the values at those ranks, at most 1 / share of them, found by narrowing histograms, hold every such
    key; the order is that of a hash of the key. The few keys found are then counted exactly, which also tells keys with
    the same hash apart. Rows without either name count in the total and never come out. An empty log gives no row.
    """
    keys = ["db_name", "table_name"]
    named = log.select(plain_name("db_name").alias("db_name"), plain_name("table_name").alias("table_name")).withColumn("hash", F.xxhash64(*keys))
    total = log.count()
    least = max(1, math.ceil(Fraction(str(share)) * total))
    ranks = {f"at{i}": F.lit(i * least) for i in range(1, total // least + 1)}
    if not ranks:
        return log.sparkSession.createDataFrame([], "db_name string, table_name string, rows bigint")
    found = order_statistics(named.withColumn("all", F.lit(0)), ["all"], "hash", ranks)
    hit = found.select(F.explode(F.array(*ranks)).alias("hash")).distinct()
    heavy = named.join(F.broadcast(hit), "hash", "left_semi")  # at most 1 / share rows
    return heavy.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where((F.col("rows") >= least) & F.col("db_name").isNotNull() & F.col("table_name").isNotNull())


def _micros(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp"))
