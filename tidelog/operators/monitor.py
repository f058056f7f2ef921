"""Where readers and appliers stand, what was applied, and which names are missing on either side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.names import file_number
from tidelog.operators.ordered import laid_out, running


def stats(df: DataFrame, op: str, table: str, records: str, duration: str) -> DataFrame:
    """Events, records and duration per op and per (table, op); the former with null table."""
    grouped = df.groupingSets([[op], [op, table]], op, table)
    return grouped.agg(F.count(F.lit(1)).alias("events"), F.sum(records).alias("records"), F.sum(duration).alias("duration"))


def as_of_file(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """For each wanted position the last file that begins at or before it: (pos, file_no); null where there is none.

    files: file_no, first_pos. Both sides are put in one order and the file is carried forward, so there is one sort
    and no comparison of each position with each file.
    """
    both = files.select(F.col("first_pos").alias("pos"), F.col("file_no"), F.lit(0).alias("ask")).unionByName(
        wanted.select("pos", F.lit(None).cast(dict(files.dtypes)["file_no"]).alias("file_no"), F.lit(1).alias("ask"))
    )
    laid = laid_out(both, [], ["pos", "ask"])
    return running(laid, [], ["pos", "ask"], "found", F.col("file_no"), "last").where("ask = 1").select("pos", F.col("found").alias("file_no"))


def carried_forward(df: DataFrame, by: str, order: str, value: str) -> DataFrame:
    """value with nulls replaced by the last one before, per `by` in `order`."""
    return running(laid_out(df, [by], [order]), [by], [order], "_found", F.col(value), "last").withColumn(value, F.col("_found")).drop("_found", "_part")


def lag_report(newest_file: str, appliers: DataFrame) -> DataFrame:
    """How many log files each applier (name, file) is behind the source's newest."""
    newest = file_number(F.lit(newest_file))
    return appliers.withColumn("files_behind", newest - file_number("file"))


def reader_positions(states: DataFrame) -> DataFrame:
    """Per source the last saved position and the number of states, from replicator_state; position_history() has those before.

    Positions are compared as numbers: file number, then offset. States saved twice count once.
    """
    at = lambda c: F.struct(file_number(f"{c}.file_name").alias("file_no"), F.col(f"{c}.log_pos").alias("log_pos"))
    rows = states.where("last_seen_transaction IS NOT NULL").select("source_id", "saved_at", at("last_seen_transaction").alias("at")).distinct()
    return rows.groupBy("source_id").agg(F.max("at").alias("at"), F.count(F.lit(1)).alias("states"), F.max("saved_at").alias("saved_at")).select(
        "source_id", "at.file_no", "at.log_pos", "states", "saved_at"
    )


def position_history(states: DataFrame) -> DataFrame:
    """Each saved position (source_id, state_no, file_no, log_pos) with the one its source saved before (before_file,
    before_pos), null at the first. States in the order of their time, then number; those without position are left out."""
    at = "last_seen_transaction"
    rows = states.where(F.col(at).isNotNull()).select("source_id", "saved_at", "state_no", file_number(f"{at}.file_name").alias("file_no"), F.col(f"{at}.log_pos").alias("log_pos"))
    order = ["saved_at", "state_no"]
    here = F.struct("file_no", "log_pos")
    both = running(laid_out(rows, ["source_id"], order), ["source_id"], order, "_before", here, "last", inclusive=False)
    return both.select("source_id", "state_no", "file_no", "log_pos", F.col("_before.file_no").alias("before_file"), F.col("_before.log_pos").alias("before_pos"))


def per_period(df: DataFrame, at: str, op: str, size: str) -> DataFrame:
    """Events per op and period (period, op, events) with the op's total up to then; periods without events have no row.

    Counted first, so that what is put in order is a row per op and period.
    """
    counts = df.groupBy(F.window(at, size)["start"].alias("period"), F.col(op).alias("op")).agg(F.count(F.lit(1)).alias("events"))
    return running(laid_out(counts, ["op"], ["period"]), ["op"], ["period"], "total", F.col("events"), "sum").drop("_part")


def last_per_file(log: DataFrame) -> DataFrame:
    """The last position seen in each log file of a source, and how many deliveries name the file; others are left out."""
    placed = log.select("source_id", file_number("transaction_id.file_name").alias("file_no"), F.col("transaction_id.log_pos").alias("log_pos"))
    return placed.where("file_no IS NOT NULL").groupBy("source_id", "file_no").agg(F.max("log_pos").alias("last_pos"), F.count(F.lit(1)).alias("events"))


def structure_differences(structures: DataFrame) -> DataFrame:
    """(db_name, table_name, file_no, pos, before, after): places of a file's columns whose name isn't that of the file before.

    structures: db_name, table_name, file_no, fields (an array with names), a row per file. A column on one side only is null
    on the other; files whose neighbour before is missing are compared with nothing.
    """
    key = ["db_name", "table_name", "file_no"]
    listed = structures.select(*key, F.transform("fields", lambda f: f["name"]).alias("names"))
    before = listed.select("db_name", "table_name", (F.col("file_no") + 1).alias("file_no"), F.col("names").alias("was"))
    places = F.sequence(F.lit(1), F.greatest(F.size("names"), F.size("was")))
    pairs = listed.join(before, key).where(F.greatest(F.size("names"), F.size("was")) > 0).select(*key, "names", "was", F.explode(places).alias("pos"))
    out = pairs.select(*key, "pos", F.get("was", F.col("pos") - 1).alias("before"), F.get("names", F.col("pos") - 1).alias("after"))
    return out.where(~F.col("before").eqNullSafe(F.col("after")))


def missing_and_extra(wanted: DataFrame, had: DataFrame, name: str) -> DataFrame:
    """Names on one side only: (name, change) with change 'start' where had lacks it and 'stop' where wanted does."""
    start, stop = wanted.select(name).distinct().exceptAll(had.select(name).distinct()), had.select(name).distinct().exceptAll(wanted.select(name).distinct())
    return start.withColumn("change", F.lit("start")).unionByName(stop.withColumn("change", F.lit("stop")))


def rates(df: DataFrame, by: str, order: str, value: str) -> DataFrame:
    """value's growth per second since the row before, per `by`; null at the first row and where no time passed."""
    laid = laid_out(df, [by], [order])
    both = running(laid, [by], [order], "_before", F.struct(F.col(order).alias("at"), F.col(value).alias("v")), "last", inclusive=False)
    passed = F.unix_micros(F.col(order).cast("timestamp")) - F.unix_micros(F.col("_before.at").cast("timestamp"))
    grown = F.col(value) - F.col("_before.v")
    return both.withColumn("rate", F.when(passed > 0, grown * 1_000_000 / passed)).drop("_before", "_part")
