"""Queries over sources, streams and replicas, each with its SQL: logs and queues are written from the tables first, whole,
then read back the way a user reads them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.ddl import schema as ddl
from tidelog.ddl.convert import converted, raw_values
from tidelog.functions import names, packed
from tidelog.operators import changefeed, drift, monitor
from tidelog.plans import problems
from tidelog.plans.catalogue import registrar
from tidelog.plans.fixtures import CREATE, write_customers
from tidelog.session import shared_dir, table
from tidelog.sources import register
from tidelog.streaming.replicate import Replica

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
_query = registrar(QUERIES, ORACLE)

_CUSTOMERS = """SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance, CAST(round(c_acctbal, 2) AS DECIMAL(18, 2)) AS price,
lower(c_mktsegment) AS segment, '{"n":' || c_nationkey || '}' AS extra FROM customer"""


def _binlog(spark: SparkSession, d: str) -> str:
    folder = shared_dir(spark, "binlog")
    write_customers(table(spark, d, "customer").repartitionByRange(4, "c_custkey"), folder)
    register(spark)
    return folder


@_query(_CUSTOMERS)
def binlog_decode(spark, d):
    """Customers written as row events of binary logs, decoded and brought to the columns of their CREATE statement."""
    rows = spark.read.format("tidelog_binlog").option("path", _binlog(spark, d)).load().where("op = 'U'")
    return rows.select(raw_values(F.col("after")).alias("raw")).select(*converted(F.col("raw"), ddl.parse(CREATE, "shop").body))


@_query(_CUSTOMERS)
def binlog_stream(spark, d):
    """The same logs as a stream, applied to a replica."""
    root, folder = shared_dir(spark, "replica"), _binlog(spark, d)
    replica = Replica(spark, f"{root}/tables")
    rows = spark.readStream.format("tidelog_binlog").option("path", folder).load()
    replica.start(rows, f"{root}/checkpoint").awaitTermination()
    return replica.read("shop", "customer")


def _queue(spark: SparkSession, d: str) -> str:
    """log_events in order of arrival as a queue; a folder per database in its plain form."""
    root = shared_dir(spark, "queue")
    register(spark)
    events = table(spark, d, "log_events").withColumn("db_name", names.plain_name("db_name"))
    events.repartitionByRange(4, "delivery_no").sortWithinPartitions("delivery_no").write.format("tidelog_queue").option("path", root).mode("append").save()
    return root


_QUEUED = f"""SELECT coalesce(nullif({problems._plain("db_name")}, ''), '_') AS db_name, transaction_id.file_name AS file_name, transaction_id.log_pos AS log_pos,
event_type, table_name, records FROM log_events"""


@_query(_QUEUED)
def queue_read(spark, d):
    """The whole log written to a queue and read back."""
    q = spark.read.format("tidelog_queue").option("path", _queue(spark, d)).load()
    return q.select("db_name", "transaction_id.file_name", "transaction_id.log_pos", "event_type", "table_name", "records")


@_query(problems._P1.format(""))
def queue_stream(spark, d):
    """A queue as a stream of two files a batch, each applied as a change feed: the state is that of the whole log."""
    q, root, layouts = _queue(spark, d), shared_dir(spark, "state"), table(spark, d, "table_keys")

    def batch(rows: DataFrame, _: int) -> None:
        changefeed.apply_changes(changefeed.changes(rows.withColumn("db_name", F.nullif("db_name", F.lit("_"))), layouts), f"{root}/state")

    stream = spark.readStream.format("tidelog_queue").options(path=q, maxFilesPerTrigger=2, checkpoint=f"{root}/cp").load()
    running = stream.writeStream.foreachBatch(batch).option("checkpointLocation", f"{root}/cp").trigger(processingTime="0 seconds").start()
    running.processAllAvailable()
    running.stop()
    state = changefeed.live(changefeed.State(spark, f"{root}/state").read())
    return state.select("db_name", "table_name", "record_key", "file_no", "log_pos")


@_query("""SELECT c_custkey AS id, CASE WHEN c_custkey % 7 = 0 THEN 'N' || c_custkey ELSE c_name END AS full_name,
CAST(CASE WHEN c_custkey % 7 = 0 THEN 5 WHEN c_custkey > m // 2 THEN 1 ELSE 0 END AS INTEGER) AS grade, CAST(c_nationkey AS BIGINT) AS nation
FROM customer, (SELECT max(c_custkey) AS m FROM customer) WHERE c_custkey % 11 <> 0""")
def ddl_barrier_stream(spark, d):
    """Half of the customers under one schema, the others, changes and deletes under the next, with the statements between
    them in the same stream."""
    c, root = table(spark, d, "customer"), shared_dir(spark, "barrier")
    m = c.agg(F.max("c_custkey")).first()[0] or 0
    none = F.lit(None).cast("string")

    def rows(df: DataFrame, at: int, op: str, before, after) -> DataFrame:  # noqa: ANN001
        return df.select(
            F.lit(at).cast("bigint").alias("file_no"), F.col("c_custkey").alias("log_pos"), F.lit(0).alias("row_no"), F.lit("shop").alias("db_name"),
            F.lit("c").alias("table_name"), F.lit(op).alias("op"), none.alias("text"), before.alias("before"), after.alias("after"),
        )

    def said(at: int, sql: str) -> DataFrame:
        return spark.range(1).select(
            F.lit(at).cast("bigint").alias("file_no"), F.lit(0).cast("bigint").alias("log_pos"), F.lit(0).alias("row_no"), F.lit("shop").alias("db_name"),
            none.alias("table_name"), F.lit("Q").alias("op"), F.lit(sql).alias("text"), none.alias("before"), none.alias("after"),
        )

    old = F.to_json(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")))
    new = lambda name, grade: F.to_json(F.struct(F.col("c_custkey").alias("id"), name.alias("full_name"), F.lit(grade).alias("grade"), F.col("c_nationkey").alias("nation")))
    key = F.to_json(F.struct(F.col("c_custkey").alias("id")))
    log = [
        said(1, "CREATE TABLE c (id BIGINT PRIMARY KEY, name VARCHAR(50), nation INT)"),
        rows(c.where(F.col("c_custkey") <= m // 2), 2, "U", none, old),
        said(3, "ALTER TABLE c CHANGE name full_name VARCHAR(80), ADD COLUMN grade INT NOT NULL AFTER full_name"),
        rows(c.where(F.col("c_custkey") > m // 2), 4, "U", none, new(F.col("c_name"), 1)),
        said(5, "ALTER TABLE shop.c MODIFY COLUMN nation BIGINT"),
        rows(c.where("c_custkey % 7 = 0"), 6, "U", none, new(F.concat(F.lit("N"), F.col("c_custkey")), 5)),
        rows(c.where("c_custkey % 11 = 0"), 7, "D", key, none),
    ]
    every = log[0]
    for part in log[1:]:
        every = every.unionByName(part)
    every.repartitionByRange(3, "file_no", "log_pos").sortWithinPartitions("file_no", "log_pos").write.parquet(f"{root}/in")
    replica = Replica(spark, f"{root}/tables")
    replica.start(spark.readStream.schema(every.schema).parquet(f"{root}/in"), f"{root}/cp").awaitTermination()
    return replica.read("shop", "c")


@_query("""SELECT o_orderkey, '{"k": ' || (o_orderkey % 1000000) || ', "s": "' || o_orderstatus || '", "l": [true, null, ' || (o_orderkey % 100) || ']}' AS doc FROM orders""")
def json_binary(spark, d):
    """Documents in binary JSON, put together from bytes here, as text."""
    le = lambda c, n: F.array_join(F.reverse(F.regexp_extract_all(F.lpad(F.hex(c), 2 * n, "0"), F.lit("(..)"))), "")
    small = lambda n: le(F.lit(n), 2)
    # Keys from byte 25 of the object: k, s, l; values behind them: a number, a text, an array of three inline values.
    size = F.length("o_orderstatus") + 1
    number, text = 28, 32
    array = size + text
    inner = F.concat(small(3), small(13), F.lit("040100"), F.lit("040000"), F.lit("05"), le(F.col("o_orderkey") % 100, 2))
    entries = F.concat(F.lit("07"), small(number), F.lit("0C"), small(text), F.lit("02"), le(array, 2))
    head = F.concat(small(3), le(array + 13, 2), *[F.concat(small(25 + i), small(1)) for i in range(3)])
    body = F.concat(head, entries, F.hex(F.lit("ksl")), le(F.col("o_orderkey") % 1000000, 4), le(F.length("o_orderstatus"), 1), F.hex("o_orderstatus"), inner)
    return table(spark, d, "orders").select("o_orderkey", packed.json_documents(F.unhex(F.concat(F.lit("00"), body))).alias("doc"))


@_query("""WITH s AS (SELECT trim(lower(db_name), '` ' || chr(9)) AS db, trim(lower(table_name), '` ' || chr(9)) AS tbl, file_no, table_fields FROM table_structures
    QUALIFY row_number() OVER (PARTITION BY db, tbl, file_no ORDER BY exported_at DESC NULLS LAST, structure_no DESC) = 1),
f AS (SELECT db, tbl, file_no, unnest(range(1, len(table_fields) + 1)) AS pos, unnest(list_transform(table_fields, lambda x: trim(lower(x.field_name), '` ' || chr(9)))) AS name FROM s),
old AS (SELECT f.db, f.tbl, f.file_no + 1 AS file_no, pos, name FROM f JOIN s ON s.db = f.db AND s.tbl = f.tbl AND s.file_no = f.file_no + 1),
new AS (SELECT f.* FROM f JOIN s ON s.db = f.db AND s.tbl = f.tbl AND s.file_no = f.file_no - 1)
SELECT coalesce(o.db, n.db) AS db_name, coalesce(o.tbl, n.tbl) AS table_name, coalesce(o.file_no, n.file_no) AS file_no, CAST(coalesce(o.pos, n.pos) AS INTEGER) AS pos, o.name AS before, n.name AS after
FROM old o FULL JOIN new n ON o.db = n.db AND o.tbl = n.tbl AND o.file_no = n.file_no AND o.pos = n.pos WHERE o.name IS DISTINCT FROM n.name""")
def structure_drift(spark, d):
    """Column by column, where each file's structure differs from that of the file before."""
    s = drift.structures(table(spark, d, "table_structures"))
    return monitor.structure_differences(s)


@_query("""SELECT source_id, state_no, regexp_extract(last_seen_transaction.file_name, '([0-9]+)$', 1)::BIGINT AS file_no, last_seen_transaction.log_pos AS log_pos,
lag(regexp_extract(last_seen_transaction.file_name, '([0-9]+)$', 1)::BIGINT) OVER w AS before_file, lag(last_seen_transaction.log_pos) OVER w AS before_pos
FROM replicator_state WHERE last_seen_transaction IS NOT NULL WINDOW w AS (PARTITION BY source_id ORDER BY saved_at, state_no)""")
def reader_history(spark, d):
    return monitor.position_history(table(spark, d, "replicator_state"))


@_query("""SELECT period, op, events, sum(events) OVER (PARTITION BY op ORDER BY period)::BIGINT AS total
FROM (SELECT date_trunc('hour', ts) AS period, event_type AS op, count(*) AS events FROM events GROUP BY ALL)""")
def period_counters(spark, d):
    return monitor.per_period(table(spark, d, "events"), "ts", "event_type", "1 hour")


@_query("""SELECT {} FROM (SELECT CAST(trim(regexp_extract(transaction_id.file_name, '([0-9]+)$', 1)) AS BIGINT) AS file_no, source_id, transaction_id.log_pos AS log_pos
FROM log_events WHERE transaction_id IS NOT NULL) WHERE file_no IS NOT NULL GROUP BY source_id, file_no""".format("source_id, file_no, max(log_pos) AS last_pos, count(*) AS events"))
def last_per_file(spark, d):
    return monitor.last_per_file(table(spark, d, "log_events"))


@_query("SELECT p_partkey, bit_count(p_size)::INTEGER AS bits, sha256(p_brand || '.' || p_name) AS state_name FROM part")
def bits_and_names(spark, d):
    return table(spark, d, "part").select("p_partkey", F.bit_count("p_size").alias("bits"), names.state_name("p_brand", "p_name").alias("state_name"))
