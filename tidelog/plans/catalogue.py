"""Queries over the operators of replication, each with its SQL: change logs, normalisation, storage, positions, routing.

The events table stands for a change log: user_id is the key, event_id the position, event_type 'error' a delete.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog import config
from tidelog.ddl import schema as ddl
from tidelog.functions import names, normalize, packed, sqltext
from tidelog.operators import gtid, latest, monitor, snapshot
from tidelog.session import shared_dir, table
from tidelog.store.table import Store
from tidelog.streaming.apply import Rollup, apply_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

KEY, ORDER = ["user_id"], ["event_id"]
_EVENT = "user_id, event_id, event_type, value, props"
_NEWEST = "SELECT * FROM {src} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"
_CURRENT = f"SELECT {_EVENT} FROM ({_NEWEST.format(src='events')}) WHERE event_type <> 'error'"


def registrar(queries: dict, oracle: dict):  # noqa: ANN201
    """A decorator that registers a function under its name, with the SQL that gives the same rows."""

    def query(sql: str | None = None):  # noqa: ANN202
        def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
            queries[f.__name__] = f
            if sql:
                oracle[f.__name__] = sql
            return f

        return add

    return query


query = registrar(QUERIES, ORACLE)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "props")


# --- the newest row of each key -----------------------------------------------------------------------------------


@query(_CURRENT)
def lww_current_state(spark, d):
    return latest.current(_events(spark, d), KEY, ORDER, "event_type = 'error'")


@query(_CURRENT)
def lww_window_variant(spark, d):
    return latest.newest_by_window(_events(spark, d), KEY, ORDER).where("event_type <> 'error'")


@query(f"SELECT {_EVENT} FROM ({_NEWEST.format(src='(SELECT * FROM events WHERE event_type <> $$error$$)')})")
def upsert_ignore_deletes(spark, d):
    return latest.current(_events(spark, d), KEY, ORDER, "event_type = 'error'", ignore_deletes=True)


@query(f"SELECT user_id FROM ({_NEWEST.format(src='events')}) WHERE event_type = 'error'")
def cdc_delete_set(spark, d):
    return latest.deleted_keys(_events(spark, d), KEY, ORDER, "event_type = 'error'")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def delete_anti_join(spark, d):
    gone = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, d, "orders").select("o_orderkey", "o_custkey").join(gone, "o_orderkey", "left_anti")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def delete_affected_semi(spark, d):
    gone = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, d, "orders").select("o_orderkey", "o_custkey").join(gone, "o_orderkey", "left_semi")


@query(_CURRENT)
def snapshot_union_log(spark, d):
    """A snapshot taken at the middle of the log, with version 0, and the log after it come to the state of the whole."""
    e = _events(spark, d)
    cut = (e.agg(F.max("event_id")).first()[0] or 0) // 2
    base = latest.newest(e.where(F.col("event_id") <= cut), KEY, ORDER).withColumn("_version", F.lit(0).cast("bigint"))
    log = e.where(F.col("event_id") > cut).withColumn("_version", F.col("event_id"))
    return latest.current(base.unionByName(log), KEY, ["_version"], "event_type = 'error'").drop("_version")


@query(f"""WITH cut AS (SELECT user_id, max(event_id) AS c FROM events WHERE event_type = 'signup' GROUP BY 1),
rest AS (SELECT e.* FROM events e LEFT JOIN cut USING (user_id) WHERE event_type <> 'signup' AND (c IS NULL OR event_id > c))
SELECT {_EVENT} FROM ({_NEWEST.format(src="rest")}) WHERE event_type <> 'error'""")
def truncate_replay(spark, d):
    rest = latest.after_truncate(_events(spark, d), KEY, "event_id", "event_type = 'signup'")
    return latest.current(rest, KEY, ORDER, "event_type = 'error'")


@query(_CURRENT)
def replay_dedup(spark, d):
    """The log with its first half delivered again."""
    e = _events(spark, d)
    again = e.where(F.col("event_id") < (e.agg(F.max("event_id")).first()[0] or 0) // 2)
    return latest.current(e.unionByName(again), KEY, ORDER, "event_type = 'error'")


@query(_CURRENT)
def microbatch_fold(spark, d):
    """Batches folded one by one, then together."""
    e = _events(spark, d).withColumn("batch", F.expr("event_id div 1000"))
    folded = latest.newest(e, [*KEY, "batch"], ORDER)
    return latest.current(folded.drop("batch"), KEY, ORDER, "event_type = 'error'")


@query("SELECT user_id, event_id, CAST(100 + row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS _version FROM events")
def version_assign(spark, d):
    return latest.versioned(_events(spark, d).select("user_id", "event_id"), KEY, ORDER, 100)


@query("SELECT event_type, max(event_id) AS max_version, count(*) AS versions FROM events GROUP BY ALL")
def max_version(spark, d):
    return _events(spark, d).groupBy("event_type").agg(F.max("event_id").alias("max_version"), F.count(F.lit(1)).alias("versions"))


@query("SELECT event_id, op FROM (SELECT event_id, CASE event_type WHEN 'error' THEN 'D' WHEN 'signup' THEN 'Q' ELSE 'U' END AS op FROM events) WHERE op IN ('U', 'D')")
def operation_filter(spark, d):
    op = F.when(F.col("event_type") == "error", "D").when(F.col("event_type") == "signup", "Q").otherwise("U")
    return _events(spark, d).select("event_id", op.alias("op")).where(F.col("op").isin("U", "D"))


@query("""SELECT event_id FROM events, (SELECT min(event_id) AS low, max(event_id) AS high FROM events)
WHERE event_id > low + (high - low) // 4 AND event_id < high - (high - low) // 4""")
def bounded_replay(spark, d):
    """The log between two positions: its middle half, whatever its length."""
    e = _events(spark, d).select("event_id")
    low, high = e.agg(F.min("event_id"), F.max("event_id")).first()
    quarter = ((high or 0) - (low or 0)) // 4
    return e.where((F.col("event_id") > (low or 0) + quarter) & (F.col("event_id") < (high or 0) - quarter))


@query("""SELECT event_id, CAST(CASE WHEN event_id < 300 THEN 0 WHEN event_id < 700 THEN 1 ELSE 2 END AS INTEGER) AS segment
FROM events WHERE event_id NOT IN (300, 700)""")
def ddl_segments(spark, d):
    """The log cut at two schema statements, at positions 300 and 700."""
    parts = latest.segments(_events(spark, d).select("event_id"), "event_id", [300, 700])
    out = parts[0].withColumn("segment", F.lit(0))
    for i, p in enumerate(parts[1:], 1):
        out = out.unionByName(p.withColumn("segment", F.lit(i)))
    return out


# --- storage ------------------------------------------------------------------------------------------------------

_STORE = "user_id bigint, event_id bigint, event_type string, value double, props string"


def _append(store: Store, spark, d, numbers: range, batches: int = 4) -> None:
    e = _events(spark, d).withColumns({"_version": F.col("event_id"), "_deleted": F.col("event_type") == "error"})
    for b in numbers:
        store.append(e.where(F.expr(f"(event_id div 100) % {batches} = {b}")), b)


def _stored(spark, d, batches: int = 4) -> Store:
    store = Store(spark, shared_dir(spark, "store"), KEY, _STORE)
    _append(store, spark, d, range(batches), batches)
    return store


@query(_CURRENT)
def store_read_final(spark, d):
    return _stored(spark, d).read().drop("_version")


@query(_CURRENT)
def compaction_equiv(spark, d):
    """Compacted half way, then a batch replayed and the rest added."""
    store = Store(spark, shared_dir(spark, "store"), KEY, _STORE)
    _append(store, spark, d, range(2))
    store.optimize()
    _append(store, spark, d, range(1, 4))
    return store.read().drop("_version")


@query(f"SELECT {_EVENT} FROM ({_CURRENT}) WHERE user_id % 3 <> 0")
def store_erase(spark, d):
    store = _stored(spark, d)
    top = store.max_version() or 0
    store.erase(store.read().where("user_id % 3 = 0"), top + 1, "erased")
    return store.read().drop("_version")


@query(f"SELECT {_EVENT} FROM ({_NEWEST.format(src='(SELECT * FROM events WHERE event_id > 600)')}) WHERE event_type <> 'error'")
def store_truncate(spark, d):
    store = _stored(spark, d)
    store.truncate(600)
    return store.read().drop("_version")


@query(_CURRENT)
def stream_apply(spark, d):
    """The log as a stream of files, applied batch by batch to a store."""
    src, root = shared_dir(spark, "stream-in"), shared_dir(spark, "stream")
    e = _events(spark, d).withColumns({"_version": F.col("event_id"), "_deleted": F.col("event_type") == "error"})
    e.repartitionByRange(4, "event_id").write.parquet(src)
    store = Store(spark, f"{root}/store", KEY, _STORE)
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(src)
    apply_stream(stream, store, f"{root}/checkpoint").awaitTermination()
    return store.read().drop("_version")


_DAILY = "SELECT CAST(ts AS DATE) AS day, event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY ALL"


@query(_DAILY)
def rollup_daily(spark, d):
    return table(spark, d, "events").groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))


@query(_DAILY)
def rollup_incremental(spark, d):
    """Partial counts per batch; a batch that comes twice counts once."""
    rollup = Rollup(shared_dir(spark, "rollup"), {"day": "to_date(ts)", "event_type": "event_type"})
    e = table(spark, d, "events")
    for b in (0, 1, 2, 1):
        rollup.add(e.where(F.col("event_id") % 3 == b), b)
    return rollup.read(spark)


@query(f"""WITH f AS ({_NEWEST.format(src="events")}), a AS (SELECT event_type, count(*) AS versions FROM events GROUP BY 1),
b AS (SELECT event_type, count(*) AS living FROM f WHERE event_type <> 'error' GROUP BY 1)
SELECT event_type, versions, coalesce(living, 0) AS living FROM a LEFT JOIN b USING (event_type)""")
def rollup_versions_vs_final(spark, d):
    e = _events(spark, d)
    final = latest.current(e, KEY, ORDER, "event_type = 'error'").groupBy("event_type").agg(F.count(F.lit(1)).alias("living"))
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("versions")).join(final, "event_type", "left").fillna(0)


# --- copying in parts ---------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 500")
def keyset_page(spark, d):
    return snapshot.page(table(spark, d, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], 500, [1000])


_LINES = "SELECT l_orderkey, l_linenumber, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY ALL"


@query(f"SELECT * FROM ({_LINES}) WHERE (l_orderkey, l_linenumber) > (200, 3) ORDER BY l_orderkey, l_linenumber LIMIT 400")
def keyset_page_composite(spark, d):
    lines = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.sum("l_quantity").cast("bigint").alias("quantity"))
    return snapshot.page(lines, ["l_orderkey", "l_linenumber"], 400, [200, 3])


@query("SELECT count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS total FROM orders")
def keyset_full_scan_equiv(spark, d):
    """A copy in three ranges of the key is the copy of all."""
    o = table(spark, d, "orders")
    top = o.agg(F.max("o_orderkey")).first()[0] or 0
    cuts = [top // 3, 2 * top // 3]
    a = o.where(~snapshot.after_key(["o_orderkey"], [cuts[0]]))
    b = o.where(snapshot.after_key(["o_orderkey"], [cuts[0]]) & ~snapshot.after_key(["o_orderkey"], [cuts[1]]))
    c = o.where(snapshot.after_key(["o_orderkey"], [cuts[1]]))
    return a.unionByName(b).unionByName(c).agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("total"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem ORDER BY l_orderkey DESC, l_linenumber DESC LIMIT 1")
def snapshot_last_key(spark, d):
    return snapshot.last_key(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


#: CRC-32 by its definition: a table of 256 remainders, then a step per byte.
_CRC = """(WITH t AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
b AS (SELECT list_transform(string_split(o_orderkey || '|' || o_custkey, ''), lambda x: CAST(ascii(x) AS BIGINT)) AS bytes FROM orders)
SELECT xor(list_reduce(list_prepend(4294967295, bytes), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) AS crc FROM b, t)"""


@query(f"SELECT CAST(crc % 8 AS INTEGER) AS shard, count(*) AS n FROM {_CRC} GROUP BY ALL")
def crc32_shards(spark, d):
    shard = snapshot.shard(["o_orderkey", "o_custkey"], 8).cast("int").alias("shard")
    return table(spark, d, "orders").groupBy(shard).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey // 1000 AS bucket, count(*) AS n FROM orders GROUP BY ALL")
def partition_intdiv(spark, d):
    return table(spark, d, "orders").groupBy(snapshot.bucket("o_orderkey", 1000).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT strftime(o_orderdate, '%Y%m') AS month, count(*) AS n FROM orders GROUP BY ALL")
def partition_month(spark, d):
    return table(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyyMM").alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_name IS NULL OR c_custkey IS NULL OR c_custkey % 2 = 0")
def raw_where(spark, d):
    """A free condition, passed through as text."""
    return table(spark, d, "customer").where("c_name IS NULL OR c_custkey IS NULL OR c_custkey % 2 = 0").select("c_custkey", "c_name")


_Q1 = """SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
    max(l_shipdate) AS last_shipped FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00' GROUP BY l_returnflag, l_linestatus"""


@query(_Q1)
def raw_sql(spark, d):
    """SQL passed through to the engine."""
    view = "lineitem_" + shared_dir(spark, "v").rsplit("-", 1)[1]
    table(spark, d, "lineitem").createOrReplaceTempView(view)
    return spark.sql(_Q1.replace("FROM lineitem", f"FROM {view}").replace("TIMESTAMP '", "TIMESTAMP_NTZ '"))


# --- selection and routing ----------------------------------------------------------------------------------------


@query("""SELECT p_partkey, p_brand FROM part WHERE (p_brand GLOB 'Brand#1*' OR p_brand GLOB '*[2-3]5') AND NOT p_brand GLOB '*1[!1-3]'""")
def glob_include_exclude(spark, d):
    return table(spark, d, "part").where(config.selected("p_brand", ["Brand#1*", "*[2-3]5"], "*1[!1-3]")).select("p_partkey", "p_brand")


@query("SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'works' WHEN 'MACHINERY' THEN 'works' ELSE c_mktsegment END AS target FROM customer")
def route_targets(spark, d):
    return table(spark, d, "customer").select("c_custkey", config.routed("c_mktsegment", {"BUILDING": "works", "MACHINERY": "works"}).alias("target"))


@query("""SELECT target, count(*) AS sources FROM (SELECT DISTINCT c_mktsegment, CASE c_mktsegment WHEN 'BUILDING' THEN 'works' WHEN 'MACHINERY'
THEN 'works' ELSE c_mktsegment END AS target FROM customer) GROUP BY target HAVING count(*) > 1""")
def multi_source_detect(spark, d):
    routed = table(spark, d, "customer").select("c_mktsegment", config.routed("c_mktsegment", {"BUILDING": "works", "MACHINERY": "works"}).alias("target"))
    return routed.distinct().groupBy("target").agg(F.count(F.lit(1)).alias("sources")).where("sources > 1")


@query("SELECT c_custkey AS id, c_name AS name, 'customer' AS origin FROM customer UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier")
def multi_source_union(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("customer").alias("origin"))
    b = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("supplier").alias("origin"))
    return a.unionByName(b)


@query("""SELECT n_name AS name, 'start' AS change FROM nation WHERE n_name NOT IN (SELECT n_name FROM nation WHERE n_nationkey < 20)
UNION ALL SELECT r_name, 'stop' FROM region""")
def catalog_diff(spark, d):
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    had = n.where("n_nationkey < 20").select(F.col("n_name").alias("name")).unionByName(r.select(F.col("r_name").alias("name")))
    return monitor.missing_and_extra(n.select(F.col("n_name").alias("name")), had, "name")


@query("SELECT n_nationkey AS nation FROM nation INTERSECT SELECT c_nationkey FROM customer")
def catalog_intersect(spark, d):
    return table(spark, d, "nation").select(F.col("n_nationkey").alias("nation")).intersect(table(spark, d, "customer").select("c_nationkey"))


# --- values -------------------------------------------------------------------------------------------------------


@query("""SELECT c_custkey, CASE WHEN v < 0 THEN v + 256 ELSE v END AS u8, CASE WHEN v < 0 THEN v + 65536 ELSE v END AS u16,
CASE WHEN v < 0 THEN v + 16777216 ELSE v END AS u24, CASE WHEN v < 0 THEN v + 4294967296 ELSE v END AS u32,
CAST(CASE WHEN v < 0 THEN CAST(v AS HUGEINT) + 18446744073709551616 ELSE v END AS DECIMAL(20, 0)) AS u64
FROM (SELECT c_custkey, CAST(c_nationkey - 12 AS BIGINT) AS v FROM customer)""")
def map_unsigned_wrap(spark, d):
    v = F.col("c_nationkey") - 12
    return table(spark, d, "customer").select("c_custkey", *[normalize.unsigned(v, b).alias(f"u{b}") for b in (8, 16, 24, 32, 64)])


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n, CASE WHEN l_linenumber <= 4 THEN ['one', 'two', 'three', 'four'][l_linenumber]
ELSE CAST(l_linenumber AS VARCHAR) END AS label FROM lineitem GROUP BY ALL""")
def map_enum(spark, d):
    label = normalize.enum_label(F.col("l_linenumber"), ["One", "Two", "Three", "Four"]).alias("label")
    return table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber", label).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT r_regionkey, CASE WHEN r_regionkey BETWEEN 1 AND 2 THEN ['a', 'b'][r_regionkey] ELSE CAST(r_regionkey AS VARCHAR) END AS label,
CASE WHEN lower(r_name) IN ('asia', 'europe') THEN lower(r_name) ELSE r_name END AS name FROM region""")
def map_enum_invalid(spark, d):
    label, name = normalize.enum_label(F.col("r_regionkey"), ["A", "b"]), normalize.enum_text(F.col("r_name"), ["Asia", "Europe"])
    return table(spark, d, "region").select("r_regionkey", label.alias("label"), name.alias("name"))


@query("""SELECT p_partkey, array_to_string(list_filter([
{}], lambda x: x IS NOT NULL), ',') AS labels FROM part""".format(", ".join(f"CASE WHEN p_size & {1 << i} > 0 THEN 'l{i}' END" for i in range(7))))
def map_set_bitmask(spark, d):
    return table(spark, d, "part").select("p_partkey", normalize.set_labels(F.col("p_size"), [f"l{i}" for i in range(7)]).alias("labels"))


@query("SELECT o_orderkey, CAST(greatest(1901, least(2155, year(o_orderdate) + CASE WHEN o_orderkey % 2 = 0 THEN 200 ELSE -200 END)) AS INTEGER) AS y FROM orders")
def map_year_clamp(spark, d):
    y = F.year("o_orderdate") + F.when(F.col("o_orderkey") % 2 == 0, 200).otherwise(-200)
    return table(spark, d, "orders").select("o_orderkey", normalize.year(y.cast("string")).alias("y"))


@query("""SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'O'), '') AS status, coalesce(nullif(o_custkey % 5, 0), 0) AS rest,
coalesce(CASE WHEN o_custkey % 7 <> 0 THEN o_orderdate END, TIMESTAMP '1970-01-01') AS at FROM orders""")
def map_null_defaults(spark, d):
    o = table(spark, d, "orders")
    at = F.coalesce(F.when(F.col("o_custkey") % 7 != 0, F.col("o_orderdate")), F.lit("1970-01-01").cast("timestamp_ntz"))
    return o.select(
        "o_orderkey", normalize.filled(F.nullif("o_orderstatus", F.lit("O")), "").alias("status"),
        normalize.filled(F.nullif(F.col("o_custkey") % 5, F.lit(0)), 0).alias("rest"), at.alias("at"),
    )


_ZERO = "CASE o_orderkey % 3 WHEN 0 THEN '0000-00-00 00:00:00' WHEN 1 THEN '2013-00-10 00:00:00' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END"


@query(f"""SELECT o_orderkey, try_cast(t AS TIMESTAMP) AS at, coalesce(try_cast(t AS TIMESTAMP), TIMESTAMP '1970-01-01') AS filled,
CASE WHEN try_cast(t AS TIMESTAMP) IS NOT NULL THEN NULL WHEN t LIKE '0000-00-00%' THEN 'zero_date' ELSE 'invalid_date' END AS reason
FROM (SELECT o_orderkey, {_ZERO} AS t FROM orders)""")
def map_zero_dates(spark, d):
    t = F.when(F.col("o_orderkey") % 3 == 0, "0000-00-00 00:00:00").when(F.col("o_orderkey") % 3 == 1, "2013-00-10 00:00:00")
    o = table(spark, d, "orders").select("o_orderkey", t.otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("t"))
    at = normalize.moment(F.col("t"))
    return o.select("o_orderkey", at.alias("at"), normalize.moment_or_epoch(F.col("t")).alias("filled"), normalize.null_reason(F.col("t"), at).alias("reason"))


@query("SELECT p_partkey, p_size % 2 <> 0 AS flag FROM part")
def map_bool(spark, d):
    return table(spark, d, "part").select("p_partkey", (F.col("p_size") % 2).cast("boolean").alias("flag"))


@query("SELECT p_partkey, lpad(bin(p_size), 8, '0') AS bits FROM part")
def map_bit_string(spark, d):
    return table(spark, d, "part").select("p_partkey", packed.bit_string(F.col("p_size"), 8).alias("bits"))


_HASH = "md5(CAST(o_orderkey AS VARCHAR))"


@query(f"""SELECT o_orderkey, {_HASH}[1:8] || '-' || {_HASH}[9:12] || '-' || {_HASH}[13:16] || '-' || {_HASH}[17:20] || '-' || {_HASH}[21:32] AS uuid,
CAST(16 AS INTEGER) AS n FROM orders""")
def map_uuid(spark, d):
    raw = F.upper(F.md5(F.col("o_orderkey").cast("string")))
    u = normalize.uuid_text(raw)
    return table(spark, d, "orders").select("o_orderkey", u.alias("uuid"), F.octet_length(normalize.uuid_bytes(u)).alias("n"))


@query("SELECT event_id, replace(props, ' ', '') AS props FROM events")
def map_json_text(spark, d):
    return table(spark, d, "events").select("event_id", normalize.json_text(F.col("props")).alias("props"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


_SECONDS = "(o_orderkey * 7919) % 6000000 - 3000000"


@query(f"""SELECT o_orderkey, CASE WHEN d = 0 THEN '' WHEN abs(d) = 1 THEN d || ' day, ' ELSE d || ' days, ' END
|| (r // 3600) || ':' || lpad(CAST(r // 60 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(r % 60 AS VARCHAR), 2, '0')
|| CASE WHEN o_orderkey % 2 = 0 THEN '.000012' ELSE '' END AS t
FROM (SELECT o_orderkey, CAST(floor(s / 86400.0) AS BIGINT) AS d, s - CAST(floor(s / 86400.0) AS BIGINT) * 86400 AS r FROM (SELECT o_orderkey, {_SECONDS} AS s FROM orders))""")
def map_timedelta_text(spark, d):
    micros = F.expr(_SECONDS) * 1_000_000 + F.when(F.col("o_orderkey") % 2 == 0, 12).otherwise(0)
    return table(spark, d, "orders").select("o_orderkey", normalize.timedelta_text(micros).alias("t"))


@query("SELECT o_orderkey, CAST((o_orderdate AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS TIMESTAMP) AS utc FROM orders")
def map_tz_convert(spark, d):
    return table(spark, d, "orders").select("o_orderkey", normalize.to_utc(F.col("o_orderdate"), "America/New_York").alias("utc"))


@query("SELECT o_orderkey, date_trunc('second', o_orderdate) + INTERVAL 45 SECOND AS at, CAST(o_orderdate AS DATE) AS day FROM orders")
def map_fraction_pack(spark, d):
    """Times packed into 40 bits and read back; dates likewise in 24."""
    o = table(spark, d, "orders").withColumn("t", F.date_trunc("second", "o_orderdate").cast("timestamp_ntz") + F.expr("INTERVAL 45 SECOND"))
    date = (F.year("t") * 512 + F.month("t") * 32 + F.dayofmonth("t")).cast("bigint")
    return o.select("o_orderkey", packed.datetime5(packed.packed_datetime5(F.col("t"))).alias("at"), packed.date3(date).alias("day"))


_ROMAN, _CYRILLIC = "abcdefghijklmnopqrstuvwxyz", "".join(chr(0x430 + i) for i in range(26))


@query(f"SELECT p_partkey, translate(p_name, '{_ROMAN}', '{_CYRILLIC}') AS name, translate(p_name, '{_ROMAN}', '{_CYRILLIC}') AS koi FROM part")
def decode_charset(spark, d):
    """Names in Cyrillic letters, from their bytes in two character sets (bytes are written as Latin-1 characters)."""
    made = lambda codec: F.encode(F.translate("p_name", _ROMAN, _CYRILLIC.encode(codec).decode("latin-1")), "ISO-8859-1")
    read = lambda charset, codec: normalize.decoded(made(codec), charset)
    return table(spark, d, "part").select("p_partkey", read("cp1251", "cp1251").alias("name"), read("koi8r", "koi8-r").alias("koi"))


@query("SELECT o_orderkey, CAST(o_orderkey % 1000000 AS BIGINT) AS le, CAST(o_orderkey % 1000000 AS BIGINT) AS be FROM orders")
def read_integers(spark, d):
    n = F.lpad(F.hex(F.col("o_orderkey") % 1000000), 6, "0")
    flip = F.concat(F.substring(n, 5, 2), F.substring(n, 3, 2), F.substring(n, 1, 2))
    le, be = packed.unsigned_of_bytes(F.unhex(flip), 3), packed.unsigned_of_bytes(F.unhex(n), 3, little=False)
    return table(spark, d, "orders").select("o_orderkey", le.alias("le"), be.alias("be"))


@query("SELECT o_orderkey, CAST(round(o_totalprice, 2) AS DECIMAL(18, 2)) AS price FROM orders")
def decimal_decode(spark, d):
    pack = F.udf(lambda t: packed.packed_decimal(t, 18, 2), "binary", useArrow=True)
    text = F.round("o_totalprice", 2).cast("decimal(18,2)").cast("string")
    return table(spark, d, "orders").select("o_orderkey", packed.decimals(pack(text), 18, 2).alias("price"))


def _wkb_point(x, y):
    import struct

    return struct.pack("<BI2d", 1, 1, x, y)


def _wkb_square(x, header=True):
    import struct

    ring = [(x, 0.0), (x + 1, 0.0), (x + 1, 1.0), (x, 1.0), (x, 0.0)]
    hole = [(x + 0.2, 0.2), (x + 0.4, 0.2), (x + 0.2, 0.2)]
    body = struct.pack("<I", 2)
    for r in (ring, hole):
        body += struct.pack("<I", len(r)) + b"".join(struct.pack("<2d", *p) for p in r)
    return (b"\0\0\0\0" if header else b"") + struct.pack("<BI", 1, 3) + body


def _wkb_two(x):
    import struct

    return struct.pack("<BII", 1, 6, 2) + _wkb_square(x, False) + _wkb_square(x + 5, False)


@query("SELECT s_suppkey, CAST(s_nationkey AS FLOAT) AS x, CAST(s_suppkey AS FLOAT) AS y FROM supplier")
def geo_point(spark, d):
    made = F.udf(lambda x, y: _wkb_point(float(x), float(y)), "binary", useArrow=True)
    p = table(spark, d, "supplier").select("s_suppkey", packed.point(made("s_nationkey", "s_suppkey")).alias("p"))
    return p.select("s_suppkey", "p.x", "p.y")


@query("SELECT s_suppkey, CAST(5 AS INTEGER) AS points, CAST(s_nationkey + 1 AS FLOAT) AS right_edge FROM supplier")
def geo_polygon(spark, d):
    made = F.udf(lambda x: _wkb_square(float(x)), "binary", useArrow=True)
    p = table(spark, d, "supplier").select("s_suppkey", packed.polygon(made("s_nationkey")).alias("p"))
    return p.select("s_suppkey", F.size("p").alias("points"), F.array_max(F.transform("p", lambda q: q["x"])).alias("right_edge"))


@query("SELECT s_suppkey, CAST(2 AS INTEGER) AS parts, CAST(10 AS INTEGER) AS points FROM supplier")
def geo_multipolygon(spark, d):
    made = F.udf(lambda x: _wkb_two(float(x)), "binary", useArrow=True)
    p = table(spark, d, "supplier").select("s_suppkey", packed.multipolygon(made("s_nationkey")).alias("p"))
    return p.select("s_suppkey", F.size("p").alias("parts"), F.size(F.flatten("p")).alias("points"))


# --- positions, transactions, monitoring --------------------------------------------------------------------------


@query("""SELECT op, tbl, count(*) AS events, CAST(sum(k) AS BIGINT) AS records, CAST(sum(k) * 2 AS BIGINT) AS duration
FROM (SELECT CASE WHEN event_type = 'error' THEN 'erase' ELSE 'insert' END AS op, event_type AS tbl, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
GROUP BY GROUPING SETS ((op), (op, tbl))""")
def stats_grouping(spark, d):
    op = F.when(F.col("event_type") == "error", "erase").otherwise("insert").alias("op")
    k = F.get_json_object("props", "$.k").cast("bigint")
    e = table(spark, d, "events").select(op, F.col("event_type").alias("tbl"), k.alias("k"), (k * 2).alias("took"))
    return monitor.stats(e, "op", "tbl", "k", "took")


_ISLANDS = """
marked AS (SELECT sid, n, n - row_number() OVER (PARTITION BY sid ORDER BY n) AS g FROM nums)
SELECT sid, min(n) AS "start", max(n) + 1 AS "end" FROM marked GROUP BY sid, g"""


@query(f"WITH nums AS (SELECT DISTINCT user_id AS sid, event_id // 3 AS n FROM events),{_ISLANDS}")
def gtid_union(spark, d):
    e = _events(spark, d).select("user_id", F.expr("event_id div 3").alias("n"))
    return gtid.intervals(e, "user_id", "n")


@query(f"""WITH nums AS (SELECT DISTINCT user_id % 10 AS sid, event_id // 7 AS n FROM events WHERE event_type <> 'view'
EXCEPT SELECT DISTINCT user_id % 10, event_id // 7 FROM events WHERE event_type = 'error'),{_ISLANDS}""")
def gtid_subtract(spark, d):
    e = _events(spark, d).select((F.col("user_id") % 10).alias("sid"), F.expr("event_id div 7").alias("n"), "event_type")
    a, b = (gtid.intervals(e.where(c), "sid", "n") for c in ("event_type <> 'view'", "event_type = 'error'"))
    return gtid.subtracted(a, b)


@query("""SELECT DISTINCT sid FROM (SELECT user_id AS sid FROM events WHERE event_type = 'view') WHERE sid NOT IN (
SELECT sid FROM (SELECT user_id AS sid, event_id // 2000 AS n FROM events WHERE event_type = 'view'
EXCEPT SELECT user_id, event_id // 2000 FROM events WHERE event_type <> 'view'))""")
def gtid_contains(spark, d):
    e = _events(spark, d).select(F.col("user_id").alias("sid"), F.expr("event_id div 2000").alias("n"), "event_type")
    a, b = (gtid.intervals(e.where(c), "sid", "n") for c in ("event_type <> 'view'", "event_type = 'view'"))
    return gtid.contained(a, b)


@query(f"""WITH nums AS (SELECT DISTINCT user_id AS sid, event_id // 3 AS n FROM events), spans AS ({_ISLANDS.strip().replace('marked AS', 'SELECT * FROM (WITH marked AS') + ')'})
SELECT sid, string_agg(CASE WHEN "end" = "start" + 1 THEN CAST("start" AS VARCHAR) ELSE "start" || '-' || ("end" - 1) END, ':' ORDER BY "start") AS txt
FROM spans GROUP BY sid""")
def gtid_text(spark, d):
    spans = gtid.intervals(_events(spark, d).select("user_id", F.expr("event_id div 3").alias("n")), "user_id", "n")
    # Text of a server's intervals is its set written out, so it is as long as the set.
    part = F.when(F.col("end") == F.col("start") + 1, F.col("start").cast("string")).otherwise(F.concat_ws("-", "start", F.col("end") - 1))
    listed = F.array_sort(F.collect_list(F.struct("start", part.alias("t"))))
    return spans.groupBy("sid").agg(F.array_join(F.transform(listed, lambda x: x["t"]), ":").alias("txt"))


@query("""WITH f AS (SELECT event_id // 1000 AS file_no, min(event_id) AS first_pos FROM events GROUP BY 1)
SELECT w.event_id AS pos, f.file_no FROM events w ASOF LEFT JOIN f ON w.event_id >= f.first_pos""")
def asof_file_lookup(spark, d):
    """The file of every position."""
    e = _events(spark, d)
    files = e.groupBy(F.expr("event_id div 1000").alias("file_no")).agg(F.min("event_id").alias("first_pos"))
    return monitor.as_of_file(files, e.select(F.col("event_id").alias("pos")))


@query("""SELECT user_id, event_id, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) AS v
FROM (SELECT user_id, event_id, CASE WHEN event_type = 'signup' THEN event_id END AS v FROM events)""")
def tablemap_ffill(spark, d):
    e = _events(spark, d).select("user_id", "event_id", F.when(F.col("event_type") == "signup", F.col("event_id")).alias("v"))
    return monitor.carried_forward(e, "user_id", "event_id", "v")


@query("""SELECT source_id, max(CAST(regexp_extract(last_seen_transaction.file_name, '([0-9]+)$', 1) AS BIGINT)) AS file_no,
arg_max(last_seen_transaction.log_pos, CAST(regexp_extract(last_seen_transaction.file_name, '([0-9]+)$', 1) AS BIGINT) * 10000000000 + last_seen_transaction.log_pos) AS log_pos,
count(DISTINCT (saved_at, CAST(regexp_extract(last_seen_transaction.file_name, '([0-9]+)$', 1) AS BIGINT), last_seen_transaction.log_pos)) AS states, max(saved_at) AS saved_at
FROM replicator_state WHERE last_seen_transaction IS NOT NULL GROUP BY 1""")
def monitor_lag(spark, d):
    return monitor.reader_positions(table(spark, d, "replicator_state"))


@query("""SELECT source_id, file, 1100 - CAST(regexp_extract(file, '([0-9]+)$', 1) AS BIGINT) AS files_behind
FROM (SELECT DISTINCT source_id, last_seen_transaction.file_name AS file FROM replicator_state WHERE last_seen_transaction IS NOT NULL)""")
def file_lag(spark, d):
    s = table(spark, d, "replicator_state").where("last_seen_transaction IS NOT NULL")
    return monitor.lag_report("binlog.001100", s.select("source_id", F.col("last_seen_transaction.file_name").alias("file")).distinct())


@query("""SELECT user_id, event_id, ts, CASE WHEN epoch_us(ts) > epoch_us(lag(ts) OVER w)
THEN round((event_id - lag(event_id) OVER w) * 1000000 / (epoch_us(ts) - epoch_us(lag(ts) OVER w)), 6) END AS rate
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)""")
def event_rates(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "ts")
    return monitor.rates(e, "user_id", "ts", "event_id").withColumn("rate", F.round("rate", 6))


# --- schemas ------------------------------------------------------------------------------------------------------


@query(r"""SELECT delivery_no, lower(regexp_extract(
    regexp_replace(regexp_replace(regexp_replace(records, '/\*.*?\*/', ' ', 'gs'), '--[^\n]*', ' ', 'g'), '#[^\n]*', ' ', 'g'),
    '^\s*(create|alter)\s+table\s+(if\s+not\s+exists\s+)?`?([^`\s.;,]+)`?\s*\.', 3, 'is')) AS db
FROM log_events WHERE event_type = 3""")
def db_name_from_ddl(spark, d):
    """The database that each statement names, those with comments too."""
    text = sqltext.without_comments(F.col("records"))
    shape = rf"(?is)^\s*(?:create|alter)\s+table\s+(?:if\s+not\s+exists\s+)?{sqltext.NAME}\s*\.\s*{sqltext.NAME}"
    rows = table(spark, d, "log_events").where("event_type = 3")
    return rows.select("delivery_no", names.plain_name(F.regexp_extract(text, shape, 1)).alias("db"))


_CUSTOMER = "create table customer (c_custkey bigint primary key, c_name varchar(50), c_nationkey int, c_acctbal double, c_mktsegment varchar(20))"


@query("""SELECT 'x' AS first_c, c_custkey AS id, c_mktsegment AS segment, CAST(c_nationkey AS BIGINT) AS c_nationkey, CAST(NULL AS INTEGER) AS later FROM customer""")
def ddl_evolve_project(spark, d):
    """Rows stored before the schema changed, read under the schema after."""
    r = ddl.Registry()
    r.apply(_CUSTOMER, "shop")
    stored = r.tables[("shop", "customer")].store(table(spark, d, "customer"))
    r.apply("ALTER TABLE customer DROP COLUMN c_name, DROP c_acctbal, RENAME COLUMN c_custkey TO id, CHANGE c_mktsegment segment varchar(30) AFTER id", "shop")
    r.apply("ALTER TABLE customer ADD later INT, ADD COLUMN first_c ENUM('X','y') NOT NULL FIRST, MODIFY c_nationkey BIGINT", "shop")
    return r.tables[("shop", "customer")].project(stored)


@query("SELECT n_nationkey AS id, n_name AS name FROM nation WHERE n_nationkey >= 10")
def rename_swap(spark, d):
    """A new table takes an old one's name in one statement."""
    r = ddl.Registry()
    r.apply("create table t (id int primary key, name varchar(30))", "a")
    r.apply("create table _t_new like t", "a")
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    held = {"t": r.tables[("a", "t")].store(n.where("id < 10")), "_t_new": r.tables[("a", "_t_new")].store(n.where("id >= 10"))}
    for old, new in r.apply("RENAME TABLE t TO _t_old, _t_new TO t", "a").body:
        held[new] = held.pop(old)
    return r.tables[("a", "t")].project(held["t"])


@query("SELECT count(*) AS keys, count(*) FILTER (user_id IS NULL) AS null_keys FROM (SELECT DISTINCT user_id FROM events)")
def nullable_key_check(spark, d):
    k = _events(spark, d).select("user_id").distinct()
    return k.agg(F.count(F.lit(1)).alias("keys"), F.count_if(F.col("user_id").isNull()).alias("null_keys"))
