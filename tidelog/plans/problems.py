"""Queries p1 to p5: change feeds, repeated messages, hot keys, drifting schemas, differing copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators import changefeed, drift, messages, order_statistics, reconcile
from tidelog.session import shared_dir, table


def p1_state(spark: SparkSession, sf_dir: str, payload: bool = False) -> DataFrame:
    feed = changefeed.changes(table(spark, sf_dir, "log_events"), table(spark, sf_dir, "table_keys"), payload)
    return changefeed.live(changefeed.apply_changes(feed, shared_dir(spark, "state")))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_state(spark, sf_dir).select("db_name", "table_name", "record_key", "file_no", "log_pos")


def p1_current_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every living record with its fields, as JSON list of texts."""
    return p1_state(spark, sf_dir, payload=True).select("db_name", "table_name", "record_key", "file_no", "log_pos", "payload")


def p1_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows from the log applied in three parts, each holding batches from its whole length, the last first."""
    log, layouts, root = table(spark, sf_dir, "log_events"), table(spark, sf_dir, "table_keys"), shared_dir(spark, "state")
    for part in (2, 0, 1):
        mine = log.where(F.pmod(F.coalesce("batch_no", F.lit(0)), F.lit(3)) == part)
        state = changefeed.apply_changes(changefeed.changes(mine, layouts, payload=True), root)
    return changefeed.live(state).select("db_name", "table_name", "record_key", "file_no", "log_pos", "payload")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.repeated_messages(table(spark, sf_dir, "log_events"))


def p2_first_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with one row per message."""
    return messages.first_copies(table(spark, sf_dir, "log_events")).select(
        "source_id", "file_no", "log_pos", "delivery_no", "batch_no", "event_type", "records"
    )


def p2_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log in three parts, one after another, each freed of the messages that were stored before it."""
    log, root = table(spark, sf_dir, "log_events"), shared_dir(spark, "messages")
    count = (log.agg(F.max("batch_no")).first()[0] or 0) + 1
    part = F.expr(f"coalesce(batch_no, 0) * 3 div {count}")
    for i in range(3):
        added = messages.append_new(log.where(part == i), root)
    kept = messages.stored_messages(spark, root, added.schema)
    return kept.select("source_id", "file_no", "log_pos", "delivery_no", part.cast("bigint").alias("part"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_statistics.heavy_keys(table(spark, sf_dir, "log_events")).select("db_name", "table_name")


def p3_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_statistics.delivery_profile(table(spark, sf_dir, "log_events"))


def _drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.changes(table(spark, sf_dir, "table_structures"), table(spark, sf_dir, "file_rows"))[0]


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drift(spark, sf_dir).select("db_name", "table_name", "file_no", "change_kind", "field_name")


def p4_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of every record in the typed column of its field in the last schema of its table, or as rescued text
    under the name in its file."""
    w = drift.consistent_table(table(spark, sf_dir, "table_structures"), table(spark, sf_dir, "file_rows"))
    families = ("whole", "number", "approx", "at", "text")
    names = F.map_keys(F.map_filter("typed", lambda _, v: v.isNotNull()))
    typed = F.transform(names, lambda n: F.struct(n.alias("field_name"), *[F.try_element_at(f, n).alias(f) for f in families], F.lit(None).cast("string").alias("rescued")))
    held = F.coalesce(F.from_json("rescued", "map<string,string>"), F.expr("map()").cast("map<string,string>"))
    kinds = {"whole": "decimal(38,0)", "number": "decimal(38,10)", "approx": "double", "at": "timestamp_ntz", "text": "string"}
    lost = F.transform(F.map_entries(held), lambda e: F.struct(e["key"].alias("field_name"), *[F.lit(None).cast(k).alias(f) for f, k in kinds.items()], e["value"].alias("rescued")))
    return w.select("db_name", "table_name", "file_no", "line_no", F.explode(F.concat(typed, lost)).alias("v")).select("db_name", "table_name", "file_no", "line_no", "v.*")


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = reconcile.copies(table(spark, sf_dir, "source_rows"), table(spark, sf_dir, "target_rows"), table(spark, sf_dir, "table_keys"))
    return reconcile.differences(a, b)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(spark, sf_dir).select("db_name", "table_name", "record_key", "field_name")


def p5_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p5_found with both values as they were compared."""
    return _compared(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_current_rows, p1_batches, p2_found, p2_first_copies, p2_batches, p3_found, p3_profile, p4_found, p4_table, p5_found, p5_differences)
}


def _plain(c: str) -> str:
    return f"trim(lower({c}), '` ' || chr(9))"


def _file(c: str) -> str:
    return f"try_cast(nullif(regexp_extract({c}, '([0-9]+)$', 1), '') AS BIGINT)"


_MESSAGES = f"""
m AS (
    SELECT delivery_no, batch_no, source_id, event_type, {_plain("db_name")} AS db, {_plain("table_name")} AS tbl, records,
        logged_at, received_at, {_file("transaction_id.file_name")} AS file_no, transaction_id.log_pos AS log_pos
    FROM log_events)"""
_PLACED = "file_no IS NOT NULL AND log_pos IS NOT NULL"

_P1 = f"""
WITH {_MESSAGES},
lay AS (SELECT {_plain("table_name")} AS tbl, list_transform(primary_keys, lambda k: list_position(table_fields, k) - 1) AS places FROM table_keys),
lists AS (SELECT DISTINCT db, m.tbl, file_no, log_pos, event_type, places, from_json(records, '["JSON"]') AS list FROM m JOIN lay USING (tbl)
    WHERE event_type IN (1, 2) AND {_PLACED}),
rows AS (SELECT db, tbl, file_no, log_pos, event_type, places, unnest(list) AS r, unnest(range(len(list))) AS row_no FROM lists),
keyed AS (SELECT db, tbl, file_no, log_pos, event_type, row_no, r,
        array_to_string(list_transform(places, lambda i: coalesce(json_extract_string(r, '$[' || i || ']'), '')), '|') AS record_key FROM rows),
newest AS (SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY db, tbl, record_key ORDER BY file_no DESC, log_pos DESC, row_no DESC) = 1),
said AS (SELECT db, file_no, log_pos,
        regexp_replace(regexp_replace(records, '/\\*.*?\\*/', ' ', 'gs'), '--[^\\n]*', ' ', 'g') AS sql FROM m WHERE event_type = 3 AND {_PLACED}),
cut AS (SELECT db, file_no, log_pos, string_split(trim(regexp_replace(sql, '^\\s*truncate\\s+(table\\s+)?', '', 'i'), chr(10) || ' ;'), '.') AS n
    FROM said WHERE regexp_matches(sql, '^\\s*truncate\\s', 'i')),
gone AS (SELECT {_plain("CASE WHEN len(n) = 2 THEN n[1] ELSE db END")} AS db, {_plain("n[len(n)]")} AS tbl,
        max(file_no * 1000000000000 + log_pos) AS until FROM cut GROUP BY ALL)
SELECT k.db AS db_name, k.tbl AS table_name, record_key, file_no, log_pos{{}} FROM newest k LEFT JOIN gone USING (db, tbl)
WHERE event_type = 1 AND (until IS NULL OR file_no * 1000000000000 + log_pos > until)"""

_PAYLOAD = ", CAST(to_json(list_transform(CAST(r AS JSON[]), lambda x: x ->> '$')) AS VARCHAR) AS payload"

_P2_RANKED = f"""
WITH {_MESSAGES},
ranked AS (SELECT *, row_number() OVER (PARTITION BY source_id, file_no, log_pos ORDER BY received_at NULLS LAST, delivery_no) AS n
    FROM m WHERE {_PLACED})"""

_P3 = f"""
WITH {_MESSAGES},
a AS (SELECT db, tbl, count(*) AS deliveries, min(logged_at) AS first_logged_at, max(logged_at) AS last_logged_at,
        quantile_disc(logged_at, 0.5) AS median_logged_at, quantile_disc(epoch_us(received_at) - epoch_us(logged_at), 0.5) AS delay_median,
        quantile_disc(epoch_us(received_at) - epoch_us(logged_at), 0.95) AS delay_p95 FROM m GROUP BY ALL),
d AS (SELECT db, tbl, source_id, file_no, log_pos,
        max(CASE WHEN event_type IN (1, 2) THEN coalesce(json_array_length(records), 0) ELSE 0 END) AS held FROM m WHERE {_PLACED} GROUP BY ALL),
b AS (SELECT db, tbl, count(*) AS messages, sum(held) AS records FROM d GROUP BY ALL)
SELECT a.db AS db_name, a.tbl AS table_name, deliveries, coalesce(messages, 0) AS messages, CAST(coalesce(records, 0) AS BIGINT) AS records,
    first_logged_at, last_logged_at, median_logged_at, delay_median, delay_p95
FROM a LEFT JOIN b ON a.db IS NOT DISTINCT FROM b.db AND a.tbl IS NOT DISTINCT FROM b.tbl"""


def _side(name: str, created: str, version: str) -> str:
    return f"""
{name} AS (
    SELECT {_plain("s.table_name")} AS tbl, {_plain("s.db_name")} AS db, CASE WHEN len(primary_keys) = 1 THEN CAST(id AS VARCHAR)
            ELSE coalesce(CAST(id AS VARCHAR), '') || '|' || coalesce(display_name, '') END AS record_key,
        CASE WHEN len(primary_keys) = 1 THEN display_name END AS display_name, age, lower(kind) AS kind, amount, {created} AS created_at, field1
    FROM {name}_rows s JOIN table_keys t ON t.table_name = {_plain("s.table_name")}
    QUALIFY row_number() OVER (PARTITION BY {_plain("s.db_name")}, tbl, record_key ORDER BY {version} DESC) = 1)"""


_P5 = f"""
WITH {_side("source", "try_cast(created_at AS TIMESTAMP)", "id")},
{_side("target", "created_at", "_version")},
met AS (SELECT coalesce(a.db, b.db) AS db_name, coalesce(a.tbl, b.tbl) AS table_name, coalesce(a.record_key, b.record_key) AS record_key,
    list_filter([
        CASE WHEN a.db IS NULL THEN 'missing_in_source' END, CASE WHEN b.db IS NULL THEN 'missing_in_target' END,
        {", ".join(f"CASE WHEN a.db = b.db AND a.{c} IS DISTINCT FROM b.{c} THEN '{c}' END" for c in ("display_name", "age", "kind", "amount", "created_at", "field1"))}
    ], lambda x: x IS NOT NULL) AS names
    FROM source a FULL JOIN target b ON a.db = b.db AND a.tbl = b.tbl AND a.record_key = b.record_key)
SELECT db_name, table_name, record_key, unnest(names) AS field_name FROM met"""

_P5_VALUES = f"""
WITH {_side("source", "try_cast(created_at AS TIMESTAMP)", "id")},
{_side("target", "created_at", "_version")},
texts AS (SELECT coalesce(a.db, b.db) AS db_name, coalesce(a.tbl, b.tbl) AS table_name, coalesce(a.record_key, b.record_key) AS record_key,
    a.db IS NULL AS no_a, b.db IS NULL AS no_b, unnest([
        {", ".join("{{'f': '{0}', 'x': {1}, 'y': {2}}}".format(c, t.format("a." + c), t.format("b." + c)) for c, t in (
            ("display_name", "{}"), ("age", "CAST({} AS VARCHAR)"), ("kind", "{}"), ("amount", "CAST(CAST({} AS DECIMAL(24, 6)) AS VARCHAR)"),
            ("created_at", "CAST(epoch_us({}) AS VARCHAR)"), ("field1", "{}")))}
    ]) AS c
    FROM source a FULL JOIN target b ON a.db = b.db AND a.tbl = b.tbl AND a.record_key = b.record_key)
SELECT DISTINCT db_name, table_name, record_key, CASE WHEN no_a THEN 'missing_in_source' WHEN no_b THEN 'missing_in_target' ELSE c.f END AS field_name,
    CASE WHEN NOT no_a AND NOT no_b THEN c.x END AS a_value, CASE WHEN NOT no_a AND NOT no_b THEN c.y END AS b_value
FROM texts WHERE no_a OR no_b OR c.x IS DISTINCT FROM c.y"""

_P4 = f"""
WITH s AS (SELECT {_plain("db_name")} AS db, {_plain("table_name")} AS tbl, file_no, table_fields, primary_keys FROM table_structures),
files AS (SELECT DISTINCT db, tbl, file_no, list_transform(primary_keys, lambda p: {_plain("p")}) AS pk FROM s),
f AS (SELECT DISTINCT db, tbl, file_no, {_plain("x.field_name")} AS name, regexp_replace(lower(x.field_type), '\\s+', '', 'g') AS typ
    FROM (SELECT db, tbl, file_no, unnest(table_fields) AS x FROM s)),
old AS (SELECT db, tbl, file_no + 1 AS file_no, name, typ FROM f),
gone AS (SELECT o.* FROM old o JOIN files USING (db, tbl, file_no) LEFT JOIN f USING (db, tbl, file_no, name) WHERE f.typ IS NULL),
fresh AS (SELECT f.* FROM f JOIN (SELECT DISTINCT db, tbl, file_no FROM old) USING (db, tbl, file_no) LEFT JOIN old USING (db, tbl, file_no, name) WHERE old.typ IS NULL),
keys AS (SELECT DISTINCT {_plain("db_name")} AS db, {_plain("table_name")} AS tbl, file_no, line_no, payload, unnest(json_keys(payload)) AS k FROM file_rows),
v AS (SELECT db, tbl, file_no, line_no, {_plain("k")} AS name, json_extract_string(payload, '$."' || k || '"') AS val FROM keys),
ids AS (SELECT db, tbl, file_no, line_no, val AS id FROM v WHERE name = 'id' AND val IS NOT NULL),
held AS (SELECT ids.db, ids.tbl, ids.file_no, id, name, val FROM v JOIN ids USING (db, tbl, file_no, line_no)),
shared AS (SELECT DISTINCT a.db, a.tbl, a.file_no, a.id FROM ids a JOIN ids b ON a.db = b.db AND a.tbl = b.tbl AND a.id = b.id AND b.file_no = a.file_no - 1),
pairs AS (SELECT g.db, g.tbl, g.file_no, g.name AS old_name, n.name, g.typ AS old_typ, n.typ FROM gone g JOIN fresh n USING (db, tbl, file_no)),
judged AS (SELECT p.db, p.tbl, p.file_no, p.old_name, p.name, p.old_typ, p.typ, bool_and(a.val IS NOT DISTINCT FROM b.val) AS same FROM pairs p JOIN shared i USING (db, tbl, file_no)
    LEFT JOIN held a ON a.db = p.db AND a.tbl = p.tbl AND a.file_no = p.file_no AND a.id = i.id AND a.name = p.name
    LEFT JOIN held b ON b.db = p.db AND b.tbl = p.tbl AND b.file_no = p.file_no - 1 AND b.id = i.id AND b.name = p.old_name GROUP BY ALL),
moved AS (SELECT * FROM judged WHERE same),
pk AS (SELECT n.db, n.tbl, n.file_no, n.pk, list(coalesce(m.name, u.k) ORDER BY u.i) AS was FROM files n
    JOIN (SELECT db, tbl, file_no + 1 AS file_no, unnest(pk) AS k, unnest(range(len(pk))) AS i FROM files) u USING (db, tbl, file_no)
    LEFT JOIN moved m ON m.db = n.db AND m.tbl = n.tbl AND m.file_no = n.file_no AND m.old_name = u.k GROUP BY ALL),
every AS (
    SELECT db, tbl, file_no, 'added' AS change_kind, name FROM fresh ANTI JOIN moved USING (db, tbl, file_no, name)
    UNION ALL SELECT g.db, g.tbl, g.file_no, 'removed', g.name FROM gone g LEFT JOIN moved m ON m.db = g.db AND m.tbl = g.tbl AND m.file_no = g.file_no AND m.old_name = g.name WHERE m.db IS NULL
    UNION ALL SELECT db, tbl, file_no, 'renamed', name FROM moved
    UNION ALL SELECT db, tbl, file_no, 'type_changed', name FROM moved WHERE typ <> old_typ
    UNION ALL SELECT f.db, f.tbl, f.file_no, 'type_changed', f.name FROM f JOIN old USING (db, tbl, file_no, name) WHERE f.typ <> old.typ
    UNION ALL SELECT db, tbl, file_no, 'key_changed', array_to_string(pk, ',') FROM pk WHERE pk <> was)
SELECT db AS db_name, tbl AS table_name, file_no, change_kind, name AS field_name FROM every"""

_WHOLE = "TRY_CAST(val AS DECIMAL(38, 10))"
_P4_TABLE = _P4[: _P4.index("pk AS (SELECT n.db")] + f"""
lastly AS (SELECT db, tbl, max(file_no) AS file_no FROM files GROUP BY ALL),
shapes AS (SELECT DISTINCT db, tbl, {_plain("x.field_name")} AS name, lower(x.field_type) AS shape
    FROM (SELECT db, tbl, unnest(table_fields) AS x FROM s JOIN lastly USING (db, tbl, file_no))),
carried AS (
    SELECT db, tbl, file_no AS start, file_no, name AS first_name, name FROM f
    UNION ALL SELECT c.db, c.tbl, c.start, c.file_no + 1, c.first_name, coalesce(m.name, c.name) FROM carried c JOIN lastly l ON l.db = c.db AND l.tbl = c.tbl AND c.file_no < l.file_no
        LEFT JOIN moved m ON m.db = c.db AND m.tbl = c.tbl AND m.file_no = c.file_no + 1 AND m.old_name = c.name),
ends AS (SELECT c.db, c.tbl, c.start AS file_no, c.first_name AS name, c.name AS final_name, regexp_replace(shape, '\\s+', '', 'g') AS shape
    FROM carried c JOIN lastly l ON l.db = c.db AND l.tbl = c.tbl AND l.file_no = c.file_no JOIN shapes ON shapes.db = c.db AND shapes.tbl = c.tbl AND shapes.name = c.name),
judged_values AS (SELECT DISTINCT v.db, v.tbl, v.file_no, v.line_no, v.name, v.val, final_name, shape,
    CASE regexp_extract(shape, '^[a-z]+') WHEN 'int' THEN 'whole' WHEN 'bigint' THEN 'whole' WHEN 'smallintunsigned' THEN 'whole' WHEN 'decimal' THEN 'number' WHEN 'double' THEN 'approx'
        WHEN 'date' THEN 'at' WHEN 'datetime' THEN 'at' ELSE 'text' END AS family,
    CASE WHEN shape = 'int' THEN {_WHOLE} = floor({_WHOLE}) AND {_WHOLE} BETWEEN -2147483648 AND 2147483647
        WHEN shape = 'bigint' THEN {_WHOLE} = floor({_WHOLE}) AND {_WHOLE} BETWEEN -9223372036854775808 AND 9223372036854775807
        WHEN shape = 'smallintunsigned' THEN {_WHOLE} = floor({_WHOLE}) AND {_WHOLE} BETWEEN 0 AND 65535
        WHEN shape LIKE 'decimal%' THEN regexp_matches(val, '^[+-]?0*[0-9]{{0,' || CASE shape WHEN 'decimal(20,10)' THEN '10' ELSE '6' END || '}}([.][0-9]{{0,' || CASE shape WHEN 'decimal(20,10)' THEN '10' ELSE '4' END || '}}0*)?$')
        WHEN shape = 'double' THEN TRY_CAST(val AS DOUBLE) IS NOT NULL
        WHEN shape = 'date' THEN regexp_matches(val, '^[0-9]{{4}}-[0-9]+-[0-9]+$') AND TRY_CAST(val AS DATE) IS NOT NULL
        WHEN shape LIKE 'datetime%' THEN TRY_CAST(val AS TIMESTAMP) IS NOT NULL
        WHEN shape LIKE 'enum%' THEN list_contains(string_split(trim(shape, 'enum()'), ','), chr(39) || lower(val) || chr(39))
        WHEN shape LIKE 'varchar%' THEN length(val) <= CAST(regexp_extract(shape, '[0-9]+') AS INTEGER) ELSE TRUE END AS fits
    FROM v LEFT JOIN ends USING (db, tbl, file_no, name) WHERE val IS NOT NULL)
SELECT db AS db_name, tbl AS table_name, file_no, line_no, CASE WHEN fits AND shape IS NOT NULL THEN final_name ELSE name END AS field_name,
    CASE WHEN fits AND family = 'whole' THEN CAST({_WHOLE} AS DECIMAL(38, 0)) END AS whole, CASE WHEN fits AND family = 'number' THEN {_WHOLE} END AS number,
    CASE WHEN fits AND family = 'approx' THEN CAST(val AS DOUBLE) END AS approx, CASE WHEN fits AND family = 'at' THEN CAST(val AS TIMESTAMP) END AS at,
    CASE WHEN fits AND family = 'text' AND shape IS NOT NULL THEN val END AS text, CASE WHEN fits AND shape IS NOT NULL THEN NULL ELSE val END AS rescued
FROM judged_values"""
_P4_TABLE = _P4_TABLE.replace("WITH s AS", "WITH RECURSIVE s AS", 1)

ORACLE = {
    "p4_found": _P4,
    "p4_table": _P4_TABLE,
    "p1_found": _P1.format(""),
    "p1_current_rows": _P1.format(_PAYLOAD),
    "p1_batches": _P1.format(_PAYLOAD),
    "p2_found": _P2_RANKED + " SELECT source_id, file_no, log_pos FROM ranked WHERE n = 2",
    "p2_first_copies": _P2_RANKED + " SELECT source_id, file_no, log_pos, delivery_no, batch_no, event_type, records FROM ranked WHERE n = 1",
    "p2_batches": f"""WITH {_MESSAGES}, b AS (SELECT max(batch_no) + 1 AS n FROM log_events),
    parts AS (SELECT m.*, coalesce(batch_no, 0) * 3 // n AS part FROM m, b WHERE {_PLACED})
    SELECT source_id, file_no, log_pos, delivery_no, part FROM parts
    QUALIFY row_number() OVER (PARTITION BY source_id, file_no, log_pos ORDER BY part, received_at NULLS LAST, delivery_no) = 1""",
    "p3_found": f"""WITH {_MESSAGES} SELECT db AS db_name, tbl AS table_name FROM m WHERE db IS NOT NULL AND tbl IS NOT NULL GROUP BY ALL
        HAVING count(*) >= 0.05 * (SELECT count(*) FROM log_events)""",
    "p3_profile": _P3,
    "p5_found": _P5,
    "p5_differences": _P5_VALUES,
}
