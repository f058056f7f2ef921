"""Reading files whose fields come, go, change name and change type into one table, and reporting each change.

Rows are ingested against a target schema. A field the target doesn't know, or whose value its type can't hold, isn't
lost: it goes to a rescue column as JSON. A rescued field that later becomes part of the schema is promoted: its
rescued values are replayed into the typed column. Schemas are data here (a row per file), so one job serves any number
of tables; nothing is gathered per table.

A file's declared fields are a record too, of the types by name. Ingested under the schema of the file before, what is
new or declared otherwise lands in the rescue column, and promoting the renames leaves what was added there.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.ddl.types import SourceType
from tidelog.functions.names import plain_name, plain_type, type_shape
from tidelog.session import all_kept, bounded, kept

FILE = ["db_name", "table_name", "file_no"]
_MAP = "map<string,string>"
#: Files whose schemas are broadcast to their records; more are joined by file.
TARGETS = 20_000
_TYPES = "array<struct<name:string,type:string,shape:string>>"


def structures(raw: DataFrame) -> DataFrame:
    """One row per file of table_structures: db_name, table_name, file_no, fields (name, type and shape), key.

    Names and types are plain, so letter case, blanks and parameters make no difference; shape is the type with the blanks
    inside its labels kept, which decides what values it holds. Of several rows for a file the
    one exported last counts (ties: the highest structure_no). A null list of fields or keys counts as empty; a field
    without name is left out.
    """
    fields = F.transform(
        F.coalesce("table_fields", F.expr("array()").cast("array<struct<field_name:string,field_type:string,parameters:string>>")),
        lambda f: F.struct(plain_name(f["field_name"]).alias("name"), F.coalesce(plain_type(f["field_type"]), F.lit("")).alias("type"), F.coalesce(type_shape(f["field_type"]), F.lit("")).alias("shape")),
    )
    key = F.transform(F.coalesce("primary_keys", F.expr("array()").cast("array<string>")), plain_name)
    slim = raw.select(
        plain_name("db_name").alias("db_name"), plain_name("table_name").alias("table_name"), "file_no",
        F.filter(fields, lambda f: f["name"].isNotNull()).alias("fields"), key.alias("key"), "exported_at", "structure_no",
    )
    # A name that a file lists twice has the type listed first.
    listed = F.transform("fields", lambda f: f["name"])
    slim = slim.withColumn("fields", F.filter("fields", lambda f, i: F.array_position(listed, f["name"]) == i + 1))
    newest = F.max(F.struct(F.coalesce("exported_at", F.lit("0001-01-01").cast("timestamp_ntz")).alias("at"), "structure_no", "fields", "key"))
    return slim.groupBy(*FILE).agg(newest.alias("s")).select(*FILE, "s.fields", "s.key")


def file_records(raw: DataFrame) -> DataFrame:
    """One row per line of file_rows: the file's columns, line_no, id, and fields, the payload's texts by plain name.

    Repeated lines count once. JSON numbers keep their digits, JSON null and absent both give no text. A payload that
    isn't a JSON object gives no fields and a null id, and is kept. Of two spellings of a name in one payload the first
    that has a value counts.
    """
    parsed = F.coalesce(F.from_json("payload", _MAP), _empty(_MAP))
    lines = (
        raw.select(plain_name("db_name").alias("db_name"), plain_name("table_name").alias("table_name"), "file_no", "line_no", "payload", "file_row_no")
        .groupBy(*FILE, "line_no")
        .agg(F.min_by("payload", "file_row_no").alias("payload"))
    ).withColumn("fields", parsed)
    keys = F.map_keys("fields")
    distinct = F.array_distinct(F.transform(keys, plain_name))
    first = lambda n: F.get(F.filter(F.map_entries("fields"), lambda e: (plain_name(e["key"]) == n) & e["value"].isNotNull())["value"], F.lit(0))
    cleaned = F.map_from_arrays(distinct, F.transform(distinct, first))
    plain = F.forall(keys, lambda k: k == plain_name(k)) & (F.size(keys) == F.size(F.array_distinct(keys)))
    return lines.select(*FILE, "line_no", F.when(plain, F.col("fields")).otherwise(cleaned).alias("fields")).withColumn("id", F.try_element_at("fields", F.lit("id")))


def _empty(kind: str) -> Column:
    return F.expr("map()" if kind.startswith("map") else "array()").cast(kind)


#: Bits of the integer types, octets of the text types without a length.
_BITS = {"int": 32, "integer": 32, "bigint": 64, "mediumint": 24, "smallint": 16, "tinyint": 8}
_OCTETS = {"tinytext": 255, "tinyblob": 255, "text": 65_535, "blob": 65_535, "mediumtext": 16_777_215, "mediumblob": 16_777_215}
_DAY = r"\d{4}-\d{1,2}-\d{1,2}"
_ARGUMENTS = r"^[a-z]+\((\d+)(?:,(\d+))?\)"
_FAMILIES = {"whole": "decimal(38,0)", "number": "decimal(38,10)", "approx": "double", "at": "timestamp_ntz", "text": "string"}


def _base(kind: Column, *names: str) -> Column:
    """Whether the type's own name, before arguments and attributes, is one of these."""
    return kind.rlike(rf"^(?:{'|'.join(names)})(?=$|\(|unsigned|signed|zerofill|precision|character|charset|collate)")


def _digits(value: Column) -> tuple[Column, Column]:
    """Digits before and behind the point, without zeros that say nothing; null where the text is no number."""
    plain = F.when(value.rlike("(?i)e"), value.try_cast("decimal(38,10)").cast("string")).otherwise(value)
    shape = r"^[+-]?0*(\d*)(?:\.(\d*?)0*)?$"
    number = plain.rlike(r"^[+-]?(?:\d+\.?\d*|\.\d+)$")
    return tuple(F.when(number, F.length(F.regexp_extract(plain, shape, i))) for i in (1, 2))


def holds(value: Column, kind: Column) -> Column:
    """Whether a column of source type `kind` (its shape) can hold the text `value` without loss. Null and unknown types can.

    Numbers must lie within the type's range, precision and scale; dates and times exist (a zero date doesn't); enum and
    set values be labels whatever their letter case; JSON be JSON; texts not be longer than the type takes.
    """
    no, unsigned = F.lit(False), kind.contains("unsigned")
    number = value.try_cast("decimal(38,10)")
    most = F.lit(None).cast("decimal(38,0)")
    for name, bits in _BITS.items():
        limit = [F.lit(str(2**b)).cast("decimal(38,0)") for b in (bits, bits - 1)]
        most = F.when(_base(kind, name), F.when(unsigned, limit[0]).otherwise(limit[1])).otherwise(most)
    whole = (number == F.floor(number)) & (number < most) & (number >= F.when(unsigned, F.lit(0).cast("decimal(38,0)")).otherwise(-most))
    first, second = (F.regexp_extract(kind, _ARGUMENTS, i).try_cast("int") for i in (1, 2))
    before, behind = _digits(value)
    precision, scale = F.coalesce(first, F.lit(10)), F.coalesce(second, F.lit(0))
    exact = (before <= precision - scale) & (behind <= scale) & ~(unsigned & value.startswith("-") & (number < 0))
    # enum('a','b'): a label is what stands between two quotes; two quotes inside one are one.
    labels = F.split(F.regexp_extract(kind, r"^(?:enum|set)\('(.*)'\)", 1), "','")
    said = F.replace(F.lower(value), F.lit("'"), F.lit("''"))
    octets = F.lit(None).cast("int")
    for name, n in _OCTETS.items():
        octets = F.when(_base(kind, name), n).otherwise(octets)
    hour = F.regexp_extract(value, r"^-?(\d{1,3}):[0-5]\d(?::[0-5]\d(?:\.\d{1,6})?)?$", 1).try_cast("int")
    year = F.when(value.rlike(r"^\d{1,4}$"), value.try_cast("int"))
    yes = lambda c: F.coalesce(c, no)
    return (
        F.when(value.isNull(), True)
        .when(_base(kind, *_BITS), yes(whole))
        .when(_base(kind, "decimal", "numeric", "dec", "fixed"), yes(exact))
        .when(_base(kind, "double", "float", "real"), yes(value.rlike(r"\d") & value.try_cast("double").isNotNull()))
        .when(_base(kind, "datetime", "timestamp"), value.rlike(rf"^{_DAY}(?:[ T]\d{{1,2}}:\d{{2}}(?::\d{{2}}(?:\.\d{{1,9}})?)?)?$") & value.try_cast("timestamp_ntz").isNotNull())
        .when(_base(kind, "date"), value.rlike(rf"^{_DAY}$") & value.try_cast("date").isNotNull())
        .when(_base(kind, "time"), yes(hour <= 838))
        .when(_base(kind, "year"), yes((year < 100) | year.between(1901, 2155)))
        .when(_base(kind, "json"), F.try_parse_json(value).isNotNull())
        .when(_base(kind, "bit"), value.rlike("^[01]+$") & (F.length(value) <= F.coalesce(first, F.lit(1))))
        .when(_base(kind, "bool", "boolean"), F.lower(value).isin("0", "1", "true", "false"))
        .when(_base(kind, "uuid"), value.rlike("(?i)^[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}$"))
        .when(kind.startswith("enum("), F.array_contains(labels, said))
        .when(kind.startswith("set("), (value == "") | F.forall(F.split(said, ","), lambda x: F.array_contains(labels, x)))
        .when(_base(kind, "varchar", "char"), F.length(value) <= F.coalesce(first, F.lit(2**31 - 1)))
        .when(_base(kind, "varbinary", "binary"), F.octet_length(value) <= F.coalesce(first, F.lit(2**31 - 1)))
        .when(octets.isNotNull(), F.octet_length(value) <= octets)
        .otherwise(True)
    )


def family(kind: Column) -> Column:
    """Which typed column takes values of a source type: whole, number, approx, at or text (what fits none of the others)."""
    first, second = (F.regexp_extract(kind, _ARGUMENTS, i).try_cast("int") for i in (1, 2))
    scale = F.coalesce(second, F.lit(0))
    narrow = (scale <= 10) & (F.coalesce(first, F.lit(10)) - scale <= 28)
    return (
        F.when(_base(kind, *_BITS, "year"), "whole")
        .when(_base(kind, "decimal", "numeric", "dec", "fixed") & narrow, "number")
        .when(_base(kind, "double", "float", "real"), "approx")
        .when(_base(kind, "datetime", "timestamp", "date"), "at")
        .otherwise("text")
    )


def _same(value: Column, kind: Column) -> Column:
    """A declared type against another: a record of declared fields fits where the type is the same."""
    return value == kind


def _any(value: Column, kind: Column) -> Column:
    return F.lit(True)


Fits = Callable[[Column, Column], Column]


def ingest(records: DataFrame, targets: DataFrame, fits: Fits = holds) -> DataFrame:
    """records under a target schema: typed (the value of each of its fields, in order) and rescued (JSON or null).

    targets has the columns of FILE and fields (name and shape, or type where a field has no shape); records of a file
    without a target keep everything in `rescued`. Every value a record holds is afterwards in exactly one of the two
    columns. fits decides whether a field's type takes a value.
    """
    aimed = targets.select(*FILE, F.map_from_arrays(F.col("fields")["name"], F.col("fields")["shape"]).alias("_target"))
    joined = records.join(bounded(aimed, TARGETS), FILE, "left").withColumn("_target", F.coalesce("_target", _empty(_MAP)))
    value = lambda n: F.try_element_at("fields", n)
    typed = F.transform_values("_target", lambda n, kind: _fitting(value(n), kind, fits))
    lost = F.map_filter("fields", lambda n, v: v.isNotNull() & ~_fits(v, F.try_element_at("_target", n), fits))
    return joined.withColumns({"typed": typed, "rescued": _json(lost)}).drop("_target", "fields")


def _fits(value: Column, kind: Column, fits: Fits) -> Column:
    return F.when(kind.isNull(), False).otherwise(fits(value, kind))


def _fitting(value: Column, kind: Column, fits: Fits) -> Column:
    """The value if it fits, else null; bound once, since it is used several times."""
    return F.get(F.filter(F.array(value), lambda v: v.isNotNull() & fits(v, kind)), F.lit(0))


def _json(fields: Column) -> Column:
    return F.when(F.size(fields) > 0, F.to_json(fields))


def promote(ingested: DataFrame, approved: DataFrame, fits: Fits = holds) -> DataFrame:
    """Replays rescued values of approved fields into typed columns.

    approved: the columns of FILE, name (as rescued), target_name, target_type. A value the type holds moves from
    `rescued` to `typed` under target_name, where the column is empty or absent so far; all others stay rescued.
    """
    aim = F.struct(F.col("name").alias("key"), F.struct("target_name", "target_type").alias("value"))
    grouped = approved.dropDuplicates([*FILE, "name"]).groupBy(*FILE).agg(F.map_from_entries(F.collect_list(aim)).alias("_aims"))
    none = "map<string,struct<target_name:string,target_type:string>>"
    joined = ingested.join(grouped, FILE, "left").withColumns(
        {"_held": F.coalesce(F.from_json("rescued", _MAP), _empty(_MAP)), "_aims": F.coalesce("_aims", _empty(none))}
    )
    aimed = lambda n: F.try_element_at("_aims", n)
    moves = F.map_filter("_held", lambda n, v: _fits(v, aimed(n)["target_type"], fits) & F.try_element_at("typed", aimed(n)["target_name"]).isNull())
    joined = joined.withColumn("_moves", moves)
    moved = F.transform_keys("_moves", lambda n, _: aimed(n)["target_name"])
    taken = F.map_keys(moved)
    typed = F.map_concat(F.map_filter("typed", lambda n, _: ~F.array_contains(taken, n)), moved)
    rest = F.map_filter("_held", lambda n, _: ~F.map_contains_key("_moves", n))
    # Two names that lead to one column: the first keeps it, the others stay rescued.
    safe = joined.withColumn("_moves", F.when(F.size(F.array_distinct(F.transform(F.map_keys("_moves"), lambda n: aimed(n)["target_name"]))) < F.size("_moves"), _first_aims()).otherwise(F.col("_moves")))
    return safe.withColumns({"typed": typed, "rescued": _json(rest)}).drop("_held", "_aims", "_moves")


def _first_aims() -> Column:
    """_moves with only the first name of each target."""
    names = F.map_keys("_moves")
    aim = lambda n: F.try_element_at("_aims", n)["target_name"]
    return F.map_filter("_moves", lambda n, _: F.filter(names, lambda o: aim(o) == aim(n))[0] == n)


def _renames(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """(columns of FILE, old_name, name, old_type, type) of the fields that changed their name.

    The later file's records are ingested under the earlier file's schema, so a name that is new stands in `rescued`.
    Its values and those of the names that are gone are compared over the ids that both files hold, by a sum of hashes
    of (id, value) that adds up in any order: work grows with fields, not with pairs of fields.
    """
    pairs = pairs.where("size(gone) > 0 AND size(new) > 0")
    records = records.where("id IS NOT NULL")
    later = ingest(records, pairs.select(*FILE, F.col("old_fields").alias("fields")), _any).join(bounded(pairs.select(*FILE, "new"), TARGETS), FILE)
    picked = lambda names, fields: F.explode(F.transform(names, lambda n: F.struct(n.alias("name"), F.try_element_at(fields, n).alias("value")))).alias("f")
    new_side = later.withColumn("held", F.from_json("rescued", _MAP)).select(*FILE, "id", picked("new", "held"))
    earlier = records.withColumn("file_no", F.col("file_no") + 1).join(bounded(pairs.select(*FILE, "gone"), TARGETS), FILE)
    new_side, old_side = all_kept((new_side, "new-side"), (earlier.select(*FILE, "id", picked("gone", "fields")), "old-side"))
    once = lambda df: df.select(*FILE, "id").distinct()
    both = kept(once(new_side).intersect(once(old_side)), "shared-ids")

    def prints(side: DataFrame) -> DataFrame:
        seen = side.groupBy(*FILE, "id", F.col("f.name").alias("name")).agg(F.min("f.value").alias("value")).join(both, [*FILE, "id"], "left_semi")
        h = F.xxhash64("id", F.coalesce(F.concat(F.lit("="), "value"), F.lit("")))
        h2 = F.xxhash64(F.lit("again"), "id", F.coalesce(F.concat(F.lit("="), "value"), F.lit("")))
        prints_ = seen.groupBy(*FILE, "name").agg(F.sum(h.cast("decimal(38,0)")).alias("p1"), F.bit_xor(h2).alias("p2"), F.count(F.lit(1)).alias("n"))
        # Columns alike in all values pair off in the order of their names.
        return prints_.withColumn("nth", F.row_number().over(Window.partitionBy(*FILE, "p1", "p2", "n").orderBy("name")))

    on = [*FILE, "p1", "p2", "n", "nth"]
    matched = prints(new_side).join(prints(old_side).withColumnRenamed("name", "old_name"), on).select(*FILE, "old_name", "name")
    type_in = lambda fields, name: F.filter(fields, lambda f: f["name"] == F.col(name))[0]["type"]
    return matched.join(pairs, FILE).select(*FILE, "old_name", "name", type_in("old_fields", "old_name").alias("old_type"), type_in("fields", "name").alias("type"))


def changes(raw_structures: DataFrame, raw_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(every change between neighbouring files, the renames among them).

    Changes: db_name, table_name, file_no (the later file), change_kind (added, removed, renamed, type_changed,
    key_changed), field_name, before, after. A file whose predecessor is missing is compared with nothing. A field with
    no value in common records is a rename only if both sides have none; without a common record there is no rename.
    """
    s, records = all_kept((structures(raw_structures), "structures"), (file_records(raw_rows), "records"))
    before = s.select("db_name", "table_name", (F.col("file_no") + 1).alias("file_no"), F.col("fields").alias("old_fields"), F.col("key").alias("old_key"))
    # Declared fields as a record under the schema before: what it doesn't know, or knows under another type, is rescued.
    declared = s.withColumns({"declared": "fields", "fields": F.map_from_arrays(F.col("fields")["name"], F.col("fields")["type"])})
    plain = F.transform("old_fields", lambda f: F.struct(f["name"].alias("name"), f["type"].alias("shape")))
    held = ingest(declared.join(before, FILE), before.select(*FILE, plain.alias("fields")), _same)
    rest, was = F.coalesce(F.from_json("rescued", _MAP), _empty(_MAP)), F.map_from_arrays(F.col("old_fields")["name"], F.col("old_fields")["type"])
    held = held.withColumns({"rest": rest, "was": was})
    held = held.withColumns(
        {
            "gone": F.map_keys(F.map_filter("typed", lambda n, v: v.isNull() & ~F.map_contains_key("rest", n))),
            "new": F.map_keys(F.map_filter("rest", lambda n, _: ~F.map_contains_key("was", n))),
        }
    ).drop("rest")
    held = kept(held, "file-pairs")
    renames = kept(_renames(held.select(*FILE, F.col("declared").alias("fields"), "old_fields", "gone", "new"), records), "renames")
    # A renamed field is approved for the column of its old name, so its declared type moves there.
    approved = renames.select(*FILE, "name", F.col("old_name").alias("target_name"), F.col("type").alias("target_type"))
    known = renames.groupBy(*FILE).agg(F.collect_list(F.struct("old_name", "name")).alias("moved"))
    replayed = promote(held.drop("gone", "new"), approved, _same).join(known, FILE, "left")
    replayed = replayed.withColumns({"rest": rest, "moved": F.coalesce("moved", F.expr("array()").cast("array<struct<old_name:string,name:string>>"))})
    change = lambda kind, name, a, b: F.struct(F.lit(kind).alias("change_kind"), name.alias("field_name"), a.alias("before"), b.alias("after"))
    nothing, in_was = F.lit(None).cast("string"), lambda n: F.try_element_at("was", n)
    listed = lambda m: F.map_keys(m)
    added = F.transform(listed(F.map_filter("rest", lambda n, _: ~F.map_contains_key("was", n))), lambda n: change("added", n, nothing, F.try_element_at("rest", n)))
    removed = F.transform(listed(F.map_filter("typed", lambda n, v: v.isNull() & ~F.map_contains_key("rest", n))), lambda n: change("removed", n, in_was(n), nothing))
    renamed = F.transform("moved", lambda m: change("renamed", m["name"], m["old_name"], m["name"]))
    at_old = lambda m: F.try_element_at("typed", m["old_name"])
    retyped = F.transform(F.filter("moved", lambda m: at_old(m) != in_was(m["old_name"])), lambda m: change("type_changed", m["name"], in_was(m["old_name"]), at_old(m)))
    typed = F.transform(listed(F.map_filter("rest", lambda n, _: F.map_contains_key("was", n))), lambda n: change("type_changed", n, in_was(n), F.try_element_at("rest", n)))
    now = F.transform("old_key", lambda k: F.coalesce(F.get(F.filter("moved", lambda m: m["old_name"] == k)["name"], F.lit(0)), k))
    keyed = F.when(now != F.col("key"), F.array(change("key_changed", F.array_join("key", ","), F.array_join("old_key", ","), F.array_join("key", ",")))).otherwise(
        F.array().cast("array<struct<change_kind:string,field_name:string,before:string,after:string>>")
    )
    every = replayed.select(*FILE, F.explode(F.concat(added, removed, renamed, retyped, typed, keyed)).alias("c"))
    return every.select(*FILE, "c.change_kind", "c.field_name", "c.before", "c.after"), renames


def consistent_table(raw_structures: DataFrame, raw_rows: DataFrame) -> DataFrame:
    """All records of all files under the last file's schema of their table.

    db_name, table_name, file_no, line_no, id, typed (the final schema's values by name, as text), rescued (JSON of values
    that schema has no field or no type for), shapes (the final schema's types by name), and the typed columns: maps by name
    of the values as whole (decimal(38,0)), number (decimal(38,10)), approx (double), at (timestamp_ntz) and text. wide()
    makes a column per field of one table's rows. Each record is rescued whole, then each field that its own file declares
    and the final schema still has, under whatever name, is promoted into the final column where that holds its value.
    """
    _, renames = changes(raw_structures, raw_rows)
    s = kept(structures(raw_structures), "structures")
    last = s.groupBy("db_name", "table_name").agg(F.max_by(F.col("fields"), F.col("file_no")).alias("final"))
    # A table's renames are a few per file; names are carried to the end file by file inside one row.
    moved = renames.groupBy("db_name", "table_name").agg(
        F.array_sort(F.collect_list(F.struct("file_no", "old_name", "name"))).alias("moves")
    )
    files = s.join(moved, ["db_name", "table_name"], "left").join(last, ["db_name", "table_name"])
    moves = F.coalesce("moves", F.expr("array()").cast("array<struct<file_no:int,old_name:string,name:string>>"))
    files = files.withColumn("moves", F.filter(moves, lambda m: m["file_no"] > F.col("file_no")))
    carried = files.select(*FILE, "final", "moves", F.explode("fields").alias("f")).withColumn(
        "target_name",
        F.aggregate("moves", F.col("f.name"), lambda name, m: F.when(m["old_name"] == name, m["name"]).otherwise(name)),
    )
    at_end = F.get(F.filter("final", lambda f: f["name"] == F.col("target_name"))["shape"], F.lit(0))
    approved = carried.select(*FILE, F.col("f.name").alias("name"), "target_name", at_end.alias("target_type")).where("target_type IS NOT NULL")
    # The target starts without the fields, so everything is rescued first and what is approved is replayed.
    empty = s.select(*FILE, F.expr("array()").cast(_TYPES).alias("fields"))
    replayed = promote(ingest(file_records(raw_rows), empty), approved).join(last, ["db_name", "table_name"], "left")
    wide_ = F.transform_values(F.map_from_entries(F.transform("final", lambda f: F.struct(f["name"], f["shape"]))), lambda n, _: F.try_element_at("typed", n))
    shapes = F.map_from_arrays(F.col("final")["name"], F.col("final")["shape"])
    out = replayed.withColumns({"typed": F.coalesce(wide_, "typed"), "shapes": F.coalesce(shapes, _empty(_MAP))}).drop("final")
    of = lambda name, kind: F.transform_values(F.map_filter("typed", lambda n, v: v.isNotNull() & (family(F.try_element_at("shapes", n)) == name)), lambda _, v: _cast(v, kind))
    return out.withColumns({name: of(name, kind) for name, kind in _FAMILIES.items()})


def _cast(value: Column, kind: str) -> Column:
    """Text as a typed value; 6401.0 is a whole number."""
    return value.try_cast("decimal(38,10)").cast(kind) if kind == "decimal(38,0)" else value.try_cast(kind)


def wide(consistent: DataFrame, db: str, table: str, fields: Sequence[tuple[str, str]]) -> DataFrame:
    """One table's rows of consistent_table() with a column of the Spark type per field (name, source type) and what else
    they hold: file_no, line_no, rescued. The fields are those of one schema, a few names."""
    mine = consistent.where((F.col("db_name") == db) & (F.col("table_name") == table))

    def column(name: str, kind: str) -> Column:
        spark_type = SourceType.parse(kind).spark()
        text = F.try_element_at("typed", F.lit(name))
        small = spark_type.simpleString() in ("tinyint", "smallint", "int", "bigint")
        return (text.try_cast("decimal(38,10)") if small else text).try_cast(spark_type).alias(name)

    return mine.select("file_no", "line_no", *[column(n, k) for n, k in fields], "rescued")
