"""What a source has: its databases, base tables and log files, and the CREATE statements of tables, over JDBC or from given
rows.

The functions that choose work on DataFrames with the columns of a source's INFORMATION_SCHEMA, so a catalogue may as well
come from a file. Reading over JDBC needs the driver's jar.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.config import Settings
from tidelog.functions.names import file_number

#: Databases of the source itself.
OWN = ("information_schema", "mysql", "performance_schema", "sys")
TABLES = "SELECT TABLE_SCHEMA, TABLE_NAME, TABLE_TYPE FROM INFORMATION_SCHEMA.TABLES"


def jdbc_query(spark: SparkSession, url: str, sql: str, **options: str) -> DataFrame:
    """The rows of a statement that the source runs."""
    return spark.read.format("jdbc").options(url=url, query=sql, **options).load()


def base_tables(tables: DataFrame, settings: Settings | None = None) -> DataFrame:
    """(db_name, table_name) of base tables, views and the source's own databases aside, that the settings select."""
    rows = tables.where((F.upper("TABLE_TYPE") == "BASE TABLE") & ~F.lower("TABLE_SCHEMA").isin(*OWN)).select(
        F.col("TABLE_SCHEMA").alias("db_name"), F.col("TABLE_NAME").alias("table_name")
    )
    if settings:
        rows = rows.where(settings.database_selected("db_name") & settings.table_selected("table_name"))
    return rows


def databases(tables: DataFrame, settings: Settings | None = None) -> DataFrame:
    """(db_name, tables) of the databases that have selected base tables."""
    return base_tables(tables, settings).groupBy("db_name").agg(F.count(F.lit(1)).alias("tables"))


def log_files(files: DataFrame) -> DataFrame:
    """(file, file_no, size) of SHOW BINARY LOGS' rows (Log_name, File_size), in numeric order."""
    rows = files.select(F.col("Log_name").alias("file"), file_number("Log_name").alias("file_no"), F.col("File_size").cast("bigint").alias("size"))
    return rows.orderBy("file_no")


def create_text(columns: DataFrame, db: str, table: str) -> str:
    """A CREATE statement from the rows of INFORMATION_SCHEMA.COLUMNS, as many as the table has columns."""
    mine = columns.where((F.col("TABLE_SCHEMA") == db) & (F.col("TABLE_NAME") == table)).orderBy("ORDINAL_POSITION")
    rows = mine.select("COLUMN_NAME", "COLUMN_TYPE", "IS_NULLABLE", "COLUMN_KEY").collect()
    name = lambda x: "`" + x.replace("`", "``") + "`"
    lines = [f"{name(r.COLUMN_NAME)} {r.COLUMN_TYPE}" + (" NOT NULL" if r.IS_NULLABLE == "NO" else "") for r in rows]
    key = [name(r.COLUMN_NAME) for r in rows if r.COLUMN_KEY == "PRI"]
    return f"CREATE TABLE {name(db)}.{name(table)} ({', '.join([*lines, *([f'PRIMARY KEY ({chr(44).join(key)})'] if key else [])])})"


def pending(wanted: DataFrame, had: DataFrame) -> Iterator[tuple[str, str]]:
    """(database, table) of tables that are wanted and not had yet, such as those a replica must still copy."""
    rows = wanted.select("db_name", "table_name").distinct().exceptAll(had.select("db_name", "table_name").distinct())
    for r in rows.orderBy("db_name", "table_name").toLocalIterator():
        yield r.db_name, r.table_name
