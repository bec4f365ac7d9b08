"""Catalog tables: daily idempotent writes, atomic rebuilds, exports.

A table that is rebuilt as a whole is a view over its newest version. A rebuild writes a version of
its own and then points the view at it, in one catalog operation, so a reader finds the old version
or the new one and never none.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ROWS = "rows"


def create_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


VERSION = "__version_"


def list_tables(spark: SparkSession, database: str) -> list[str]:
    """Names that readers use; versions behind views are left out."""
    return sorted(t.name for t in spark.catalog.listTables(database) if VERSION not in t.name and not t.isTemporary)


def preview(spark: SparkSession, table: str, rows: int = 5) -> DataFrame:
    return spark.sql(f"SELECT * FROM {table} LIMIT {int(rows)}")


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows while they are written; reading the count afterwards runs no second job."""
    watch = Observation(name)
    return df.observe(watch, F.count(F.lit(1)).alias(ROWS)), watch


def write_partitions(
    df: DataFrame, table: str, partition: Sequence[str], table_format: str = "parquet"
) -> int:
    """Write the partitions present in ``df``, replacing just those. Running a day twice changes nothing.

    Rows are rebalanced by partition and ticker: files stay of a useful size and a hot ticker is
    split over tasks.
    """
    spark = df.sparkSession
    by = [*partition, *(["ticker"] if "ticker" in df.columns else [])]
    watched, watch = observed(df.hint("rebalance", *by), f"write {table}")
    if spark.catalog.tableExists(table):
        columns = spark.read.table(table).columns
        # A write into the table's folder takes the option of its own, so the session is left as it is.
        watched.select(*columns).write.format(table_format).mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(*partition).save(_described(spark, table)["Location"])
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
        spark.catalog.refreshTable(table)
    else:
        watched.write.format(table_format).partitionBy(*partition).saveAsTable(table)
    return watch.get[ROWS]


def write_day(df: DataFrame, table: str, run_date: dt.date, table_format: str = "parquet") -> int:
    return write_partitions(df.withColumn("run_date", F.lit(run_date)), table, ["run_date"], table_format)


def read_day(spark: SparkSession, table: str, run_date: dt.date) -> DataFrame:
    return spark.read.table(table).where(F.col("run_date") == F.lit(run_date))


def replace_table(df: DataFrame, table: str, table_format: str = "parquet") -> int:
    """Rebuild a whole table; whatever fails, the old one stays readable.

    The version before the new one is kept, for readers that have begun with it; older ones go. A
    plain table of that name becomes a version itself, which is the one time that it has no name for
    a moment.
    """
    spark = df.sparkSession
    watched, watch = observed(df, f"replace {table}")
    version = f"{table}{VERSION}{uuid.uuid4().hex}"
    watched.write.format(table_format).saveAsTable(version)
    old = None
    if spark.catalog.tableExists(table):
        if spark.catalog.getTable(table).tableType == "VIEW":
            old = _version_behind(spark, table)
        else:
            old = f"{table}{VERSION}first"
            spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {version}")
    database, _, name = table.rpartition(".")
    for found in spark.catalog.listTables(database or None):
        full = f"{database}.{found.name}" if database else found.name
        if found.name.startswith(name + VERSION) and full not in (version, old):
            spark.sql(f"DROP TABLE {full}")
    return watch.get[ROWS]


def _version_behind(spark: SparkSession, view: str) -> str:
    return _described(spark, view)["View Text"].rpartition(" ")[2]


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str, single_row: bool = False) -> None:
    """A report as CSV with a header. Only a one-row summary is put into a single file."""
    (df.coalesce(1) if single_row else df).write.mode("overwrite").option("header", True).csv(path)
