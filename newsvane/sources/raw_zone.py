"""The raw zone: dated JSON files per ticker, and landing fetched payloads there."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsvane.operators.news import explode_articles, ticker_from_path

NEWS, MARKET = "news", "market"

NEWS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("headline", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("datetime", T.LongType()),
    ]
)
MARKET_SCHEMA = T.StructType(
    [
        T.StructField("Date", T.StringType()),
        *[T.StructField(c, T.DoubleType()) for c in ("Open", "High", "Low", "Close")],
        T.StructField("Volume", T.LongType()),
        *[T.StructField(c, T.DoubleType()) for c in ("Dividends", "Stock Splits", "Capital Gains")],
    ]
)
SCHEMAS = {NEWS: NEWS_SCHEMA, MARKET: MARKET_SCHEMA}


def _with_ticker(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(ticker_from_path(F.col("_metadata.file_path")).alias("ticker"), *[f"`{c}`" for c in columns])


def read_daily(spark: SparkSession, zone: str, kind: str, run_date: dt.date) -> DataFrame:
    """All files of one kind and day, `<zone>/<kind>/YYYY/MM/DD/<TICKER>.json`, each an array of records.

    Such a file cannot be split, so one large file is one scan task. The jobs shuffle the rows by
    ticker and id before any work on the text, which then no longer depends on a file's size.
    """
    schema = SCHEMAS[kind]
    files = spark.read.schema(schema).option("multiLine", True).json(
        f"{zone}/{kind}/{run_date:%Y/%m/%d}/*.json"
    )
    return _with_ticker(files, schema.names)


def read_history(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Every JSON file below a folder; records that do not parse are dropped."""
    schema = SCHEMAS[kind]
    files = (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("mode", "DROPMALFORMED")
        .json(path)
    )
    return _with_ticker(files, schema.names)


def read_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Every JSON file below a folder without a given schema: (file, place, record) and (file, place, reason).

    A file holds an array of records or one record. What is no record goes to the second table: a
    file that is no JSON or too large for one value (place null), an entry that is no object. A file is one value
    and one row of the first step; an empty array has neither records nor rejects.
    """
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    values = files.select(F.col("_metadata.file_path").alias("file"), F.try_parse_json("value").alias("v"))
    entries = F.expr(
        "CASE WHEN schema_of_variant(v) LIKE 'ARRAY%' THEN try_variant_get(v, '$', 'array<variant>') ELSE array(v) END"
    )
    rows = values.where("v IS NOT NULL").select("file", F.posexplode(entries).alias("place", "record"))
    is_object = F.schema_of_variant("record").like("OBJECT%")
    unread = values.where("v IS NULL").select(
        "file", F.lit(None).cast("int").alias("place"), F.lit("no JSON, or too large").alias("reason")
    )
    strange = rows.where(~F.coalesce(is_object, F.lit(False))).select("file", "place", F.lit("no object").alias("reason"))
    return rows.where(is_object), unread.unionByName(strange)


# Parts of an inferred schema: quoted names stay as they are, the rest becomes a table's types.
_TYPES = re.compile(r"`(?:[^`]|``)*`|\bOBJECT<|\bDECIMAL\(\d+,\s*\d+\)|(?<=[<:\s])(?:VOID|VARIANT)\b(?!:)")


def inferred_schema(records: DataFrame) -> str:
    """The type that holds all records, found by one aggregate over them.

    Fields that are missing in some records are there, numbers with a fraction are doubles, and what
    is of several kinds, or always null, is text.
    """
    found = records.agg(F.schema_of_variant_agg("record")).first()[0] or "OBJECT<>"

    def kind(match: re.Match) -> str:
        part = match.group()
        if part.startswith("`"):
            return part
        return "STRUCT<" if part.startswith("OBJECT") else "DOUBLE" if part.startswith("DECIMAL") else "STRING"

    return _TYPES.sub(kind, found)


def read_inferred(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Records as columns of the schema inferred from all files, with their ticker, and the rejects of `read_records`."""
    records, rejects = read_records(spark, path)
    made = F.try_variant_get("record", "$", inferred_schema(records)).alias("r")
    return records.select(ticker_from_path(F.col("file")).alias("ticker"), made).select("ticker", "r.*"), rejects


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """Files holding one JSON array of nested articles each, as rows (ticker, uuid, title, ...).

    A whole file is one value, as the feed delivers it, so a file must stay well below 2 GB; the feed
    splits by ticker and day. The articles are dealt out anew as soon as they are rows, so work on
    them does not depend on a file's size.
    """
    files = spark.read.text(path, wholetext=True)
    named = files.select(ticker_from_path(F.col("_metadata.file_path")).alias("ticker"), "value")
    return explode_articles(named, "value", "ticker").hint("rebalance")


def list_files(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """Files below a folder with size and time; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
    )
    return files.select("path", "length", "modificationTime")


def land(df: DataFrame, zone: str, records_per_file: int = 1_000_000) -> None:
    """Write fetched records as JSON lines below kind, run date and ticker.

    Landing a day again replaces that day's folders only. Rebalancing lets Spark split the folder
    of a hot ticker over several tasks.
    """
    keys = ("kind", "run_date", "ticker")
    balanced = df.hint("rebalance", *keys)
    (
        balanced.write.partitionBy(*keys)
        .option("maxRecordsPerFile", records_per_file)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .json(zone)
    )


def read_landed(spark: SparkSession, zone: str, kind: str) -> DataFrame:
    """Landed records of one kind with their run date and ticker; other folders are pruned."""
    schema = T.StructType(
        [
            *SCHEMAS[kind].fields,
            T.StructField("kind", T.StringType()),
            T.StructField("run_date", T.DateType()),
            T.StructField("ticker", T.StringType()),
        ]
    )
    return spark.read.schema(schema).json(zone).where(F.col("kind") == kind).drop("kind")
