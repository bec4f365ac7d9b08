"""The given test tables seen as news, prices and dictionaries.

The tables are synthetic and not about finance. A document stands for an article (its source for
the ticker, its first sentence for the title), the events of a user group and day for a daily bar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsvane.dictionaries import LEMMAS, STOPWORDS
from newsvane.functions.text import lemmatize, tokenize
from newsvane.operators.news import normalize_news

FIRST_DAY = "2024-01-01"
FIRST_DAY_SECONDS = 1_704_067_200
DAYS = 30
TICKERS = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# How many pieces the test tables are cut into as they are read; unset, they stay as they lie.
PIECES = "spark.newsvane.inputPieces"


def spread(df: DataFrame, key: str) -> DataFrame:
    """Cut a test table that is one file of one row group, if the session asks for it.

    A table of many files needs no cutting and no shuffle before its first stage, so the setting is
    left alone but on one machine with many cores.
    """
    pieces = df.sparkSession.conf.get(PIECES, None)
    return df.repartition(int(pieces), key) if pieces else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def raw_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ticker, id, headline, summary, datetime): flat news as the feed delivers it."""
    day = F.expr(f"doc_id div {TICKERS}") % DAYS
    seconds = F.lit(FIRST_DAY_SECONDS) + day * 86_400 + (F.col("doc_id") * 37) % 86_400
    return documents(spark, sf_dir).select(
        F.col("source").alias("ticker"),
        F.col("doc_id").alias("id"),
        F.substring_index("text", ".", 1).alias("headline"),
        F.col("text").alias("summary"),
        seconds.alias("datetime"),
    )


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    normalized = normalize_news(raw_news(spark, sf_dir))
    return normalized.withColumn("trade_date", F.to_date("published_at"))


def tokenized_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News with the token lists of both fields."""
    return news(spark, sf_dir).select(
        "*",
        tokenize("title", STOPWORDS).alias("title_tokens"),
        tokenize("summary", STOPWORDS).alias("summary_tokens"),
    )


def nlp_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokenised news with the lemma lists of both fields."""
    return tokenized_news(spark, sf_dir).select(
        "*",
        lemmatize(F.col("title_tokens"), LEMMAS).alias("title_lemmas"),
        lemmatize(F.col("summary_tokens"), LEMMAS).alias("summary_lemmas"),
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar per ticker and day. Opening and closing value by time, equal times by event."""
    events = table(spark, sf_dir, "events")
    # One sortable number, so the aggregate stays a hash aggregate.
    moment = F.unix_micros(F.col("ts").cast("timestamp")).cast("decimal(38,0)") * F.expr(
        "CAST(10000000000000000000 AS DECIMAL(20,0))"
    ) + F.col("event_id").cast("decimal(38,0)")
    return (
        events.select(
            F.concat(F.lit("src"), F.col("user_id") % TICKERS).alias("ticker"),
            F.to_date("ts").alias("trade_date"),
            "value",
            moment.alias("moment"),
        )
        .groupBy("ticker", "trade_date")
        .agg(
            F.min_by("value", "moment").alias("open_price"),
            F.max("value").alias("high_price"),
            F.min("value").alias("low_price"),
            F.max_by("value", "moment").alias("close_price"),
            F.count("*").alias("volume"),
        )
    )
