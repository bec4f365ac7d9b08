"""Incremental ingest: every new raw file is normalised, tokenised, scored and stored once.

Which articles are known is keyed state of the stream, in Spark's state store: no batch reads the
tables it writes. An article that comes again, in the same batch, the next day or months later, is
dropped by the state of its (ticker, id); the state is forgotten when the article has not come for
a horizon longer than any fetch window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from newsvane.config import Thresholds
from newsvane.operators.news import normalize_news, ticker_from_path
from newsvane.plans.daily import Lemmas, analyse_news, score_articles
from newsvane.sources.raw_zone import NEWS_SCHEMA
from newsvane.sources.tables import write_partitions

RUN_DATE_IN_PATH = r"/(\d{4})/(\d{2})/(\d{2})/[^/]+\.json$"
# The longest fetch window is 365 days; state lives longer than that after an article was last met.
HORIZON_MS = 400 * 86_400_000
ARRIVED = "__arrived"


def news_stream(spark: SparkSession, path: str, files_per_batch: int = 10_000) -> DataFrame:
    """New files below ``path`` (a glob of dated folders) as a stream of raw news with its run date."""
    files = (
        spark.readStream.schema(NEWS_SCHEMA)
        .option("multiLine", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )
    file = F.col("_metadata.file_path")
    parts = [F.regexp_extract(file, RUN_DATE_IN_PATH, i) for i in (1, 2, 3)]
    return files.select(
        ticker_from_path(file).alias("ticker"), *NEWS_SCHEMA.names,
        F.to_date(F.concat_ws("-", *parts)).alias("run_date"),
    )


def _latest(rows: pd.DataFrame) -> pd.DataFrame:
    """The row of the last run, then of the last publication; equals by their texts."""
    def place(i: int) -> tuple:
        row = rows.iloc[i]
        run, published = row["run_date"], row["datetime"]
        return (str(run), -1 if pd.isna(published) else int(published), str(row["headline"]), str(row["summary"]))

    return rows.iloc[[max(range(len(rows)), key=place)]]


def _first_seen(horizon_ms: int) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        if any(pd.isna(part) for part in key):
            # Without a whole key rows are no copies of each other.
            for rows in batches:
                yield rows.drop(columns=ARRIVED)
            return
        best = None
        for rows in batches:
            best = _latest(rows if best is None else pd.concat([best, rows]))
        known = state.exists
        now = int(state.getCurrentProcessingTimeMs())
        state.update((now,))
        state.setTimeoutTimestamp(now + horizon_ms)
        if best is not None and not known:
            yield best.drop(columns=ARRIVED)

    return run


def unseen_articles(news: DataFrame, horizon_ms: int = HORIZON_MS) -> DataFrame:
    """A stream's articles (ticker, id, ...) that it has not met before, once each.

    Of several rows of an article in one batch the latest goes on, whatever order they come in. Rows
    without a ticker or id all go on. State is one number per article; it is refreshed whenever the
    article comes and expires ``horizon_ms`` later. The stream's time is when rows arrive, not a date
    they carry, so no row is ever late and dropped for that.
    """
    # Timeouts by the clock alone would let a run over all available files go on for ever.
    arriving = news.withColumn(ARRIVED, F.current_timestamp()).withWatermark(ARRIVED, "0 seconds")
    return arriving.groupBy("ticker", "id").applyInPandasWithState(
        _first_seen(horizon_ms), news.schema, "met long", "append", GroupStateTimeout.EventTimeTimeout
    )


@dataclass(frozen=True)
class Scoring:
    """Where scores go and what they are made with."""

    table: str
    lexicon: DataFrame
    modifiers: DataFrame
    cuts: Thresholds = Thresholds()


def store_batch(
    batch: DataFrame, batch_id: int, table: str, stopwords: Iterable[str], lemmas: Lemmas, scoring: Scoring | None = None,
) -> int:
    """Store the new articles of a batch and, if asked for, their scores; returns the articles.

    The batch writes only partitions that carry its own number, so running it again after a failure
    replaces its first attempt and leaves all other batches alone. Neither table is read.
    """
    number = F.lit(batch_id).cast("bigint").alias("batch_id")
    analysed = analyse_news(normalize_news(batch, "run_date"), stopwords, lemmas, "run_date").select("*", number)
    if scoring is None:
        return write_partitions(analysed, table, ["run_date", "batch_id"])
    # Read twice: for the articles and for their scores.
    held = analysed.persist()
    try:
        stored = write_partitions(held, table, ["run_date", "batch_id"])
        scores = score_articles(held, scoring.lexicon, scoring.modifiers, scoring.cuts, "run_date", "batch_id")
        write_partitions(scores, scoring.table, ["run_date", "batch_id"])
        return stored
    finally:
        held.unpersist()


def ingest_available(
    spark: SparkSession, path: str, table: str, checkpoint: str,
    stopwords: Iterable[str], lemmas: Lemmas, scoring: Scoring | None = None, horizon_ms: int = HORIZON_MS,
) -> StreamingQuery:
    """Process everything that has arrived since the last run, then stop."""
    return (
        unseen_articles(news_stream(spark, path), horizon_ms)
        .writeStream.foreachBatch(lambda df, n: store_batch(df, n, table, stopwords, lemmas, scoring) and None)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
