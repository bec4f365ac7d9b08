"""Daily sentiment, rolling statistics and trading signals.

Every window here runs over one row per ticker and day (or per day), so a partition is bounded by
the calendar however many articles a ticker has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsvane.config import SignalSettings
from newsvane.functions.numeric import from_micros, micros_sql, round_sql, round_to, to_micros


def daily_sentiment(scored: DataFrame, prices: DataFrame, score: str) -> DataFrame:
    """Mean score and article count per ticker and trading day, with the day's close.

    The articles are summed before the join: the price table meets one row per ticker and day.
    """
    per_day = scored.groupBy("ticker", "trade_date").agg(
        F.expr(f"sum({micros_sql(score)}) AS total"), F.count("*").alias("news_count")
    )
    bars = prices.select("ticker", "trade_date", "close_price")
    return per_day.join(bars, ["ticker", "trade_date"], "inner").selectExpr(
        "ticker", "trade_date", "close_price",
        f"{round_sql('total / news_count / 1e6D', 6)} AS avg_score", "news_count",
    )


def market_daily_sentiment(daily: DataFrame) -> DataFrame:
    """All tickers of a day together: news-weighted mean score and mean close."""
    weighted = F.sum(to_micros(F.col("avg_score")) * F.col("news_count"))
    closes = F.sum(to_micros(F.col("close_price")))
    return daily.groupBy("trade_date").agg(
        round_to(from_micros(closes / F.count("*")), 6).alias("close_price"),
        round_to(from_micros(weighted / F.sum("news_count")), 6).alias("avg_score"),
        F.sum("news_count").alias("news_count"),
    )


def rolling_statistics(
    daily: DataFrame, partition: Sequence[str] = ("ticker",), settings: SignalSettings = SignalSettings()
) -> DataFrame:
    """Moving average of the close and z-score of the sentiment over the last rows with news.

    One window specification, so Spark sorts once and evaluates all sums in one pass. The sample
    deviation comes from integer sums: null for one row, exactly 0 for equal values.
    """
    by = f"PARTITION BY {', '.join(partition)}" if partition else ""
    last = settings.window_rows - 1
    frame = f"({by} ORDER BY trade_date ROWS BETWEEN {last} PRECEDING AND CURRENT ROW)"
    score, close = micros_sql("avg_score"), micros_sql("close_price")
    sums = daily.selectExpr(
        "*",
        f"count(*) OVER {frame} AS n_",
        f"sum({close}) OVER {frame} AS close_",
        f"sum({score}) OVER {frame} AS score_",
        f"sum({score} * {score}) OVER {frame} AS squares_",
    )
    z = f"({score} - score_ / n_) / CASE WHEN std_ = 0 THEN 1D ELSE std_ END"
    return sums.selectExpr(
        "*",
        "CASE WHEN n_ > 1 THEN sqrt((n_ * squares_ - score_ * score_) / (n_ * (n_ - 1))) END AS std_",
        f"{round_sql('close_ / n_ / 1e6D', 6)} AS sma_20",
        f"{round_sql('score_ / n_ / 1e6D', 6)} AS sentiment_mean_20",
        f"{round_sql('std_ / 1e6D', 6)} AS sentiment_std_20",
        f"{round_sql(z, 6)} AS sentiment_z_score",
    ).drop("n_", "close_", "score_", "squares_", "std_")


def signal_column(settings: SignalSettings = SignalSettings()) -> Column:
    close, sma, z = F.col("close_price"), F.col("sma_20"), F.col("sentiment_z_score")
    return (
        F.when((close > sma) & (z > settings.z_threshold), 1)
        .when((close < sma) & (z < -settings.z_threshold), -1)
        .otherwise(0)
    )


def trading_signals(
    scored: DataFrame, prices: DataFrame, score: str, settings: SignalSettings = SignalSettings()
) -> DataFrame:
    """Signals per ticker and day. The first row of a ticker has no deviation and is left out."""
    rolled = rolling_statistics(daily_sentiment(scored, prices, score), settings=settings)
    return (
        rolled.withColumn("signal", signal_column(settings))
        .dropna(subset=["sma_20", "sentiment_z_score"])
        .select(
            "ticker", "trade_date", "close_price", "sma_20",
            F.col("avg_score").alias("avg_vader_score"),
            "sentiment_z_score", "news_count", "signal",
        )
    )


def signal_chart_data(signals: DataFrame, settings: SignalSettings = SignalSettings()) -> DataFrame:
    """What a price-and-signal chart of a ticker plots, one row per bar."""
    ticker = Window.partitionBy("ticker")
    close = F.col("close_price")
    offset = from_micros(F.sum(to_micros(close)).over(ticker) / F.count("*").over(ticker)) * 0.02
    return (
        signals.withColumn("__offset", offset)
        .withColumn(
            "band",
            F.when(close > F.col("sma_20"), "above").when(close < F.col("sma_20"), "below"),
        )
        .withColumn(
            "marker",
            F.when(F.col("signal") == 1, "buy").when(F.col("signal") == -1, "sell"),
        )
        .withColumn(
            "marker_price",
            F.when(F.col("signal") == 1, round_to(close - F.col("__offset"), 6)).when(
                F.col("signal") == -1, round_to(close + F.col("__offset"), 6)
            ),
        )
        .withColumn("z_colour", F.when(F.col("sentiment_z_score") > 0, "green").otherwise("red"))
        .withColumn("z_upper", F.lit(settings.z_threshold))
        .withColumn("z_lower", F.lit(-settings.z_threshold))
        .drop("__offset")
    )
