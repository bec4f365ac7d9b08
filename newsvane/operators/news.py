"""News and price records: normalising, flattening, joining."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsvane.functions.numeric import from_micros, round_to, to_micros
from newsvane.functions.text import html_to_text
from newsvane.operators.ranking import latest_per_key

ARTICLE_SCHEMA = (
    "array<struct<id:string,content:struct<id:string,title:string,summary:string,pubDate:string>>>"
)


def normalize_news(raw: DataFrame, *keep: str) -> DataFrame:
    """Raw flat news (ticker, id, headline, summary, datetime in epoch seconds)."""
    return raw.select(
        "ticker",
        "id",
        F.col("headline").alias("title"),
        "summary",
        F.timestamp_seconds("datetime").alias("published_at"),
        *keep,
    )


def normalize_market(raw: DataFrame) -> DataFrame:
    """Raw daily bars with capitalised names and the date as text; a malformed date becomes null."""
    return raw.select(
        "ticker",
        F.expr("try_to_date(`Date`)").alias("trade_date"),
        F.col("Open").alias("open_price"),
        F.col("High").alias("high_price"),
        F.col("Low").alias("low_price"),
        F.col("Close").alias("close_price"),
        F.col("Volume").alias("volume"),
    )


def normalize_market_history(raw: DataFrame) -> DataFrame:
    """Older daily bars, which also carry corporate actions under names with blanks."""
    actions = (("Dividends", "dividends"), ("Stock Splits", "stock_splits"), ("Capital Gains", "capital_gains"))
    present = [F.col(f"`{old}`").alias(new) for old, new in actions if old in raw.columns]
    return raw.select(
        *(["ticker"] if "ticker" in raw.columns else []),
        F.expr("try_to_date(`Date`)").alias("trade_date"),
        *[F.col(c).alias(c.lower()) for c in ("Open", "High", "Low", "Close", "Volume")],
        *present,
    )


def explode_articles(df: DataFrame, json_column: str, *keep: str) -> DataFrame:
    """A column holding a JSON array of nested articles, one output row per article."""
    articles = F.from_json(F.col(json_column), ARTICLE_SCHEMA)
    article = df.select(*keep, F.explode_outer(articles).alias("a"))
    return article.select(
        *keep,
        F.col("a.content.id").alias("uuid"),
        F.col("a.content.title").alias("title"),
        F.col("a.content.summary").alias("summary"),
        F.col("a.content.pubDate").alias("published"),
    ).dropna(subset=["uuid", "published"])


def ticker_from_path(path: Column, extension: str = "json") -> Column:
    """Last path segment without its extension."""
    return F.regexp_extract(path, rf"([^/]+)\.{extension}$", 1)


def market_symbol(symbol: Column) -> Column:
    """Share classes are written with a dash by the price feed."""
    return F.replace(symbol, F.lit("."), F.lit("-"))


def fetch_plan(symbols: DataFrame, run_date: dt.date, days: int = 365, step: int = 30) -> DataFrame:
    """Windows to request per symbol, newest first; neighbouring windows share their end date."""
    end, start = F.lit(run_date), F.date_sub(F.lit(run_date), days)
    steps = F.sequence(F.lit(0), F.lit((days - 1) // step))
    return symbols.select("symbol", F.posexplode(steps).alias("chunk", "n")).select(
        "symbol",
        "chunk",
        F.greatest(F.date_sub(end, (F.col("n") + 1) * step), start).alias("from_date"),
        F.date_sub(end, F.col("n") * step).alias("to_date"),
    )


def merged_windows(windows: DataFrame) -> DataFrame:
    """(symbol, from_date, to_date): windows of whole days joined where they overlap or touch."""
    by_start = Window.partitionBy("symbol").orderBy("from_date", "to_date")
    reached = F.max("to_date").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    first = F.when(reached.isNull() | (F.col("from_date") > F.date_add(reached, 1)), 1).otherwise(0)
    # Windows that end before they start, or lack an end, hold no day.
    whole = windows.where("symbol IS NOT NULL AND from_date <= to_date").select("symbol", "from_date", "to_date").distinct()
    numbered = whole.withColumn("first", first).withColumn("island", F.sum("first").over(by_start))
    return numbered.groupBy("symbol", "island").agg(
        F.min("from_date").alias("from_date"), F.max("to_date").alias("to_date")
    ).drop("island")


def fetch_gaps(plan: DataFrame, landed: DataFrame) -> DataFrame:
    """(symbol, from_date, to_date): the days of ``plan`` that no landed window holds, as windows.

    Both are (symbol, from_date, to_date) with both ends included, in any order, overlapping or not.
    The days between a symbol's landed windows, and before and after them, are laid over its wanted
    ones; a symbol of which nothing landed keeps all it wants.
    """
    by_start = Window.partitionBy("symbol").orderBy("from_date")
    early, late = F.lit("0001-01-02").cast("date"), F.lit("9999-12-30").cast("date")
    held = merged_windows(landed)
    before = held.select(
        "symbol", F.coalesce(F.date_add(F.lag("to_date").over(by_start), 1), early).alias("open_from"),
        F.date_sub("from_date", 1).alias("open_to"),
    )
    after = held.groupBy("symbol").agg(F.date_add(F.max("to_date"), 1).alias("open_from")).withColumn("open_to", late)
    wanted = merged_windows(plan)
    # A symbol has as many open stretches as it has landed windows, and one more.
    laid = wanted.join(before.unionByName(after), "symbol", "left").select(
        "symbol", F.greatest("from_date", F.coalesce("open_from", early)).alias("from_date"),
        F.least("to_date", F.coalesce("open_to", late)).alias("to_date"),
    )
    return laid.where("from_date <= to_date")


def dedup_fetches(df: DataFrame, *keys: str, ties: Sequence[Column] | None = None) -> DataFrame:
    """Overlapping fetches repeat records; the one of the latest run date stays. Records without a whole key stay."""
    return latest_per_key(df, keys, F.col("run_date"), ties)


def intraday_return(prices: DataFrame) -> DataFrame:
    change = F.try_divide(F.col("close_price") - F.col("open_price"), F.col("open_price"))
    return prices.withColumn("intraday_return", round_to(change, 4))


def join_prices(news: DataFrame, prices: DataFrame) -> DataFrame:
    """News with the bar of its own ticker and day. News of a day without trading is left out."""
    return news.join(prices, ["ticker", "trade_date"], "inner")


def merge_articles(articles: DataFrame, prices: DataFrame) -> DataFrame:
    """Exploded articles with their text freed of HTML and the bar of their own ticker and day."""
    dated = articles.select(
        "ticker", F.expr("try_to_date(left(published, 10))").alias("trade_date"), "uuid", "title",
        html_to_text(F.col("summary")).alias("cleaned_text"),
    )
    bars = intraday_return(prices).select(
        "ticker", "trade_date", "open_price", "close_price", "intraday_return"
    )
    return join_prices(dated, bars)


def market_mood(news: DataFrame, prices: DataFrame, score: str) -> DataFrame:
    """Every bar with the market-wide news score of its day.

    News is reduced to one row per day before the join, so no article is paired with every ticker.
    """
    mean = from_micros(F.sum(to_micros(F.col(score))) / F.count("*"))
    daily = news.groupBy("trade_date").agg(
        round_to(mean, 6).alias("market_score"), F.count("*").alias("market_news")
    )
    return prices.join(daily, "trade_date", "inner")


def news_on_date(news: DataFrame, day: dt.date) -> DataFrame:
    """The articles of one day, each with the number of articles of that day.

    The count is one number, summed over all tasks and looked up, so the articles are not gathered.
    """
    found = news.where(F.col("trade_date") == F.lit(day))
    return found.withColumn("articles", found.agg(F.count("*")).scalar())


def up_to(df: DataFrame, run_date: dt.date) -> DataFrame:
    return df.where(F.to_date("trade_date") <= F.lit(run_date))


def artifact_manifest(written: DataFrame, run_date: dt.date, terms_table: str, topics_table: str) -> DataFrame:
    """Which tables hold the day's artefacts of each ticker in ``written``: its terms and its topic map."""
    where = F.concat(F.lit(f"?run_date={run_date:%Y-%m-%d}&ticker="), F.col("ticker"))
    return written.select("ticker").distinct().select(
        "ticker",
        F.lit(f"{run_date:%Y-%m-%d}").alias("report_date"),
        F.concat(F.lit(terms_table), where).alias("wordcloud_url"),
        F.concat(F.lit(topics_table), where).alias("ldavis_url"),
    )


def below_price(df: DataFrame, limit: float = 1000.0) -> DataFrame:
    return df.where(F.col("close_price") < limit)
