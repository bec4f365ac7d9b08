"""The daily jobs. Each reads its tables, writes one table and returns what it wrote.

    news, market -> sentiment -> signals -> backtest
    news -> topics -> report
    sentiment -> comparison, prediction (run by hand, not daily)
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsvane.config import Settings, Thresholds
from newsvane.functions.text import INLINE_DICTIONARY_LIMIT, combine_tokens, lemmatize, tokenize
from newsvane.operators import compare, embeddings, models
from newsvane.operators import news as news_ops
from newsvane.operators import sentiment, signals, terms, topics, trading
from newsvane.operators.ranking import latest_per_key
from newsvane.sources import raw_zone, tables

NEWS_TABLE, MARKET_TABLE, SCORES_TABLE = "daily_news_nlp", "daily_market_prices", "comprehensive_sentiment_scores"
SIGNALS_TABLE, TOPICS_TABLE = "trading_signals", "daily_news_topics"
TERMS_TABLE, BIGRAMS_TABLE, MANIFEST_TABLE = "report_terms", "report_bigrams", "report_manifest"
COLLOCATIONS_TABLE, LAYOUT_TABLE, SALIENCY_TABLE = "report_collocations", "report_topic_layout", "report_term_saliency"
TOPIC_TERMS_TABLE, TOPIC_DISTANCE_TABLE, TOPIC_SIZES_TABLE = "report_topic_terms", "report_topic_distance", "report_topic_sizes"
COMPARISON_TABLE, PREDICTIONS_TABLE = "sentiment_comparison", "news_score_predictions"
VECTORS_TABLE, HEADS_TABLE = "word_vectors", "news_score_heads"
TRADES_TABLE, EQUITY_TABLE = "backtest_trades", "backtest_equity"

# Dictionaries are tables that the user stores: (w), (token, lemma), and what `operators.sentiment` scores with.
STOPWORDS_TABLE, LEMMAS_TABLE = "dictionary_stopwords", "dictionary_lemmas"
LEXICON_TABLE, MODIFIERS_TABLE = "dictionary_lexicon", "dictionary_modifiers"
# A stop-word list of more words is refused: it travels inside the plan.
MOST_STOPWORDS = 20_000

NLP_COLUMNS = ("title_tokens", "title_lemmas", "summary_tokens", "summary_lemmas")


Lemmas = Mapping[str, str] | DataFrame


def analyse_news(news: DataFrame, stopwords: Iterable[str], lemmas: Lemmas, *keep: str) -> DataFrame:
    """Token and lemma lists of title and summary; both lists of a field are equally long.

    ``lemmas`` is a mapping or, for a full dictionary, a table (token, lemma). A mapping that is too
    large to travel inside the plan is joined as a table; the lists are the same either way.
    """
    fields = ("title", "summary")
    lists = news.select(
        "ticker", "id", "published_at", *fields, *keep, *[tokenize(f, stopwords).alias(f"{f}_tokens") for f in fields]
    )
    if not isinstance(lemmas, DataFrame) and len(lemmas) > INLINE_DICTIONARY_LIMIT:
        lemmas = news.sparkSession.createDataFrame(list(lemmas.items()), "token string, lemma string")
    for field in fields:
        if isinstance(lemmas, DataFrame):
            lists = terms.with_lemmas(lists, f"{field}_tokens", f"{field}_lemmas", lemmas)
        else:
            lists = lists.withColumn(f"{field}_lemmas", lemmatize(F.col(f"{field}_tokens"), lemmas))
    return lists.select("ticker", "id", "published_at", *fields, *NLP_COLUMNS, *keep)


def dictionary(spark: SparkSession, cfg: Settings, name: str) -> DataFrame:
    """A stored dictionary. There is no default: scores from a made-up one would look like any other."""
    if not spark.catalog.tableExists(cfg.table(name)):
        raise LookupError(f"no dictionary {cfg.table(name)}: store one before the jobs run, or pass one")
    return spark.read.table(cfg.table(name))


def stored_stopwords(spark: SparkSession, cfg: Settings) -> list[str]:
    words = dictionary(spark, cfg, STOPWORDS_TABLE).select("w").where("w IS NOT NULL").distinct()
    known = [r["w"] for r in words.limit(MOST_STOPWORDS + 1).collect()]
    if len(known) > MOST_STOPWORDS:
        raise ValueError(f"{cfg.table(STOPWORDS_TABLE)} holds more than {MOST_STOPWORDS} words")
    return sorted(known)


def news_job(
    spark: SparkSession, cfg: Settings, run_date: dt.date,
    stopwords: Iterable[str] | None = None, lemmas: Lemmas | None = None,
) -> DataFrame:
    """Token and lemma lists of the day's articles, with the stored dictionaries unless others are passed."""
    stopwords = stored_stopwords(spark, cfg) if stopwords is None else stopwords
    lemmas = dictionary(spark, cfg, LEMMAS_TABLE) if lemmas is None else lemmas
    raw = raw_zone.read_daily(spark, cfg.raw_zone, raw_zone.NEWS, run_date)
    # An article repeated within the day's files counts once.
    articles = latest_per_key(news_ops.normalize_news(raw), ["ticker", "id"], F.col("published_at"))
    analysed = analyse_news(articles, stopwords, lemmas)
    tables.write_day(analysed, cfg.table(NEWS_TABLE), run_date, cfg.table_format)
    return tables.read_day(spark, cfg.table(NEWS_TABLE), run_date)


def market_job(spark: SparkSession, cfg: Settings, run_date: dt.date) -> DataFrame:
    raw = raw_zone.read_daily(spark, cfg.raw_zone, raw_zone.MARKET, run_date)
    bars = news_ops.normalize_market(raw)
    tables.write_day(bars, cfg.table(MARKET_TABLE), run_date, cfg.table_format)
    return tables.read_day(spark, cfg.table(MARKET_TABLE), run_date)


def score_articles(
    articles: DataFrame, lexicon: DataFrame, modifiers: DataFrame, cuts: Thresholds, *keep: str
) -> DataFrame:
    """Articles with token and lemma lists to their texts, twelve scores and twelve labels."""
    # Texts are not grouping keys: only the identifying columns travel with the sums.
    scores = sentiment.sentiment_matrix(articles, ["ticker", "id"], lexicon, modifiers, cuts)
    texts = articles.select("ticker", "id", "published_at", "title", "summary", *keep)
    return texts.join(scores, ["ticker", "id"])


def sentiment_job(
    spark: SparkSession, cfg: Settings, run_date: dt.date,
    lexicon: DataFrame | None = None, modifiers: DataFrame | None = None,
) -> DataFrame:
    """Scores of the day's articles only; earlier days keep theirs. Stored dictionaries unless others are passed."""
    lexicon = dictionary(spark, cfg, LEXICON_TABLE) if lexicon is None else lexicon
    modifiers = dictionary(spark, cfg, MODIFIERS_TABLE) if modifiers is None else modifiers
    articles = tables.read_day(spark, cfg.table(NEWS_TABLE), run_date)
    matrix = score_articles(articles, lexicon, modifiers, cfg.thresholds)
    tables.write_day(matrix, cfg.table(SCORES_TABLE), run_date, cfg.table_format)
    return tables.read_day(spark, cfg.table(SCORES_TABLE), run_date)


def signal_job(spark: SparkSession, cfg: Settings, run_date: dt.date) -> DataFrame:
    """Signals from all scores and prices; repeated fetches count once, the latest."""
    score = "vd_comp_summary_token"
    scores = spark.read.table(cfg.table(SCORES_TABLE)).select(
        "ticker", "id", F.to_date("published_at").alias("trade_date"), score, "run_date"
    )
    bars = spark.read.table(cfg.table(MARKET_TABLE)).select("ticker", "trade_date", "close_price", "run_date")
    made = signals.trading_signals(
        news_ops.dedup_fetches(scores, "ticker", "id"),
        news_ops.dedup_fetches(bars, "ticker", "trade_date"),
        score, cfg.signals,
    )
    tables.replace_table(made, cfg.table(SIGNALS_TABLE), cfg.table_format)
    return spark.read.table(cfg.table(SIGNALS_TABLE))


def backtest_job(spark: SparkSession, cfg: Settings, run_date: dt.date) -> DataFrame:
    """Trades and equity up to the run date; returns the one-row summary."""
    known = news_ops.up_to(spark.read.table(cfg.table(SIGNALS_TABLE)), run_date)
    tables.replace_table(trading.trades(known, cfg.signals), cfg.table(TRADES_TABLE), cfg.table_format)
    tables.replace_table(trading.equity_curve(known, cfg.signals), cfg.table(EQUITY_TABLE), cfg.table_format)
    return trading.backtest_summary(spark.read.table(cfg.table(EQUITY_TABLE)), cfg.signals)


def _all_news(spark: SparkSession, cfg: Settings) -> DataFrame:
    """Every article once, with the lists of its latest fetch."""
    return news_ops.dedup_fetches(spark.read.table(cfg.table(NEWS_TABLE)), "ticker", "id")


def topic_job(spark: SparkSession, cfg: Settings, run_date: dt.date) -> DataFrame:
    news = _all_news(spark, cfg)
    docs = news.select(
        "ticker", "id", combine_tokens(F.col("title_tokens"), F.col("summary_tokens")).alias("tokens")
    )
    model = topics.fit_topics(docs, cfg.topics)
    described = topics.describe_assignments(
        model, news.select("ticker", "id", "published_at", "title", "summary")
    )
    tables.replace_table(described, cfg.table(TOPICS_TABLE), cfg.table_format)
    model.discard()
    return spark.read.table(cfg.table(TOPICS_TABLE))


def report_job(spark: SparkSession, cfg: Settings, run_date: dt.date) -> DataFrame:
    """What word clouds and topic maps show, per ticker, and where the day's artefacts are kept.

    Words, neighbouring words and collocations of the titles, and the small topic model behind a map
    with its terms, their saliency, and the topics' distances, places and sizes. The manifest lists the tickers whose rows were written.
    """
    titled = spark.read.table(cfg.table(TOPICS_TABLE)).where(F.col("title").isNotNull())
    words = titled.select("ticker", "id", tokenize("title", stored_stopwords(spark, cfg)).alias("tokens"))
    parts = {
        TERMS_TABLE: terms.top_terms_per_group(words, F.col("tokens"), 100, "ticker"),
        BIGRAMS_TABLE: terms.top_bigrams_per_group(words, "tokens", 100, "ticker"),
        COLLOCATIONS_TABLE: terms.collocations_per_group(words, "tokens", 100, "ticker"),
    }
    model = topics.display_model(words, cfg.topics)
    parts[TOPIC_TERMS_TABLE] = topics.topic_relevance(model.topic_terms())
    parts[TOPIC_DISTANCE_TABLE] = topics.topic_distance(model.topic_terms())
    parts[TOPIC_SIZES_TABLE] = topics.topic_sizes(model.assignments())
    parts[LAYOUT_TABLE] = topics.topic_layout(topics.topic_distance(model.topic_terms()))
    shares = topics.topic_shares(model.topic_terms(), model.assignments())
    parts[SALIENCY_TABLE] = topics.term_saliency(model.topic_terms(), shares)
    for name, part in parts.items():
        tables.write_day(part, cfg.table(name), run_date, cfg.table_format)
    model.discard()
    written = tables.read_day(spark, cfg.table(TERMS_TABLE), run_date).join(
        tables.read_day(spark, cfg.table(TOPIC_TERMS_TABLE), run_date).select("ticker"), "ticker", "left_semi"
    )
    manifest = news_ops.artifact_manifest(written, run_date, cfg.table(TERMS_TABLE), cfg.table(TOPIC_TERMS_TABLE))
    tables.write_day(manifest, cfg.table(MANIFEST_TABLE), run_date, cfg.table_format)
    return tables.read_day(spark, cfg.table(MANIFEST_TABLE), run_date)


def comparison_job(spark: SparkSession, cfg: Settings, run_date: dt.date) -> DataFrame:
    """Both scorers on the summaries, article by article, and the one-row report of their agreement."""
    names = ("polarity", "compound")
    scores = spark.read.table(cfg.table(SCORES_TABLE))
    # Both scores stand on one row; an article is one per ticker.
    sides = [("polarity", "tb_pol", "tb_label"), ("compound", "vd_comp", "vd_label")]
    paired = scores.select(
        "ticker", "id",
        *[F.col(f"{score}_summary_token").alias(f"{name}_score") for name, score, _ in sides],
        *[F.col(f"{label}_summary_token").alias(f"{name}_label") for name, _, label in sides],
    )
    tables.replace_table(compare.compare_pair(paired, names), cfg.table(COMPARISON_TABLE), cfg.table_format)
    report = compare.agreement_report(spark.read.table(cfg.table(COMPARISON_TABLE)), names)
    tables.export_csv(report, f"{cfg.report_root}/agreement_{run_date:%Y-%m-%d}", single_row=True)
    return report


def prediction_job(
    spark: SparkSession, cfg: Settings, run_date: dt.date, size: int = embeddings.SIZE, **vector_options
) -> DataFrame:
    """Scores predicted from word vectors, next to the scores they were fitted on.

    The model is two tables: the word vectors, and the weights of the heads (target, weights), the
    constant first.
    """
    targets = [f"{scorer}_{field}_token" for field in ("title", "summary") for scorer in ("tb_pol", "tb_sub")]
    scores = news_ops.dedup_fetches(
        spark.read.table(cfg.table(SCORES_TABLE)).select("ticker", "id", "run_date", *targets), "ticker", "id"
    )
    docs = _all_news(spark, cfg).select(
        "ticker", "id", "published_at", "title",
        combine_tokens(F.col("title_tokens"), F.col("summary_tokens")).alias("tokenized_text"),
    )
    rows = docs.join(scores.drop("run_date"), ["ticker", "id"])
    fitted = embeddings.fit(rows, "tokenized_text", size, **vector_options)
    tables.replace_table(fitted, cfg.table(VECTORS_TABLE), cfg.table_format)
    words = spark.read.table(cfg.table(VECTORS_TABLE))
    others = [c for c in rows.columns if c not in ("ticker", "id")]
    features = models.article_features(rows, ["ticker", "id"], "tokenized_text", words, size, *others)
    predicted, weights = models.score_predictions(features, targets, size)
    heads = spark.createDataFrame(list(weights.items()), "target string, weights array<double>")
    tables.replace_table(heads, cfg.table(HEADS_TABLE), cfg.table_format)
    tables.replace_table(predicted.drop("vector"), cfg.table(PREDICTIONS_TABLE), cfg.table_format)
    return spark.read.table(cfg.table(PREDICTIONS_TABLE))


JOBS = (news_job, market_job, sentiment_job, signal_job, backtest_job, topic_job, report_job)


def run_all(spark: SparkSession, cfg: Settings, run_date: dt.date) -> dict[str, DataFrame]:
    """All jobs of a day in dependency order. A failing job raises; later ones do not run."""
    tables.create_database(spark, cfg.database)
    return {job.__name__: job(spark, cfg, run_date) for job in JOBS}
