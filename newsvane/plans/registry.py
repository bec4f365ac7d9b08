"""One registered query per operator, bound to the given tables. Every query reads whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsvane import dictionaries as dic
from newsvane.functions import labels, text
from newsvane.operators import (
    compare, embeddings, models, news as news_ops, ranking, regression, sentiment, signals as signal_ops, terms, topics,
    trading, vectors,
)
from newsvane.plans import views
from newsvane.session import stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_DATE = dt.date(2024, 1, 30)
AS_OF = dt.date(2024, 1, 20)
DRILL_DATE = dt.date(2024, 1, 5)
PRICE_LIMIT = 100.0
KEYS = ["ticker", "id", "trade_date"]


def query(build: Query) -> Query:
    """Register under the function's name. Dates are computed in UTC, as the oracle does."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return build


def _dates_as_text(df: DataFrame) -> DataFrame:
    return df.selectExpr(*[f"date_format({c}, 'yyyy-MM-dd') AS {c}" if t == "date" else c for c, t in df.dtypes])


def _dictionaries(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    return dic.lexicon_table(spark), dic.modifier_table(spark)


def _scored(spark: SparkSession, sf: str, field: str = "summary") -> DataFrame:
    news = views.tokenized_news(spark, sf)
    return sentiment.score_texts(news, KEYS, f"{field}_tokens", *_dictionaries(spark))


def _matrix(spark: SparkSession, sf: str) -> DataFrame:
    return sentiment.sentiment_matrix(views.nlp_news(spark, sf), KEYS, *_dictionaries(spark))


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    return signal_ops.daily_sentiment(_scored(spark, sf), views.prices(spark, sf), "compound")


def _signals(spark: SparkSession, sf: str) -> DataFrame:
    return signal_ops.trading_signals(_scored(spark, sf), views.prices(spark, sf), "compound")


def _labelled_docs(spark: SparkSession, sf: str) -> DataFrame:
    quality = views.table(spark, sf, "labels").select(F.col("doc_id").alias("id"), "quality")
    return views.tokenized_news(spark, sf).join(quality, "id", "left")


def _doc_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return views.tokenized_news(spark, sf).select(
        "ticker", "id", text.combine_tokens(F.col("title_tokens"), F.col("summary_tokens")).alias("tokens")
    )


# --- sources and fetches -------------------------------------------------------------------------


@query
def json_array_explode(spark, sf):
    event = views.table(spark, sf, "events")
    published = F.date_format("ts", "yyyy-MM-dd")

    def article(prefix, date):
        content = F.struct(
            F.concat(F.lit(prefix), F.col("event_id")).alias("id"),
            F.col("event_type").alias("title"),
            F.col("props").alias("summary"),
            date.alias("pubDate"),
        )
        return F.struct(F.col("event_id").cast("string").alias("id"), content.alias("content"))

    second_date = F.when(F.col("event_id") % 3 != 0, published)
    payload = F.to_json(F.array(article("a", published), article("b", second_date)))
    return news_ops.explode_articles(event.select("event_id", payload.alias("payload")), "payload", "event_id")


@query
def ticker_from_path(spark, sf):
    path = F.concat(F.regexp_replace("url", "[?#].*$", ""), F.lit(".json"))
    return views.table(spark, sf, "pages").select("page_id", news_ops.ticker_from_path(path).alias("ticker"))


@query
def fetch_plan(spark, sf):
    dotted = F.replace("s_name", F.lit("#"), F.lit("."))
    symbols = views.table(spark, sf, "supplier").select(news_ops.market_symbol(dotted).alias("symbol"))
    return _dates_as_text(news_ops.fetch_plan(symbols, RUN_DATE))


@query
def fetch_gaps(spark, sf):
    """What is still to fetch for every supplier's symbol; a user's events stand for windows that landed."""
    suppliers = views.table(spark, sf, "supplier").select("s_suppkey", news_ops.market_symbol(F.replace("s_name", F.lit("#"), F.lit("."))).alias("symbol"))
    day = F.to_date("ts")
    landed = views.table(spark, sf, "events").where("user_id % 3 <> 0").select(
        (F.col("user_id") % 40 + 1).alias("s_suppkey"), day.alias("from_date"),
        F.date_add(day, (F.col("event_id") % 3 - 1).cast("int")).alias("to_date"),
    )
    plan = news_ops.fetch_plan(suppliers.select("symbol"), RUN_DATE)
    return _dates_as_text(news_ops.fetch_gaps(plan, landed.join(suppliers, "s_suppkey").drop("s_suppkey")))


@query
def dedup_latest(spark, sf):
    fetched = views.table(spark, sf, "events").select(
        "user_id", "event_type", F.to_date("ts").alias("run_date"), "value", "event_id"
    )
    ties = [F.col("value"), F.col("event_id")]
    return _dates_as_text(news_ops.dedup_fetches(fetched, "user_id", "event_type", ties=ties))


@query
def news_normalize(spark, sf):
    return news_ops.normalize_news(views.raw_news(spark, sf)).withColumn(
        "published_at", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss")
    )


@query
def market_normalize(spark, sf):
    bars = views.prices(spark, sf)
    # A seventh of the rows carries a malformed date, as a dirty feed would.
    date = F.when(F.col("volume") % 7 == 0, F.lit("n/a")).otherwise(F.date_format("trade_date", "yyyy-MM-dd"))
    raw = bars.select(
        "ticker", date.alias("Date"), F.col("open_price").alias("Open"), F.col("high_price").alias("High"),
        F.col("low_price").alias("Low"), F.col("close_price").alias("Close"), F.col("volume").alias("Volume"),
    )
    return _dates_as_text(news_ops.normalize_market(raw))


# --- filters and joins ---------------------------------------------------------------------------


@query
def signals_asof(spark, sf):
    # Signals look back only, so days after the date need not be read, scored or joined.
    news = news_ops.up_to(views.tokenized_news(spark, sf), AS_OF)
    scored = sentiment.score_texts(news, KEYS, "summary_tokens", *_dictionaries(spark))
    bars = news_ops.up_to(views.prices(spark, sf), AS_OF)
    return _dates_as_text(signal_ops.trading_signals(scored, bars, "compound"))


@query
def price_sanity_filter(spark, sf):
    bars = news_ops.below_price(views.prices(spark, sf), PRICE_LIMIT)
    return _dates_as_text(bars.select("ticker", "trade_date", "close_price"))


@query
def drop_incomplete(spark, sf):
    quality = views.table(spark, sf, "labels").select(F.col("doc_id").alias("id"), "quality")
    joined = views.news(spark, sf).join(quality, "id", "left")
    return joined.dropna(subset=["title", "quality"]).select("ticker", "id", "title", "quality")


@query
def news_on_date(spark, sf):
    found = news_ops.news_on_date(views.news(spark, sf), DRILL_DATE)
    return found.select("ticker", "id", "title", "articles")


@query
def min_group_gate(spark, sf):
    events = views.table(spark, sf, "events").select("event_id", "user_id")
    return ranking.groups_of_at_least(events, "user_id", 68)


@query
def cap_per_ticker(spark, sf):
    titles = views.news(spark, sf).select("ticker", "id", "title")
    return ranking.top_n_per_group(titles, ["ticker"], [F.asc("id")], 20, salt_on=["id"])


@query
def news_price_join(spark, sf):
    bars = news_ops.intraday_return(views.prices(spark, sf))
    joined = news_ops.join_prices(views.news(spark, sf).select(*KEYS, "title"), bars)
    return _dates_as_text(joined.select(*KEYS, "title", "open_price", "close_price", "intraday_return"))


@query
def merge_articles(spark, sf):
    articles = views.news(spark, sf).select(
        "ticker", F.concat(F.lit("a"), F.col("id")).alias("uuid"), "title", F.concat(F.lit("<p>"), "summary", F.lit("</p>")).alias("summary"),
        F.concat(F.date_format("trade_date", "yyyy-MM-dd"), F.lit("T10:00:00Z")).alias("published"),
    )
    return _dates_as_text(news_ops.merge_articles(articles, views.prices(spark, sf)))


@query
def market_mood_join(spark, sf):
    bars = views.prices(spark, sf).select("ticker", "trade_date", "close_price")
    return _dates_as_text(news_ops.market_mood(_scored(spark, sf), bars, "compound"))


@query
def topic_name_lookup(spark, sf):
    topic = views.table(spark, sf, "embeddings").select("vec_id", F.col("label").cast("int").alias("topic_id"))
    named = topics.topic_names(topic, dic.topic_name_table(spark), dic.DEFAULT_TOPIC_NAME)
    return named.withColumn(
        "display_name", F.concat_ws(" - ", F.lit("topic"), F.col("topic_id").cast("string"), "topic_name")
    )


@query
def distinct_tickers(spark, sf):
    return views.news(spark, sf).select("ticker").distinct()


@query
def dedup_text(spark, sf):
    docs = views.news(spark, sf).select("id", "ticker", "summary")
    return ranking.first_per_text(docs, "summary", "id")


@query
def daily_return(spark, sf):
    bars = news_ops.intraday_return(views.prices(spark, sf))
    return _dates_as_text(bars.select("ticker", "trade_date", "open_price", "close_price", "intraday_return"))


@query
def artifact_manifest(spark, sf):
    sizes = topics.topic_counts(views.news(spark, sf))
    return news_ops.artifact_manifest(sizes, RUN_DATE, "report_terms", "report_topic_terms")


# --- text ----------------------------------------------------------------------------------------


@query
def clean_text(spark, sf):
    return views.documents(spark, sf).select("doc_id", text.clean_text(F.col("text")).alias("clean"))


@query
def tokenize(spark, sf):
    news = views.tokenized_news(spark, sf)
    return news.select(
        "id", F.array_join("summary_tokens", " ").alias("tokens"), F.size("summary_tokens").alias("n_tokens")
    )


@query
def tokenize_long(spark, sf):
    return terms.tokens_long(views.tokenized_news(spark, sf), "summary_tokens", "id")


@query
def tokens_to_text(spark, sf):
    return views.tokenized_news(spark, sf).select(
        "id", text.tokens_to_text(F.col("title_tokens")).alias("title_text"),
        text.tokens_to_text(F.when(F.col("id") % 5 != 0, F.col("summary_tokens"))).alias("summary_text"),
    )


@query
def combined_tokens(spark, sf):
    news = views.tokenized_news(spark, sf)
    both = text.combine_tokens(F.when(F.col("id") % 5 != 0, F.col("title_tokens")), F.col("summary_tokens"))
    again = text.split_words(text.tokens_to_text(both))
    return news.select("id", F.array_join(both, " ").alias("tokens"), F.size(again).alias("n_tokens"))


@query
def lemmatize(spark, sf):
    news = views.tokenized_news(spark, sf)
    lemmas = text.lemmatize(F.col("summary_tokens"), dic.LEMMAS)
    return news.select("id", F.array_join(lemmas, " ").alias("lemmas"), F.size(lemmas).alias("n_lemmas"))


@query
def news_nlp(spark, sf):
    nlp = views.nlp_news(spark, sf)
    lists = ("title_tokens", "title_lemmas", "summary_tokens", "summary_lemmas")
    return nlp.select("ticker", "id", *[F.array_join(c, " ").alias(c) for c in lists])


@query
def html_to_text(spark, sf):
    pages = views.spread(views.table(spark, sf, "pages"), "page_id")
    return pages.select("page_id", text.html_to_text(F.col("html")).alias("text"))


ENTITY_FORMS = (("a", "&agrave;"), ("e", "&#8217;"), ("i", "&#x20AC;"), ("o", "&mdash;"), ("u", "&amp;lt;"), ("n", "&nosuch;"), ("r", "&#0;"))


@query
def html_entities(spark, sf):
    """Documents with some letters written as character references of every kind."""
    written = F.col("text")
    for letter, reference in ENTITY_FORMS:
        written = F.replace(written, F.lit(letter), F.lit(reference))
    return views.documents(spark, sf).select("doc_id", text.html_to_text(written).alias("text"))


def _report(spark, sf):
    """Documents laid out like an extracted report: broken words, dot leaders, page numbers, wide gaps."""
    laid_out = F.col("text")
    for old, new in REPORT_LAYOUT:
        laid_out = F.replace(laid_out, F.lit(old), F.lit(new))
    return views.documents(spark, sf).select("doc_id", laid_out.alias("report"))


REPORT_LAYOUT = ((", ", "-\n  "), (". ", " ..... 12\n 42 \n\n"), (" of ", "     of "))


@query
def report_line_clean(spark, sf):
    return _report(spark, sf).select("doc_id", text.clean_report(F.col("report")).alias("clean"))


@query
def report_tokens(spark, sf):
    cleaned = _report(spark, sf).select("doc_id", text.clean_report(F.col("report")).alias("clean"))
    tokens = text.report_tokens("clean", dic.STOPWORDS, dic.LEMMAS)
    return cleaned.select("doc_id", F.array_join(tokens, " ").alias("tokens"))


# --- sentiment -----------------------------------------------------------------------------------


@query
def vader_score(spark, sf):
    return _scored(spark, sf).select("ticker", "id", "compound")


# Sentences with every modifying rule, put before the prose in turn.
PROSE = (
    "not very good but extremely bad ", "the best growth but a weak profit ", "never a great gain ",
    "a slightly bad loss and no risk ", "cannot really be good ", "",
)


def unfiltered_words(summary: str) -> str:
    """SQL, in either engine, of a summary with one of the sentences in front."""
    cases = " ".join(f"WHEN id % {len(PROSE)} = {i} THEN '{s}'" for i, s in enumerate(PROSE))
    return f"concat(CASE {cases} END, coalesce({summary}, ''))"


@query
def vader_score_unfiltered(spark, sf):
    """All words are scored, stop words too, so that negations, boosters and the contrast word act."""
    news = views.news(spark, sf).withColumn("prose", F.expr(unfiltered_words("summary")))
    tokens = news.select("ticker", "id", text.tokenize("prose").alias("tokens"))
    return sentiment.score_texts(tokens, ["ticker", "id"], "tokens", *_dictionaries(spark))


@query
def narrow_scores(spark, sf):
    return sentiment.narrow_scores(views.nlp_news(spark, sf), ["ticker", "id"], "lemma", "polarity", *_dictionaries(spark))


@query
def polarity_subjectivity(spark, sf):
    return _scored(spark, sf).select("ticker", "id", "polarity", "subjectivity")


@query
def sentiment_labels(spark, sf):
    return _scored(spark, sf).select(
        "id",
        labels.compound_label(F.col("compound")).alias("compound_label"),
        labels.polarity_label(F.col("polarity")).alias("polarity_label"),
        labels.subjectivity_label(F.col("subjectivity")).alias("subjectivity_label"),
    )


@query
def sentiment_matrix(spark, sf):
    return _matrix(spark, sf).drop("trade_date")


@query
def scores_long_union(spark, sf):
    return sentiment.scores_long(_matrix(spark, sf), ["id"])


@query
def lexicon_induction(spark, sf):
    return sentiment.induce_lexicon(_labelled_docs(spark, sf), "summary_tokens", "quality")


# --- comparisons ---------------------------------------------------------------------------------

VARIANT_NAMES, SCORER_NAMES = ("token", "lemma"), ("polarity", "compound")


def _compared_variants(spark, sf):
    slots = {name: f"title_{name}s" for name in VARIANT_NAMES}
    scored = sentiment.score_variants(views.nlp_news(spark, sf), ["ticker", "id"], slots, *_dictionaries(spark))
    return compare.compare_pair(scored, VARIANT_NAMES)


def _compared_scorers(spark, sf):
    scored = _scored(spark, sf).select(
        "ticker", "id", F.col("polarity").alias("polarity_score"), F.col("compound").alias("compound_score"),
        labels.polarity_label(F.col("polarity")).alias("polarity_label"),
        labels.compound_label(F.col("compound")).alias("compound_label"),
    )
    return compare.compare_pair(scored, SCORER_NAMES)


@query
def compare_token_lemma(spark, sf):
    return _compared_variants(spark, sf)


@query
def compare_scorers(spark, sf):
    return _compared_scorers(spark, sf)


@query
def label_match_counts(spark, sf):
    return compare.label_match_counts(_compared_variants(spark, sf))


@query
def avg_score_diff(spark, sf):
    return compare.average_difference(_compared_variants(spark, sf))


@query
def top_score_diffs(spark, sf):
    return ranking.top_n(
        _compared_variants(spark, sf).select("ticker", "id", "token_score", "lemma_score", "score_diff"),
        [F.desc("score_diff"), F.asc("ticker"), F.asc("id")], 200,
    )


@query
def scorer_agreement_report(spark, sf):
    return compare.agreement_report(_compared_scorers(spark, sf), SCORER_NAMES)


# --- signals and trading -------------------------------------------------------------------------


@query
def daily_sentiment(spark, sf):
    return _dates_as_text(_daily(spark, sf))


@query
def market_daily_sentiment(spark, sf):
    return _dates_as_text(signal_ops.market_daily_sentiment(_daily(spark, sf)))


@query
def sma20(spark, sf):
    rolled = signal_ops.rolling_statistics(_daily(spark, sf))
    return _dates_as_text(rolled.select("ticker", "trade_date", "close_price", "sma_20"))


@query
def sentiment_z(spark, sf):
    rolled = signal_ops.rolling_statistics(_daily(spark, sf))
    return _dates_as_text(
        rolled.select(
            "ticker", "trade_date", "avg_score", "sentiment_mean_20", "sentiment_std_20", "sentiment_z_score"
        )
    )


@query
def market_sentiment_z(spark, sf):
    market = signal_ops.market_daily_sentiment(_daily(spark, sf))
    rolled = signal_ops.rolling_statistics(market, partition=())
    return _dates_as_text(rolled.withColumn("signal", signal_ops.signal_column()))


@query
def trading_signals(spark, sf):
    return _dates_as_text(_signals(spark, sf))


@query
def position_state(spark, sf):
    states = trading.position_state(_signals(spark, sf))
    return _dates_as_text(states.select("ticker", "trade_date", "signal", "position"))


@query
def trades(spark, sf):
    return _dates_as_text(trading.trades(_signals(spark, sf)))


@query
def trade_pnl(spark, sf):
    return _dates_as_text(trading.trade_pnl(trading.trades(_signals(spark, sf))))


@query
def equity_curve(spark, sf):
    return _dates_as_text(trading.equity_curve(_signals(spark, sf)))


@query
def backtest_summary(spark, sf):
    return trading.backtest_summary(trading.equity_curve(_signals(spark, sf)))


@query
def signal_chart_data(spark, sf):
    return _dates_as_text(signal_ops.signal_chart_data(_signals(spark, sf)))


# --- terms ---------------------------------------------------------------------------------------


@query
def term_topn(spark, sf):
    titled = views.tokenized_news(spark, sf).where(F.col("title").isNotNull())
    return terms.top_terms(titled, F.col("title_tokens"), 200)


@query
def term_topn_per_ticker(spark, sf):
    return terms.top_terms_per_group(views.tokenized_news(spark, sf), F.col("summary_tokens"), 100, "ticker")


@query
def bigram_topn(spark, sf):
    return terms.top_bigrams_per_group(views.tokenized_news(spark, sf), "summary_tokens", 100, "ticker")


@query
def collocations_per_ticker(spark, sf):
    return terms.collocations_per_group(views.tokenized_news(spark, sf), "summary_tokens", 100, "ticker")


@query
def doc_frequency_pruned(spark, sf):
    return terms.document_frequencies(views.tokenized_news(spark, sf), "summary_tokens", 2, 0.4)


@query
def vocabulary(spark, sf):
    return terms.vocabulary(_doc_tokens(spark, sf), "tokens")


@query
def vocabulary_per_ticker(spark, sf):
    return terms.vocabulary_per_group(_doc_tokens(spark, sf), "tokens", "ticker")


def _encoded(docs: DataFrame) -> DataFrame:
    encoded = terms.encode_sequences(docs, ["ticker", "id"], "tokens")
    return encoded.select("ticker", "id", F.array_join(F.col("sequence").cast("array<string>"), ",").alias("sequence"))


@query
def sequence_encode(spark, sf):
    return _encoded(_doc_tokens(spark, sf))


@query
def sequence_encode_shared_ids(spark, sf):
    """Every id under two tickers: the article's own, with all its words, and a second one with its title's."""
    news = views.tokenized_news(spark, sf)
    second = news.select(F.concat("ticker", F.lit("-B")).alias("ticker"), "id", F.col("title_tokens").alias("tokens"))
    return _encoded(_doc_tokens(spark, sf).unionByName(second))


@query
def lemmatize_by_join(spark, sf):
    dictionary = dic.lemma_table(spark)
    news = views.tokenized_news(spark, sf)
    joined = terms.lemmatize_by_join(news, ["ticker", "id"], "summary_tokens", dictionary)
    return joined.select(
        "ticker", "id", F.array_join("lemmas", " ").alias("lemmas"), F.size("lemmas").alias("n_lemmas")
    )


@query
def term_lift(spark, sf):
    return terms.term_lift(_labelled_docs(spark, sf), "summary_tokens", "quality")


# --- vectors, topics, models ---------------------------------------------------------------------


@query
def dominant_topic(spark, sf):
    vector = F.col("embedding").cast("array<double>")
    return views.table(spark, sf, "embeddings").select("vec_id", vectors.dominant_index(vector).alias("dominant_topic_id"))


@query
def embedding_topk(spark, sf):
    return vectors.nearest_vectors(views.table(spark, sf, "embeddings"), "vec_id", "embedding", 0, 15)


@query
def train_test_split(spark, sf):
    return views.documents(spark, sf).select("doc_id", vectors.is_train(F.col("doc_id")).cast("int").alias("is_train"))


@query
def label_index(spark, sf):
    scored = _scored(spark, sf).withColumn("label", labels.polarity_label(F.col("polarity")))
    return models.label_index(scored, "label")


@query
def topic_k_choice(spark, sf):
    return topics.topic_counts(views.news(spark, sf))


@query
def count_vectors(spark, sf):
    counted = terms.count_vectors(_doc_tokens(spark, sf), ["ticker", "id"], "tokens")
    written = [F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("indices", "counts")]
    return counted.select("ticker", "id", *written)


@query
def topics_corpus(spark, sf):
    model = models.corpus_topics(_doc_tokens(spark, sf), "tokens")
    return models.corpus_assignments(model).select("ticker", "id", "dominant_topic_id")


@query
def topic_keywords(spark, sf):
    return models.corpus_topic_keywords(models.corpus_topics(_doc_tokens(spark, sf), "tokens"))


@query
def topics_per_ticker(spark, sf):
    news = views.tokenized_news(spark, sf)
    docs = news.select("ticker", "id", text.combine_tokens(F.col("title_tokens"), F.col("summary_tokens")).alias("tokens"))
    model = topics.fit_topics(docs)
    return topics.describe_assignments(model, news.select("ticker", "id", "published_at", "title"))


def _counted_topics(spark, sf):
    """Topic-term table with the quality labels as topics: no model, so SQL can repeat it."""
    labelled = _labelled_docs(spark, sf).where("quality IS NOT NULL")
    return topics.counted_topic_terms(labelled, "summary_tokens", "quality", 2)


@query
def topic_relevance(spark, sf):
    return topics.topic_relevance(_counted_topics(spark, sf))


@query
def topic_distance(spark, sf):
    return topics.topic_distance(_counted_topics(spark, sf))


# The languages of the documents, which stand for four topics of a ticker.
LANGUAGES = ("de", "en", "es", "fr")


def _language_news(spark, sf):
    lang = views.documents(spark, sf).select(F.col("doc_id").alias("id"), F.array_position(F.array(*map(F.lit, LANGUAGES)), F.col("lang")).alias("at"))
    known = lang.where("at > 0").select("id", (F.col("at") - 1).cast("int").alias("topic"))
    return views.tokenized_news(spark, sf).join(known, "id")


@query
def topic_layout(spark, sf):
    spoken = topics.counted_topic_terms(_language_news(spark, sf), "summary_tokens", "topic", len(LANGUAGES))
    return topics.topic_layout(topics.topic_distance(spoken))


@query
def term_saliency(spark, sf):
    news = _language_news(spark, sf)
    spoken = topics.counted_topic_terms(news, "summary_tokens", "topic", len(LANGUAGES))
    words = news.groupBy("ticker", "topic").agg(F.sum(F.size("summary_tokens")).alias("words"))
    every = words.groupBy("ticker").agg(F.sum("words").alias("every"))
    shares = words.join(every, "ticker").select("ticker", "topic", F.try_divide("words", "every").alias("share"))
    return topics.term_saliency(spoken, shares)


@query
def topic_sizes(spark, sf):
    """The entries of a vector, made positive and scaled to one, stand for a document's topic shares."""
    size = F.transform("embedding", lambda x: F.abs(x.cast("double")))
    total = F.aggregate(size, F.lit(0.0), lambda a, x: a + x)
    shares = views.table(spark, sf, "embeddings").select(
        F.concat(F.lit("L"), F.col("label")).alias("ticker"), F.transform(size, lambda x: x / total).alias("distribution")
    )
    return topics.topic_sizes(shares)


@query
def vocabulary_pruned_per_ticker(spark, sf):
    """The vocabulary of the display model."""
    return terms.pruned_vocabulary_per_group(views.tokenized_news(spark, sf), "title_tokens", "ticker", 500)


VECTOR_SIZE = 64


def _word_table(spark, sf):
    """The given vectors as a stored word-vector table: the vector of a term's place in the vocabulary."""
    words = terms.vocabulary(_doc_tokens(spark, sf), "tokens")
    stored = views.table(spark, sf, "embeddings").select(F.col("vec_id").alias("term_index"), F.col("embedding").alias("vector"))
    words = words.withColumn("term_index", F.col("term_index").cast("bigint"))
    return stage(words.join(stored, "term_index").select("term", "vector"), "word-table")[0]


@query
def word2vec_docs(spark, sf):
    docs = vectors.document_vectors(_doc_tokens(spark, sf), ["ticker", "id"], "tokens", _word_table(spark, sf), VECTOR_SIZE)
    micros = F.transform("vector", lambda x: F.floor(x * 1e6 + 0.5).cast("string"))
    return docs.select("ticker", "id", "known_words", F.array_join(micros, ",").alias("vector"))


@query
def word2vec_synonyms(spark, sf):
    """The words nearest to the most frequent one, by stored vectors."""
    words = _word_table(spark, sf)
    term = terms.vocabulary(_doc_tokens(spark, sf), "tokens", size=1).first()["term"]
    near = vectors.nearest_terms(words, term, 15)
    return near.select(F.lit(term).alias("query"), F.col("term").alias("word"), F.col("cosine").alias("similarity"))


@query
def cooccurrence(spark, sf):
    return embeddings.cooccurrence(_doc_tokens(spark, sf), "tokens")


@query
def ppmi(spark, sf):
    return embeddings.corpus_ppmi(_doc_tokens(spark, sf), "tokens")


@query
def word_vectors(spark, sf):
    """Repeatable word vectors of the corpus, entries in millionths."""
    micros = F.transform("vector", lambda x: F.floor(x * 1e6 + 0.5).cast("string"))
    return embeddings.fit(_doc_tokens(spark, sf), "tokens", VECTOR_SIZE).select("term", F.array_join(micros, ",").alias("vector"))


@query
def word_vector_neighbours(spark, sf):
    """The words nearest to the most frequent one, by the corpus's own vectors."""
    docs = _doc_tokens(spark, sf)
    words = embeddings.fit(docs, "tokens", VECTOR_SIZE)
    term = terms.vocabulary(docs, "tokens", size=1).first()["term"]
    near = vectors.nearest_terms(words, term, 15)
    return near.select(F.lit(term).alias("query"), F.col("term").alias("word"), F.col("cosine").alias("similarity"))


def _labelled_tokens(spark, sf):
    scored = sentiment.sentiment_matrix(views.nlp_news(spark, sf), ["ticker", "id"], *_dictionaries(spark))
    targets = scored.select(
        "ticker", "id", F.col("tb_label_summary_token").alias("label"), *SCORE_TARGETS
    )
    # Read for the words of the articles and for their scores: made once.
    return _doc_tokens(spark, sf).join(stage(targets, "targets")[0], ["ticker", "id"])


SCORE_TARGETS = [
    f"{scorer}_{field}_token" for field in ("title", "summary") for scorer in ("tb_pol", "tb_sub")
]


def _article_rows(spark, sf):
    """(ticker, id, label, scores, vector): articles as the corpus's own word vectors describe them."""
    docs = _labelled_tokens(spark, sf)
    words = embeddings.fit(_doc_tokens(spark, sf), "tokens", VECTOR_SIZE)
    rows = models.article_features(docs, ["ticker", "id"], "tokens", words, VECTOR_SIZE, "label", *SCORE_TARGETS)
    # Fitted on and predicted for: read twice, made once.
    return stage(rows, "article-rows")[0]


def _predicted_labels(spark, sf):
    train, test = models.split(_article_rows(spark, sf), "id")
    return models.fit_classifier(train, ["ticker", "id"], "label").transform(models.with_features(test))


@query
def sentiment_classifier(spark, sf):
    return _predicted_labels(spark, sf).select("ticker", "id", "label", "label_index", "prediction")


@query
def classifier_accuracy(spark, sf):
    return models.accuracy_report(_predicted_labels(spark, sf))


@query
def held_out_labels(spark, sf):
    """What a classifier is judged on: articles per label on both sides of the split."""
    scored = _scored(spark, sf).withColumn("label", labels.polarity_label(F.col("polarity")))
    train = vectors.is_train(F.col("id"))
    return scored.groupBy("label").agg(
        F.count_if(train).alias("train_articles"), F.count_if(~train).alias("test_articles")
    )


def _label_numbers(spark, sf):
    """One scorer's label as the truth, the other's as a prediction of it."""
    scored = _scored(spark, sf)
    number = {"positive": 0.0, "neutral": 1.0, "negative": 2.0}
    truth, guess = labels.polarity_label(F.col("polarity")), labels.compound_label(F.col("compound"))

    def numbered(label):
        return F.coalesce(*[F.when(label == name, F.lit(n)) for name, n in number.items()])

    return scored.select(numbered(truth).alias("label_index"), numbered(guess).alias("prediction"))


@query
def label_confusion(spark, sf):
    return models.confusion(_label_numbers(spark, sf))


@query
def label_accuracy(spark, sf):
    return models.accuracy_report(_label_numbers(spark, sf))


@query
def score_regression(spark, sf):
    rows, _ = models.score_predictions(_article_rows(spark, sf), SCORE_TARGETS, VECTOR_SIZE)
    return rows.select("ticker", "id", *SCORE_TARGETS, *[f"pred_{t}" for t in SCORE_TARGETS])


@query
def score_gram(spark, sf):
    """What linear heads for the four scores are solved from, with stored word vectors as features."""
    docs = vectors.document_vectors(_doc_tokens(spark, sf), ["ticker", "id"], "tokens", _word_table(spark, sf), VECTOR_SIZE)
    scored = sentiment.sentiment_matrix(views.nlp_news(spark, sf), ["ticker", "id"], *_dictionaries(spark))
    rows = docs.join(scored.select("ticker", "id", *SCORE_TARGETS), ["ticker", "id"])
    sums = regression.gram(rows, "vector", SCORE_TARGETS, VECTOR_SIZE)
    return sums.select("i", "j", F.col("total").cast("string").alias("total"))
