"""One topic model per ticker, all tickers trained together.

Variational LDA. The documents of a ticker are cut into blocks of bounded size, and its blocks into
slices of a bounded number of blocks; a slice is inferred by one task, so a ticker with a third of
all news is spread over as many tasks as it has slices. The blocks are written once, bucketed by
slice, and stay where they lie: in a round only the ticker's current topics are moved, once to each
of its slices. Tasks infer the document mixtures and add up term statistics and the variational
bound, and Spark sums those per (ticker, term). All are summed as integers, so a run does not depend
on how many cores there are or how rows are distributed.

Intermediates are tables in the shared folder; those of a round are deleted when the next is done.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsvane.config import TopicSettings
from newsvane.functions.numeric import MICROS, round_to
from newsvane.operators.ranking import top_n_per_group
from newsvane.operators.terms import pruned_vocabulary_per_group, vocabulary_per_group
from newsvane.operators.topic_inference import BOUND, MILLIS, assign_with, encode, lay_out, statistics_of
from newsvane.session import discard, stage, stage_buckets

# A block holds about so many documents and words at most, a slice so many blocks.
BLOCK_DOCUMENTS, BLOCK_TOKENS, SLICE_BLOCKS = 256, 100_000, 64
# Fewer blocks in all make shorter slices, so that there are about so many of them, of so many blocks at least.
SLICES, LEAST_BLOCKS = 96, 4
# A bucket holds about so many blocks, so many small tickers share one; Spark allows so many buckets.
BUCKET_BLOCKS, MOST_BUCKETS = 32, 100_000


def topic_count(documents: Column, settings: TopicSettings = TopicSettings()) -> Column:
    """Half as many topics as documents, at least 2, at most the maximum."""
    half = F.floor(documents / 2)
    return F.greatest(F.lit(2), F.least(F.lit(settings.max_topics), half)).cast("int")


def display_topic_count(documents: Column) -> Column:
    """The smaller model behind a topic map: a third as many, between 2 and 5."""
    return F.least(F.lit(5), F.greatest(F.lit(2), F.floor(documents / 3))).cast("int")


def topic_counts(df: DataFrame, settings: TopicSettings = TopicSettings()) -> DataFrame:
    """Tickers with enough documents and the number of topics each gets."""
    sizes = df.groupBy("ticker").agg(F.count("*").alias("documents"))
    large = sizes.where(F.col("documents") >= settings.min_documents)
    return large.withColumn("k", topic_count(F.col("documents"), settings))


def _leads(rows: DataFrame, slices: DataFrame) -> DataFrame:
    """A ticker's row of ``rows`` once for each of its slices."""
    numbers = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)).alias("slice")
    return rows.join(slices.select("ticker", numbers), "ticker")


def _cut(docs: DataFrame, sizes: DataFrame) -> DataFrame:
    """Tickers with their number of blocks: by documents or by words, whichever is more."""
    words = docs.groupBy("ticker").agg(F.sum("words").alias("words"))
    blocks = F.greatest(
        F.ceil(F.col("documents") / BLOCK_DOCUMENTS), F.ceil(F.col("words") / BLOCK_TOKENS), F.lit(1)
    ).cast("bigint")
    return sizes.join(words, "ticker").withColumn("blocks", blocks)


def _slice_blocks(blocks: int) -> int:
    """How many blocks a slice holds, from those of all tickers: the same on any number of cores."""
    return min(SLICE_BLOCKS, max(LEAST_BLOCKS, blocks // SLICES))


def _blocks(docs: DataFrame, vocabulary: DataFrame, slices: DataFrame, tasks: int) -> DataFrame:
    """Documents as lists of vocabulary indices, in blocks.

    The token lists are shuffled once, as they are, to the task of their slice, which turns them into
    indices and cuts them into blocks, so no row per token is ever sorted or moved; the vocabulary
    goes to each slice once.
    """
    block = F.pmod(F.xxhash64("id"), F.col("blocks"))
    placed = docs.join(slices, "ticker").select(
        "ticker", "k", block.alias("block"), F.pmod(block, F.col("slices")).alias("slice"), "id", "tokens"
    )
    index = vocabulary.groupBy("ticker").agg(F.collect_list(F.struct("term_index", "term")).alias("entries"))
    index = index.selectExpr(
        "ticker", "transform(entries, e -> e.term_index) AS known_places", "transform(entries, e -> e.term) AS known"
    )
    leads = _leads(index, slices).withColumn("lead", F.lit(True))
    both = leads.unionByName(placed.withColumn("lead", F.lit(False)), allowMissingColumns=True)
    ordered = both.repartition(tasks, "ticker", "slice").sortWithinPartitions(
        "ticker", "slice", F.desc("lead"), "block", "id", "tokens"
    )
    return ordered.withColumn("id", F.col("id").cast("string")).mapInArrow(
        encode, "ticker string, slice bigint, block bigint, k int, ids array<string>, lengths array<int>, terms array<int>"
    )


def _start_weights(vocabulary: DataFrame, settings: TopicSettings) -> DataFrame:
    """Seeded pseudo-random start: one list of topic weights per term, one row per ticker."""

    def start(topic: int) -> Column:
        draw = F.pmod(F.xxhash64("ticker", "term", F.lit(topic), F.lit(settings.seed)), F.lit(10_000))
        return F.lit(0.5) + draw / 10_000.0

    drawn = vocabulary.select(
        "ticker", "term_index", F.array(*[start(j) for j in range(settings.max_topics)]).alias("w")
    )
    return _per_ticker(drawn)


def _per_ticker(weights: DataFrame) -> DataFrame:
    """All weights of a ticker as one list, term by term: bounded by vocabulary and topics.

    The terms stand in any order; ``places`` says which is which. A row that is no term brings the
    bound of the weights before these.
    """
    term = F.when(F.col("term_index") != BOUND, F.struct("term_index", "w"))
    bound = F.max(F.when(F.col("term_index") == BOUND, F.get("w", F.lit(0))))
    lists = weights.groupBy("ticker").agg(F.collect_list(term).alias("rows"), bound.alias("bound"))
    return lists.select(
        "ticker",
        "bound",
        F.transform("rows", lambda r: r["term_index"]).alias("places"),
        F.flatten(F.transform("rows", lambda r: r["w"])).alias("weights"),
    )


def stage_documents(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents (ticker, id, tokens) with their number of words, written once: sizes, vocabulary and
    blocks read lists of tokens, none of them cuts the texts anew."""
    words = F.greatest(F.size("tokens"), F.lit(0)).alias("words")
    return stage(docs.select("ticker", "id", "tokens", words), "topic-docs")


class TickerTopics:
    """Fitted models: topic-term weights per ticker and the staged documents they were fitted on."""

    def __init__(self, docs: DataFrame, settings: TopicSettings, sizes: DataFrame, vocabulary: DataFrame):
        self._settings, self._id_type = settings, docs.schema["id"].dataType
        self._paths: list[str] = []
        self._sizes = self._stage(sizes, "sizes")
        cut = self._stage(_cut(docs, self._sizes), "slices")
        blocks = cut.agg(F.sum("blocks")).first()[0] or 0
        self._slices = cut.withColumn("slices", F.ceil(F.col("blocks") / _slice_blocks(blocks)).cast("bigint"))
        slices = self._slices.agg(F.sum("slices")).first()[0] or 0
        # Enough buckets for every core, at most one a slice.
        wanted = max(4 * docs.sparkSession.sparkContext.defaultParallelism, blocks // BUCKET_BLOCKS, SLICES)
        buckets = max(1, min(slices, wanted, MOST_BUCKETS))
        # The terms of other tickers are left out here, not their documents before: a join on the ticker
        # would deal documents by ticker, and one task would count all words of a ticker.
        self._vocabulary = self._stage(vocabulary.join(self._sizes.select("ticker"), "ticker"), "vocabulary")
        self._blocks, path, self._table = stage_buckets(
            _blocks(docs, self._vocabulary, self._slices, buckets), "topic-blocks", ["ticker", "slice"], buckets
        )
        self._paths.append(path)
        self._weights, self._weights_path = stage(_start_weights(self._vocabulary, settings), "topic-weights")
        self._bounds: list[DataFrame] = []

    def _stage(self, df: DataFrame, name: str) -> DataFrame:
        made, path = stage(df, f"topic-{name}")
        self._paths.append(path)
        return made

    def owns(self, path: str) -> None:
        """Delete what is staged there with the other intermediates."""
        self._paths.append(path)

    def discard(self) -> None:
        """Delete the intermediates. Results that were not written by now can no longer be read."""
        spark = self._blocks.sparkSession
        spark.sql(f"DROP TABLE IF EXISTS {self._table}")
        discard(spark, [*self._paths, self._weights_path])

    def _over_slices(self, work, schema: str, *more: str) -> DataFrame:
        """``work`` on the blocks of every slice and the ticker's topics; the blocks are not moved.

        A block comes with its documents' lengths and terms, and the columns ``more``.
        """
        by = ["ticker", "slice"]
        leads = _leads(self._weights.drop("bound"), self._slices)
        blocks = self._blocks.select(*by, "block", "k", "lengths", "terms", *more)
        return blocks.groupBy(*by).cogroup(leads.groupBy(*by)).applyInArrow(work, schema)

    def _statistics(self) -> DataFrame:
        names = [f"s{j}" for j in range(self._settings.max_topics)]
        schema = "ticker string, term_index int, " + ", ".join(f"{n} bigint" for n in names)
        parts = self._over_slices(statistics_of(self._settings.max_topics), schema)
        return parts.groupBy("ticker", "term_index").agg(*[F.sum(n).alias(n) for n in names])

    def step(self) -> None:
        """One round: infer documents, add up statistics, write the new weights over the old."""
        prior = self._sizes.select("ticker", (F.lit(1.0) / F.col("k")).alias("eta"))
        # A term that no topic claims keeps the prior, so that every term has a weight.
        terms = self._vocabulary.select("ticker", "term_index")
        bounds = self._weights.select("ticker", F.lit(BOUND).alias("term_index"))
        every = terms.unionByName(bounds).join(self._statistics(), ["ticker", "term_index"], "left")
        smoothed = every.join(prior, "ticker").withColumn("eta", F.expr(f"if(term_index = {BOUND}, 0.0D, eta)")).select(
            "ticker",
            "term_index",
            F.array(
                *[F.coalesce(f"s{j}", F.lit(0)) / float(MICROS) + F.col("eta") for j in range(self._settings.max_topics)]
            ).alias("w"),
        )
        old = self._weights_path
        self._weights, self._weights_path = stage(_per_ticker(smoothed), "topic-weights")
        discard(self._blocks.sparkSession, [old])
        numbered = self._weights.select(
            "ticker", F.lit(len(self._bounds)).alias("round"), (F.col("bound") * float(MICROS // MILLIS)).alias("bound")
        )
        # One number per ticker.
        self._bounds.append(self._stage(numbered, "bound"))

    def bounds(self) -> DataFrame:
        """(ticker, round, bound): the variational bound, in nats, of the topics that every round began with.

        It does not fall from round to round, and how little it still rises says whether more are worth it.
        """
        empty = self._sizes.select("ticker", F.lit(0).alias("round"), F.lit(0.0).alias("bound")).limit(0)
        return reduce(DataFrame.unionByName, self._bounds, empty)

    def topic_terms(self) -> DataFrame:
        """(ticker, topic, term, n, probability) for every term of a ticker's vocabulary."""
        topics = self._settings.max_topics
        rows = self._weights.select("ticker", "places", F.posexplode("weights").alias("at", "weight"))
        cells = (
            rows.withColumn("term_index", F.get("places", F.floor(F.col("at") / topics).cast("int")))
            .withColumn("topic", F.col("at") % topics)
            .join(self._sizes.select("ticker", "k"), "ticker")
            .where(F.col("topic") < F.col("k"))
        )
        totals = cells.groupBy("ticker", "topic").agg(F.sum("weight").alias("total"))
        words = self._vocabulary.select("ticker", "term_index", "term", "n")
        return (
            cells.join(totals, ["ticker", "topic"])
            .join(words, ["ticker", "term_index"])
            .select("ticker", "topic", "term", "n", (F.col("weight") / F.col("total")).alias("probability"))
        )

    def keywords(self) -> DataFrame:
        """(ticker, topic, keywords): the likeliest terms joined by a comma."""
        ranked = top_n_per_group(
            self.topic_terms(), ["ticker", "topic"], [F.desc("probability"), F.asc("term")],
            self._settings.keywords, salt_on=["term"], salts=4,
        )
        listed = ranked.groupBy("ticker", "topic").agg(
            F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("r")
        )
        words = F.array_join(F.transform("r", lambda r: r["term"]), ", ")
        return listed.select("ticker", "topic", words.alias("keywords"))

    def assignments(self) -> DataFrame:
        """(ticker, id, distribution, dominant_topic_id) for every document."""
        out = self._over_slices(
            assign_with(self._settings.max_topics), "ticker string, id string, distribution array<double>", "ids"
        )
        best = F.array_position("distribution", F.array_max("distribution")) - 1
        return out.withColumn("id", F.col("id").cast(self._id_type)).withColumn("dominant_topic_id", best)


def fit_topics(
    docs: DataFrame, settings: TopicSettings = TopicSettings(), sizes: DataFrame | None = None,
    vocabulary: DataFrame | None = None, staged: str | None = None,
) -> TickerTopics:
    """Fit one model per ticker on (ticker, id, tokens); tickers with too few documents are skipped.

    ``id`` tells the documents of a ticker apart. Every round reads all documents. ``staged`` is where
    documents lie that come from `stage_documents`.
    """
    if staged is None:
        docs, staged = stage_documents(docs)
    sizes = topic_counts(docs, settings) if sizes is None else sizes
    if vocabulary is None:
        vocabulary = vocabulary_per_group(docs, "tokens", "ticker", settings.vocabulary)
    model = TickerTopics(docs, settings, sizes, vocabulary)
    model.owns(staged)
    for _ in range(settings.iterations):
        model.step()
    return model


def display_model(docs: DataFrame, settings: TopicSettings = TopicSettings()) -> TickerTopics:
    """The smaller per-ticker model behind a topic map: fewer topics, five rounds, and a vocabulary
    without terms of one document or of more than nine tenths of a ticker's."""
    settings = replace(settings, max_topics=min(5, settings.max_topics), iterations=min(5, settings.iterations))
    docs, staged = stage_documents(docs)
    sizes = topic_counts(docs, settings).withColumn("k", F.least(display_topic_count(F.col("documents")), F.lit(settings.max_topics)))
    vocabulary = pruned_vocabulary_per_group(docs, "tokens", "ticker", settings.vocabulary)
    return fit_topics(docs, settings, sizes, vocabulary, staged)


def counted_topic_terms(df: DataFrame, tokens: str, topic: str, topics: int) -> DataFrame:
    """(ticker, topic, term, n, probability) with a known topic number per article, 0 to ``topics`` - 1.

    A term's probability in a topic is its smoothed share of the topic's words; ``n`` counts it in
    all topics of the ticker. The same table as a fitted model gives, from counts alone.
    """
    words = df.select("ticker", F.col(topic).alias("topic"), F.explode_outer(tokens).alias("term")).where("term IS NOT NULL")
    counts = [F.count_if(F.col("topic") == t).alias(f"c{t}") for t in range(topics)]
    per_term = words.groupBy("ticker", "term").agg(F.count("*").alias("n"), *counts)
    sums = [F.sum(f"c{t}").alias(f"t{t}") for t in range(topics)]
    totals = per_term.groupBy("ticker").agg(F.count("*").alias("terms"), *sums)
    cells = F.array(
        *[
            F.struct(F.lit(t).alias("topic"), ((F.col(f"c{t}") + 1) / (F.col(f"t{t}") + F.col("terms"))).alias("probability"))
            for t in range(topics)
        ]
    )
    return per_term.join(totals, "ticker").select("ticker", "term", "n", F.inline(cells)).select(
        "ticker", "topic", "term", "n", "probability"
    )


def describe_assignments(model: TickerTopics, news: DataFrame) -> DataFrame:
    """The topics table: news with its dominant topic, that topic's keywords and a readable name."""
    labelled = model.assignments().join(
        model.keywords().withColumnRenamed("topic", "dominant_topic_id"),
        ["ticker", "dominant_topic_id"], "left",
    )
    topics = labelled.select(
        "ticker", "id", "dominant_topic_id", F.col("keywords").alias("lda_summary_keywords"),
        F.concat_ws(" - ", F.lit("topic"), F.col("dominant_topic_id").cast("string"), "keywords").alias("topic_name"),
    )
    return news.join(topics, ["ticker", "id"])


def topic_names(df: DataFrame, names: DataFrame, default: str) -> DataFrame:
    """Names from a fixed dictionary keyed by topic number, a default for numbers it lacks."""
    named = df.join(names, "topic_id", "left")
    return named.withColumn("topic_name", F.coalesce("topic_name", F.lit(default)))


def topic_relevance(topic_terms: DataFrame, weight: float = 0.6) -> DataFrame:
    """Term relevance within a topic: log p(w|t) balanced against its lift over p(w)."""
    totals = topic_terms.select("ticker", "term", "n").distinct().groupBy("ticker").agg(
        F.sum("n").alias("corpus")
    )
    lift = F.col("probability") / (F.col("n") / F.col("corpus"))
    relevance = weight * F.ln("probability") + (1 - weight) * F.ln(lift)
    return topic_terms.join(totals, "ticker").select(
        "ticker", "topic", "term", round_to(F.col("probability"), 9).alias("probability"),
        round_to(relevance, 6).alias("relevance"),
    )


def topic_sizes(assignments: DataFrame) -> DataFrame:
    """Share of a ticker's documents each topic accounts for."""
    parts = assignments.select("ticker", F.posexplode("distribution").alias("topic", "share"))
    return parts.groupBy("ticker", "topic").agg(
        round_to(F.avg("share"), 9).alias("prevalence"), F.count("*").alias("documents")
    )


def topic_distance(topic_terms: DataFrame) -> DataFrame:
    """Jensen-Shannon divergence between the topics of a ticker.

    At most ten topics share a term, so a term's row meets nine others, never the whole vocabulary.
    """
    left = topic_terms.select("ticker", "term", F.col("topic").alias("topic_a"), F.col("probability").alias("p"))
    right = topic_terms.select("ticker", "term", F.col("topic").alias("topic_b"), F.col("probability").alias("q"))
    middle = (F.col("p") + F.col("q")) / 2.0
    part = 0.5 * (F.col("p") * F.ln(F.col("p") / middle) + F.col("q") * F.ln(F.col("q") / middle))
    pairs = left.join(right, ["ticker", "term"]).where(F.col("topic_a") < F.col("topic_b"))
    return pairs.groupBy("ticker", "topic_a", "topic_b").agg(round_to(F.sum(part), 6).alias("js_divergence"))


LAYOUT_SCHEMA = "ticker string, topic int, x double, y double"


def topic_layout(distances: DataFrame) -> DataFrame:
    """(ticker, topic, x, y): where a map shows the topics, from their distances (`topic_distance`).

    Classical scaling: squared distances centred by row and column, and the two leading eigenvectors,
    each as long as the root of its eigenvalue; an axis whose eigenvalue is not positive is all zero. A ticker's
    topics, ten at most by the settings, are one small matrix; tickers are spread over the tasks. A
    ticker with a single topic has no distances and no place.
    """
    laid_out = distances.groupBy("ticker").applyInPandas(lay_out, LAYOUT_SCHEMA)
    # Adding zero turns a negative zero into zero.
    return laid_out.select("ticker", "topic", *[(round_to(F.col(c), 6) + F.lit(0.0)).alias(c) for c in ("x", "y")])


def topic_shares(topic_terms: DataFrame, assignments: DataFrame) -> DataFrame:
    """(ticker, topic, share): the part of a ticker's documents that a fitted model gives to a topic."""
    known = topic_terms.select("ticker", "topic").distinct()
    return topic_sizes(assignments).join(known, ["ticker", "topic"], "left_semi").select(
        "ticker", "topic", F.col("prevalence").alias("share")
    )


def term_saliency(topic_terms: DataFrame, shares: DataFrame, n: int = 30) -> DataFrame:
    """(ticker, term, distinctiveness, saliency, rank): the terms a map shows before a topic is chosen.

    Distinctiveness is how far the topics of a term, p(topic | term), are from the shares the topics
    have anyway (ticker, topic, share); saliency weighs it by the term's part of the ticker's words.
    Topics without a share are left out. ``n`` is the operator's feature: terms per ticker.
    """
    given = topic_terms.join(shares.where("share > 0"), ["ticker", "topic"])
    # As many rows as a ticker has topics, ten at most, meet per term.
    parts = given.groupBy("ticker", "term").agg(
        F.max("n").alias("n"), F.sum("probability").alias("total"),
        F.array_sort(F.collect_list(F.struct("topic", "probability", "share"))).alias("topics"),
    )
    kernel = F.aggregate(
        "topics", F.lit(0.0),
        lambda s, t: s + t["probability"] / F.col("total") * F.ln(t["probability"] / F.col("total") / t["share"]),
    )
    corpus = topic_terms.select("ticker", "term", "n").distinct().groupBy("ticker").agg(F.sum("n").alias("corpus"))
    scored = parts.withColumn("d", kernel).join(corpus, "ticker").select(
        "ticker", "term", round_to(F.col("d"), 6).alias("distinctiveness"),
        round_to(F.col("n") / F.col("corpus") * F.col("d"), 9).alias("saliency"),
    )
    return top_n_per_group(scored, ["ticker"], [F.desc("saliency"), F.asc("term")], n, salt_on=["term"], salts=32)
