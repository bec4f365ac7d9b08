"""Corpus topics, and the classifier and score heads on word vectors."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsvane.config import TopicSettings
from newsvane.functions.numeric import round_to
from newsvane.operators import regression
from newsvane.operators.terms import vocabulary
from newsvane.operators.topics import TickerTopics, fit_topics, stage_documents
from newsvane.operators.vectors import document_vectors, is_train
from newsvane.session import discard, stage

SEED = 42


CORPUS = "*"


def corpus_topics(
    docs: DataFrame, tokens: str, k: int = 10, iterations: int = 20, size: int = 10_000, min_docs: int = 5
) -> TickerTopics:
    """One topic model over the whole corpus (ticker, id, tokens): the per-ticker model with all
    articles under one heading.

    Every round reads every document, and sums are whole numbers, so the model is the same on any
    number of cores. The vocabulary, ``size`` terms at most, is the operator's feature.
    """
    whole = docs.select(F.lit(CORPUS).alias("ticker"), F.to_json(F.struct("ticker", "id")).alias("id"), F.col(tokens).alias("tokens"))
    whole, staged = stage_documents(whole)
    settings = TopicSettings(max_topics=k, iterations=iterations, vocabulary=size)
    sizes = whole.groupBy("ticker").agg(F.count("*").alias("documents")).withColumn("k", F.lit(k))
    words = vocabulary(whole, "tokens", size, min_docs).select(F.lit(CORPUS).alias("ticker"), "term_index", "term", "n")
    return fit_topics(whole, settings, sizes, words, staged)


def corpus_assignments(model: TickerTopics, id_type: str = "bigint") -> DataFrame:
    """(ticker, id, distribution, dominant_topic_id) of a corpus model."""
    article = F.from_json("id", f"ticker string, id {id_type}")
    return model.assignments().select(
        article["ticker"].alias("ticker"), article["id"].alias("id"), "distribution", "dominant_topic_id"
    )


def corpus_topic_keywords(model: TickerTopics) -> DataFrame:
    """(topic, keywords): the likeliest terms of every topic."""
    return model.keywords().select("topic", "keywords")


def article_features(
    df: DataFrame, keys: Sequence[str], tokens: str, words: DataFrame, size: int, *keep: str
) -> DataFrame:
    """(keys, ``keep`` columns, vector): the mean vector of an article's known words from a stored table
    (term, vector), zeros for an article without one. Keys are whole and occur once."""
    means = document_vectors(df, keys, tokens, words, size).select(*keys, "vector")
    zeros = F.array_repeat(F.lit(0.0), size)
    vector = F.coalesce("vector", zeros).alias("vector")
    return df.select(*keys, *keep).join(means, list(keys)).select(*keys, *keep, vector)


def sentiment_classifier(label: str, trees: int = 50, depth: int = 10) -> Pipeline:
    """Label index and random forest on the column ``features``."""
    return Pipeline(
        stages=[
            StringIndexer(inputCol=label, outputCol="label_index", handleInvalid="keep"),
            RandomForestClassifier(
                featuresCol="features", labelCol="label_index", numTrees=trees, maxDepth=depth, seed=SEED
            ),
        ]
    )


# A forest draws its samples task by task. So many rows are the work of one, whatever the machine.
ROWS_PER_TASK = 100_000


def with_features(rows: DataFrame) -> DataFrame:
    """The column ``vector`` as ``features``, in the form Spark ML reads."""
    return rows.withColumn("features", array_to_vector("vector"))


def fit_classifier(
    rows: DataFrame, keys: Sequence[str], label: str, trees: int = 50, depth: int = 10,
    rows_per_task: int = ROWS_PER_TASK,
) -> PipelineModel:
    """A forest fitted on rows (keys, vector, label); predict with ``transform(with_features(rows))``.

    The model is the same on any number of cores: rows are dealt by a hash of their keys to a number of tasks that
    follows from how many rows there are, and are sorted there, so every tree meets the same sample.
    Rows without a label take part as a label of their own, as the indexer keeps them.
    """
    spark = rows.sparkSession
    narrow, path = stage(rows.select(*keys, label, "vector"), "forest-rows")
    tasks = max(1, math.ceil(narrow.count() / rows_per_task))
    dealt = narrow.repartition(tasks, *keys).sortWithinPartitions(*keys, label)
    fitted = sentiment_classifier(label, trees, depth).fit(with_features(dealt))
    discard(spark, [path])
    return fitted


def split(df: DataFrame, key: str, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    train = is_train(F.col(key), share)
    return df.where(train), df.where(~train)


def accuracy(predictions: DataFrame) -> float:
    evaluator = MulticlassClassificationEvaluator(
        labelCol="label_index", predictionCol="prediction", metricName="accuracy"
    )
    return evaluator.evaluate(predictions)


def confusion(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("label_index", "prediction").agg(F.count("*").alias("articles"))


def accuracy_report(predictions: DataFrame) -> DataFrame:
    """One row: the share of articles whose prediction is their label, and how many there are."""
    right = F.avg(F.when(F.col("label_index") == F.col("prediction"), 1.0).otherwise(0.0))
    return predictions.agg(round_to(right, 6).alias("accuracy"), F.count("*").alias("articles"))


def score_predictions(
    rows: DataFrame, targets: Sequence[str], size: int, ridge: float = 0.01
) -> tuple[DataFrame, dict[str, list[float]]]:
    """The rows with `pred_<score>` per score, and the weights: linear heads on the column ``vector``.

    All heads are solved from one pass over the rows (`regression.gram`), the same on any number of
    cores. Rows without a score take no part in the fit and are predicted all the same.
    """
    weights = regression.fit_heads(regression.gram(rows, "vector", targets, size), size, targets, ridge)
    return regression.predict(rows, "vector", weights), weights


def mean_squared_errors(predictions: DataFrame, targets: list[str]) -> dict[str, float]:
    return {
        t: RegressionEvaluator(labelCol=t, predictionCol=f"pred_{t}", metricName="mse").evaluate(predictions)
        for t in targets
    }


def label_index(df: DataFrame, label: str) -> DataFrame:
    """Labels by frequency, index 0 the most frequent, ties by label: the order of a label indexer."""
    counts = df.groupBy(label).agg(F.count("*").alias("articles"))
    # One row per distinct label; a label column with very many values is no label column.
    order = Window.orderBy(F.desc("articles"), F.asc(label))
    return counts.withColumn("label_index", (F.row_number().over(order) - 1).cast("bigint"))
