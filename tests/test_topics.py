import math
import numpy as np
import os
import subprocess
import sys
from itertools import takewhile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from newsvane import session
from newsvane.config import TopicSettings
from newsvane.operators import embeddings, models, topic_inference, topics, vectors


def corpus(rows, hot=40):
    """Two tickers whose documents speak of one of two word sets; one ticker is too small."""
    sets = (["oil", "gas", "rig", "well"], ["chip", "code", "cloud", "data"])
    data = [("hot", i, sets[i % 2] * 3) for i in range(hot)]
    data += [("cold", 1000 + i, sets[i % 2] * 2) for i in range(9)]
    data += [("tiny", 2000 + i, sets[0]) for i in range(4)] + [("cold", 1100, [])]
    return rows(data, "ticker string, id bigint, tokens array<string>")


@pytest.mark.parametrize("documents, k", [(5, 2), (9, 4), (40, 10), (400, 10)])
def test_topic_count(rows, documents, k):
    df = rows([(documents,)], "n bigint")
    assert df.select(topics.topic_count(F.col("n"))).first()[0] == k


def test_small_tickers_are_skipped(rows):
    got = {r["ticker"]: r["k"] for r in topics.topic_counts(corpus(rows)).collect()}
    assert got == {"hot": 10, "cold": 5}


def test_topics_separate_and_repeat(rows, monkeypatch):
    # Small blocks, so the hot ticker really is cut into several.
    monkeypatch.setattr(topics, "BLOCK_DOCUMENTS", 4)
    monkeypatch.setattr(topics, "SLICE_BLOCKS", 3)
    settings = TopicSettings(max_topics=2, iterations=15)
    docs = corpus(rows)
    model = topics.fit_topics(docs, settings)
    assert model._blocks.where("ticker = 'hot'").count() > 4
    assigned = model.assignments().collect()
    assert len(assigned) == 50
    for r in assigned:
        assert sum(r["distribution"]) == pytest.approx(1.0)
        assert r["dominant_topic_id"] == r["distribution"].index(max(r["distribution"]))
    hot = {r["id"]: r["dominant_topic_id"] for r in assigned if r["ticker"] == "hot"}
    assert len({hot[i] for i in range(0, 40, 2)}) == 1
    assert len({hot[i] for i in range(1, 40, 2)}) == 1
    assert hot[0] != hot[1]
    words = {(r["ticker"], r["topic"]): set(r["keywords"].split(", ")[:4]) for r in model.keywords().collect()}
    assert words["hot", hot[0]] == {"oil", "gas", "rig", "well"}
    totals = model.topic_terms().groupBy("ticker", "topic").agg(F.sum("probability").alias("p")).collect()
    assert all(r["p"] == pytest.approx(1.0) for r in totals)
    distances = topics.topic_distance(model.topic_terms()).collect()
    assert all(0 < r["js_divergence"] <= 0.6932 for r in distances)
    sizes = topics.topic_sizes(model.assignments()).groupBy("ticker").agg(F.sum("prevalence").alias("s")).collect()
    assert all(r["s"] == pytest.approx(1.0, abs=1e-6) for r in sizes)

    monkeypatch.setattr(topics, "BLOCK_DOCUMENTS", 4)
    again = topics.fit_topics(docs.repartition(3), settings).assignments().collect()
    same = {(r["ticker"], r["id"]): r["distribution"] for r in again}
    assert all(same[r["ticker"], r["id"]] == r["distribution"] for r in assigned)


def test_blocks_are_bounded_by_words(rows, monkeypatch):
    monkeypatch.setattr(topics, "BLOCK_TOKENS", 20)
    model = topics.fit_topics(corpus(rows), TopicSettings(max_topics=2, iterations=1))
    assert model._blocks.where("ticker = 'hot'").count() > 10
    assert model.assignments().count() == 50


def test_rounds_leave_nothing_behind(spark, rows):
    folder = f"{session.ensure_checkpoint_dir(spark)}/staged".removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    model = topics.fit_topics(corpus(rows), TopicSettings(max_topics=2, iterations=3))
    assert len([f for f in set(os.listdir(folder)) - before if "weights" in f]) == 1
    model.discard()
    assert set(os.listdir(folder)) - before == set()
    assert not spark.catalog.tableExists(model._table)


def test_the_bound_never_falls(rows):
    model = topics.fit_topics(corpus(rows), TopicSettings(max_topics=3, iterations=8))
    found = {}
    for r in model.bounds().orderBy("ticker", "round").collect():
        found.setdefault(r["ticker"], []).append(r["bound"])
    assert {t: len(b) for t, b in found.items()} == {"hot": 8, "cold": 8}
    # Inner steps end within a tolerance, and parts of the sum are whole thousandths.
    assert all(after >= before - 0.1 for b in found.values() for before, after in zip(b, b[1:]))
    assert all(b[-1] > b[0] for b in found.values())


@pytest.mark.parametrize("lengths", [[0], [3, 0, 5], [1] * 40])
def test_the_bound_of_a_block(lengths):
    """The bound of documents, written out for each of them, against the one of the whole block."""
    rng = np.random.default_rng(3)
    lengths, k, width, alpha = np.array(lengths, dtype=np.int64), 2, 4, 0.5
    terms = rng.integers(0, width, lengths.sum())
    beta = rng.random((width, k))
    gamma, _, _, bound = topic_inference._infer(lengths, terms, beta)
    expected, at = 0.0, 0
    for n, g in zip(lengths, gamma):
        logs = topic_inference._expected_logs(g[None])[0]
        expected += sum(math.log(sum(math.exp(logs[j]) * beta[t, j] for j in range(k))) for t in terms[at : at + n])
        expected += sum((alpha - g[j]) * logs[j] + math.lgamma(g[j]) - math.lgamma(alpha) for j in range(k))
        expected += math.lgamma(alpha * k) - math.lgamma(sum(g))
        at += n
    assert bound == pytest.approx(expected, abs=1e-6)


@pytest.mark.parametrize("rows_of", [([3, 0, 1, 2] * 30, [40] * 9), ([1] * 40, [0]), ([90, 2] * 33,)])
def test_blocks_inferred_together_are_those_inferred_alone(rows_of, monkeypatch):
    """Batches of documents of several blocks give what plain loops over groups of documents give."""
    rng = np.random.default_rng(5)
    beta = rng.random((30, 3)) ** 4
    blocks = [(np.array(n, dtype=np.int64), rng.integers(0, 30, sum(n))) for n in rows_of]
    monkeypatch.setattr(topic_inference, "_CELLS_AT_ONCE", 50)
    for (lengths, terms), (gamma, seen, sums, _) in zip(blocks, topic_inference._infer_blocks(blocks, beta)):
        want, total, at = [], np.zeros_like(beta), 0
        for first in range(0, len(lengths), topic_inference._DOCUMENTS_AT_ONCE):
            group = lengths[first : first + topic_inference._DOCUMENTS_AT_ONCE]
            words = np.split(terms[at : at + group.sum()], np.cumsum(group)[:-1])
            now, at = 1 / 3 + group[:, None] / 3 + np.zeros((1, 3)), at + group.sum()
            for _ in range(topic_inference._INNER_STEPS):
                parts = [topic_inference._expected(g[None]) * beta[w] for g, w in zip(now, words)]
                new = np.array([1 / 3 + (p / p.sum(axis=1, keepdims=True)).sum(axis=0) for p in parts])
                change, now = np.abs(new - now).mean(), new
                if change < topic_inference._INNER_TOLERANCE:
                    break
            for g, w in zip(now, words):
                p = topic_inference._expected(g[None]) * beta[w]
                np.add.at(total, w, p / p.sum(axis=1, keepdims=True))
            want.append(now)
        assert gamma == pytest.approx(np.concatenate(want), abs=1e-9)
        assert list(seen) == sorted(set(terms)) and sums == pytest.approx(total[seen], abs=1e-9)


def test_texts_are_cut_into_tokens_once(spark, rows):
    """Sizes, vocabulary and blocks read the staged lists, whatever the tokens are made from."""
    cut = spark.sparkContext.accumulator(0)

    def tokens(text):
        cut.add(1)
        return text.split()

    texts = rows([("t", i, "oil gas rig" if i % 2 else "chip code") for i in range(12)], "ticker string, id bigint, text string")
    made = texts.select("ticker", "id", F.udf(tokens, "array<string>")("text").alias("tokens"))
    model = topics.fit_topics(made, TopicSettings(max_topics=2, iterations=1))
    assert model.assignments().count() == 12 and cut.value == 12
    models.corpus_topics(made, "tokens", k=2, min_docs=1, iterations=1)
    assert cut.value == 24


def test_a_small_corpus_is_cut_for_many_tasks(rows, monkeypatch):
    """Ten blocks are not one slice, which one task would infer, and a slice never holds more than its bound."""
    monkeypatch.setattr(topics, "BLOCK_DOCUMENTS", 4)
    model = topics.fit_topics(corpus(rows), TopicSettings(max_topics=2, iterations=1))
    assert model._blocks.where("ticker = 'hot'").select("slice").distinct().count() >= 2
    assert [topics._slice_blocks(n) for n in (0, 100, 960, 10**6)] == [4, 4, 10, 64]
    assert "ids" not in model._statistics()._jdf.queryExecution().executedPlan().toString()


def test_a_round_does_not_move_the_blocks(rows):
    model = topics.fit_topics(corpus(rows), TopicSettings(max_topics=2, iterations=1))
    plan = model._statistics()._jdf.queryExecution().executedPlan().toString()
    blocks, leads = plan[plan.index("FlatMapCoGroupsInArrow") :].split("+- Sort", 1)
    assert "Bucketed: true" in blocks and "Exchange" not in blocks and "Exchange" in leads


def test_many_small_tickers_share_buckets(rows, monkeypatch):
    monkeypatch.setattr(topics, "MOST_BUCKETS", 2)
    data = [(f"t{i}", 10 * i + j, ["oil", "gas", "rig"] if j % 2 else ["chip", "code"]) for i in range(9) for j in range(5)]
    docs = rows(data, "ticker string, id bigint, tokens array<string>")
    settings = TopicSettings(max_topics=2, iterations=2)
    few = topics.fit_topics(docs, settings)
    assert few._blocks.rdd.getNumPartitions() <= 2
    monkeypatch.undo()
    order = ["ticker", "id"]
    many = topics.fit_topics(docs, settings).assignments().orderBy(*order).collect()
    assert few.assignments().orderBy(*order).collect() == many and len(many) == 45


CORES = """
import sys
sys.path.insert(0, {root!r})
from newsvane.plans.registry import QUERIES
from newsvane.session import build_session
spark = build_session("cores", "local[{cores}]", **{{"spark.sql.shuffle.partitions": "{partitions}", "spark.sql.warehouse.dir": {folder!r}}})
spark.sparkContext.setLogLevel("OFF")
from newsvane.config import TopicSettings
from newsvane.operators import embeddings, models, topics
from newsvane.plans import registry
docs = registry._doc_tokens(spark, "/root/testdata/sf0.001")
one = models.corpus_assignments(models.corpus_topics(docs, "tokens", iterations=3)).orderBy("ticker", "id").collect()
two = topics.fit_topics(docs, TopicSettings(iterations=2)).assignments().orderBy("ticker", "id").collect()
words = embeddings.fit(docs.where("id < 60"), "tokens", 8, rounds=2)
rows = models.article_features(docs.withColumn("label", docs.id % 3), ["ticker", "id"], "tokens", words, 8, "label")
forest = models.fit_classifier(rows.selectExpr("ticker", "id", "CAST(label AS STRING) AS label", "vector"), ["ticker", "id"], "label", 5, 4, 90)
heads, weights = models.score_predictions(rows, ["label"], 8)
print("RESULT", hash(tuple(str(r) for r in one + two)), hash(forest.stages[-1].toDebugString.split(",", 1)[1]), hash(str(weights)))
"""


def test_models_are_the_same_on_two_and_four_cores(tmp_path):
    root = str(Path(__file__).resolve().parent.parent)
    found = set()
    for cores, partitions in ((2, 3), (4, 8)):
        code = CORES.format(root=root, cores=cores, partitions=partitions, folder=str(tmp_path / f"w{cores}"))
        done = subprocess.run(
            [sys.executable, "-c", code], capture_output=True, text=True, cwd=root, timeout=600,
            env={**os.environ, "PYTHONHASHSEED": "0"},
        )
        found.add(next(line for line in done.stdout.splitlines() if line.startswith("RESULT")))
    assert len(found) == 1


def test_articles_that_share_an_id_are_two_in_the_corpus_model(rows):
    words = (["oil", "gas", "rig"] * 3, ["chip", "code", "cloud"] * 3)
    df = rows([(t, i, words[t == "B"]) for t in "AB" for i in range(12)], "ticker string, id bigint, tokens array<string>")
    got = models.corpus_assignments(models.corpus_topics(df, "tokens", k=2, min_docs=1, iterations=10)).collect()
    assert len(got) == 24
    assert len({r["dominant_topic_id"] for r in got if r["ticker"] == "A"}) == 1
    assert {r["dominant_topic_id"] for r in got if r["ticker"] == "A"} != {r["dominant_topic_id"] for r in got if r["ticker"] == "B"}


def test_document_vectors(rows):
    words = rows([("a", [1.0, 0.0]), ("b", [0.0, 0.5])], "term string, vector array<double>")
    df = rows([("A", 1, ["a", "a", "b", "x"]), ("B", 1, ["b"]), ("A", 2, ["x"])], "ticker string, id bigint, tokens array<string>")
    got = {(r["ticker"], r["id"]): (r["known_words"], r["vector"]) for r in vectors.document_vectors(df, ["ticker", "id"], "tokens", words, 2).collect()}
    assert got["A", 1][0] == 3 and got["A", 1][1] == pytest.approx([2 / 3, 1 / 6], abs=1e-6)
    assert got["B", 1] == (1, [0.0, 0.5]) and got["A", 2] == (0, None)
    assert [r["term"] for r in vectors.nearest_terms(words, "a", 5).collect()] == ["b"]


def test_argmax_takes_the_first_of_equals(rows):
    df = rows([([0.4, 0.4, 0.2],), ([0.1, 0.2, 0.7],)], "v array<double>")
    assert [r[0] for r in df.select(vectors.dominant_index(F.col("v"))).collect()] == [0, 2]


def test_split_is_stable_and_near_its_share(spark):
    ids = spark.range(20_000)
    train, test = models.split(ids, "id")
    assert train.count() + test.count() == 20_000
    assert 0.78 < train.count() / 20_000 < 0.82
    assert train.repartition(3).exceptAll(models.split(ids.repartition(5), "id")[0]).count() == 0


def _articles(rows, sets, n):
    tokens = [(("A", "B")[i % 3 == 0], i, sets[i % 2] * 4 + (["only"] if i == 7 else [])) for i in range(n)]
    labels = [(*t, "positive" if t[1] % 2 == 0 else "negative", 0.8 if t[1] % 2 else -0.8) for t in tokens]
    odd = [("A", 900, [], "positive", 0.1), ("A", 901, ["unseen"], "negative", None)]
    return rows(labels + odd, "ticker string, id bigint, tokens array<string>, label string, polarity double")


def test_classifier_learns_saves_and_loads(spark, rows, tmp_path):
    df = _articles(rows, (["gain", "rise", "up"], ["loss", "fall", "down"]), 120)
    words = embeddings.fit(df, "tokens", size=8, rounds=4)
    made = models.article_features(df, ["ticker", "id"], "tokens", words, 8, "label")
    assert made.count() == df.count() and made.where("id = 900").first()["vector"] == [0.0] * 8
    train, test = models.split(made.where("id < 900"), "id")
    options = {"trees": 5, "depth": 3, "rows_per_task": 40}
    fitted = models.fit_classifier(train, ["ticker", "id"], "label", **options)
    predicted = fitted.transform(models.with_features(test))
    assert models.accuracy(predicted) > 0.9
    fitted.write().overwrite().save(str(tmp_path / "model"))
    again = models.PipelineModel.load(str(tmp_path / "model")).transform(models.with_features(test))
    assert again.select("id", "prediction").exceptAll(predicted.select("id", "prediction")).count() == 0
    assert models.confusion(again).count() >= 2
    # The layout of the rows changes no tree.
    other = models.fit_classifier(train.repartition(7), ["ticker", "id"], "label", **options)
    trees = [model.stages[-1].toDebugString.split(",", 1)[1] for model in (fitted, other)]
    assert trees[0] == trees[1]


def test_score_heads(rows):
    df = _articles(rows, (["good", "fine"], ["bad", "poor"]), 60)
    words = embeddings.fit(df, "tokens", size=4, rounds=4)
    made = models.article_features(df, ["ticker", "id"], "tokens", words, 4, "polarity")
    predicted, weights = models.score_predictions(made, ["polarity"], 4)
    assert set(weights) == {"polarity"} and len(weights["polarity"]) == 5
    assert predicted.count() == 62 and predicted.where("pred_polarity IS NULL").count() == 0
    assert models.mean_squared_errors(predicted.where("id < 900"), ["polarity"])["polarity"] < 0.2


def test_predictions_are_those_of_sql_from_the_same_weights(rows, spark):
    import duckdb

    df = _articles(rows, (["good", "fine"], ["bad", "poor"]), 60)
    words = embeddings.fit(df, "tokens", size=4, rounds=4)
    made = models.article_features(df, ["ticker", "id"], "tokens", words, 4, "polarity")
    predicted, weights = models.score_predictions(made, ["polarity"], 4)
    table = made.select("id", "vector").toPandas()  # noqa: F841
    table["vector"] = table["vector"].map(list)
    constant, *rest = weights["polarity"]
    sql = f"SELECT id, {constant!r} + list_dot_product(vector::DOUBLE[], {rest!r}::DOUBLE[]) FROM table"
    want = dict(duckdb.sql(sql.replace("FROM table", 'FROM "table"')).fetchall())
    assert {r["id"]: r["pred_polarity"] for r in predicted.collect()} == pytest.approx(want, abs=1e-9)


def test_label_index(rows):
    df = rows([("b",), ("a",), ("c",), ("c",)], "label string")
    got = models.label_index(df, "label").orderBy("label_index").collect()
    assert [tuple(r) for r in got] == [("c", 2, 0), ("a", 1, 1), ("b", 1, 2)]


def test_layout_keeps_distances_of_points_in_a_plane(rows):
    points = {0: (0.0, 0.0), 1: (3.0, 0.0), 2: (0.5, 1.0), 3: (-1.0, -0.25), 4: (2.0, 2.0)}
    pairs = [
        ("A", a, b, float(np.hypot(points[a][0] - points[b][0], points[a][1] - points[b][1])))
        for a in points for b in points if a < b
    ] + [("B", 0, 1, 0.5)]
    df = rows(pairs, "ticker string, topic_a int, topic_b int, js_divergence double")
    got = {(r.ticker, r.topic): (r.x, r.y) for r in topics.topic_layout(df).collect()}
    for ticker, a, b, d in pairs:
        assert np.hypot(*np.subtract(got[ticker, a], got[ticker, b])) == pytest.approx(d, abs=1e-5)
    # The first axis is the wider one, centred, and its first topic off the middle is on the positive side.
    places = np.array([got["A", t] for t in points])
    assert np.allclose(places.sum(axis=0), 0, atol=1e-5) and (places**2).sum(axis=0)[0] >= (places**2).sum(axis=0)[1]
    assert places[0][0] > 0 and got["B", 0] == (0.25, 0.0) and got["B", 1] == (-0.25, 0.0)


def test_layout_of_equal_topics_and_none(rows):
    schema = "ticker string, topic_a int, topic_b int, js_divergence double"
    same = rows([("A", 0, 1, 0.0), ("A", 0, 2, 0.0), ("A", 1, 2, 0.0)], schema)
    assert {(r.x, r.y) for r in topics.topic_layout(same).collect()} == {(0.0, 0.0)}
    assert topics.topic_layout(same.where("false")).collect() == []


def test_saliency_prefers_frequent_terms_of_one_topic(rows):
    cells = [("A", t, w, n, p) for w, n, ps in [("only", 50, (0.5, 0.001)), ("both", 50, (0.2, 0.2)), ("rare", 2, (0.001, 0.3))]
             for t, p in enumerate(ps)]
    df = rows(cells, "ticker string, topic int, term string, n bigint, probability double")
    shares = rows([("A", 0, 0.5), ("A", 1, 0.5)], "ticker string, topic int, share double")
    got = topics.term_saliency(df, shares, 2).collect()
    assert [(r.term, r["rank"]) for r in sorted(got, key=lambda r: r["rank"])] == [("only", 1), ("rare", 2)]
    q = np.array([0.5, 0.001]) / 0.501
    d = float((q * np.log(q / 0.5)).sum())
    assert got[0].distinctiveness == pytest.approx(d, abs=1e-6) and got[0].saliency == pytest.approx(50 / 102 * d, abs=1e-8)


def test_document_vectors_move_one_row_per_article(rows, monkeypatch):
    """Words meet their vectors where they are read, also when the table of words goes in pieces."""
    rng = np.random.default_rng(8)
    docs = [("t", i, [f"w{int(x)}" for x in rng.integers(0, 30, i)]) for i in range(25)]
    df = rows(docs, "ticker string, id bigint, tokens array<string>").repartition(3)
    words = rows([(f"w{i}", [float(i), -0.5 * i]) for i in range(20)], "term string, vector array<double>")
    made = vectors.document_vectors(df, ["ticker", "id"], "tokens", words, 2)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(term" not in plan and ", term" not in "".join(p.split("]")[0] for p in plan.split("hashpartitioning(")[1:])
    whole = {r["id"]: (r["known_words"], r["vector"]) for r in made.collect()}
    monkeypatch.setattr(vectors, "BROADCAST_LIMIT_BYTES", 500)
    cut = {r["id"]: (r["known_words"], r["vector"]) for r in vectors.document_vectors(df, ["ticker", "id"], "tokens", words, 2).collect()}
    assert cut == whole and len(cut) == 25
    for _, i, tokens in docs:
        known = [int(w[1:]) for w in tokens if int(w[1:]) < 20]
        assert whole[i][0] == len(known)
        assert not known or whole[i][1] == pytest.approx([np.mean(known), -0.5 * np.mean(known)])


def test_a_ticker_is_not_one_task(spark, rows, monkeypatch):
    """The words of a ticker are counted where they are read and dealt by term; documents are moved once, in slices."""
    written = []
    stage, stage_buckets = topics.stage, topics.stage_buckets
    monkeypatch.setattr(topics, "stage", lambda df, name, *a: written.append((name, df)) or stage(df, name, *a))
    monkeypatch.setattr(topics, "stage_buckets", lambda df, *a: written.append(("blocks", df)) or stage_buckets(df, *a))
    monkeypatch.setattr(topics, "BLOCK_DOCUMENTS", 4)
    # Nothing is small enough to be broadcast unasked: a join on the ticker would move its documents.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        topics.fit_topics(corpus(rows), TopicSettings(max_topics=2, iterations=0))
        topics.display_model(corpus(rows), TopicSettings(max_topics=2, iterations=0))
        plans = [df._jdf.queryExecution().executedPlan().toString() for name, df in written if name == "topic-vocabulary"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(plans) == 2
    for plan in plans:
        lines = plan.splitlines()
        at = next(i for i, line in enumerate(lines) if "Generate explode" in line)
        # What stands below the counted words is indented further.
        deep = lines[at].index("Generate")
        below = list(takewhile(lambda line: line[deep:].startswith(("+-", "   ")), lines[at + 1 :]))
        assert "Scan" in below[-1] and not any("Exchange" in line for line in below), plan
    blocks = next(df for name, df in written if name == "blocks")
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    # Documents are not collected before they are dealt to their slices.
    assert "REPARTITION_BY_NUM" in plan and "ids" not in plan[plan.index("REPARTITION_BY_NUM") :]
    assert "collect_list(struct(id" not in plan


def test_blocks_may_be_cut_by_batches(rows, monkeypatch, spark):
    """The blocks are the same however many rows come to a task at once, documents without words included."""

    def blocks():
        model = topics.fit_topics(corpus(rows), TopicSettings(max_topics=2, iterations=0))
        return sorted((r.ticker, r.slice, r.block, r.k, r.ids, r.lengths, r.terms) for r in model._blocks.collect())

    monkeypatch.setattr(topics, "BLOCK_DOCUMENTS", 7)
    whole = blocks()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert blocks() == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sum(len(r[4]) for r in whole) == 50 and [] not in [r[4] for r in whole]
    assert all(sum(r[5]) == len(r[6]) for r in whole)
