import numpy as np
import pytest

from newsvane.operators import article_blocks, embeddings, models, vector_blocks, vectors

SCHEMA = "ticker string, id bigint, tokens array<string>"


@pytest.fixture
def articles(rows):
    """Articles without tokens, with unknown words and nulls, and one key on two rows."""
    rng = np.random.default_rng(8)
    lists = [[None if w == 7 else f"w{w}" for w in rng.integers(0, 90, n).tolist()] for n in [*range(25), 400, 1, 3]]
    data = [("t", i, t) for i, t in enumerate(lists)] + [("t", 5, ["w1", "w1"]), ("u", 5, None), ("u", 6, ["w88"])]
    return data, rows(data, SCHEMA).repartition(3)


def test_vectors_beyond_a_broadcast_are_shuffled(rows, articles, monkeypatch):
    """The same sums where the table of words may not be broadcast, in many groups, tasks and small blocks."""
    data, df = articles
    rng = np.random.default_rng(2)
    known = {f"w{i}": np.round(rng.normal(size=3) * 10 ** rng.integers(0, 4), 6) for i in range(70)}
    words = rows([(t, v.tolist()) for t, v in known.items()], "term string, vector array<double>")
    whole = sorted(map(tuple, vectors.document_vectors(df, ["ticker", "id"], "tokens", words, 3).collect()))
    sent = []

    def watched(frame, broadcast=vectors.F.broadcast):
        sent.append(set(frame.columns))
        return broadcast(frame)

    monkeypatch.setattr(vectors.F, "broadcast", watched)
    monkeypatch.setattr(vectors, "BROADCAST_LIMIT_BYTES", 0)
    for name, value in (("GROUP_WORDS", 10), ("ROW_WORDS", 9)):
        monkeypatch.setattr(vector_blocks, name, value)
    for name, value in (("BLOCK_TOKENS", 60), ("BLOCK_ARTICLES", 4)):
        monkeypatch.setattr(article_blocks, name, value)
    cut = sorted(map(tuple, vectors.document_vectors(df, ["ticker", "id"], "tokens", words, 3).collect()))
    assert cut == whole and len(cut) == len(data)
    assert sent and not any(columns & {"term", "v0", "vector", "x"} for columns in sent)
    merged = [w for t, i, tokens in data if (t, i) == ("t", 5) for w in tokens if w in known]
    for ticker, key, n, vector in cut:
        if (ticker, key) == ("t", 5):
            assert n == len(merged) and vector == pytest.approx(np.mean([known[w] for w in merged], axis=0), abs=1e-5)


def test_large_vectors_and_no_articles(rows, articles, monkeypatch):
    data, df = articles
    monkeypatch.setattr(vectors, "BROADCAST_LIMIT_BYTES", 0)
    words = rows([("w1", [3e9, -5e8]), ("w2", [-4e9, 1.0])], "term string, vector array<double>")
    cut = {(r.ticker, r.id): r for r in vectors.document_vectors(df, ["ticker", "id"], "tokens", words, 2).collect()}
    long = [w for w in data[25][2] if w in ("w1", "w2")]
    assert cut["t", 25].known_words == len(long)
    assert cut["t", 25].vector[0] == (long.count("w1") * 3 * 10**15 - long.count("w2") * 4 * 10**15) / len(long) / 1e6
    assert vectors.document_vectors(df.where("false"), ["ticker", "id"], "tokens", words, 2).collect() == []
    huge = rows([("w1", [9e12, 0.0])], "term string, vector array<double>")
    with pytest.raises(ArithmeticError):
        vectors.document_vectors(df, ["ticker", "id"], "tokens", huge, 2)


def test_features_of_the_classifier_without_a_broadcast(rows, articles, monkeypatch):
    """Labels and vectors of articles are the same when the word vectors are beyond a broadcast."""
    data, df = articles
    df = df.where("id <> 5").withColumn("label", vectors.F.col("id") % 3)
    words = rows([(f"w{i}", [0.5 * i, -1.0]) for i in range(60)], "term string, vector array<double>")
    whole = sorted(map(tuple, models.article_features(df, ["ticker", "id"], "tokens", words, 2, "label").collect()))
    monkeypatch.setattr(vectors, "BROADCAST_LIMIT_BYTES", 0)
    cut = sorted(map(tuple, models.article_features(df, ["ticker", "id"], "tokens", words, 2, "label").collect()))
    assert cut == whole and len(cut) == len([d for d in data if d[1] != 5])


def test_neighbours_of_vectors_made_without_a_broadcast(rows, monkeypatch):
    rng = np.random.default_rng(5)
    lists = [[f"w{int(x)}" for x in rng.zipf(1.4, 30) if x < 30] for _ in range(50)]
    df = rows([(t,) for t in lists], "tokens array<string>").repartition(2)
    near = [tuple(r) for r in vectors.nearest_terms(embeddings.fit(df, "tokens", 4, rounds=2), "w1", 5).collect()]
    sent = []

    def watched(frame, broadcast=embeddings.F.broadcast):
        sent.append(set(frame.columns))
        return broadcast(frame)

    monkeypatch.setattr(embeddings.F, "broadcast", watched)
    monkeypatch.setattr(embeddings, "BROADCAST_LIMIT_BYTES", 0)
    again = [tuple(r) for r in vectors.nearest_terms(embeddings.fit(df, "tokens", 4, rounds=2), "w1", 5).collect()]
    assert again == near and len(near) == 5 and not any(columns & {"x", "term", "ns"} for columns in sent)
