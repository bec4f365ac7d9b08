import zlib

import numpy as np
import pytest

from newsvane.llm import language, private, queries, toxicity

MEDIUM = "/root/testdata/sf0.1"


def fold(doc_id, of):
    return zlib.crc32(str(doc_id).encode()) % of


@pytest.fixture(scope="module")
def scored(spark):
    return {r.doc_id: r for r in queries.op1_toxicity(spark, MEDIUM).collect()}


def test_toxicity_on_held_out_documents(spark, scored):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    held = [(scored[i].predicted, y) for i, y in labels.items() if scored[i].held_out]
    hits = sum(p and y for p, y in held)
    assert all(r.held_out == (fold(i, 4) == 2) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for i, r in scored.items())
    assert hits / sum(y for _, y in held) > 0.8
    assert hits / sum(p for p, _ in held) > 0.9
    assert len(scored) == spark.read.parquet(f"{MEDIUM}/documents.parquet").count()


def test_toxicity_of_planted_words():
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("aeioulnrstmd"), rng.integers(3, 9))) for _ in range(500)]
    plain = [" ".join(rng.choice(words, 40)) for _ in range(400)]
    toxic = [f"{t[:80]} {rng.choice(['grumbalox', 'vilefang', 'scumbert'])} {t[80:]}" for t in plain[:120]]
    model = toxicity.fit(plain[120:] + toxic[:90], [0] * 280 + [1] * 90)
    _, score = model.scorer()
    assert (score(toxic[90:]) >= 0.3).mean() > 0.95 and (score(plain[:120]) >= 0.3).mean() < 0.05


@pytest.mark.parametrize("texts, labels", [([], []), (["a b"], [1]), (["a b", "c"], [0, 0]), (["a b", ""], [0, 1]), (["x"] * 9, [0, 1, 0] * 3)])
def test_toxicity_of_tiny_samples(texts, labels):
    _, score = toxicity.fit(texts, labels).scorer()
    got = score(["anything", "", None])
    assert ((got >= 0) & (got <= 1)).all()


def test_toxicity_of_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(5, 1, 0), (6, 1, 1), (6, 0, 0), (8, 0, None), (None, 0, 1), (9, 0, 7), (99, 0, 1)], "doc_id long, quality int, toxic int")
    for docs in (odd_docs, no_docs):
        model = toxicity.train(docs, labels)
        got = toxicity.score_documents(docs, model).collect()
        assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    model = toxicity.train(odd_docs, labels.limit(0))
    assert {r.predicted for r in toxicity.score_documents(odd_docs, model).collect()} == {0}


def test_language_on_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang").collect()}
    got = queries.op7_language(spark, MEDIUM).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in got)
    held = [r.lang_pred == truth[r.doc_id] for r in got if r.held_out]
    assert sum(held) / len(held) > 0.99


def test_mixtures_are_told_apart(make_docs):
    one, two = "the river and the stone " * 30, "der fluss und das haus "  * 30
    docs = make_docs([(1, one, "en"), (2, two, "de"), (3, one, "en"), (4, two, "de")])
    model = language.train(docs)
    shares, _ = model.proportions([one, two, one + two, one + one + two])
    assert np.allclose(shares[0], [0, 1]) and np.allclose(shares[1], [1, 0])
    assert abs(shares[2][0] - 0.5) < 0.1 and 0.2 < shares[3][0] < 0.45


def _likeliest(model, text):
    """Share per language and penalised likelihood, by plain loops: every set that the order begins."""
    import math

    data = language.normalised(text)
    whole = data + b"    "
    buckets = [int.from_bytes(whole[i : i + 4], "little") * 2654435761 % 2**32 >> 16 for i in range(len(data))]
    n = len(model.languages)
    segments = [
        [sum(float(model.logs[b, k]) for b in buckets[i : i + language.SEGMENT]) for k in range(n)]
        for i in range(0, len(buckets), language.SEGMENT)
    ]
    total = [sum(s[k] for s in segments) for k in range(n)]
    one_round = [sum(1 / sum(math.exp(s[j] - s[k]) for j in range(n)) for s in segments) for k in range(n)]
    order = sorted(range(n), key=lambda k: (-round(one_round[k], 6), -total[k]))
    best, reached = {total.index(max(total)): 1.0}, max(total)
    for size in range(2, n + 1):
        share = dict.fromkeys(order[:size], 1 / size)
        for _ in range(3000):
            mixed = [sum(share[k] * math.exp(s[k] - max(s)) for k in share) for s in segments]
            share = {
                k: sum(share[k] * math.exp(s[k] - max(s)) / m for s, m in zip(segments, mixed)) / len(segments)
                for k in share
            }
        value = sum(max(s) + math.log(sum(share[k] * math.exp(s[k] - max(s)) for k in share)) for s in segments)
        value -= (size - 1) * (math.log(max(len(segments), 2)) / 2 + 2)
        if value > reached:
            best, reached = share, value
    return best, reached


def test_mixtures_as_by_plain_loops_with_any_number_of_languages():
    rng = np.random.default_rng(6)
    words = [["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(6)] for _ in range(6)]
    texts = [" ".join(rng.choice(w, 60)) for w in words]
    counts = np.full((language.BUCKETS, 6), 0.5)
    for k, text in enumerate(texts):
        np.add.at(counts[:, k], language.gram_buckets(language.normalised(text)), 1)
    model = language.Model(list("uvwxyz"), np.log(counts / counts.sum(0)).astype(np.float32))
    asked = [texts[2], texts[0] + texts[1], " ".join(texts), " ".join(texts[:5]), "abc", texts[3] + "jj aa " * 9]
    got, reached = model.proportions(asked)
    for text, row, value in zip(asked, got, reached):
        want, best = _likeliest(model, text)
        assert set(np.flatnonzero(row)) == set(want)
        assert value == pytest.approx(best, abs=language.TOLERANCE * len(text))
        assert [row[k] for k in want] == pytest.approx(list(want.values()), abs=0.03)
    # Five and six languages are found, and a text's result does not depend on those beside it.
    assert (got[2] > 0).sum() == 6 and (got[3] > 0).sum() == 5
    for i, text in enumerate(asked):
        assert np.allclose(model.proportions([text])[0][0], got[i], atol=1e-12)


def test_pieces_of_a_long_text_change_nothing(monkeypatch):
    rng = np.random.default_rng(7)
    model = language.Model(["a", "b"], np.log(rng.uniform(1, 9, (language.BUCKETS, 2)) / 1e5).astype(np.float32))
    texts = ["".join(rng.choice(list("abc "), size)) for size in (3, 700, 50, 0)]
    whole = model.proportions(texts)
    monkeypatch.setattr(language, "PIECE", language.SEGMENT * 2)
    assert all(np.array_equal(a, b) for a, b in zip(whole, model.proportions(texts)))


def test_gram_buckets_by_hand():
    data = language.normalised("Ab1 ÉTÉ")
    assert len(data) % language.SEGMENT == 0 and data.startswith("ab  été    ".encode())
    whole = data + b"    "
    for at, bucket in enumerate(language.gram_buckets(data).tolist()):
        assert bucket == int.from_bytes(whole[at : at + 4], "little") * 2654435761 % 2**32 >> 16


def test_language_of_odd_documents(odd_docs, no_docs):
    model = language.train(odd_docs)
    got = [tuple(r) for r in language.identify(odd_docs, model, with_shares=True).collect()]
    texts = [r.text for r in odd_docs.collect()]
    assert [g[1] == "und" and g[2] == 0 for g in got] == [not any(c.isalpha() for c in t or "") for t in texts]
    assert language.identify(no_docs, model).collect() == []
    nothing = language.train(no_docs)
    assert {r.lang_pred for r in language.identify(odd_docs, nothing).collect()} == {"und"}
    alone = language.train(odd_docs.where("lang = 'en'"))
    assert {r.lang_pred for r in language.identify(odd_docs, alone).collect()} == {"en", "und"}


def test_viterbi_as_by_trying_all_paths():
    from itertools import product

    rng = np.random.default_rng(2)
    sizes = [1, 3, 5, 2, 5]
    emission = rng.normal(size=(sum(sizes), 4)).astype(np.float32)
    pairs = rng.normal(size=(4, 4)).astype(np.float32)
    end = np.cumsum(sizes)
    got = private.viterbi(emission, end - sizes, end, pairs)
    for stop, size in zip(end, sizes):
        part = emission[stop - size : stop]
        best = max(
            product(range(4), repeat=size),
            key=lambda p: sum(part[t, y] for t, y in enumerate(p)) + sum(pairs[a, b] for a, b in zip(p, p[1:])),
        )
        assert tuple(got[stop - size : stop]) == best


def test_slope_of_the_likelihood():
    rng = np.random.default_rng(3)
    emission, pairs, labels = rng.normal(size=(4, 4)), rng.normal(size=(4, 4)), [0, 2, 1, 1]

    def likelihood(e, p):
        from itertools import product

        score = lambda y: sum(e[t, c] for t, c in enumerate(y)) + sum(p[a, b] for a, b in zip(y, y[1:]))
        return score(labels) - np.log(sum(np.exp(score(y)) for y in product(range(4), repeat=4)))

    gap, pair_gap = private._gap(emission, pairs, labels)
    for which, slope in ((0, gap), (1, pair_gap)):
        for at in np.ndindex(4, 4):
            moved = [emission.copy(), pairs.copy()]
            moved[which][at] += 1e-5
            assert abs((likelihood(*moved) - likelihood(emission, pairs)) / 1e-5 - slope[at]) < 1e-3
