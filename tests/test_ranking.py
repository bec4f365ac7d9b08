import math
import random

import pytest
from pyspark.sql import functions as F

from newsvane import session
from newsvane.operators import ranking, terms


@pytest.mark.parametrize("threshold", ["1000", "10"])
def test_top_n_per_group_with_a_hot_group(spark, rows, threshold):
    """Both ways: Spark's own cut for a small n, slices for an n above its threshold."""
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", threshold)
    draw = random.Random(3)
    data = [("hot" if i % 3 else f"g{i % 7}", i, draw.randint(0, 50)) for i in range(3000)]
    df = rows(data, "g string, id bigint, v bigint")
    got = ranking.top_n_per_group(df, ["g"], [F.desc("v"), F.asc("id")], 25, salt_on=["id"], salts=8)
    expected = []
    for g in {d[0] for d in data}:
        best = sorted((d for d in data if d[0] == g), key=lambda d: (-d[2], d[1]))[:25]
        expected += [(*d, i + 1) for i, d in enumerate(best)]
    assert sorted(tuple(r) for r in got.select("g", "id", "v", "rank").collect()) == sorted(expected)
    spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_global_rank_numbers_every_row_once(rows):
    draw = random.Random(4)
    data = [(i, draw.randint(0, 9)) for i in range(2000)]
    ranked = ranking.global_rank(rows(data, "id bigint, v bigint").repartition(5), [F.desc("v"), F.asc("id")])
    got = [(r["id"], r["v"]) for r in sorted(ranked.collect(), key=lambda r: r["rank"])]
    assert got == sorted(data, key=lambda d: (-d[1], d[0]))
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, 2001))


def test_latest_per_key_keeps_the_later_run(rows):
    df = rows(
        [("a", "2024-01-01", 1.0, 1), ("a", "2024-01-01", 2.0, 3), ("a", "2024-01-01", None, 2)],
        "ticker string, trade_date string, close double, run int",
    )
    kept = ranking.latest_per_key(df, ["ticker", "trade_date"], F.col("run"))
    assert [tuple(r) for r in kept.collect()] == [("a", "2024-01-01", 2.0, 3)]


def test_first_per_text(rows):
    df = rows([(3, "x", "s"), (1, "x", "t"), (2, "y", "s")], "id bigint, text string, source string")
    got = ranking.first_per_text(df, "text", "id").orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "x", "t", 2), (2, "y", "s", 1)]


def test_rows_without_a_text_are_no_copies(rows):
    df = rows([(1, None, "s"), (2, None, "t"), (4, "x", "t"), (3, "x", "s"), (None, "x", "u"), (None, "z", None)],
              "id bigint, text string, source string")
    got = {(r["id"], r["text"], r["copies"]) for r in ranking.first_per_text(df, "text", "id").collect()}
    assert got == {(1, None, 1), (2, None, 1), (3, "x", 3), (None, "z", 1)}


def test_rows_without_a_whole_key_all_stay(rows):
    data = [("A", None, "h1", 1), ("A", None, "h2", 1), (None, 1, "h3", 1), ("A", 1, "old", 1), ("A", 1, "new", 2), ("B", 1, "other", 1)]
    df = rows(data, "ticker string, id bigint, title string, run int")
    got = sorted(r["title"] for r in ranking.latest_per_key(df, ["ticker", "id"], F.col("run")).collect())
    assert got == ["h1", "h2", "h3", "new", "other"]


def test_latest_of_equals_is_the_same_in_any_layout(rows):
    df = rows([("A", 1, f"t{i}", 5) for i in range(30)] + [("A", 1, "t3", 5)], "ticker string, id bigint, title string, run int")
    first = ranking.latest_per_key(df, ["ticker", "id"], F.col("run")).collect()
    again = ranking.latest_per_key(df.repartition(7), ["ticker", "id"], F.col("run")).collect()
    assert len(first) == 1 and first == again


def test_dedup_never_sorts_wide_rows(rows):
    df = rows([(1, "x", "s", 1)], "id bigint, text string, source string, run int")
    for made in (ranking.first_per_text(df, "text", "id"), ranking.latest_per_key(df, ["id"], F.col("run"))):
        assert "SortAggregate" not in made._jdf.queryExecution().executedPlan().toString()


def test_bigrams_do_not_cross_documents(rows):
    df = rows([("A", ["a", "b", "a", "b"]), ("A", ["b"]), ("A", []), ("B", ["c", "a"])], "ticker string, tokens array<string>")
    got = terms.top_bigrams_per_group(df, "tokens", 2, "ticker").collect()
    assert sorted(tuple(r) for r in got) == [("A", "a b", 2, 1), ("A", "b a", 1, 2), ("B", "c a", 1, 1)]


def test_group_gate(rows):
    df = rows([("a", i) for i in range(4)] + [("b", i) for i in range(5)], "ticker string, i int")
    assert {r["ticker"] for r in ranking.groups_of_at_least(df, "ticker", 5).collect()} == {"b"}


def test_sequences(rows):
    df = rows(
        [("A", 1, ["a", "u", "b"]), ("A", 2, ["a", "b", "b", "b", "a", "a", "a"]), ("A", 3, []), ("A", 4, None)],
        "ticker string, id bigint, tokens array<string>",
    )
    got = {r["id"]: r["sequence"] for r in terms.encode_sequences(df, ["ticker", "id"], "tokens", 5).collect()}
    assert got == {1: [1, 0, 2, 0, 0], 2: [1, 2, 2, 2, 1], 3: [0] * 5, 4: [0] * 5}


def test_sequences_of_two_tickers_with_one_id(rows):
    df = rows([("A", 1, ["aa", "bb"]), ("B", 1, ["cc", "dd"])], "ticker string, id bigint, tokens array<string>")
    got = {r["ticker"]: r["sequence"] for r in terms.encode_sequences(df, ["ticker", "id"], "tokens", 6, 1).collect()}
    assert got == {"A": [1, 2, 0, 0, 0, 0], "B": [3, 4, 0, 0, 0, 0]}


def test_lemma_lists_by_join_need_no_key(rows):
    df = rows([(None, ["rising", "x"]), (None, ["x", "rising", "rising"]), (1, []), (1, None)], "id bigint, tokens array<string>")
    dictionary = rows([("rising", "rise"), ("rising", "rise"), ("unused", "u")], "token string, lemma string")
    got = [(r["id"], r["lemmas"]) for r in terms.with_lemmas(df, "tokens", "lemmas", dictionary).collect()]
    expected = [(None, ["rise", "x"]), (None, ["x", "rise", "rise"]), (1, []), (1, None)]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_count_vectors(rows):
    df = rows([("A", 1, ["a", "b", "a"]), ("B", 1, ["b"]), ("A", 2, ["c"]), ("A", 3, None)], "ticker string, id bigint, tokens array<string>")
    got = {(r["ticker"], r["id"]): (r["indices"], r["counts"]) for r in terms.count_vectors(df, ["ticker", "id"], "tokens", 2, 1).collect()}
    assert got == {("A", 1): ([0, 1], [2, 1]), ("B", 1): ([1], [1]), ("A", 2): ([], []), ("A", 3): ([], [])}


def test_pruned_vocabulary(rows):
    df = rows([("A", ["x", "all"]), ("A", ["x", "all", "x"]), ("A", ["one", "all"]), ("B", ["x"])], "ticker string, tokens array<string>")
    got = [tuple(r) for r in terms.pruned_vocabulary_per_group(df, "tokens", "ticker").collect()]
    assert got == [("A", 0, "x", 3)]


def test_document_frequencies_prune_both_ends(rows):
    df = rows([(["a", "a", "b"],), (["a", "b"],), (["a", "c"],), ([],)], "tokens array<string>")
    got = terms.document_frequencies(df, "tokens", 2, 0.6).collect()
    assert [tuple(r) for r in got] == [("b", 2, 4)]


def test_vocabulary_counts_words_and_documents(rows):
    df = rows([(["a", "a", "b"],), (["b"],), (["c", "c", "c"],)], "tokens array<string>")
    got = terms.vocabulary(df, "tokens", size=2, min_docs=1).orderBy("term_index").collect()
    assert [tuple(r) for r in got] == [(0, "c", 3, 1), (1, "a", 2, 1)]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 6, 99])
def test_rows_at_least_as_large_as_the_nth(rows, n):
    counts = [9, 7, 7, 5, 5, 1]
    got = sorted((r["n"] for r in ranking.at_least_nth(rows([(c,) for c in counts], "n bigint"), "n", n).collect()), reverse=True)
    assert got == [c for c in counts if n > len(counts) or c >= counts[n - 1]]


def g_squared(n, first, second, words):
    cells = [(n, first * second), (first - n, first * (words - second)), (second - n, (words - first) * second),
             (words - first - second + n, (words - first) * (words - second))]
    return 2 * sum(o * math.log(o * words / e) for o, e in cells if o > 0)


def test_association_is_a_likelihood_ratio(rows):
    cases = [(5, 7, 6, 100), (1, 50, 40, 100), (3, 3, 3, 1000), (0, 4, 5, 60), (2, 2, 2, 2), (19, 30, 20, 31)]
    df = rows(cases, "n bigint, a bigint, b bigint, c bigint").select("*", terms.association("n", "a", "b", "c").alias("g"))
    for n, a, b, c, g in df.collect():
        assert g == pytest.approx(0 if c in (a, b) else g_squared(n, a, b, c), abs=1e-9)


def test_collocations_take_from_their_words(rows):
    fixed = ["new", "york"] * 20
    filler = [f"w{i}" for i in range(120)]
    text = [w for i in range(20) for w in ("new", "york", *filler[6 * i : 6 * i + 6])] + ["new", "old"]
    df = rows([("A", text), ("B", fixed[:1]), ("B", []), ("B", None), ("C", fixed + ["of"])], "ticker string, tokens array<string>")
    got = {(r.ticker, r.term): r for r in terms.collocations_per_group(df, "tokens", 5, "ticker", ["of"]).collect()}
    pair = got["A", "new york"]
    assert (pair.n, pair.words, pair["rank"]) == (20, 2, 1) and pair.score == pytest.approx(g_squared(20, 21, 20, 162), abs=1e-5)
    # "york" has nothing left; "new" has the one time it stood before "old".
    assert ("A", "york") not in got and max(r.n for k, r in got.items() if k[0] == "A" and r.words == 1) == 1
    assert got["B", "new"].n == 1
    assert not any("of" in k[1] for k in got)


def test_tokens_of_collocations_are_made_once(spark, rows, monkeypatch):
    """Pairs, words and what scores are staged; words beyond a broadcast give the same by a shuffle."""
    made = spark.sparkContext.accumulator(0)

    def tokens(text):
        made.add(1)
        return text.split()

    texts = rows([("A" if i % 3 else "B", f"new york w{i} w{i % 5} old") for i in range(30)], "ticker string, text string")
    df = texts.select("ticker", F.udf(tokens, "array<string>")("text").alias("tokens"))
    first = sorted(map(tuple, terms.collocations_per_group(df, "tokens", 50, "ticker").collect()), key=str)
    assert made.value == 30 and any(r[1] == "new york" for r in first)
    monkeypatch.setattr(session, "BROADCAST_LIMIT_BYTES", 1)
    assert sorted(map(tuple, terms.collocations_per_group(df, "tokens", 50, "ticker").collect()), key=str) == first


def test_a_hot_group_of_pairs_is_the_same_in_any_layout(rows):
    data = [("A" if i % 3 else "B", [f"w{(i * k) % 7}" for k in range(9)]) for i in range(200)]
    df = rows(data, "ticker string, tokens array<string>")
    first = terms.collocations_per_group(df, "tokens", 50, "ticker").collect()
    again = terms.collocations_per_group(df.repartition(5), "tokens", 50, "ticker").collect()
    assert sorted(map(tuple, first), key=str) == sorted(map(tuple, again), key=str) and first
