import math
import random

import pytest
from pyspark.sql import functions as F

from newsvane.config import Thresholds
from newsvane.dictionaries import inline_table, lexicon_table, modifier_table
from newsvane.functions import labels
from newsvane.operators import sentiment

LEXICON = [("good", 19, 700, 600), ("bad", -25, -700, 667), ("best", 32, 1000, 300), ("meh", -5, -100, 200)]
MODIFIERS = [
    ("very", 293, False, 1300), ("slightly", -293, False, 700), ("not", 0, True, None),
    ("never", 0, True, None), ("best", 293, False, 1500),
]


def fixed(x):
    return math.floor(x * 1e6 + 0.5)


def brute_force(tokens):
    """The rules word by word, as written down by their authors."""
    lexicon = {w: rest for w, *rest in LEXICON}
    modifiers = {w: rest for w, *rest in MODIFIERS if w not in lexicon}
    turn = tokens.index("but") if "but" in tokens else None
    valence, polarity, subjectivity, hits = 0, 0, 0, 0
    for i, word in enumerate(tokens):
        if word not in lexicon:
            continue
        tenths, pol, sub = lexicon[word]
        v = tenths / 10
        for distance, damping in ((1, 1.0), (2, 0.95), (3, 0.9)):
            if i - distance < 0 or tokens[i - distance] not in modifiers:
                continue
            boost, negation, _ = modifiers[tokens[i - distance]]
            v += math.copysign(1, v if v else 1) * boost / 1000 * damping
            v *= -0.74 if negation else 1
        if turn is not None:
            v *= 0.5 if i < turn else 1.5 if i > turn else 1.0
        one = modifiers.get(tokens[i - 1]) if i > 0 else None
        two = modifiers.get(tokens[i - 2]) if i > 1 else None
        intensity = one[2] / 1000 if one and one[2] else None
        negated = bool(one and one[1]) or bool(intensity and two and two[1])
        factor = intensity or 1.0
        factor = 1 / factor if negated else factor
        p = max(-1.0, min(1.0, pol / 1000 * factor)) * (-0.5 if negated else 1)
        valence += fixed(v)
        polarity += fixed(p)
        subjectivity += fixed(min(1.0, sub / 1000 * factor))
        hits += 1
    total = valence / 1e6
    compound = math.floor(total / math.sqrt(total * total + 15) * 1e4 + 0.5) / 1e4
    mean = (lambda x: x / hits / 1e6) if hits else (lambda x: 0.0)
    return compound, mean(polarity), mean(subjectivity)


@pytest.fixture(scope="module")
def dictionaries(spark):
    return lexicon_table(spark, LEXICON), modifier_table(spark, MODIFIERS)


def score(rows, dictionaries, texts):
    df = rows([(i, t) for i, t in enumerate(texts)], "id bigint, tokens array<string>")
    scored = sentiment.score_texts(df, ["id"], "tokens", *dictionaries).collect()
    return [(r["compound"], r["polarity"], r["subjectivity"]) for r in sorted(scored, key=lambda r: r["id"])]


def test_one_hit(rows, dictionaries):
    assert score(rows, dictionaries, [["good"]])[0][0] == 0.4404


def test_texts_without_hits_keep_a_zero_score(rows, dictionaries):
    assert score(rows, dictionaries, [[], None, ["xyz"]]) == [(0.0, 0.0, 0.0)] * 3


def test_known_phrases(rows, dictionaries):
    scored = score(rows, dictionaries, [["very", "good"], ["not", "good"], ["not", "very", "good"]])
    assert scored[0] == (brute_force(["very", "good"])[0], 0.91, 0.78)
    assert scored[1][1] == -0.35
    assert scored[2][1] == pytest.approx(-0.7 / 1.3 / 2, abs=1e-6)


def test_matches_brute_force(rows, dictionaries):
    draw = random.Random(7)
    words = ["good", "bad", "best", "meh", "very", "slightly", "not", "never", "but", "x", "y"]
    texts = [[draw.choice(words) for _ in range(draw.randint(0, 14))] for _ in range(400)]
    assert score(rows, dictionaries, texts) == [brute_force(t) for t in texts]


def test_compound_stays_in_range_and_ignores_layout(spark, rows, dictionaries):
    texts = [["best"] * n for n in (1, 10, 500)] + [["bad"] * 500]
    df = rows([(i, t) for i, t in enumerate(texts)], "id bigint, tokens array<string>")
    one = sentiment.score_texts(df.repartition(1), ["id"], "tokens", *dictionaries)
    many = sentiment.score_texts(df.repartition(7), ["id"], "tokens", *dictionaries)
    assert sorted(one.collect()) == sorted(many.collect())
    assert all(-1 <= r["compound"] <= 1 for r in one.collect())


def test_labels_at_the_cut_points(rows):
    df = rows([(0.1,), (-0.1,), (0.0999,), (0.05,), (-0.05,), (0.5,)], "s double")
    got = df.select(
        labels.polarity_label(F.col("s")), labels.compound_label(F.col("s")), labels.subjectivity_label(F.col("s"))
    ).collect()
    assert [tuple(r) for r in got] == [
        ("positive", "positive", "objective"), ("negative", "negative", "objective"),
        ("neutral", "positive", "objective"), ("neutral", "positive", "objective"),
        ("neutral", "negative", "objective"), ("positive", "positive", "subjective"),
    ]


def test_matrix_has_twelve_scores_and_labels_and_goes_long(rows, dictionaries):
    nlp = rows(
        [(1, ["good"], ["goods"], ["bad"], [])],
        "id bigint, title_lemmas array<string>, title_tokens array<string>,"
        " summary_lemmas array<string>, summary_tokens array<string>",
    )
    matrix = sentiment.sentiment_matrix(nlp, ["id"], *dictionaries, Thresholds())
    assert len(matrix.columns) == 25
    row = matrix.first()
    assert (row["vd_comp_title_lemma"], row["vd_comp_title_token"]) == (0.4404, 0.0)
    assert (row["vd_label_title_lemma"], row["tb_label_summary_lemma"]) == ("positive", "negative")
    long = sentiment.scores_long(matrix, ["id"])
    assert long.count() == 12
    picked = long.where("field = 'title' AND variant = 'lemma' AND scorer = 'vd_comp'").first()
    assert (picked["score"], picked["label"]) == (0.4404, "positive")


def test_narrow_tables(rows, dictionaries):
    nlp = rows([(1, ["good"], ["not", "bad"])], "id bigint, title_tokens array<string>, summary_tokens array<string>")
    vader = sentiment.narrow_scores(nlp, ["id"], "token", "compound", *dictionaries).first()
    assert (vader["title_text"], vader["title_vader_score"], vader["title_vader_sentiment"]) == ("good", 0.4404, "positive")
    assert vader["summary_vader_sentiment"] == "positive"
    blob = sentiment.narrow_scores(nlp, ["id"], "token", "polarity", *dictionaries).first()
    assert (blob["summary_text"], blob["summary_polarity"], blob["title_subjectivity_sentiment"]) == (
        "not bad", 0.35, "subjective",
    )


def test_induced_lexicon(rows):
    docs = rows(
        [(["a", "a", "b"], 1), (["a"], 1), (["b"], 0), (["c"], None)], "tokens array<string>, quality int"
    )
    found = {r["w"]: r for r in sentiment.induce_lexicon(docs, "tokens", "quality", min_documents=1).collect()}
    assert set(found) == {"a", "b"}
    assert (found["a"]["in_one"], found["a"]["in_zero"]) == (2, 0)
    assert found["a"]["log_odds"] == pytest.approx(math.log((3 / 4) / (1 / 3)), abs=1e-6)


def test_inline_table_quotes_text(spark):
    assert inline_table(spark, [("it's", None, True)], ("a", "b", "c")).first() == ("it's", None, True)


def test_an_induced_table_scores(rows):
    induced = rows([("gain", 3, 0, 2.0), ("loss", 0, 9, -9.0), ("none", 1, 1, 0.0)], "w string, in_one bigint, in_zero bigint, log_odds double")
    lexicon = sentiment.lexicon_of(induced)
    assert sorted(map(tuple, lexicon.collect())) == [("gain", 20, 500, 500), ("loss", -40, -1000, 1000)]
    docs = rows([(1, ["gain", "none"]), (2, ["loss"])], "id bigint, tokens array<string>")
    modifiers = rows([], "w string, booster_milli int, is_negation boolean, intensity_milli int")
    got = {r.id: r.polarity for r in sentiment.score_texts(docs, ["id"], "tokens", lexicon, modifiers).collect()}
    assert got == {1: 0.5, 2: -1.0}
