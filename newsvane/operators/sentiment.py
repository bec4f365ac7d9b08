"""Lexicon sentiment as token-level joins.

A text is scored by exploding its tokens, keeping those that are lexicon words, looking at up to
three words before each of them, and summing. The explode, the lexicon join and the first half of
the sum run in one stage; what is shuffled is one partial row per text, never its tokens.

Contributions are rounded to six decimals as integers, so a score does not depend on the order in
which Spark adds them up.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsvane.config import Thresholds
from newsvane.dictionaries import CONTRAST_WORD
from newsvane.functions.labels import compound_label, polarity_label, subjectivity_label
from newsvane.functions.numeric import micros_sql, round_sql, round_to

# Fixed values of the valence rules (Hutto & Gilbert 2014).
DISTANCES = (1, 2, 3)  # words looked at before a lexicon word
BOOSTER_DAMPING = (1.0, 0.95, 0.9)  # by distance
NEGATION_FACTOR = -0.74
CONTRAST_BEFORE, CONTRAST_AFTER = 0.5, 1.5
NORMALIZATION = 15.0
# Fixed value of the polarity rules: a negated word keeps half its polarity, reversed.
POLARITY_NEGATION = -0.5

FIELDS = ("title", "summary")
VARIANTS = ("lemma", "token")
SCORERS = {"tb_pol": "tb_label", "tb_sub": "tb_sub_label", "vd_comp": "vd_label"}
# Never a token, so it can stand in front of every list and keep texts without hits.
_START = ""


def _lexicon_hits(
    df: DataFrame, keys: Sequence[str], slots: Mapping[str, str],
    lexicon: DataFrame, modifiers: DataFrame,
) -> DataFrame:
    """One row per lexicon word in any of the token-list columns, plus one start row per list."""
    empty = "CAST(array() AS array<string>)"
    lists = ", ".join(
        f"struct('{slot}' AS slot, concat(array('{_START}'), coalesce({column}, {empty})) AS words)"
        for slot, column in slots.items()
    )
    texts = df.selectExpr(*keys, f"explode_outer(array({lists})) AS t").selectExpr(
        *keys, "t.slot", "t.words", f"array_position(t.words, '{CONTRAST_WORD}') AS contrast"
    )
    words = texts.selectExpr(
        *keys, "slot", "words", "contrast", "posexplode_outer(words) AS (at, w)"
    )
    start = df.sparkSession.sql(
        f"SELECT '{_START}' AS w, 0 AS valence_tenths, 0 AS polarity_milli,"
        " 0 AS subjectivity_milli, 0 AS is_hit"
    )
    entries = lexicon.withColumn("is_hit", F.lit(1)).unionByName(start)
    measures = ("valence_tenths", "polarity_milli", "subjectivity_milli", "is_hit")
    hits = words.join(entries, "w", "inner").selectExpr(
        *keys, "slot", "contrast", "at", *measures,
        *[f"CASE WHEN at > {d} THEN words[at - {d}] END AS before{d}" for d in DISTANCES],
    )
    # A lexicon word in front modifies nothing.
    usable = modifiers.join(lexicon.select("w"), "w", "left_anti")
    for d in DISTANCES:
        near = usable.selectExpr(
            f"w AS before{d}", f"booster_milli / 1000D AS boost{d}", f"is_negation AS negated{d}",
            f"intensity_milli / 1000D AS intensity{d}",
        )
        hits = hits.join(near, f"before{d}", "left")
    return hits


def _valence_steps() -> list[str]:
    """Boosters and negations in front, from the nearest to the farthest, then the contrast weight.

    Each step refers to the ones before it.
    """
    steps = ["valence_tenths / 10D AS valence0"]
    for d, damping in zip(DISTANCES, BOOSTER_DAMPING):
        before, boost = f"valence{d - 1}", f"coalesce(boost{d} * {damping}D, 0D)"
        steps.append(f"CASE WHEN {before} < 0 THEN {before} - {boost} ELSE {before} + {boost} END AS boosted{d}")
        steps.append(f"CASE WHEN negated{d} THEN boosted{d} * {NEGATION_FACTOR}D ELSE boosted{d} END AS valence{d}")
    # `contrast` counts from 1 over a list that starts with the start word, as `at + 1` does.
    steps.append(
        "CASE WHEN contrast = 0 OR at + 1 = contrast THEN 1D"
        f" WHEN at + 1 < contrast THEN {CONTRAST_BEFORE}D ELSE {CONTRAST_AFTER}D END AS weight"
    )
    counted = f"CASE WHEN is_hit = 1 THEN valence{DISTANCES[-1]} * weight ELSE 0D END"
    return [*steps, f"{micros_sql(counted)} AS valence_micros"]


def _polarity_steps() -> list[str]:
    """An intensifier in front multiplies, a negation reverses and halves.

    Negation turns the intensifier round too: "not very good" is weaker than "not good".
    """
    factor = "CASE WHEN negated THEN 1D / coalesce(intensity1, 1D) ELSE coalesce(intensity1, 1D) END"
    polarity = "least(greatest(polarity_milli / 1000D * factor, -1D), 1D)"
    reversed_ = f"CASE WHEN negated THEN {polarity} * {POLARITY_NEGATION}D ELSE {polarity} END"
    return [
        "coalesce(negated1, false) OR (intensity1 IS NOT NULL AND coalesce(negated2, false)) AS negated",
        f"{factor} AS factor",
        f"{micros_sql(reversed_)} AS polarity_micros",
        f"{micros_sql('least(subjectivity_milli / 1000D * factor, 1D)')} AS subjectivity_micros",
    ]


def lexicon_sums(
    df: DataFrame, keys: Sequence[str], slots: Mapping[str, str],
    lexicon: DataFrame, modifiers: DataFrame,
) -> DataFrame:
    """One row per key with the integer sums of every token-list column.

    ``slots`` maps a slot name to a token-list column. All slots are scored in one pass.
    """
    hits = _lexicon_hits(df, keys, slots, lexicon, modifiers)
    valued = hits.selectExpr("*", *_valence_steps(), *_polarity_steps())
    sums = [
        F.expr(f"sum(CASE WHEN slot = '{slot}' THEN {measure} ELSE 0 END) AS {slot}__{measure}")
        for slot in slots
        for measure in ("valence_micros", "polarity_micros", "subjectivity_micros", "is_hit")
    ]
    return valued.groupBy(*keys).agg(*sums)


def slot_scores(slot: str) -> dict[str, str]:
    """The three scores of a slot, as expressions over its sums."""
    total, hits = f"({slot}__valence_micros / 1e6D)", f"{slot}__is_hit"
    squashed = f"{total} / sqrt({total} * {total} + {NORMALIZATION}D)"

    def mean(measure: str) -> str:
        return f"CASE WHEN {hits} = 0 THEN 0D ELSE {slot}__{measure}_micros / {hits} / 1e6D END"

    return {"tb_pol": mean("polarity"), "tb_sub": mean("subjectivity"), "vd_comp": round_sql(squashed, 4)}


def slot_name(field: str, variant: str) -> str:
    return f"{field}_{variant}"


def score_texts(
    df: DataFrame, keys: Sequence[str], tokens: str, lexicon: DataFrame, modifiers: DataFrame
) -> DataFrame:
    """Compound, polarity and subjectivity of one token-list column."""
    sums = lexicon_sums(df, keys, {"text": tokens}, lexicon, modifiers)
    scores = slot_scores("text")
    return sums.selectExpr(
        *keys,
        f"{scores['vd_comp']} AS compound",
        f"{scores['tb_pol']} AS polarity",
        f"{scores['tb_sub']} AS subjectivity",
    )


def score_variants(
    df: DataFrame, keys: Sequence[str], slots: Mapping[str, str], lexicon: DataFrame, modifiers: DataFrame,
    cuts: Thresholds = Thresholds(),
) -> DataFrame:
    """`<slot>_score` and `<slot>_label` by the compound score, for several token lists of a row in one pass."""
    sums = lexicon_sums(df, keys, slots, lexicon, modifiers)
    scored = sums.selectExpr(*keys, *[f"{slot_scores(slot)['vd_comp']} AS {slot}_score" for slot in slots])
    labels = [compound_label(F.col(f"{slot}_score"), cuts).alias(f"{slot}_label") for slot in slots]
    return scored.select("*", *labels)


def label_for(scorer: str, score: Column, cuts: Thresholds) -> Column:
    rules = {"tb_pol": polarity_label, "tb_sub": subjectivity_label, "vd_comp": compound_label}
    return rules[scorer](score, cuts)


def sentiment_matrix(
    nlp: DataFrame, keys: Sequence[str], lexicon: DataFrame, modifiers: DataFrame,
    cuts: Thresholds = Thresholds(),
) -> DataFrame:
    """Twelve scores and twelve labels per article: {title, summary} x {lemma, token} x scorer.

    Expects columns ``title_lemmas``, ``title_tokens``, ``summary_lemmas``, ``summary_tokens``.
    """
    slots = {slot_name(f, v): f"{f}_{v}s" for f in FIELDS for v in VARIANTS}
    sums = lexicon_sums(nlp, keys, slots, lexicon, modifiers)
    scored = sums.selectExpr(
        *keys,
        *[
            f"{score} AS {scorer}_{slot}"
            for slot in slots
            for scorer, score in slot_scores(slot).items()
        ],
    )
    columns: list[Column] = []
    for slot in slots:
        for scorer, label in SCORERS.items():
            score = F.col(f"{scorer}_{slot}")
            columns.append(score)
            columns.append(label_for(scorer, score, cuts).alias(f"{label}_{slot}"))
    return scored.select(*keys, *columns)


def scores_long(matrix: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The wide table as rows (key, field, variant, scorer, score, label)."""
    rows = ", ".join(
        f"struct('{field}' AS field, '{variant}' AS variant, '{scorer}' AS scorer,"
        f" {scorer}_{slot_name(field, variant)} AS score, {label}_{slot_name(field, variant)} AS label)"
        for field in FIELDS
        for variant in VARIANTS
        for scorer, label in SCORERS.items()
    )
    return matrix.selectExpr(*keys, f"inline(array({rows}))")


# The narrow tables of one scorer: its measures and the names they go by there.
NARROW = {
    "compound": {"vd_comp": ("vader_score", "vader_sentiment")},
    "polarity": {
        "tb_pol": ("polarity", "polarity_sentiment"),
        "tb_sub": ("subjectivity", "subjectivity_sentiment"),
    },
}


def narrow_scores(
    nlp: DataFrame, keys: Sequence[str], variant: str, scorer: str, lexicon: DataFrame,
    modifiers: DataFrame, cuts: Thresholds = Thresholds(),
) -> DataFrame:
    """One scorer over one kind of list: the scored texts, their scores and labels, per field.

    ``variant`` is "token" or "lemma", ``scorer`` is "compound" or "polarity".
    """
    slots = {field: f"{field}_{variant}s" for field in FIELDS}
    sums = lexicon_sums(nlp, keys, slots, lexicon, modifiers)
    columns = []
    for field in FIELDS:
        for measure, (score_name, label_name) in NARROW[scorer].items():
            score = F.expr(slot_scores(field)[measure])
            columns.append(score.alias(f"{field}_{score_name}"))
            columns.append(label_for(measure, score, cuts).alias(f"{field}_{label_name}"))
    texts = nlp.select(*keys, *[F.concat_ws(" ", slots[f]).alias(f"{f}_text") for f in FIELDS])
    return texts.join(sums.select(*keys, *columns), list(keys))


def induce_lexicon(
    docs: DataFrame, tokens: str, label: str, min_documents: int = 5, smoothing: float = 1.0
) -> DataFrame:
    """Smoothed log-odds of a token between documents labelled 1 and 0, by document frequency."""
    labelled = docs.where(F.col(label).isNotNull())
    words = labelled.select(label, F.explode_outer(F.array_distinct(tokens)).alias("w"))
    is_one, is_zero = (F.col(label) == 1).cast("bigint"), (F.col(label) == 0).cast("bigint")
    totals = labelled.agg(F.struct(F.sum(is_one).alias("one"), F.sum(is_zero).alias("zero"))).scalar()
    counts = (
        words.where(F.col("w").isNotNull())
        .groupBy("w")
        .agg(F.sum(is_one).alias("in_one"), F.sum(is_zero).alias("in_zero"))
        .where(F.col("in_one") + F.col("in_zero") >= min_documents)
    )
    odds_one = (F.col("in_one") + smoothing) / (F.col("docs")["one"] + 2 * smoothing)
    odds_zero = (F.col("in_zero") + smoothing) / (F.col("docs")["zero"] + 2 * smoothing)
    return counts.withColumn("docs", totals).select(
        "w", "in_one", "in_zero", round_to(F.ln(odds_one / odds_zero), 6).alias("log_odds")
    )


# Fixed value: log-odds of this much and more count as the strongest feeling.
STRONGEST = 4.0


def lexicon_of(induced: DataFrame) -> DataFrame:
    """An induced table (w, log_odds) as a lexicon to score with: valence up to 4, polarity up to 1, and as
    subjective as it is polar, by how far the log-odds are on the way to the strongest."""
    part = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("log_odds") / STRONGEST))
    return induced.where(F.col("log_odds") != 0).select(
        "w", F.round(part * 40).cast("int").alias("valence_tenths"), F.round(part * 1000).cast("int").alias("polarity_milli"),
        F.round(F.abs(part) * 1000).cast("int").alias("subjectivity_milli"),
    )
