import importlib.util
from pathlib import Path

import pytest

import __spark_entry__ as spark_entry

ROOT = Path(__file__).resolve().parent.parent
SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

spec = importlib.util.spec_from_file_location("check_oracles", ROOT / "tools" / "check_oracles.py")
check_oracles = importlib.util.module_from_spec(spec)
spec.loader.exec_module(check_oracles)

ORACLES = spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def small():
    return check_oracles.connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_its_sql(spark, small, name):
    _, _, verdict = check_oracles.compare(spark, small, SMALL, name, ORACLES[name])
    assert verdict == "ok"


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(spark_entry.queries())


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0


def values(spark, query, column):
    return {r[0] for r in spark_entry.queries()[query](spark, MEDIUM).select(column).distinct().collect()}


@pytest.mark.parametrize(
    "query, column, expected",
    [
        ("trading_signals", "signal", {-1, 0, 1}),
        ("position_state", "position", {0, 1}),
        ("trades", "side", {"buy", "sell"}),
        ("compare_scorers", "is_conflict", {True, False}),
        ("compare_token_lemma", "is_conflict", {True, False}),
        ("signal_chart_data", "marker", {"buy", "sell", None}),
        ("train_test_split", "is_train", {0, 1}),
    ],
)
def test_every_branch_occurs(spark, query, column, expected):
    assert values(spark, query, column) == expected


def test_every_label_occurs(spark):
    got = spark_entry.queries()["sentiment_labels"](spark, MEDIUM).collect()
    for column in ("compound_label", "polarity_label"):
        assert {r[column] for r in got} == {"positive", "negative", "neutral"}
    assert {r["subjectivity_label"] for r in got} == {"subjective", "objective"}
