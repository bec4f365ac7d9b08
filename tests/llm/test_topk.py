import math

import numpy as np
from pyspark.sql import functions as F

from newsvane.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, score long, query_id string"


def brute(rows, k=5, step=3):
    def scaled(x):
        # Exact also where a float has no fraction left.
        return math.floor(256 * float(np.float32(x))) if abs(x) < 2**60 else int(np.float32(x)) * 256

    whole = [(i, [scaled(x) for x in v]) for i, v in rows]
    out = []
    for q in sorted({i for i, _ in whole if i % step == 0}):
        mine = min(np.float32(v).tolist() for i, v in rows if i == q)
        mine = [scaled(x) for x in mine]
        scored = sorted((-sum(a * b for a, b in zip(mine, v)), i) for i, v in whole if i != q)
        out += [(q, r + 1, i, min(max(-s, -(2**63)), 2**63 - 1)) for r, (s, i) in enumerate(scored[:k])]
    return out


def run(spark, rows, step=3, k=5):
    df = spark.createDataFrame([(i, v, 1, 0, "q") for i, v in rows], SCHEMA)
    got = topk.top_k(df, df.where(F.col("vec_id") % step == 0), k)
    return sorted(tuple(r) for r in got.collect())


def test_random_vectors_and_many_ties(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(200)]
    rows += [(200 + i, [0.5] * 6) for i in range(300)]
    assert run(spark, rows) == brute(rows)


def test_left_out_and_uneven_vectors(spark):
    good = [(i, [float(i % 4), -1.0, 0.25]) for i in range(12)] + [(12, []), (13, [2.0]), (4, [9.0, 9.0, 9.0])]
    bad = [(15, None), (18, [1.0, None, 2.0]), (21, [float("nan"), 1.0, 1.0]), (24, [float("inf")]), (None, [1.0])]
    assert run(spark, good + bad) == brute(good)


def test_vectors_of_any_size_take_part(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=3).astype(np.float32).tolist()) for i in range(40)]
    rows += [(40, [1e30, 0.0, 0.0]), (42, [-1e30, 2.0, 1e38]), (45, [3e38, -3e38, 1.0]), (46, [1e30, 0.0, 0.0]), (48, [0.0, 1e9, 0.0])]
    assert run(spark, rows) == brute(rows)


def test_sums_beyond_64_bits(spark):
    near = float((1 << 28) - 1) / 256
    rows = [(i, [near * (1 if i % 4 else -1)] * 255 + [float(i)]) for i in range(12)] + [(12 + i, [0.5 * i] * 256) for i in range(6)]
    assert run(spark, rows) == brute(rows)


def test_a_repeated_query_is_answered_for_a_vector_that_takes_part(spark):
    good = [(i, [float(i), 1.0]) for i in range(7)]
    assert run(spark, good + [(3, None), (3, [None, 0.0]), (3, [float("-inf"), 0.0])]) == brute(good)


def test_large_numbers_stay_exact(spark):
    rows = [(i, [1e6 - i / 7, -9e5 + i, 3.0, 8e5]) for i in range(9)]
    assert run(spark, rows) == brute(rows)


def test_few_rows_and_none(spark):
    assert run(spark, [(0, [1.0]), (3, [2.0]), (4, [2.0])]) == brute([(0, [1.0]), (3, [2.0]), (4, [2.0])])
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, [(1, [1.0])]) == []
    assert run(spark, []) == []


def test_small_bins_need_more_rounds(spark, monkeypatch):
    monkeypatch.setattr(topk, "BINS", 8)
    monkeypatch.setattr(topk, "QUERIES_PER_BLOCK", 5)
    monkeypatch.setattr(topk, "ROWS_PER_BLOCK", 16)
    rng = np.random.default_rng(4)
    rows = [(i, rng.integers(-3, 4, size=4).astype(float).tolist()) for i in range(120)]
    assert run(spark, rows) == brute(rows)
