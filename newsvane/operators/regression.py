"""Linear score heads from one pass: sums of products of features and targets, solved once.

The table of sums is as wide as there are features and targets, whatever the number of articles.
Values are whole millionths and their products are summed exactly, so the sums, and with them the
fitted weights, do not depend on how rows lie or in which order they are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsvane.functions.numeric import MICROS, to_micros

ROWS_AT_ONCE = 4096


def _design(vector: str, targets: Sequence[str]) -> Column:
    """A constant, the features, the targets, in millionths."""
    features = F.transform(F.col(vector), to_micros)
    return F.concat(F.array(F.lit(MICROS).cast("bigint")), features, F.array(*[to_micros(F.col(t)) for t in targets]))


def gram(df: DataFrame, vector: str, targets: Sequence[str], size: int) -> DataFrame:
    """(i, j, total), i <= j: sums over all rows of the products of columns i and j, in millionths squared.

    Column 0 is the constant 1, 1 to ``size`` are the features, the targets follow. Rows with a null
    among them take no part; without rows the result is empty. Totals have up to 38 digits.
    """
    width = 1 + size + len(targets)
    upper = np.triu_indices(width)
    rows = df.select(_design(vector, targets).alias("m")).where(F.col("m").isNotNull() & ~F.exists("m", lambda x: x.isNull()))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(len(upper[0]), dtype=object), 0
        for batch in batches:
            matrix = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)
            for begin in range(0, len(matrix), ROWS_AT_ONCE):
                part = matrix[begin : begin + ROWS_AT_ONCE]
                # Beyond this a sum of a part's products could leave 64 bits.
                if np.abs(part).max(initial=0) >= 1 << 25:
                    part = part.astype(object)
                total += (part.T @ part)[upper]
                seen += len(part)
        if seen:
            totals = pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), totals], names=["i", "j", "total"]
            )

    parts = rows.mapInArrow(sums, "i int, j int, total decimal(38,0)")
    return parts.groupBy("i", "j").agg(F.sum("total").alias("total"))


def fit_heads(sums: DataFrame, size: int, targets: Sequence[str], ridge: float = 0.01) -> dict[str, list[float]]:
    """Weights per target, the constant first, from `gram`; ``ridge`` weighs on every weight but the constant.

    What reaches the driver is the table of sums, whose size is that of the model squared.
    """
    width = 1 + size + len(targets)
    made = np.zeros((width, width))
    for i, j, total in sums.collect():
        made[i, j] = made[j, i] = float(total) / MICROS**2
    articles = made[0, 0]
    if not articles:
        raise ValueError("no rows to fit on")
    known = 1 + size
    penalty = np.eye(known) * ridge * articles
    penalty[0, 0] = 0.0
    weights = np.linalg.solve(made[:known, :known] + penalty, made[:known, known:])
    return {t: weights[:, k].tolist() for k, t in enumerate(targets)}


def predict(df: DataFrame, vector: str, weights: dict[str, list[float]]) -> DataFrame:
    """The rows with ``pred_<target>`` per target; null where the features are."""
    for target, (constant, *parts) in weights.items():
        products = F.zip_with(F.col(vector), F.array(*map(F.lit, parts)), lambda x, w: x * w)
        df = df.withColumn(f"pred_{target}", F.aggregate(products, F.lit(float(constant)), lambda s, x: s + x))
    return df
