"""A sparse matrix in cells, staged once, and its products with narrow blocks that come by shuffle."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsvane.operators import vector_blocks
from newsvane.session import discard, stage_buckets

# What goes to a Python worker at once: a row holds a cell, and most are larger than this.
BATCH_BYTES = 4 << 20


class Cells:
    """The cells of a matrix, from their pieces (PIECE_SCHEMA), in one bucket for the rows of one task.

    A product moves the block's parts to the buckets, which are read where they lie. A task adds up all its rows.
    """

    def __init__(self, pieces: DataFrame, rows: vector_blocks.Grid, numbers: np.ndarray):
        self._spark, self._rows, self.numbers = pieces.sparkSession, rows, numbers
        dealt = pieces.repartition(rows.rows, "cell").sortWithinPartitions("cell")
        cells = dealt.mapInArrow(vector_blocks.whole_cells, vector_blocks.CELL_SCHEMA)
        # A reader holds many rows of a file at once, so a cell is a file.
        self.table, self._path, self._name = stage_buckets(cells, "cells", ["cell"], rows.rows, 1)

    def times(self, block: DataFrame, width: int, kind: str = "<i4") -> DataFrame:
        """(p, y) of every group of rows, from the block (BLOCK_SCHEMA) of ``width`` numbers a word."""
        parts = block.select("x", F.explode("cells").alias("cell")).repartition(self._rows.rows, "cell")
        met = self.table.join(parts.hint("merge"), "cell").drop("cell")
        sums = met.mapInArrow(vector_blocks.times(self._rows, width, kind), "p int, y binary")
        # Whole already where a bucket is one task.
        return sums.groupBy("p").applyInArrow(vector_blocks.added, "p int, y binary")

    def discard(self) -> None:
        self._spark.sql(f"DROP TABLE IF EXISTS {self._name}")
        discard(self._spark, [self._path])
