"""What the operators of this subpackage share: folds, Arrow batches of texts, staged tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from newsvane.session import ensure_checkpoint_dir

# A step inside a task works on at most this many texts, and stops adding texts at this many characters.
SLICE_ROWS, SLICE_CHARS = 512, 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % of


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared checkpoint folder and read it back.

    The files survive the loss of any executor. They stay until the folder is cleaned, as
    checkpoints do.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/staged/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# What goes to a Python worker at once, in bytes. Rows hold whole texts, and Spark's own bound would
# take tens of megabytes, several times over, on both sides of every task.
BATCH_BYTES = 4 << 20


def bounded_batches(df: DataFrame) -> DataFrame:
    """The frame itself, in a session whose Arrow batches are small. Spark has no setting of this kind
    for one query; it changes no result."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def _slices(texts: list) -> Iterator[tuple[int, int]]:
    start = size = 0
    for at, text in enumerate(texts):
        size += len(text) if text else 0
        if at + 1 - start >= SLICE_ROWS or size >= SLICE_CHARS:
            yield start, at + 1
            start, size = at + 1, 0
    if start < len(texts):
        yield start, len(texts)


def map_texts(
    df: DataFrame,
    text: str,
    keep: Sequence[str],
    fields: Sequence[StructField],
    factory: Callable[[], Callable[[list], Sequence]],
) -> DataFrame:
    """Add ``fields`` computed from whole texts, in Arrow batches, without a shuffle.

    ``factory`` runs once per task and returns a function from a list of texts (null: None) to one
    list or array per field. If the function has a ``finish``, that is called at the task's end: a
    worker process goes on to other tasks, which need the memory. ``keep`` columns pass through as
    they are.
    """
    schema = StructType([df.schema[c] for c in keep] + list(fields))
    arrow = to_arrow_schema(schema)
    added = [arrow.field(len(keep) + i).type for i in range(len(fields))]

    # A text that is kept travels once.
    place = list(keep).index(text) if text in keep else len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = factory()
        for batch in batches:
            texts = batch.column(place)
            for begin in range(0, batch.num_rows, SLICE_ROWS):
                part = texts.slice(begin, SLICE_ROWS).to_pylist()
                for start, stop in _slices(part):
                    made = work(part[start:stop])
                    kept = [
                        batch.column(i).slice(begin + start, stop - start).cast(arrow.field(i).type)
                        for i in range(len(keep))
                    ]
                    yield pa.RecordBatch.from_arrays(
                        kept + [pa.array(v, type=t) for v, t in zip(made, added)], schema=arrow
                    )
        getattr(work, "finish", lambda: None)()

    columns = [F.col(f"`{c}`") for c in keep]
    if text not in keep:
        columns.append(F.col(f"`{text}`").alias("__text"))
    return bounded_batches(df.select(*columns)).mapInArrow(run, schema)


def set_aside(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The same columns under names that clash with nothing, and the new name of each."""
    names = {c: f"__kept_{i}" for i, c in enumerate(df.columns)}
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names
