"""Removal of long repeated passages with a run-length index.

A byte is removed if a 400-byte string that covers it also starts anywhere else.

1. Windows. In every 400-byte window the smallest hash of a 32-byte gram is the window's anchor.
   It depends on the window's bytes only, so equal windows have equal anchors at equal places, and
   a repeated string can be found among the windows of one anchor hash. The windows of one anchor
   in one text are a run of consecutive starts.
2. Cores. Windows that start at most 184 bytes before their anchor all hold the 216 bytes from the
   anchor on; the others all hold the 184 bytes before it and the gram. The hash of those bytes is
   the key of a group. Passages that do not repeat, and repeated lines too short to matter, are
   alone under their key and end here.
3. Classes. Equal stretches under one key repeat as a whole: all their windows are matched, by
   counts alone. Those of one text are one row from the start, so a line that a text says hundreds
   of times is not dealt hundreds of times. Where a key has several different stretches, one of
   each goes on.
4. Index. The stretches of a key are aligned by their anchor. A run-length positional
   Burrows-Wheeler transform is built over them, one column of bytes after the other: rows are held
   in the order of what they end in, a column is held as runs of equal bytes, and where a match
   with the row above begins is sampled at the ends of runs, the only places where it changes.
   Reading the columns in order streams the matching statistics: the longest match of a row that
   ends in a column is with the row above or below it. Ends of matches of 400 bytes are marked.
5. A key with very many different stretches is not indexed in one task: its windows are counted by
   hash, in all tasks.
6. Marked windows are merged per text, and texts are cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType,
)
from pyspark.sql.pandas.types import to_arrow_schema

from newsvane.llm.common import bounded_batches, staged
from newsvane.session import broadcast_if_small

LENGTH, GRAM = 400, 32
GRAMS = LENGTH - GRAM + 1
# Windows that start up to this far before their anchor are of the first half.
HALF = (GRAMS - 1) // 2
# Columns of aligned stretches: from HALF, or all grams, before the anchor.
WIDTH = LENGTH + HALF
# Stretches indexed at once; a key with more is counted by hash.
BATCH, HOT_STRETCHES = 20_000, 50_000

_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64
)

# The first of the equal stretches of a text, and how far behind it each of the others is.
STRETCHES = "key long, stretch long, d1 long, d2 long, anchor int, first int, last int, others array<int>"


def _gram_hashes(data: bytes) -> np.ndarray:
    """A hash of the 32 bytes at every place."""
    words = np.empty(len(data) - 7, dtype=np.uint64)
    for k in range(8):
        part = words[k::8]
        part[:] = np.frombuffer(data, "<u8", offset=k, count=len(part))
    n = len(data) - GRAM + 1
    mixed = sum(words[8 * k : 8 * k + n] * _MULTIPLIERS[k] for k in range(4))
    mixed ^= mixed >> np.uint64(29)
    mixed *= _MULTIPLIERS[1]
    return mixed ^ (mixed >> np.uint64(32))


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values: the ends of one block, the start of the next."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], before[width - 1 : n])


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors and the first and last start of their windows; of equal hashes the leftmost counts."""
    hashes = _gram_hashes(data)
    placed = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    at = (_window_minima(placed, GRAMS) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    change = np.flatnonzero(np.diff(at)) + 1
    first = np.concatenate([[0], change])
    return at[first], first, np.concatenate([change - 1, [len(at) - 1]])


def stretches_of(data: bytes) -> list[tuple[int, int, int, int, int]]:
    """(key, stretch, anchor, first, last) for every run of windows of one anchor and half."""
    if len(data) < LENGTH:
        return []
    hashed = xxhash.xxh3_64_intdigest
    out = []
    for at, first, last in zip(*(x.tolist() for x in anchors(data))):
        split = max(first, at - HALF)
        if split <= last:
            key = hashed(data[at : at + LENGTH - HALF])
            out.append((key, hashed(data[split : last + LENGTH], seed=at - last), at, split, last))
        if first < split:
            until = min(last, split - 1)
            key = hashed(data[at - HALF : at + GRAM], seed=1)
            out.append((key, hashed(data[first : until + LENGTH], seed=at - until), at, first, until))
    return out


def _find_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d1, d2, text) to rows of STRETCHES."""
    names = ["key", "stretch", "d1", "d2", "anchor", "first", "last", "others"]
    for batch in batches:
        for at in range(batch.num_rows):
            # Equal stretches lie alike around their anchors, so they differ by a shift.
            found: dict[tuple[int, int], tuple[int, int, int]] = {}
            behind: dict[tuple[int, int], list[int]] = {}
            for key, stretch, *place in stretches_of(batch.column(2)[at].as_py().encode("utf-8", "replace")):
                here = found.setdefault((key, stretch), tuple(place))
                if here[0] != place[0]:
                    behind.setdefault((key, stretch), []).append(place[0] - here[0])
            if not found:
                continue
            key, stretch = zip(*found)
            anchor, first, last = zip(*found.values())
            d1, d2 = (np.full(len(found), batch.column(k)[at].as_py()) for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array(key, np.uint64).view(np.int64)), pa.array(np.array(stretch, np.uint64).view(np.int64)),
                    pa.array(d1), pa.array(d2), *(pa.array(x, pa.int32()) for x in (anchor, first, last)),
                    pa.array([behind.get(x) for x in found], pa.list_(pa.int32())),
                ],
                names=names,
            )


def match_ends(rows: np.ndarray, held: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For aligned rows of bytes: which 400-byte strings, by the column they end in, another row of
    the group has in the same columns.

    ``rows`` is (n, WIDTH) bytes, ``held`` (n, 2) the first column a row has and the one behind its
    last, ``group`` ascending numbers. The result has a column per end, from LENGTH - 1 on.

    ``order`` are the rows in the order of what they end in, per group; ``since[i]`` is the column
    at which the match of row ``order[i]`` with the one above it begins.
    """
    n, width = rows.shape
    order, since = np.arange(n), np.zeros(n, dtype=np.int32)
    head = np.ones(n, dtype=bool)
    head[1:] = group[1:] != group[:-1]
    marks = np.zeros((n, width - LENGTH + 1), dtype=bool)
    for column in range(width):
        symbols = rows[order, column].astype(np.int64)
        absent = (column < held[order, 0]) | (column >= held[order, 1])
        symbols[absent] = 256
        starts = head.copy()
        starts[1:] |= symbols[1:] != symbols[:-1]
        runs = np.flatnonzero(starts)
        if len(runs) > head.sum():
            # Sort the runs, not the rows: equal symbols of a group come together in their order.
            run_group, run_symbol = group[runs], symbols[runs]
            sorted_runs = np.lexsort((run_symbol, run_group))
            same = np.zeros(len(runs), dtype=bool)
            a, b = sorted_runs[:-1], sorted_runs[1:]
            same[1:] = (run_group[a] == run_group[b]) & (run_symbol[a] == run_symbol[b])
            # A run's first row now follows the last row of the run before it with its symbol: their
            # match begins where the latest match between the two begins.
            largest = np.append(np.maximum.reduceat(since, runs), 0)
            at = sorted_runs[same]
            before = sorted_runs[np.flatnonzero(same) - 1]
            sampled = np.full(len(runs), column + 1, dtype=np.int32)
            if len(at):
                between = np.maximum.reduceat(largest, np.column_stack([before + 1, at]).ravel())[::2]
                sampled[at] = np.maximum(between, since[runs[at]])
            since[runs] = sampled
            sizes = np.diff(np.append(runs, n))
            moved = np.repeat(runs[sorted_runs] - np.concatenate([[0], np.cumsum(sizes[sorted_runs])[:-1]]), sizes[sorted_runs])
            moved += np.arange(n)
            order, since, absent = order[moved], since[moved], absent[moved]
        since[head] = column + 1
        # What a row does not have matches nothing.
        if absent.any():
            since[absent] = column + 1
            since[1:][absent[:-1]] = column + 1
        if column >= LENGTH - 1:
            long = column + 1 - since >= LENGTH
            marks[order[long], column - LENGTH + 1] = True
            marks[order[:-1][long[1:]], column - LENGTH + 1] = True
    return marks


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches sorted by key, (key, d1, d2, anchor, first, last, bytes), to matched (d1, d2, first, last)."""

    def indexed(columns: list[np.ndarray], data: list[bytes]) -> pa.RecordBatch | None:
        key, d1, d2, anchor, first, last = columns
        origin = np.where(anchor - first <= HALF, anchor - HALF, anchor - GRAMS + 1).astype(np.int64)
        rows = np.zeros((len(data), WIDTH), dtype=np.uint8)
        for row, (text, begin) in enumerate(zip(data, (first - origin).tolist())):
            rows[row, begin : begin + len(text)] = np.frombuffer(text, np.uint8)
        held = np.column_stack([first - origin, last + LENGTH - origin])
        group = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        marks = match_ends(rows, held, group)
        edges = np.diff(np.pad(marks.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, begin = np.nonzero(edges == 1)
        end = np.nonzero(edges == -1)[1] - 1
        return pa.RecordBatch.from_arrays(
            [
                pa.array(d1[row]), pa.array(d2[row]), pa.array((origin[row] + begin).astype(np.int32)),
                pa.array((origin[row] + end).astype(np.int32)),
            ],
            names=["d1", "d2", "first", "last"],
        )

    columns: list[list[np.ndarray]] = [[] for _ in range(6)]
    data: list[bytes] = []
    size = 0

    def flush(upto: int):
        joined = [np.concatenate(c) for c in columns]
        made = indexed([c[:upto] for c in joined], data[:upto])
        for c, whole in zip(columns, joined):
            c[:] = [whole[upto:]]
        del data[:upto]
        return made

    for batch in batches:
        for begin in range(0, batch.num_rows, BATCH):
            part = batch.slice(begin, BATCH)
            for c, k in zip(columns, range(6)):
                c.append(part.column(k).to_numpy())
            data += part.column(6).to_pylist()
            size = len(data)
            keys = np.concatenate(columns[0])
            # The last key may go on in the next batch.
            whole = int(np.searchsorted(-(keys != keys[-1]).astype(int), 0))
            if whole >= BATCH:
                yield flush(whole)
    if data:
        yield flush(len(data))


def _window_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of every window of a stretch: (key, h, d1, d2, start)."""
    for batch in batches:
        for row in batch.to_pylist():
            text = row["bytes"]
            count = row["last"] - row["first"] + 1
            starts = np.arange(row["first"], row["last"] + 1, dtype=np.int32)
            hashes = np.array([xxhash.xxh3_64_intdigest(text[i : i + LENGTH]) for i in range(count)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(count, row["key"])), pa.array(hashes.view(np.int64)),
                 pa.array(np.full(count, row["d1"])), pa.array(np.full(count, row["d2"])), pa.array(starts)],
                names=["key", "h", "d1", "d2", "start"],
            )


def matched_windows(docs: DataFrame, text: str = "text", hot: int = HOT_STRETCHES) -> DataFrame:
    """(d1, d2, first, last): runs of window starts that are matched, per text digest."""
    texts = docs.where(F.octet_length(text) >= LENGTH).select(*_digests(text), F.col(text).alias("text"))
    stretches = staged(bounded_batches(texts).mapInArrow(_find_stretches, STRETCHES), "repeat-stretches")
    # Most keys occur once; their rows go no further. Written out, the keys are a side of their own,
    # and Spark can split the rows of a hot one.
    times = F.sum(1 + F.coalesce(F.array_size("others"), F.lit(0)))
    keys = staged(stretches.groupBy("key").agg(times.alias("c")).where("c > 1").select("key"), "repeat-keys")
    live = staged(stretches.join(keys, "key", "left_semi"), "repeat-live")
    # Equal stretches under a key; the first of a text, by a hash of its place, stands for the class.
    # A text that occurs twice brings each of its stretches twice.
    place = F.xxhash64("d1", "d2", "anchor")
    classes = staged(
        live.groupBy("key", "stretch").agg(times.alias("size"), F.min(place).alias("place")), "repeat-classes"
    )
    repeated = classes.where("size > 1").select("key", "stretch")
    shifts = F.concat(F.array(F.lit(0)), F.coalesce("others", F.array().cast("array<int>")))
    equal = (
        live.join(repeated, ["key", "stretch"], "left_semi").select("d1", "d2", "first", "last", F.explode(shifts).alias("by"))
        .select("d1", "d2", (F.col("first") + F.col("by")).alias("first"), (F.col("last") + F.col("by")).alias("last"))
    )
    # Keys with several classes go on, with one stretch of each class. Copies of a text are one row
    # here: distinct by columns that the join was not dealt by, so they are combined before a shuffle.
    several = classes.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    columns = ["key", "n", "d1", "d2", "anchor", "first", "last"]
    wanted = staged(
        live.join(classes.join(several, "key"), ["key", "stretch"]).where(F.col("place") == place).select(columns).distinct(),
        "repeat-wanted",
    )
    count = wanted.count()
    cut = F.expr(f"substring(CAST(text AS BINARY), first + 1, last - first + {LENGTH})").alias("bytes")
    parts = staged(
        texts.join(broadcast_if_small(wanted, count, 96), ["d1", "d2"])
        .select(*columns, cut)
        .dropDuplicates(["key", "d1", "d2", "anchor", "first"]),
        "repeat-parts",
    )
    ordered = (
        parts.where(F.col("n") <= hot).repartition("key").sortWithinPartitions("key")
        .select("key", "d1", "d2", "anchor", "first", "last", "bytes")
    )
    indexed = ordered.mapInArrow(_index, "d1 long, d2 long, first int, last int")
    counted = parts.where(F.col("n") > hot).mapInArrow(
        _window_hashes, "key long, h long, d1 long, d2 long, start int"
    )
    twice = counted.groupBy("key", "h").agg(F.count("*").alias("c")).where("c > 1").select("key", "h")
    by_hash = counted.join(twice, ["key", "h"], "left_semi").select(
        "d1", "d2", F.col("start").alias("first"), F.col("start").alias("last")
    )
    return equal.unionByName(indexed).unionByName(by_hash).distinct()


def _digests(text: str):
    # Texts made to share an XXH64 may share it at any seed, so the second hash is of a SHA-256.
    return F.xxhash64(F.col(text)).alias("d1"), F.xxhash64(F.sha2(F.col(text).cast("binary"), 256)).alias("d2")


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_text: bool = False, hot: int = HOT_STRETCHES
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) and, if asked for, the bytes kept and the
    removed runs; one row per row of ``docs``.

    Texts are bytes in UTF-8, matches stay inside one text, and a string that repeats within its own
    text, overlapping itself or not, counts. Null texts count as empty; texts under 400 bytes keep
    everything. Rows that repeat are documents of their own and so repeat each other. Ids may be
    null or shared: texts are told apart by two 64-bit hashes, not by ids. Other columns are not
    read.
    """
    windows = matched_windows(docs, text, hot)
    merged = staged(
        windows.groupBy("d1", "d2").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("found")),
        "repeat-found",
    )
    size = merged.agg(F.count("*"), F.sum(F.size("found"))).first()
    rows = docs.select(F.col(doc_id).alias("doc_id"), *_digests(text), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Sixteen bytes for a run, 48 for the rest of a row.
    small = broadcast_if_small(merged, size[0] * 3 + (size[1] or 0), 16)
    joined = rows.join(small, ["d1", "d2"], "left").select("doc_id", "text", "found")
    fields = [
        StructField("doc_id", docs.schema[doc_id].dataType), StructField("n_bytes", LongType()),
        StructField("n_removed", LongType()), StructField("n_spans", LongType()), StructField("kept_sha256", StringType()),
    ]
    if with_text:
        span = StructType([StructField("start", IntegerType()), StructField("stop", IntegerType())])
        fields += [StructField("kept", BinaryType()), StructField("spans", ArrayType(span))]
    schema = StructType(fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in fields[1:]]
            for at in range(batch.num_rows):
                data = batch.column(1)[at].as_py().encode("utf-8", "replace")
                runs: list[list[int]] = []
                for found in batch.column(2)[at].as_py() or ():
                    if runs and found["first"] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], found["last"] + LENGTH)
                    else:
                        runs.append([found["first"], found["last"] + LENGTH])
                edges = [0, *(x for r in runs for x in r), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                values = [len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()]
                if with_text:
                    values += [kept, [{"start": a, "stop": b} for a, b in runs]]
                for column, value in zip(out, values):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(arrow.field(0).type), *(pa.array(c, f.type) for c, f in zip(out, list(arrow)[1:]))],
                schema=arrow,
            )

    return bounded_batches(joined).mapInArrow(run, schema)
