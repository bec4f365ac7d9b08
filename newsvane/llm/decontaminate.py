"""Benchmark decontamination with a hash set of word windows.

Every window of 13 consecutive words of a benchmark item is hashed; the hashes, with the windows
themselves, are broadcast. A document's words are scanned once: the window at every word is hashed
inside generated code and looked up, and only hits, verified word by word, leave the scan. Nothing
but hits and one row per document is shuffled.

An item of fewer than 13 words is one window of its own length, so a scan looks up one window per
word for each of the at most 13 lengths that occur in the benchmark.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsvane.llm.common import staged
from newsvane.session import broadcast_if_small

WINDOW = 13
# Fixed value: what lies between words, once A-Z are lower case.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# A document is contaminated if at least one word in so many is hit.
CONTAMINATED_PART = 20


def words_of(text: Column) -> Column:
    """Words, A-Z in lower case; a null text has none. Other letters keep their case."""
    # Texts of ASCII letters only take the faster of the two ways, with equal results.
    lowered = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )
    return F.coalesce(F.array_remove(F.split(lowered, BETWEEN_WORDS), ""), F.array().cast("array<string>"))


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """(key, length, window, items): every distinct window with the sorted ids of its items.

    A window's length is part of what is compared, so one is never found inside another's.
    """
    words = benchmark.select(F.col(item).cast("string").alias("item"), words_of(F.col(text)).alias("words"))
    count = F.size("words")
    starts = F.explode(F.sequence(F.lit(1), F.greatest(count - (size - 1), F.lit(1))))
    windows = words.where(count > 0).select("item", "words", starts.alias("at"))
    return (
        windows.select("item", F.slice("words", F.col("at"), F.lit(size)).alias("window"))
        .groupBy("window")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
        .select(F.xxhash64("window").alias("key"), F.size("window").alias("length"), "window", "items")
    )


def find_hits(
    docs: DataFrame, windows: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, digest, n_words, at, length, items): the verified hits, and per document a row at 0.

    ``digest`` tells documents apart that share an id; rows that repeat with their text are one. The
    row at 0 is the hit of an empty window, which stands before the first word of every text, so
    that documents without a hit come out of the same scan.
    """
    about = windows.agg(F.sort_array(F.collect_set("length")), F.count("*"), F.sum(F.size("items"))).first()
    # At most as many lengths as a window has words.
    lengths = about[0] or [WINDOW]
    nothing = F.array().cast("array<string>")
    empty = docs.sparkSession.range(1).select(
        F.xxhash64(nothing).alias("key"), F.lit(0).alias("length"), nothing.alias("window"), nothing.alias("items")
    )
    set_of_hashes = broadcast_if_small(windows.unionByName(empty), about[1] + (about[2] or 0), 16 * WINDOW)
    words = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("digest"),
        words_of(F.col(text)).alias("words"),
    )
    places = words.select(
        "doc_id", "digest", F.size("words").cast("long").alias("n_words"), "words",
        F.explode(F.sequence(F.lit(0), F.size("words"))).alias("at"),
    )
    # The window at 0 has no words, those near the end have what is left.
    window = [F.slice("words", F.greatest("at", F.lit(1)), F.when(F.col("at") > 0, n).otherwise(0)) for n in lengths]
    if len(lengths) == 1:
        looked_up = places.withColumn("found", window[0])
    else:
        looked_up = places.withColumn("found", F.explode(F.array(*window)))
    return (
        looked_up.withColumn("key", F.xxhash64("found"))
        .join(set_of_hashes, "key")
        .where(F.col("found") == F.col("window"))
        .select("doc_id", "digest", "n_words", "at", "length", "items")
    )


def report(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """(doc_id, digest, n_words, n_hit, n_items, item_ids, spans, contaminated), one row per document.

    A word inside any occurrence of a benchmark window is hit; ``spans`` are the maximal runs of hit
    words as (first, last) from 1. A document is contaminated if a word in 20 is hit. Null and empty
    texts, and texts of separators only, have no words and are clean, as is everything if the
    benchmark has no words; benchmark rows without an id count under no id. A row that repeats with
    its id and text is reported once, rows that share only their id are reported each. Texts are
    scanned whole, whatever their length. Other columns are not read.
    """
    windows = benchmark_windows(benchmark.where(F.col(item).isNotNull()), item, text)
    place = F.struct("at", "length")
    per_document = (
        find_hits(docs, windows, doc_id, text)
        .groupBy("doc_id", "digest", "n_words")
        .agg(
            F.sort_array(F.collect_set(F.when(F.col("at") > 0, place))).alias("places"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("item_ids"),
        )
    )
    # Places come in order; a run grows while the next place starts no later than just behind it.
    runs = F.aggregate(
        "places",
        F.array().cast("array<struct<first:int,last:int>>"),
        lambda runs, p: F.when(
            (F.size(runs) > 0) & (p["at"] <= F.element_at(runs, -1)["last"] + 1),
            F.concat(
                F.slice(runs, 1, F.size(runs) - 1),
                F.array(
                    F.struct(
                        F.element_at(runs, -1)["first"].alias("first"),
                        F.greatest(F.element_at(runs, -1)["last"], p["at"] + p["length"] - 1).alias("last"),
                    )
                ),
            ),
        ).otherwise(F.concat(runs, F.array(F.struct(p["at"].alias("first"), (p["at"] + p["length"] - 1).alias("last"))))),
    )
    hit_words = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return (
        per_document.withColumn("spans", F.when(F.size("places") > 0, runs).otherwise(F.array().cast("array<struct<first:int,last:int>>")))
        .withColumn("n_hit", hit_words)
        .select(
            "doc_id", "digest", "n_words", "n_hit",
            F.size("item_ids").cast("long").alias("n_items"), "item_ids", "spans",
            ((F.col("n_hit") > 0) & (CONTAMINATED_PART * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        )
    )


def clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, all columns, that are not contaminated, told apart by id and text; null ids are equal."""
    bad = staged(
        report(docs, benchmark, doc_id, text).where("contaminated").select(
            F.col("doc_id").alias("__id"), F.col("digest").alias("__digest")
        ),
        "contaminated",
    )
    bad = broadcast_if_small(bad, bad.count(), 32)
    same = (F.col(f"`{doc_id}`").eqNullSafe(F.col("__id"))) & (
        F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))) == F.col("__digest")
    )
    return docs.join(bad, same, "left_anti")
