"""Term tables: frequencies, vocabularies, sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsvane.functions.numeric import round_to
from newsvane.operators.ranking import at_least_nth, global_rank, top_n, top_n_per_group
from newsvane.session import hashed, stage


def explode_terms(df: DataFrame, terms: Column, *keep: str) -> DataFrame:
    """One row per list element. The outer form keeps Spark from evaluating the list twice."""
    return df.select(*keep, F.explode_outer(terms).alias("term")).where(F.col("term").isNotNull())


def tokens_long(df: DataFrame, tokens: str, *keep: str) -> DataFrame:
    """One row per token with its position, from 0."""
    long = df.select(*keep, F.posexplode_outer(tokens).alias("pos", "token"))
    return long.where(F.col("token").isNotNull())


def lemmatize_by_join(
    df: DataFrame, keys: Sequence[str], tokens: str, dictionary: DataFrame
) -> DataFrame:
    """Lemma lists from a dictionary table (token, lemma) of any size, one row per key.

    For a dictionary that fits into a plan, `functions.text.lemmatize` gives the same lists without
    shuffling the tokens. Here a list is gathered again per key, so it is bounded by one text.
    """
    words = df.selectExpr(*keys, f"posexplode_outer({tokens}) AS (pos, token)")
    lemmas = words.join(dictionary, "token", "left").selectExpr(
        *keys, "CASE WHEN pos IS NOT NULL THEN struct(pos, coalesce(lemma, token) AS lemma) END AS entry"
    )
    gathered = lemmas.groupBy(*keys).agg(F.array_sort(F.collect_list("entry")).alias("entries"))
    return gathered.selectExpr(*keys, "transform(entries, e -> e.lemma) AS lemmas")


def with_lemmas(df: DataFrame, tokens: str, lemmas: str, dictionary: DataFrame) -> DataFrame:
    """All columns and a lemma list from a dictionary table (token, lemma) of any size.

    Words are looked up once per distinct token list, known by two hashes of its content, so rows
    need no key of their own: rows without one, or with a shared one, get their own lists. What comes
    back per list are the lemmas that differ from their tokens, bounded by the list.
    """
    lists = df.select(F.xxhash64(tokens).alias("__d1"), F.xxhash64(F.col(tokens), F.lit(1)).alias("__d2"), tokens)
    words = lists.select("__d1", "__d2", F.explode(F.array_distinct(tokens)).alias("token")).distinct()
    changed = (
        words.join(dictionary.dropDuplicates(["token"]), "token")
        .where("lemma IS NOT NULL AND lemma <> token")
        .groupBy("__d1", "__d2")
        .agg(F.map_from_entries(F.collect_list(F.struct("token", "lemma"))).alias("__changed"))
    )
    digested = df.withColumn("__d1", F.xxhash64(tokens)).withColumn("__d2", F.xxhash64(F.col(tokens), F.lit(1)))
    joined = digested.join(changed, ["__d1", "__d2"], "left")
    found = F.transform(tokens, lambda t: F.coalesce(F.try_element_at(F.col("__changed"), t), t))
    return joined.withColumn(lemmas, found).drop("__d1", "__d2", "__changed")


def term_counts(df: DataFrame, terms: Column, *group: str) -> DataFrame:
    return explode_terms(df, terms, *group).groupBy(*group, "term").agg(F.count("*").alias("n"))


def top_terms(df: DataFrame, terms: Column, n: int, stopwords: Sequence[str] = ()) -> DataFrame:
    counts = term_counts(df, terms)
    if stopwords:
        counts = counts.where(~F.col("term").isin(list(stopwords)))
    return top_n(counts, [F.desc("n"), F.asc("term")], n)


def top_terms_per_group(df: DataFrame, terms: Column, n: int, group: str) -> DataFrame:
    counts = term_counts(df, terms, group)
    return top_n_per_group(
        counts, [group], [F.desc("n"), F.asc("term")], n, salt_on=["term"], salts=32
    )


def top_bigrams_per_group(df: DataFrame, tokens: str, n: int, group: str) -> DataFrame:
    """The most frequent pairs of neighbouring words per group, blank-joined."""
    words = df.selectExpr(group, tokens, f"posexplode_outer({tokens}) AS (at, first)")
    pairs = words.selectExpr(group, "first", f"get({tokens}, at + 1) AS second").where("second IS NOT NULL")
    counts = pairs.groupBy(group, "first", "second").agg(F.count("*").alias("n"))
    named = counts.selectExpr(group, "concat(first, ' ', second) AS term", "n")
    return top_n_per_group(named, [group], [F.desc("n"), F.asc("term")], n, salt_on=["term"], salts=32)


def _x_ln_x(x: str) -> str:
    return f"CASE WHEN ({x}) > 0 THEN ({x}) * ln(CAST({x} AS DOUBLE)) ELSE 0D END"


def association(pair: str, first: str, second: str, words: str) -> Column:
    """Likelihood ratio (G squared) of two words in a row against independence, from the 2x2 table of
    how often both, one or none of them occur: 2 x the sum of observed x ln(observed / expected).

    Counts are names of columns. 0 where one of the words is all there is.
    """
    one, other, none = f"{first} - {pair}", f"{second} - {pair}", f"{words} - {first} - {second} + {pair}"
    cells = " + ".join(_x_ln_x(c) for c in (pair, one, other, none, words))
    margins = " + ".join(_x_ln_x(c) for c in (first, second, f"{words} - {first}", f"{words} - {second}"))
    ratio = f"2D * (({cells}) - ({margins}))"
    return F.expr(f"CASE WHEN {words} > {first} AND {words} > {second} THEN {ratio} ELSE 0D END")


# Pairs of words that score above this are shown as one.
COLLOCATION_THRESHOLD = 30.0
# What a group's word takes in a broadcast table with its count, about.
WORD_BYTES = 150


def collocations_per_group(
    df: DataFrame, tokens: str, n: int, group: str, stopwords: Sequence[str] = (),
    threshold: float = COLLOCATION_THRESHOLD,
) -> DataFrame:
    """(group, term, words, n, score, rank): the most frequent words and collocations of a group.

    A collocation is a pair of neighbouring words whose association scores above ``threshold``; what
    it takes is no longer counted for its two words, and words that have nothing left are left out.
    ``score`` is null for single words. Rows without a group are left out. Stop words are neither words nor part of a pair.

    Tokens are counted once, by the word and the one behind it; the counts of single words are sums
    of those. Both are staged. Pairs meet the counts of their words where they lie if the words can be
    broadcast (a measured count), else by a hash join that sorts neither side, and what scores above the
    threshold is staged for all that follows.
    """
    listed = df.selectExpr(group, tokens, f"posexplode_outer({tokens}) AS (at, first)")
    listed = listed.where(f"first <> '' AND {group} IS NOT NULL")
    # A word with nothing behind it has an empty second one.
    next_to = listed.selectExpr(group, "first", f"coalesce(get({tokens}, at + 1), '') AS second")
    if stopwords:
        known = list(stopwords)
        next_to = next_to.where(~F.col("first").isin(known))
        next_to = next_to.withColumn("second", F.when(F.col("second").isin(known), "").otherwise(F.col("second")))
    pairs = stage(next_to.groupBy(group, "first", "second").agg(F.count("*").alias("n")), "word-pairs")[0]
    singles = stage(pairs.groupBy(group, F.col("first").alias("term")).agg(F.sum("n").alias("n")), "pair-words")[0]
    totals = singles.groupBy(group).agg(F.sum("n").alias("words"))
    # Two tables of words are broadcast at once.
    rows = 2 * singles.count()
    first = singles.select(group, F.col("term").alias("first"), F.col("n").alias("n_first"))
    second = singles.select(group, F.col("term").alias("second"), F.col("n").alias("n_second"))
    first, second = (hashed(words, rows, WORD_BYTES) for words in (first, second))
    scored = (
        pairs.join(first, [group, "first"]).join(second, [group, "second"])
        .join(totals, group)
        .withColumn("score", round_to(association("n", "n_first", "n_second", "words"), 6))
        .where(F.col("score") > threshold)
        .select(group, "first", "second", "n", "score")
    )
    scored = stage(scored, "collocations")[0]
    both = scored.select(group, F.explode(F.array("first", "second")).alias("term"), "n")
    taken = both.groupBy(group, "term").agg(F.sum("n").alias("taken"))
    left = singles.join(taken, [group, "term"], "left").withColumn("n", F.col("n") - F.coalesce("taken", F.lit(0)))
    words = left.where("n > 0").select(group, "term", F.lit(1).alias("words"), "n", F.lit(None).cast("double").alias("score"))
    named = F.concat("first", F.lit(" "), "second").alias("term")
    every = words.unionByName(scored.select(group, named, F.lit(2).alias("words"), "n", "score"))
    return top_n_per_group(every, [group], [F.desc("n"), F.asc("term")], n, salt_on=["term"], salts=32)


def document_frequencies(
    df: DataFrame, tokens: str, min_docs: int = 2, max_share: float = 0.9
) -> DataFrame:
    """Documents per term, without terms in too few or in too large a share of the documents.

    A document counts a term once because its list is made distinct before it is exploded, so no
    distinct count is shuffled.
    """
    per_term = term_counts(df, F.array_distinct(tokens)).withColumnRenamed("n", "df")
    documents = df.agg(F.count("*")).scalar()
    counted = per_term.where(F.col("df") >= min_docs).withColumn("documents", documents)
    return counted.where(F.col("df") <= max_share * F.col("documents"))


def _counts_with_df(df: DataFrame, tokens: str) -> DataFrame:
    """Occurrences and documents per term, from one pass: each list is read whole and made distinct."""
    lists = df.selectExpr(f"posexplode_outer(array({tokens}, array_distinct({tokens}))) AS (kind, words)")
    words = lists.selectExpr("kind", "explode_outer(words) AS term").where("term IS NOT NULL")
    return words.groupBy("term").agg(
        F.expr("count_if(kind = 0)").alias("n"), F.expr("count_if(kind = 1)").alias("df")
    )


def vocabulary(df: DataFrame, tokens: str, size: int = 10_000, min_docs: int = 5) -> DataFrame:
    """The most frequent terms, index 0 the most frequent; ties by term."""
    counts = _counts_with_df(df, tokens).where(F.col("df") >= min_docs)
    ranked = top_n(at_least_nth(counts, "n", size), [F.desc("n"), F.asc("term")], size)
    return ranked.select((F.col("rank") - 1).alias("term_index"), "term", "n", "df")


def vocabulary_per_group(df: DataFrame, tokens: str, group: str, size: int = 5_000) -> DataFrame:
    ranked = top_terms_per_group(df, F.col(tokens), size, group)
    return ranked.select(group, (F.col("rank") - 1).alias("term_index"), "term", "n")


def pruned_vocabulary_per_group(
    df: DataFrame, tokens: str, group: str, size: int = 5_000, min_docs: int = 2, max_share: float = 0.9
) -> DataFrame:
    """The most frequent terms of every group among those in enough of its documents and not in nearly all.

    ``size`` is the operator's feature: how many terms a topic map knows.
    """
    lists = df.selectExpr(group, f"posexplode_outer(array({tokens}, array_distinct({tokens}))) AS (kind, words)")
    words = lists.selectExpr(group, "kind", "explode_outer(words) AS term").where("term IS NOT NULL")
    counts = words.groupBy(group, "term").agg(
        F.expr("count_if(kind = 0)").alias("n"), F.expr("count_if(kind = 1)").alias("df")
    )
    documents = df.groupBy(group).agg(F.count("*").alias("documents"))
    kept = counts.where(F.col("df") >= min_docs).join(documents, group).where(F.col("df") <= max_share * F.col("documents"))
    ranked = top_n_per_group(
        kept.select(group, "term", "n"), [group], [F.desc("n"), F.asc("term")], size, salt_on=["term"], salts=32
    )
    return ranked.select(group, (F.col("rank") - 1).alias("term_index"), "term", "n")


def count_vectors(df: DataFrame, keys: Sequence[str], tokens: str, size: int = 10_000, min_docs: int = 5) -> DataFrame:
    """Sparse count vectors: per article the vocabulary's terms that occur in it, and how often.

    The vocabulary is a table of ``size`` rows at most, the operator's feature; ties at its end go
    by term. Documents without a known term have empty lists.
    """
    words = vocabulary(df, tokens, size, min_docs).select("term", "term_index")
    counts = explode_terms(df, F.col(tokens), *keys).groupBy(*keys, "term").agg(F.count("*").alias("n"))
    entry = F.struct(F.col("term_index").alias("i"), "n")
    lists = counts.join(words, "term").groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("e"))
    empty = F.array().cast("array<struct<i:int,n:bigint>>")
    every = df.select(*keys).join(lists, list(keys), "left").withColumn("e", F.coalesce("e", empty))
    return every.select(
        *keys, F.transform("e", lambda e: e["i"]).alias("indices"), F.transform("e", lambda e: e["n"]).alias("counts")
    )


def encode_sequences(
    df: DataFrame, keys: Sequence[str], tokens: str, length: int = 50, min_count: int = 2
) -> DataFrame:
    """Token lists as index lists of a fixed length: unknown words and padding are both 0.

    ``keys`` identify an article: its ticker and id, since tickers share ids. The length is the
    operator's feature. Only the first ``length`` tokens of a list can appear in the result, so only they are joined
    with the vocabulary; the vocabulary itself counts all tokens.
    """
    counts = term_counts(df, F.col(tokens)).where(F.col("n") >= min_count)
    ranked = global_rank(counts, [F.desc("n"), F.asc("term")], "term_index")
    index = ranked.select("term", "term_index")
    head = df.select(*keys, F.posexplode_outer(F.slice(tokens, 1, length)).alias("pos", "term"))
    # Whether the vocabulary is broadcast is left to its measured size at run time.
    coded = head.join(index, "term", "left")
    lists = coded.groupBy(*keys).agg(
        F.array_sort(
            F.collect_list(
                F.when(
                    F.col("pos").isNotNull(),
                    F.struct("pos", F.coalesce("term_index", F.lit(0)).alias("i")),
                )
            )
        ).alias("coded")
    )
    found = F.transform("coded", lambda c: c["i"])
    padding = F.array_repeat(F.lit(0).cast("bigint"), length)
    return lists.select(*keys, F.slice(F.concat(found, padding), 1, length).alias("sequence"))


def term_lift(df: DataFrame, tokens: str, label: str, min_count: int = 5) -> DataFrame:
    """Share of a term among a label's words relative to its share among all words."""
    labelled = df.where(F.col(label).isNotNull())
    pairs = term_counts(labelled, F.col(tokens), label).withColumnRenamed("n", "n_label_term")
    # From here on one row per (label, term): a term has as many rows as there are labels.
    by_term = pairs.withColumn("n_term", F.sum("n_label_term").over(Window.partitionBy("term")))
    # One row per label.
    by_label = pairs.groupBy(label).agg(F.sum("n_label_term").alias("n_label"))
    by_label = by_label.withColumn("n_all", F.sum("n_label").over(Window.partitionBy()))
    joined = by_term.where(F.col("n_term") >= min_count).join(by_label, label)
    share = F.col("n_label_term") / F.col("n_label")
    base = F.col("n_term") / F.col("n_all")
    return joined.select(label, "term", "n_label_term", "n_term", round_to(share / base, 6).alias("lift"))
