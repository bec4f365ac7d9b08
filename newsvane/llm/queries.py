"""One registered query per operator, over its whole table."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsvane.llm import (
    bpe, chat, decontaminate, fixity, language, near_dup, private, repeats, runs, sharding, topk, toxicity, whitening,
)
from newsvane.llm.common import fold, table

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 4) != 2)
    model = toxicity.train(docs, labels)
    scored = toxicity.score_documents(docs, model)
    return scored.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated",
    )


def op4_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return sharding.place(docs, "doc_id")


def op6_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.find_private(table(spark, sf_dir, "documents"), private.train())


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = language.train(docs.where(~held_out))
    return language.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def damaged_replica(pages: DataFrame) -> DataFrame:
    """A second replica of the pages with some records changed, some lost and some added."""
    body = F.when(F.col("page_id") % 97 == 13, F.concat("html", F.lit("~"))).otherwise(F.col("html"))
    kept = pages.where(F.col("page_id") % 101 != 7).select("page_id", "url", body.alias("html"))
    added = pages.where(F.col("page_id") % 103 == 5).select((F.col("page_id") + 10_000_000).alias("page_id"), "url", "html")
    return kept.unionByName(added)


def op9_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return fixity.audit(pages, damaged_replica(pages))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    row = F.to_json(F.struct("conv_id", "turn", "role", "text"), {"ignoreNullFields": "false"})
    marks = "</s>[INST] ok [/INST]"
    added = {"conv_id": -7, "messages": [{"role": r, "content": marks} for r in ("user", "assistant")]}
    more = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.lit(json.dumps(added)).alias("record"))
    records = turns.select(F.col("conv_id").cast("long").alias("conv_id"), row.alias("record")).unionByName(more)
    return chat.read_back(chat.format_turns(chat.canonical_turns(records)))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document, by the crc32 of its id, repeats some of its words to its end."""
    id_hash = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = docs.select(
        "doc_id", "text", id_hash.alias("h"), F.floor(id_hash / 10).alias("g"),
        F.when(id_hash % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")).alias("w"),
    ).withColumn("n", F.size("w"))
    planted = (
        words.withColumn("a", F.expr("CASE WHEN n > 0 THEN CAST(g % n AS INT) END"))
        .withColumn("p", F.expr("CAST(1 + floor((n - a) / (3 + g % 8)) AS INT)"))
        # The first p words from a on, as often as they fit, and the rest of them.
        .withColumn("tail", F.expr("flatten(array_repeat(slice(w, a + 1, p), CAST(ceil((n - a) / p) AS INT)))"))
        .withColumn("changed", F.expr("array_join(concat(slice(w, 1, a), slice(tail, 1, n - a)), ' ')"))
    )
    return planted.select("doc_id", F.expr("CASE WHEN n > 0 THEN changed ELSE text END").alias("text"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.find_runs(with_planted_periods(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_bpe": op2_bpe,
    "op3_decontaminate": op3_decontaminate,
    "op4_near_dup": op4_near_dup,
    "op5_sharding": op5_sharding,
    "op6_private": op6_private,
    "op7_language": op7_language,
    "op8_repeats": op8_repeats,
    "op9_fixity": op9_fixity,
    "op10_topk": op10_topk,
    "op11_whitening": op11_whitening,
    "op12_chat": op12_chat,
    "op13_runs": op13_runs,
}
