"""A corpus from raw documents to tokens: language, near copies, benchmark text, personal data, tokens.

Every stage takes (spark, docs, sf_dir) and works on all documents that the stage before it kept.
All stages but the last return the columns of documents. Texts may be null, empty or very long,
ids null or repeated, and an empty table passes through as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsvane.llm import bpe, decontaminate, language, near_dup, private
from newsvane.llm.common import set_aside, staged, table
from newsvane.llm.queries import tokenizer_path

# Its stages are models and a tokenizer, which SQL does not express; the tests repeat them by brute force.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; null texts and texts without a letter go.

    The languages are learned from the documents that name theirs.
    """
    model = language.train(docs)
    aside, names = set_aside(docs)
    found = language.identify(aside, model, names["text"], tuple(names.values()))
    return found.where(F.col("lang_pred") != language.UNKNOWN).select(*[F.col(n).alias(c) for c, n in names.items()])


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): the smallest id.

    Rows that share an id are one document; documents without an id stay.
    """
    copies = near_dup.near_duplicates(docs).where("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    return near_dup.drop_ids(docs, copies, "doc_id")


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a word in twenty lies in a passage of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def without_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind and the lengths counted anew."""
    aside, names = set_aside(docs)
    found = private.find_private(aside, private.train(), names["text"], tuple(names.values()), with_text=True)
    length = F.length("redacted").cast(docs.schema["n_chars"].dataType)
    changed = {"text": F.col("redacted"), "n_chars": length}
    return found.select(*[changed.get(c, F.col(n)).alias(c) for c, n in names.items()])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as tokens, with digests of the tokens and of the text decoded from them."""
    encoded = bpe.encode_decode(docs, tokenizer_path(), keep=("doc_id", "lang", "source"), with_tokens=True)
    return encoded.drop("decoded")


STAGES = [
    ("language", known_language),
    ("near_dup", without_near_copies),
    ("decontaminate", without_benchmarks),
    ("private", without_private_data),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
