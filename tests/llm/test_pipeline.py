import hashlib

import pytest
from tokenizers import Tokenizer as Library

import __spark_entry__ as spark_entry
import corpus_pipeline
from newsvane.llm import language, near_dup, private, queries

from test_decontaminate import brute as decontaminated
from test_near_dup import brute as near_copies

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into and comes out of every stage."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, SMALL), f"test-{name}")
        out.append(docs)
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_the_stages_are_those_asked_for():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_dup", "decontaminate", "private", "tokens"]
    assert spark_entry.queries()["pipeline"] is corpus_pipeline.run


def test_columns_pass_through(stages):
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes


def test_language_stage_keeps_what_has_letters(stages):
    kept = rows(stages[1])
    assert set(kept) == {i for i, r in rows(stages[0]).items() if any(c.isalpha() for c in r.text or "")}


def test_one_of_each_group_stays(stages):
    before = sorted((r.doc_id, r.text) for r in stages[1].collect())
    expected = {r[0] for r in near_copies(before, 5, 80) if r[3]}
    assert set(rows(stages[2])) == expected < {i for i, _ in before}


def test_contaminated_documents_go(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    before = [(r.doc_id, r.text) for r in stages[2].collect()]
    bad = {r[0] for r in decontaminated(before, items) if r[4]}
    assert bad and set(rows(stages[3])) == {i for i, _ in before} - bad


def test_private_data_is_replaced(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert before.keys() == after.keys()
    for i, r in before.items():
        assert after[i].n_chars == len(after[i].text)
        assert not private.base_spans(after[i].text)
        if not private.base_spans(r.text):
            assert "[EMAIL]" not in after[i].text or "dot" in r.text
    assert any(after[i].text != before[i].text for i in before)


def test_tokens_are_the_librarys(stages):
    library = Library.from_file(queries.tokenizer_path())
    library.no_truncation()
    library.no_padding()
    texts = rows(stages[4])
    got = rows(stages[5])
    assert got.keys() == texts.keys()
    for i, r in got.items():
        ids = library.encode(texts[i].text, add_special_tokens=False).ids
        assert list(r.tokens) == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[i].text.encode()).hexdigest()


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(map(str, corpus_pipeline.run(spark, SMALL).collect())) == sorted(map(str, stages[-1].collect()))


def test_odd_documents_pass(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.staged(stage(spark, docs, SMALL), f"odd-{name}")
            if name != "tokens":
                assert docs.columns == columns
            if name == "private":
                left = docs
        ids = [r.doc_id for r in left.collect()]
        assert set(ids) <= {5, 6, 7, 8, 9, None} and (not ids or {5, 6, 7, 9, None} <= set(ids))


def test_defaults_are_five_words_and_four_fifths():
    assert (near_dup.SHINGLE, near_dup.PERCENT) == (5, 80) and language.UNKNOWN == "und"
