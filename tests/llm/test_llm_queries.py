import pytest

import __spark_entry__ as spark_entry

SMALL = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op2_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op3_decontaminate": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op4_near_dup": ["doc_id", "n_shingles", "component_id", "kept"],
    "op5_sharding": ["doc_id", "slot", "shard"],
    "op6_private": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op7_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op8_repeats": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op9_fixity": ["page_id", "status", "start", "stop", "other_bytes"],
    "op10_topk": ["query_id", "rank", "vec_id", "score"],
    "op11_whitening": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    "op12_chat": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op13_runs": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_whole_tables(spark, name):
    df = spark_entry.queries()[name](spark, SMALL)
    assert df.columns == COLUMNS[name]
    if "doc_id" in df.columns:
        assert df.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()


def test_native_queries_run_no_python(spark):
    for name in ("op3_decontaminate", "op5_sharding"):
        plan = spark_entry.queries()[name](spark, SMALL)._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "ExistingRDD"))
