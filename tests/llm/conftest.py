import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    # Columns whose names the operators use themselves.
    " id long, key string, score string, n long, words string, digest string, d1 string, anchor string, lang_pred string, spans string, toxic string, slot string"
)
EXTRA = (7, "k", "s", None, "w", "d", None, "a", "x", "y", "t", "z")


@pytest.fixture
def make_docs(spark):
    def make(rows):
        """(doc_id, text) or (doc_id, text, lang) with every other column filled or null."""
        return spark.createDataFrame(
            [(r[0], r[1], r[2] if len(r) > 2 else None, None, len(r[1]) if r[1] else None, *EXTRA) for r in rows], SCHEMA
        )

    return make


@pytest.fixture
def odd_docs(make_docs):
    """Null, empty, blank, wordless, very long and repeated texts, null and repeated ids."""
    long_text = " ".join(f"word{i % 977} and more" for i in range(30_000))
    return make_docs(
        [
            (1, None), (2, ""), (3, " \n\t "), (4, "!!! ... 123 \u0000 \U0001F600"), (5, long_text, "en"),
            (6, "the same row twice, in one table", "en"), (6, "the same row twice, in one table", "en"),
            (7, "one id, a first text"), (7, "one id, quite another text", "en"), (None, "no id but a text", "en"),
            (None, None), (8, "x" * 70_000), (9, "İstanbul ΑΣ Straße ÉTÉ", "de"),
        ]
    )


@pytest.fixture
def no_docs(make_docs, spark):
    return spark.createDataFrame([], SCHEMA)
