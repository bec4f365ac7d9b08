import pytest
from pyspark.sql import functions as F

from newsvane.dictionaries import LEMMAS, STOPWORDS, lemma_table
from newsvane.functions import text
from newsvane.operators import terms


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_clean_text(rows):
    df = rows([("Q3 EPS's UP 5%  now",), (None,), ("",), ("123 !!",), (" A\n\tb ",)], "t string")
    assert one(df, text.clean_text(F.col("t"))) == ["q eps s up now", "", "", "", "a b"]


def test_tokenize_drops_short_and_stop_words_and_keeps_order(rows):
    df = rows([("Q3 EPS's UP 5%  now eps",), (None,), ("",), ("123 !!",), ("the of",)], "t string")
    assert one(df, text.tokenize("t", STOPWORDS)) == [["eps", "eps"], [], [], [], []]
    assert one(df, text.tokenize("t")) == [["eps", "up", "now", "eps"], [], [], [], ["the", "of"]]


def test_tokens_and_lemmas_pair_up(rows):
    df = rows([("shares were rising",)], "t string")
    tokens = text.tokenize("t", STOPWORDS)
    assert one(df, tokens) == [["shares", "rising"]]
    assert one(df, text.lemmatize(tokens, LEMMAS)) == [["share", "rise"]]


def test_both_ways_to_lemmatize_agree(spark, rows):
    texts = [(1, "shares were rising shares"), (2, ""), (3, "nothing known here"), (4, None)]
    df = rows(texts, "id bigint, t string").select("id", text.tokenize("t", STOPWORDS).alias("tokens"))
    joined = terms.lemmatize_by_join(df, ["id"], "tokens", lemma_table(spark))
    inline = df.select("id", text.lemmatize(F.col("tokens"), LEMMAS).alias("lemmas"))
    assert sorted(joined.collect()) == sorted(inline.collect())


@pytest.mark.parametrize("size", [1, 2, 7, 5000])
def test_lookup_finds_every_entry_of_any_dictionary(rows, size):
    dictionary = {f"w{i}": f"v{i}" for i in range(size)}
    df = rows([(f"w{i}",) for i in range(size + 3)] + [(None,)], "w string")
    found = {r[0]: r[1] for r in df.select("w", text.lookup(F.col("w"), dictionary)).collect()}
    assert found == {**{f"w{i}": f"v{i}" for i in range(size)}, **{f"w{size + i}": None for i in range(3)}, None: None}


def test_lookup_refuses_a_dictionary_without_bound():
    with pytest.raises(ValueError):
        text.lookup(F.col("w"), {str(i): "x" for i in range(text.INLINE_DICTIONARY_LIMIT + 1)})


def test_combining_treats_a_missing_list_as_empty(rows):
    df = rows([(["a"], ["b", "c"]), (None, ["b"]), (None, None)], "x array<string>, y array<string>")
    assert one(df, text.combine_tokens(F.col("x"), F.col("y"))) == [["a", "b", "c"], ["b"], []]
    assert one(df, text.split_words(text.tokens_to_text(F.col("x")))) == [["a"], [], []]


def test_html_to_text(rows):
    df = rows([("<p>A &amp; B</p><script>x</script>",), (None,), ("<!-- <b> -->x<br/>&lt;y&gt;",)], "h string")
    assert one(df, text.html_to_text(F.col("h"))) == ["A & B", "", "x<y>"]


@pytest.mark.parametrize(
    "raw, decoded",
    [
        ("&rsquo;&mdash;&euro;&eacute;", "\u2019\u2014\u20ac\xe9"),
        ("a&#8217;b&#x20AC;c&#X1F600;", "a\u2019b\u20acc\U0001F600"),
        ("x&nbsp;y&#160;z&#xA0;!", "x y z !"),
        ("&amp;lt; &amp;amp;", "&lt; &amp;"),
        ("AT&T & co; &; &nosuch; &#; &#x; &#0; &#xD800; &#1114112; &amp", "AT&T & co; &; &nosuch; &#; &#x; &#0; &#xD800; &#1114112; &amp"),
        ("&&lt;&", "&<&"),
        ("no reference", "no reference"),
        ("&NotEqualTilde;", "\u2242\u0338"),
    ],
)
def test_entities(rows, raw, decoded):
    assert one(rows([(raw,)], "h string"), text.decode_entities(F.col("h"))) == [decoded]


@pytest.mark.parametrize(
    "raw, cleaned",
    [
        ("finan-\ncial", "financial"),
        ("Net Sales ........ 100", "Net Sales 100"),
        ("  42  ", ""),
        ("a    b", "a b"),
        ("one\n\n\n two \n7\nthree", "one\ntwo\n\nthree"),
        (None, ""),
    ],
)
def test_clean_report(rows, raw, cleaned):
    assert one(rows([(raw,)], "t string"), text.clean_report(F.col("t"))) == [cleaned]


def test_report_tokens(rows):
    df = rows([("The Shares rose 5% -- café q3",)], "t string")
    assert one(df, text.report_tokens("t", STOPWORDS, LEMMAS)) == [["share", "rise"]]


def test_a_reference_is_read_once(rows):
    plan = rows([("a",)], "h string").select(text.decode_entities(F.col("h")).alias("t"))._jdf.queryExecution().analyzed().toString()
    assert plan.lower().count("regexp_extract(") == 1
