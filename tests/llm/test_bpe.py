import hashlib
import random

import pytest
from tokenizers import Tokenizer as Library

from newsvane.llm import bpe, queries

PATH = queries.tokenizer_path()


@pytest.fixture(scope="module")
def library():
    made = Library.from_file(PATH)
    made.no_truncation()
    made.no_padding()
    return made


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    packed = b"".join(i.to_bytes(4, "little") for i in ids)
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_automaton_of_a_hand_made_table():
    vocabulary = {b"a": 0, b"b": 1, b"ab": 2, b"aa": 3, b"aab": 4}
    automaton = bpe.compile_merges(vocabulary, [(b"a", b"b"), (b"a", b"a"), (b"a", b"ab")])
    # After a lone "a" neither "b" nor "a" nor "ab" may follow; after "ab" all may.
    state = automaton.enters[0]
    assert not any(automaton.may_follow(state, t) for t in (0, 1, 2, 3, 4))
    assert all(automaton.may_follow(automaton.enters[1], t) for t in (0, 1, 2, 3, 4))


def test_byte_table_of_a_hand_made_table():
    vocabulary = {b"a": 0, b"b": 1, b"ab": 2, b"aa": 3, b"aab": 4, b"ba": 5}
    merges = [(b"a", b"b"), (b"a", b"a"), (b"a", b"ab"), (b"b", b"a")]
    automaton = bpe.compile_merges(vocabulary, merges)
    table = bpe.ByteTable(automaton, {k: v for k, v in vocabulary.items() if automaton.enters[v] >= 0})

    def merged(word):
        parts = [word[i : i + 1] for i in range(len(word))]
        for first, second in merges:
            at = 0
            while at + 1 < len(parts):
                if parts[at] == first and parts[at + 1] == second:
                    parts[at : at + 2] = [first + second]
                at += 1
        return [vocabulary[p] for p in parts]

    words = [bytes(97 + (n >> i & 1) for i in range(size)) for size in range(1, 11) for n in range(1 << size)]
    assert [table.read(w) for w in words] == [merged(w) for w in words]
    # The table is finite: long words add no entry to those of short ones.
    entries = len(table.entries)
    for seed in range(50):
        word = bytes(random.Random(seed).choice(b"ab") for _ in range(200))
        assert table.read(word) == merged(word)
    assert len(table.entries) == entries


def test_random_strings_as_the_library(library):
    mine, rng = bpe.load(PATH), random.Random(5)
    pieces = ["hello", "aaaa", "  ", "\n\n", "<|endoftext|>", "日本語", "🙂", "don't", "1234", "é", "\x00", "'LL", "====", "�", "a" * 300]
    texts = ["".join(rng.choice(pieces + [" "]) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    texts += ["".join(chr(rng.choice(b" etaoinsh")) for _ in range(80)) for _ in range(400)]
    for text in texts:
        ids = mine.encode(text).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert mine.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_cut_off_sequences_decode_as_the_library(library):
    mine = bpe.load(PATH)
    ids = library.encode("日本語🙂", add_special_tokens=False).ids
    for size in range(len(ids)):
        assert mine.decode(ids[:size]) == library.decode(ids[:size], skip_special_tokens=False)


def test_odd_documents(odd_docs, no_docs, library):
    got = bpe.encode_decode(odd_docs, PATH).collect()
    texts = [r["text"] for r in odd_docs.select("text").collect()]
    assert sorted(tuple(r)[1:] for r in got) == sorted(expected(library, t) for t in texts)
    assert bpe.encode_decode(no_docs, PATH).collect() == []


def test_small_caches_change_nothing(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
    monkeypatch.setattr(bpe, "TABLE_ENTRIES", 5)
    mine = bpe.Tokenizer(PATH)
    text = "Several different words, internationalization, and antidisestablishmentarianism."
    for _ in range(3):
        assert mine.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_query_over_the_table(spark, library):
    got = {r.doc_id: r for r in queries.op2_bpe(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(docs)
    assert all(tuple(got[d.doc_id])[1:] == expected(library, d.text) for d in docs)
