"""Text cleaning and token-list expressions. Everything here is a column expression: no shuffle, no UDF."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterable, Mapping
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

EMPTY_TOKENS = "array<string>"

# Dictionaries up to this many entries travel inside the plan; larger ones must be joined as tables.
INLINE_DICTIONARY_LIMIT = 100_000


def clean_text(text: Column) -> Column:
    """Lower case, letters only, single blanks, trimmed. Null becomes the empty string."""
    letters = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z]+", " ")
    return F.trim(letters)


def tokenize(text: str, stopwords: Iterable[str] = ()) -> Column:
    """Words of at least two letters that are no stop words, in order, duplicates kept.

    ``text`` is a column name. The stop words become one hashed set inside the plan.
    """
    words = f"split(lower(coalesce({text}, '')), '[^a-z]+')"
    stop = ", ".join(f"'{word}'" for word in sorted(set(stopwords)))
    unwanted = f" AND w NOT IN ({stop})" if stop else ""
    return F.expr(f"filter({words}, w -> length(w) > 1{unwanted})")


def tokens_to_text(tokens: Column) -> Column:
    """Blank-joined tokens; a null list becomes the empty string."""
    return F.concat_ws(" ", tokens)


def combine_tokens(*lists: Column) -> Column:
    """Concatenate token lists, a missing list counting as empty."""
    empty = F.array().cast(EMPTY_TOKENS)
    return F.concat(*[F.coalesce(tokens, empty) for tokens in lists])


def split_words(text: Column) -> Column:
    """Blank-separated words without the empty string that splitting '' gives."""
    return F.filter(F.split(text, " "), lambda word: word != "")


def lookup(word: Column, dictionary: Mapping[str, str]) -> Column:
    """Value of ``word`` in a bounded dictionary, null when absent.

    Spark searches a map from its first key, so a long map is slow. The entries are hashed into
    small maps instead, which makes a lookup cost the same whatever the dictionary's size, and
    they travel as one constant-folded literal.
    """
    if len(dictionary) > INLINE_DICTIONARY_LIMIT:
        raise ValueError("dictionary too large to inline; join it as a table instead")
    buckets: list[dict[str, str]] = [{} for _ in range(max(1, len(dictionary) // 2))]
    for key, value in dictionary.items():
        buckets[zlib.crc32(key.encode()) % len(buckets)][key] = value
    literal = F.from_json(F.lit(json.dumps(buckets)), "array<map<string,string>>")
    bucket = F.pmod(F.crc32(word), F.lit(len(buckets))).cast("int")
    return F.try_element_at(F.get(literal, bucket), word)


def lemmatize(tokens: Column, dictionary: Mapping[str, str]) -> Column:
    """One lemma per token, in order; a token without an entry is its own lemma."""
    return F.transform(tokens, lambda word: F.coalesce(lookup(word, dictionary), word))


# What is dropped from an HTML text.
HTML_DROPPED = r"(?is)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->"
HTML_TAG = r"(?s)<[^>]+>"
# The standard's named characters that end in a semicolon; a hard blank is a blank here.
HTML_NAMES = {name[:-1]: text for name, text in html5.items() if name.endswith(";")} | {"nbsp": " "}
LARGEST_CODE_POINT = 0x10FFFF


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used: inside a lambda Spark computes
    an expression anew at every place where it stands."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def decode_entities(text: Column) -> Column:
    """Named, decimal and hexadecimal character references as the characters they stand for.

    A reference ends in a semicolon; what is none, or names no character, stays as it is. The text
    is read once, so `&amp;lt;` becomes `&lt;`.
    """

    def character(code: Column) -> Column:
        known = (code > 0) & (code <= LARGEST_CODE_POINT) & ~code.between(0xD800, 0xDFFF)
        # Four bytes, the highest first.
        written = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(code == 160, F.lit(" ")).when(known, written)

    def meaning(name: Column) -> Column:
        digits = F.when(F.lower(F.substr(name, F.lit(2), F.lit(1))) == "x", F.conv(F.substr(name, F.lit(3)), 16, 10))
        code = digits.otherwise(F.substr(name, F.lit(2))).cast("bigint")
        return F.when(F.startswith(name, F.lit("#")), _bound(code, character)).otherwise(lookup(name, HTML_NAMES))

    def decoded(piece: Column) -> Column:
        """A piece of text that followed an ampersand."""
        name = F.regexp_extract(piece, "^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);", 1)

        def written(name: Column) -> Column:
            rest = F.substr(piece, F.length(name) + 2)
            stays = F.concat(F.lit("&"), piece)
            replaced = _bound(meaning(name), lambda found: F.coalesce(F.concat(found, rest), stays))
            return F.when(name == "", stays).otherwise(replaced)

        return _bound(name, written)

    pieces = F.split(text, "&")
    tail = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), decoded)
    return F.when(F.contains(text, F.lit("&")), F.concat(F.get(pieces, F.lit(0)), F.array_join(tail, ""))).otherwise(text)


def html_to_text(html: Column) -> Column:
    """Visible text of an HTML string; null becomes the empty string."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), HTML_DROPPED, "")
    return F.trim(decode_entities(F.regexp_replace(text, HTML_TAG, "")))


# Repairs made to lines extracted from a paged report, in this order.
REPORT_REPAIRS = (
    (r"([a-zA-Z]+)-\s*\n\s*([a-zA-Z]+)", "$1$2"),  # hyphenation
    (r"\.{2,}", " "),  # leaders
    (r"(?md)^[ \t]*[0-9]+[ \t]*$", ""),  # page numbers
    (r"[^\S\n]{2,}", " "),  # gaps
)


def clean_report(text: Column) -> Column:
    """Trim lines, drop empty ones, then apply the repairs above."""
    blanks = F.lit(" \t\r\f")
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: F.btrim(line, blanks))
    cleaned = F.array_join(F.filter(lines, lambda line: line != ""), "\n")
    for pattern, replacement in REPORT_REPAIRS:
        cleaned = F.regexp_replace(cleaned, pattern, replacement)
    return cleaned


def report_tokens(text: str, stopwords: Iterable[str], dictionary: Mapping[str, str]) -> Column:
    """Lower-case alphabetic lemmas of a report text without stop words. ``text`` is a column name."""
    stop = ", ".join(f"'{word}'" for word in sorted(set(stopwords)))
    words = F.expr(
        f"filter(split(lower({text}), '[^\\\\p{{L}}\\\\p{{N}}]+'), w -> w <> '' AND w NOT IN ({stop}))"
    )
    return F.filter(lemmatize(words, dictionary), lambda word: word.rlike("^[a-z]+$"))
