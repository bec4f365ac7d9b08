"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text and one on what toxic text has beyond
it. A window of text compresses shorter with the dictionary of the kind it resembles, and the
difference of the two lengths is its distance. A document is described by how many of its windows
reach each of several distances; weights for these counts are calibrated on labelled documents that
the dictionaries were not trained on.

A window is one word, set off by blanks and followed by a fixed mark that both dictionaries hold.
The mark makes both frames carry at least one match, so a difference is due to the word alone, and
it leaves the matcher, which never starts a match in the last bytes, room to see the whole word.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField

from newsvane.llm.common import map_texts

# At most so many labelled documents of each kind are fitted, each of at most this many characters.
TOXIC_SAMPLE, ORDINARY_SAMPLE, SAMPLE_CHARS = 2000, 5000, 40_000
DICTIONARY_BYTES = 6144
ORDINARY_BYTES = 6144
# A window is at most this many characters; longer words are several windows.
WINDOW = 48
GRAM = 5
# A gram, or a whole word, marks toxic text if at least this share of the toxic documents has it and
# it is so many times likelier there.
LEAST_SHARE, LEAST_RATIO = 0.01, 30
# Distances in bytes, and as a share of the word's bytes.
DISTANCES, SHARES = (2, 3, 4, 5, 6, 8), (0.2, 0.3, 0.4, 0.5)
FEATURES = len(DISTANCES) + len(SHARES) + 1
THRESHOLD = 0.3
MARK = bytes(range(1, 17))
CACHED_WINDOWS = 400_000


def words_of(text: str) -> list[str]:
    """Lower-case words; a word longer than a window is cut into windows."""
    words = text.lower().split()
    if max(map(len, words), default=0) <= WINDOW:
        return words
    return [w[i : i + WINDOW] for w in words for i in range(0, len(w), WINDOW)]


def _grams(word: str) -> set[bytes]:
    """The word itself and its grams."""
    padded = f" {word} ".encode()
    return {padded, *(padded[i : i + GRAM] for i in range(max(1, len(padded) - GRAM + 1)))}


def _without_copies(texts: list[str]) -> list[str]:
    """Texts of which at most a third of the three-word runs occur in texts before them.

    A passage that was copied from document to document says nothing about toxic words.
    """
    seen: set[int] = set()
    kept = []
    for text in texts:
        words = words_of(text)
        runs = {hash(run) for run in zip(words, words[1:], words[2:])}
        if 3 * len(runs & seen) <= len(runs):
            kept.append(text)
        seen |= runs
    return kept


def _document_frequency(texts: list[str]) -> Counter:
    found: Counter = Counter()
    for text in texts:
        found.update(set().union(*map(_grams, set(words_of(text)))) if text.strip() else ())
    return found


def _dictionary(words: list[str], size: int) -> bytes:
    """Trained segments; if there are too few samples to train on, the commonest words."""
    samples = [f" {' '.join(words[i : i + 8])} ".encode() for i in range(0, len(words), 8)]
    try:
        return zstandard.train_dictionary(size, samples, d=6, k=16).as_bytes()
    except zstandard.ZstdError:
        common = [w for w, _ in sorted(Counter(words).items(), key=lambda x: (x[1], x[0]))]
        return f" {' '.join(common)} ".encode()[-size:]


@dataclass
class Model:
    """Two dictionaries, the weights of the window counts and of the length, and the constant."""

    ordinary: bytes
    toxic: bytes
    weights: np.ndarray
    constant: float

    def scorer(self):
        """A function from texts to scores; it keeps the distances of words it has seen."""
        plain, marked = _compressor(self.ordinary), _compressor(self.toxic)
        known: dict[str, tuple | None] = {}

        def reached(word: str) -> tuple | None:
            """Which distances the word's window reaches; None if not even the least."""
            window = f" {word} ".encode("utf-8", "replace") + MARK
            far = len(plain.compress(window)) - len(marked.compress(window))
            share = far / (len(window) - len(MARK))
            known[word] = found = (
                (*(far >= d for d in DISTANCES), *(far >= DISTANCES[1] and share >= s for s in SHARES))
                if far >= DISTANCES[0]
                else None
            )
            return found

        def counts(texts: list) -> np.ndarray:
            out = np.zeros((len(texts), FEATURES))
            for row, text in enumerate(texts):
                if not text:
                    continue
                if len(known) > CACHED_WINDOWS:
                    known.clear()
                get = known.get
                far = [r for w in words_of(text) if (r := get(w) if w in known else reached(w))]
                if far:
                    out[row, :-1] = np.sum(far, axis=0)
                out[row, -1] = len(text)
            return np.log1p(out)

        return counts, lambda texts: 1 / (1 + np.exp(-(counts(texts) @ self.weights + self.constant)))


def _compressor(segments: bytes) -> zstandard.ZstdCompressor:
    content = zstandard.ZstdCompressionDict(segments + MARK, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    parameters = zstandard.ZstdCompressionParameters.from_level(
        6, source_size=64, dict_size=len(segments) + len(MARK), min_match=4, write_content_size=0,
        write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
    )
    content.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=content, compression_params=parameters)


def fit(texts: list[str], labels: list[int]) -> Model:
    """Train the dictionaries on two thirds of the texts, calibrate the weights on the rest.

    Without labelled texts of both kinds every text gets the share of toxic ones (0 without any).
    """
    share = (sum(labels) + 0.5) / (len(labels) + 1) if labels else 1e-6
    if not 0 < sum(labels) < len(labels):
        return Model(b" ", b" ", np.zeros(FEATURES), math.log(share / (1 - share)))
    held = [i % 3 == 2 for i in _spread(labels)]
    toxic = _without_copies([t for t, y, h in zip(texts, labels, held) if y and not h])
    ordinary = _without_copies([t for t, y, h in zip(texts, labels, held) if not y and not h])
    in_toxic, in_ordinary = _document_frequency(toxic), _document_frequency(ordinary)
    n, m = max(1, len(toxic)), max(1, len(ordinary))
    marking = {
        gram
        for gram, found in in_toxic.items()
        if found >= max(3, LEAST_SHARE * n) and found / n > LEAST_RATIO * (in_ordinary[gram] + 0.5) / m
    }
    # Words that are marked as a whole or in half of their grams, not those that merely touch a mark.
    marked = {
        w: f" {w} ".encode() in marking or 2 * len(marking & (parts := _grams(w))) >= max(2, len(parts) - 1)
        for t in toxic
        for w in words_of(t)
    }
    beyond = [w for t in toxic for w in words_of(t) if marked[w]]
    common = [w for t in ordinary for w in words_of(t)][: 1 << 20]
    model = Model(
        _dictionary(common, ORDINARY_BYTES), _dictionary(beyond, DICTIONARY_BYTES) if beyond else b" ",
        np.zeros(FEATURES), 0.0,
    )
    rest = [i for i, h in enumerate(held) if h] or range(len(texts))
    counts, _ = model.scorer()
    model.weights, model.constant = _calibrate(
        counts([texts[i] for i in rest]), np.array([labels[i] for i in rest], dtype=float)
    )
    return model


def _spread(labels: list[int]) -> list[int]:
    """The running number of each text among those with its label."""
    seen: Counter = Counter()
    out = []
    for y in labels:
        out.append(seen[y])
        seen[y] += 1
    return out


def _calibrate(x: np.ndarray, y: np.ndarray, strength: float = 0.05) -> tuple[np.ndarray, float]:
    """Logistic weights by Newton's method, drawn towards zero a little."""
    x = np.hstack([x, np.ones((len(x), 1))])
    keep = np.full(x.shape[1], strength)
    keep[-1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + keep * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep), slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fit on a bounded sample of labelled documents: those with the smallest hashes of their ids.

    ``labels`` has one row per labelled id; of repeated rows the largest label counts, other values
    than 0 and 1 are left out. Of documents that share an id the smallest text counts.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
        .groupBy(doc_id)
        .agg(F.max(label).cast("int").alias("__toxic"))
    )
    picked = [
        known.where(F.col("__toxic") == value).orderBy(F.xxhash64(doc_id), doc_id).limit(size)
        for value, size in ((1, TOXIC_SAMPLE), (0, ORDINARY_SAMPLE))
    ]
    # At most the two sample sizes together: a few thousand ids.
    sample = F.broadcast(picked[0].unionByName(picked[1]))
    rows = (
        docs.select(doc_id, F.col(text).alias("__text"))
        .where(F.length("__text").between(1, SAMPLE_CHARS))
        .join(sample, doc_id)
        .groupBy(doc_id)
        .agg(F.min("__text").alias("__text"), F.max("__toxic").alias("__toxic"))
        .collect()
    )
    rows.sort(key=lambda r: str(r[doc_id]))
    return fit([r["__text"] for r in rows], [r["__toxic"] for r in rows])


def score_documents(
    docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",), threshold: float = THRESHOLD
) -> DataFrame:
    """``keep`` columns, score (0 to 1) and predicted (1 if score >= threshold), one row per row.

    Whole texts are scored, of any length. A null, empty or blank text has no windows and gets the
    model's constant. Repeated rows get equal scores. Other columns are not read.
    """
    fields = [StructField("score", DoubleType()), StructField("predicted", IntegerType())]

    def factory():
        _, scores = model.scorer()

        def work(texts):
            found = scores(texts)
            return [found, (found >= threshold).astype("int32")]

        return work

    return map_texts(docs, text, list(keep), fields, factory)
