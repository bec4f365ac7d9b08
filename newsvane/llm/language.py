"""Language identification as inference of a mixture.

A text is a mixture of languages in unknown proportions. It is cut into short segments; a segment's
likelihood in a language is the product over its byte n-grams. Expectation-maximisation finds the
proportions under which the whole text is likeliest. How many languages the text has is decided by
penalised likelihood: another language must pay for its parameter.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField

from newsvane.llm.common import bounded_batches, map_texts

BUCKETS = 1 << 16
SEGMENT = 16
# Expectation-maximisation ends when no proportions can raise the likelihood by more than this, in
# logs per segment.
TOLERANCE = 1e-4
# Grams looked up at once, in bytes of text: whole segments.
PIECE = SEGMENT << 14
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
# Everything in ASCII but letters becomes a blank.
BLANKED = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def normalised(text: str) -> bytes:
    """Lower-case bytes, filled with blanks to whole segments and at least one gram beyond the end."""
    made = text.lower().encode("utf-8", "replace").translate(BLANKED)
    return made + b" " * (4 + -(len(made) + 4) % SEGMENT)


def gram_buckets(data: bytes) -> np.ndarray:
    """The bucket of the four bytes that start at every byte."""
    size = len(data)
    grams = np.empty(size, dtype=np.uint32)
    padded = data + b"    "
    for k in range(4):
        part = grams[k::4]
        part[:] = np.frombuffer(padded, dtype="<u4", offset=k, count=len(part))
    return ((grams * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


BLANK_BUCKET = int(gram_buckets(b"    ")[0])


@dataclass
class Model:
    languages: list[str]
    logs: np.ndarray  # bucket x language

    def _segment_logs(self, data: bytes, ends: np.ndarray) -> np.ndarray:
        """Log-likelihood of every segment in every language, a piece of the text at a time.

        ``ends`` are the ends of the texts in ``data``: no gram reaches into the next text.
        """
        logs = np.empty((len(data) // SEGMENT, len(self.languages)))
        for begin in range(0, len(data), PIECE):
            stop = min(begin + PIECE, len(data))
            buckets = gram_buckets(data[begin : stop + 3])[: stop - begin]
            for back in (1, 2, 3):
                at = ends - back - begin
                buckets[at[(at >= 0) & (at < len(buckets))]] = BLANK_BUCKET
            made = self.logs[buckets].reshape(-1, SEGMENT, len(self.languages)).sum(1, dtype=np.float64)
            logs[begin // SEGMENT : stop // SEGMENT] = made
        return logs

    def proportions(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per text the proportions of all languages (0 if not selected) and the penalised likelihood.

        The languages are taken in order of their share under one round with all of them; of the sets
        that this order begins with the one of greatest penalised likelihood is selected, however many
        languages it has. No mixture explains a segment better than the segment's best language, so a
        text is done when even that would not pay for another language.
        """
        parts = [normalised(t) for t in texts]
        segments = np.array([len(p) // SEGMENT for p in parts])
        starts = np.concatenate([[0], np.cumsum(segments)[:-1]])
        n = len(self.languages)
        logs = self._segment_logs(b"".join(parts), (starts + segments) * SEGMENT)
        whole = np.add.reduceat(logs, starts)
        # Likelihoods relative to the best language of the segment, so nothing vanishes.
        peak = logs.max(1)
        likely = np.exp(logs - peak[:, None])
        offset = np.add.reduceat(peak, starts)
        shares = np.add.reduceat(likely / likely.sum(1)[:, None], starts)
        order = np.lexsort((-whole.T, -np.round(shares, 6).T), axis=0).T if n > 1 else np.zeros((len(texts), 1), int)
        best = np.zeros((len(texts), n))
        first = whole.argmax(1)
        best[np.arange(len(texts)), first] = 1
        reached = whole.max(1)
        of = np.repeat(np.arange(len(texts)), segments)
        for size in range(2, n + 1):
            penalty = (size - 1) * np.log(np.maximum(segments, 2)) * 0.5 + 2 * (size - 1)
            open_ = offset - penalty > reached
            if not open_.any():
                break
            rows = open_[of]
            chosen = order[open_, :size]
            mine = np.take_along_axis(likely[rows], np.repeat(chosen, segments[open_], axis=0), 1)
            share, gained = mixture(mine, segments[open_])
            value = gained + offset[open_] - penalty[open_]
            better = value > reached[open_]
            at = np.flatnonzero(open_)[better]
            reached[at] = value[better]
            best[at] = 0
            best[at[:, None], chosen[better]] = share[better]
        return best, reached


def mixture(likely: np.ndarray, segments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The likeliest proportions of every text and the log-likelihood they reach.

    ``likely`` has the rows of all segments, text after text. The mean ratio of a language's likelihood
    to the mixture's bounds what is left to gain: no proportions are likelier by more than the log
    of the largest such mean a segment. A text leaves the rounds when that is below the tolerance.
    """
    texts, size = len(segments), likely.shape[1]
    share, reached = np.full((texts, size), 1 / size), np.zeros(texts)
    left, mine, counts = np.arange(texts), likely, segments
    while len(left):
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        total = (mine * np.repeat(share[left], counts, axis=0)).sum(1)
        gain = np.add.reduceat(mine / total[:, None], starts) / counts[:, None]
        done = np.log(gain.max(1)) <= TOLERANCE
        if done.any():
            reached[left[done]] = np.add.reduceat(np.log(total), starts)[done]
            going = ~done
            mine, left, gain = mine[np.repeat(going, counts)], left[going], gain[going]
            counts = counts[going]
        share[left] *= gain
    return share / share.sum(1)[:, None], reached


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Gram counts of every row with a language and a text; tasks count, Spark adds the counts up.

    What reaches the driver is one number per language and bucket, however many rows there are.
    """

    def run(batches):
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column(0), batch.column(1)
            for at in range(batch.num_rows):
                data = normalised(texts[at].as_py())
                name = langs[at].as_py()
                counts = found.setdefault(name, np.zeros(BUCKETS, dtype=np.int64))
                counts += np.bincount(gram_buckets(data), minlength=BUCKETS)
        for name, counts in found.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(counts[used])],
                names=["lang", "bucket", "n"],
            )

    rows = (
        bounded_batches(docs)
        .where(F.col(text).isNotNull() & F.col(lang).isNotNull())
        .select(F.col(text).alias("__text"), F.col(lang).alias("__lang"))
        .mapInArrow(run, "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    languages = sorted(set(rows.column("lang").to_pylist()))
    place = {name: i for i, name in enumerate(languages)}
    counts = np.full((BUCKETS, max(1, len(languages))), 0.5)
    which = np.array([place[name] for name in rows.column("lang").to_pylist()], dtype=np.int64)
    np.add.at(counts, (rows.column("bucket").to_numpy(), which), rows.column("n").to_numpy())
    return Model(languages, np.log(counts / counts.sum(0)).astype(np.float32))


def identify(
    docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",), with_shares: bool = False
) -> DataFrame:
    """``keep`` columns, lang_pred, score and, if asked for, the languages found with their shares.

    The prediction is the language with the largest share, its score that share. Null texts and
    texts without a letter are ``und`` with score 0, as is everything if nothing was learned; equal
    shares go to the language first in the alphabet. Whole texts of any length are read, their grams a
    piece at a time; what is held of a text is about two bytes a language for each of its bytes.
    Repeated rows get equal results, whatever stands beside them. Other columns are not read.
    """
    fields = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    if with_shares:
        fields += [StructField("langs", ArrayType(StringType())), StructField("shares", ArrayType(DoubleType()))]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def factory():
        model = shared.value

        def work(texts):
            known = [i for i, t in enumerate(texts) if t and LETTER.search(t)] if model.languages else []
            predicted, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            langs: list[list] = [[] for _ in texts]
            shares: list[list] = [[] for _ in texts]
            if known:
                found, _ = model.proportions([texts[i] for i in known])
                for i, row in zip(known, found):
                    top = int(row.argmax())
                    predicted[i], score[i] = model.languages[top], min(1.0, float(row[top]))
                    if with_shares:
                        held = np.flatnonzero(row)
                        langs[i], shares[i] = [model.languages[j] for j in held], row[held].tolist()
            return [predicted, score, langs, shares][: len(fields)]

        return work

    return map_texts(docs, text, list(keep), fields, factory)
