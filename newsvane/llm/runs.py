"""Periodic runs of words: stretches that repeat themselves with a period.

The words of a text are read one after the other. The suffix automaton of the text has one state per
set of strings that end in the same places; its links form a tree in which the path from the state
of a prefix to the root holds all suffixes of that prefix. Every appended word recolours that path
with its own place, as the access operation of a link-cut tree does: along the path lie segments of
equal colour, and the colour of a segment is the last place where its strings ended before. A
segment whose longest string has ``length`` words, last seen ``distance`` words ago, is the longest
common suffix of the two places; if distance <= length it is a square of that period, and more
words of the length than that make it a longer repetition. Being the *last* place makes the distance the
smallest period. Repetitions that are long enough are extended to the right as far as they go.

The tree's paths are held per heavy chain, a stack of segments each: a path crosses few chains, every
access leaves one segment on each chain it crosses, and every other segment it meets is removed, so
n words cost n log n steps.

Only stretches that can hold a run reach the automaton: inside a run every three consecutive words
occur at least three times in the text (a run has four periods and six words), so words outside such
threes are in no run. Threes are counted by hash; a collision only lets more words through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from newsvane.llm.common import map_texts

# A run has at least so many words, and at least so many periods.
WORDS, PERIODS = 6, 4

Run = tuple[int, int, int]


def link_tree(words: Sequence) -> tuple[list[int], list[int], list[int]]:
    """The suffix automaton's links and string lengths, and the state of every prefix."""
    length, link, following = [0], [-1], [{}]
    last, prefixes = 0, []
    for word in words:
        new = len(length)
        length.append(length[last] + 1)
        link.append(0)
        following.append({})
        at = last
        while at >= 0 and word not in following[at]:
            following[at][word] = new
            at = link[at]
        if at >= 0:
            target = following[at][word]
            if length[target] != length[at] + 1:
                # Strings of up to length[at] + 1 words end in one more place now: a state of their own.
                copy = len(length)
                length.append(length[at] + 1)
                link.append(link[target])
                following.append(dict(following[target]))
                while at >= 0 and following[at].get(word) == target:
                    following[at][word] = copy
                    at = link[at]
                link[target] = copy
                target = copy
            link[new] = target
        last = new
        prefixes.append(new)
    return link, length, prefixes


def heavy_chains(link: list[int], length: list[int]) -> list[int]:
    """The top state of every state's chain: a state and its child with the most states below."""
    order = np.argsort(np.array(length), kind="stable").tolist()
    below, heavy, most = [1] * len(link), [-1] * len(link), [0] * len(link)
    for state in reversed(order[1:]):
        parent = link[state]
        size = below[state]
        below[parent] += size
        if size > most[parent]:
            most[parent], heavy[parent] = size, state
    head = list(range(len(link)))
    for state in order[1:]:
        if heavy[link[state]] == state:
            head[state] = head[link[state]]
    return head


def repetitions(words: Sequence) -> list[Run]:
    """(start, length, period) of every run of ``words``, in no order."""
    link, length, prefixes = link_tree(words)
    head = heavy_chains(link, length)
    # Per chain, from the deepest segment up: the longest string of a segment and its colour.
    chains: dict[int, list[tuple[int, int]]] = {}
    n, found, reached = len(words), [], {}
    for at, state in enumerate(prefixes):
        while state > 0:
            top, longest = head[state], length[state]
            segments = chains.setdefault(top, [])
            while segments:
                deepest, colour = segments[-1]
                # The part of the segment on the path; what lies deeper keeps its colour.
                common = deepest if deepest < longest else longest
                period = at - colour
                if (
                    common >= (PERIODS - 1) * period
                    and common + period >= WORDS
                    and reached.get(period, -1) < at
                ):
                    stop = at + 1
                    while stop < n and words[stop] == words[stop - period]:
                        stop += 1
                    start = colour - common + 1
                    reached[period] = stop - 1
                    found.append((start, stop - start, period))
                if deepest <= longest:
                    segments.pop()
                if deepest >= longest:
                    break
            segments.append((longest, at))
            state = link[top]
    return found


_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


def candidate_stretches(words: np.ndarray, text_of: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (begin, end) of word numbers that may hold runs; no run reaches over their ends.

    ``text_of`` numbers the texts, whose words lie behind one another.
    """
    if len(words) < WORDS:
        return []
    w = words.astype(np.uint64)
    mixed = w[:-2] * _MIX[0] + w[1:-1] * _MIX[1] + w[2:] * _MIX[2] + text_of[:-2].astype(np.uint64) * _MIX[3]
    mixed = (mixed ^ (mixed >> np.uint64(31))) * _MIX[1]
    bits = max(10, len(words).bit_length() + 2)
    bucket = (mixed >> np.uint64(64 - bits)).astype(np.int64)
    inside = text_of[:-2] == text_of[2:]
    often = np.bincount(bucket[inside], minlength=1 << bits)[bucket] >= PERIODS - 1
    often &= inside
    covered = np.zeros(len(words) + 2, dtype=bool)
    for k in range(3):
        covered[k + 1 : k + 1 + len(often)] |= often
    # A stretch ends with its text.
    first = covered[1:-1] & (~covered[:-2] | np.concatenate([[True], text_of[1:] != text_of[:-1]]))
    last = covered[1:-1] & (~covered[2:] | np.concatenate([text_of[1:] != text_of[:-1], [True]]))
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    long = end - begin >= WORDS
    return list(zip(begin[long].tolist(), end[long].tolist()))


def best_run(runs: Sequence[Run]) -> Run | None:
    """The run of most periods; of equals the one that starts first, then the one of the smaller period."""
    best = None
    for run in runs:
        if best is None:
            best = run
            continue
        more = run[1] * best[2] - best[1] * run[2]
        if more > 0 or (more == 0 and (run[0], run[2]) < (best[0], best[2])):
            best = run
    return best


def collapsed(words: Sequence[bytes], runs: Sequence[Run]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    kept, at = [], 0
    for start, stop in sorted((s + p, s + n) for s, n, p in runs):
        if stop > at:
            kept += words[at : max(at, start)]
            at = stop
    kept += words[at:]
    return kept


def runs_of(texts: Sequence[bytes]) -> list[tuple[list[bytes], list[Run]]]:
    """The words and the runs, by start and period, of every text."""
    split = [t.split() for t in texts]
    known: dict[bytes, int] = {}
    numbers = np.array([known.setdefault(w, len(known)) for words in split for w in words], dtype=np.int64)
    sizes = np.array([len(words) for words in split], dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    found: list[list[Run]] = [[] for _ in split]
    text_of = np.repeat(np.arange(len(split)), sizes)
    for begin, end in candidate_stretches(numbers, text_of):
        text = int(text_of[begin])
        shift = begin - int(offsets[text])
        runs = repetitions(numbers[begin:end].tolist())
        found[text] += [(start + shift, size, period) for start, size, period in runs]
    return [(words, sorted(runs, key=lambda r: (r[0], r[2]))) for words, runs in zip(split, found)]


def _finder(with_text: bool):
    def make():
        def work(texts: list) -> list[list]:
            out: list[list] = [[] for _ in range(9 if with_text else 7)]
            for words, runs in runs_of([(t or "").encode("utf-8", "replace") for t in texts]):
                listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
                left = b" ".join(collapsed(words, runs))
                start, size, period = best_run(runs) or (None, None, None)
                row = [
                    len(runs), start, size, period, None if period is None else 1000 * size // period,
                    hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left).hexdigest(),
                ]
                if with_text:
                    row += [[{"start": s, "length": n, "period": p} for s, n, p in runs], left.decode()]
                for column, value in zip(out, row):
                    column.append(value)
            return out

        return work

    return make


def find_runs(
    docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), with_text: bool = False
) -> DataFrame:
    """``keep`` and (n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256); one
    row per row of ``docs``.

    Words are separated by blanks, tabs and line ends (ASCII) and numbered from 0. A run is a stretch
    of words with smallest period q, of at least 6 words and 4 periods, that no neighbouring word
    extends. start to exponent_milli describe the run of most periods (equals: the first, then the
    smallest period) and are null without a run. ``runs_sha256`` digests ``start,length,period`` and
    a line end of every run by start and period, ``collapsed_sha256`` the words, joined by a blank,
    that no run holds after its first period. ``with_text`` adds the runs and the collapsed text.

    Null texts count as empty: no runs, digests of nothing. Ids may be null or repeated, rows are
    taken each for itself, other columns are not read. There is no shuffle. Texts are read whole; the
    automaton of a stretch takes about 700 bytes a word, and only stretches of threes of words
    that come at least three times in the text have one.
    """
    fields = [
        *(StructField(c, LongType()) for c in ("n_runs", "start", "length", "period", "exponent_milli")),
        StructField("runs_sha256", StringType()), StructField("collapsed_sha256", StringType()),
    ]
    if with_text:
        run = StructType([StructField(c, LongType()) for c in ("start", "length", "period")])
        fields += [StructField("runs", ArrayType(run)), StructField("collapsed", StringType())]
    return map_texts(docs, text, keep, fields, _finder(with_text))
