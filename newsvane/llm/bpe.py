"""Byte-level BPE by a deterministic automaton over tokens.

A word's tokens are the labels on one path of an automaton that is built merge by merge. It starts
with one state in which every byte may follow. The gadget of a merge (u, v) -> w acts on the state
q that u leads to, if v may follow there: u is led to a copy of q in which v may not follow, and
beside every arc labelled u there is now one labelled w, to where v led. In the finished automaton
every word has exactly one path, and its labels are the tokens that applying the merges in order
would give.

All arcs with one label end in one state, so a state needs only its origin, the label it bars and
the merge that made it; whether an arc exists is looked up through these.

Words are read byte by byte through a table made from that automaton: (state, byte) to the next
state and the labels that are certain by then. Every beginning of a word is a word with one path of
its own, so the last label of each is known when its byte is read; a label is certain when the paths
that a longer token could still start from all share it. Rows of the table are compiled when they are
first met. Nothing is searched or taken back while a word is read.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField

from newsvane.llm.common import map_texts

# How the public byte-level tokenizers cut a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Words kept with their tokens while a task runs, and after it; entries of the byte table kept before
# it is begun anew.
CACHED_WORDS, KEPT_WORDS, TABLE_ENTRIES = 500_000, 150_000, 250_000
CACHED_WORD_BYTES = 64


def byte_symbols() -> dict[str, int]:
    """The printable characters that stand for bytes in vocabulary files."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass
class Automaton:
    """States are numbers; state 0 is the start. Tokens are numbered as in the vocabulary."""

    labels: list  # token -> bytes
    enters: list  # token -> state its arcs lead to
    born: list  # token -> merge that made it, -1 for bytes
    left: list  # token -> first part of its merge
    origin: list = field(default_factory=lambda: [-1])
    barred: list = field(default_factory=lambda: [-1])
    since: list = field(default_factory=lambda: [-1])
    arcs: dict = field(default_factory=dict)
    known: int = 0

    def forget(self) -> None:
        self.arcs.clear()
        self.known = 0

    def may_follow(self, state: int, token: int) -> bool:
        """Is there an arc labelled ``token`` out of ``state``?"""
        if (answer := self.arcs.get(key := (state, token))) is not None:
            return answer
        q, t = state, token
        while True:
            # An arc made with or after the state came with the arc of its first part.
            while self.born[t] >= self.since[q] and self.born[t] >= 0:
                t = self.left[t]
            if q == 0:
                answer = True
                break
            if t == self.barred[q]:
                answer = False
                break
            q = self.origin[q]
        self.arcs[key] = answer
        self.known += 1
        return answer


def compile_merges(vocabulary: dict[bytes, int], merges: list[tuple[bytes, bytes]]) -> Automaton:
    """Build the automaton by one gadget per merge, in order."""
    size = max(vocabulary.values()) + 1
    labels = [b""] * size
    for label, token in vocabulary.items():
        labels[token] = label
    automaton = Automaton(labels, [0] * size, [-1] * size, [-1] * size)
    for rank, (first, second) in enumerate(merges):
        u, v, w = vocabulary[first], vocabulary[second], vocabulary[first + second]
        state = automaton.enters[u]
        automaton.born[w], automaton.left[w] = rank, u
        if not automaton.may_follow(state, v):
            # The pair never meets: the merged token keeps no arc that a word can take.
            automaton.enters[w] = -1
            continue
        # The copy of the state, with the arc of v removed, takes over the arcs of u.
        automaton.enters[w] = automaton.enters[v]
        automaton.origin.append(state)
        automaton.barred.append(v)
        automaton.since.append(rank)
        automaton.enters[u] = len(automaton.origin) - 1
        if u == v:
            automaton.enters[w] = state
        automaton.forget()
    return automaton


class ByteTable:
    """(state, byte) -> (next state, labels emitted), deterministic; state 0 is the start of a word.

    A state is the bytes read since all was certain, the last label of each of their beginnings, and
    what the automaton's state there bars from following. Of that only what begins like the pending
    bytes is kept, so that words in the same state go on alike, whatever came before.
    """

    def __init__(self, automaton: Automaton, usable: dict[bytes, int]):
        self.automaton, self.usable = automaton, usable
        # What a token can still be made of by further bytes.
        self.open = {label[:size] for label in usable for size in range(1, len(label))}
        self.clear()

    def clear(self) -> None:
        # Per state: bars, pending bytes, last label of each of their beginnings (-1: no path).
        self.states: list[tuple] = [((), b"", ())]
        self.numbers: dict[tuple, int] = {self.states[0]: 0}
        self.entries: dict[int, tuple] = {}
        self.ends: list[tuple] = [()]
        self.barring: dict[tuple, tuple] = {}

    def bars(self, token: int, first: int | None) -> tuple:
        """(merge, barred label) of the state behind ``token``, latest merge first; if the next byte
        is known, those that begin with it."""
        made = self.barring.get((token, first))
        if made is None:
            found, automaton = [], self.automaton
            state = automaton.enters[token]
            while state:
                label = automaton.barred[state]
                if first is None or automaton.labels[label][0] == first:
                    found.append((automaton.since[state], label))
                state = automaton.origin[state]
            made = self.barring[token, first] = tuple(found)
        return made

    def allows(self, bars: tuple, token: int) -> bool:
        """`Automaton.may_follow` for a state given by its bars."""
        born, left = self.automaton.born, self.automaton.left
        for since, barred in bars:
            while born[token] >= since and born[token] >= 0:
                token = left[token]
            if token == barred:
                return False
        return True

    def compile(self, state: int, byte: int) -> tuple:
        """The table's entry for one state and byte."""
        labels = self.automaton.labels
        bars, pending, last = self.states[state]
        pending += bytes((byte,))
        size = len(pending)
        # The one label with which the path of everything read so far ends.
        for start in range(size):
            token = self.usable.get(pending[start:])
            if token is None or (start and last[start - 1] < 0):
                continue
            if self.allows(self.bars(last[start - 1], pending[start]) if start else bars, token):
                break
        last = (*last, token)

        def up(at: int) -> int:
            return at - len(labels[last[at - 1]])

        path = [size]
        while path[-1]:
            path.append(up(path[-1]))
        shared, on_path, live = size, set(path), False
        for at in range(size):
            if (at == 0 or last[at - 1] >= 0) and pending[at:] in self.open:
                live = live or at == 0
                while at not in on_path:
                    at = up(at)
                shared = min(shared, at)
        emitted = tuple(last[at - 1] for at in reversed(path) if 0 < at <= shared)
        if shared:
            live = pending[shared:] in self.open
            pending, before, rest = pending[shared:], last[shared - 1], last[shared:]
            bars = self.bars(before, pending[0] if pending else None)
            kept = []
            for at, label in enumerate(rest, 1):
                begins = at - len(labels[label]) if label >= 0 else -1
                kept.append(label if begins == 0 or (begins > 0 and kept[begins - 1] >= 0) else -1)
            last = tuple(kept)
        if not live and pending:
            # Nothing longer begins where all is certain: what is barred there no longer matters.
            bars = ()
        elif pending:
            bars = tuple(
                b for b in bars if labels[b[1]].startswith(pending) or pending.startswith(labels[b[1]])
            )
        number = self.numbers.get(key := (bars, pending, last))
        if number is None:
            number = self.numbers[key] = len(self.states)
            self.states.append(key)
            self.ends.append(self._end(pending, last))
        entry = self.entries[state << 8 | byte] = (number, emitted)
        return entry

    def _end(self, pending: bytes, last: tuple) -> tuple:
        """The labels of the pending bytes, if the word ends with them."""
        made, at = [], len(pending)
        while at:
            made.append(last[at - 1])
            at -= len(self.automaton.labels[last[at - 1]])
        return tuple(reversed(made))

    def read(self, word: bytes) -> list[int]:
        """The labels on the word's path: one look into the table per byte."""
        if len(self.entries) > TABLE_ENTRIES:
            self.clear()
        entry, made, state = self.entries.get, [], 0
        for byte in word:
            found = entry(state << 8 | byte)
            if found is None:
                found = self.compile(state, byte)
            state, emitted = found
            if emitted:
                made += emitted
        made += self.ends[state]
        return made


class Tokenizer:
    """Encode by transitions of the byte table, decode by the labels of the automaton's arcs."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        symbols = byte_symbols()
        to_bytes = lambda s: bytes(symbols[c] for c in s)
        vocabulary = {to_bytes(k): v for k, v in spec["model"]["vocab"].items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.automaton = compile_merges(vocabulary, [(to_bytes(a), to_bytes(b)) for a, b in pairs])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        usable = {label: token for label, token in vocabulary.items() if self.automaton.enters[token] >= 0}
        self.table = ByteTable(self.automaton, usable)
        self.labels = list(self.automaton.labels)
        for content, token in self.special.items():
            self.labels += [b""] * (token + 1 - len(self.labels))
            self.labels[token] = content.encode()
        self.words = regex.compile(WORDS)
        self.cut = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
            if self.special
            else None
        )
        self.cache: dict[str, bytes] = {}

    def trim(self) -> None:
        """Drop what was kept for one task only. The words met first, most of them common, stay for
        the worker's next task, and so does the table."""
        self.cache = dict(islice(self.cache.items(), KEPT_WORDS))

    def _packed(self, word: str) -> bytes:
        packed = np.array(self.table.read(word.encode()), dtype="<u4").tobytes()
        if len(word) <= CACHED_WORD_BYTES:
            self.cache[word] = packed
        return packed

    def _piece(self, text: str) -> list[bytes]:
        if len(self.cache) > CACHED_WORDS:
            self.cache.clear()
        get, packed = self.cache.get, self._packed
        return [get(w) or packed(w) for w in self.words.findall(text)]

    def encode(self, text: str) -> np.ndarray:
        """Token ids; the strings of added tokens give the added tokens, wherever they stand."""
        if self.cut is None or not any(s in text for s in self.special):
            parts = self._piece(text)
        else:
            parts = []
            for piece in self.cut.split(text):
                if piece in self.special:
                    parts.append(np.array([self.special[piece]], dtype="<u4").tobytes())
                elif piece:
                    parts += self._piece(piece)
        return np.frombuffer(b"".join(parts), dtype="<u4")

    def decode(self, tokens) -> str:
        """The arc labels in a row, as text; bytes that are no text become U+FFFD."""
        labels = self.labels
        return b"".join([labels[t] for t in tokens]).decode("utf-8", "replace")


_LOADED: dict[str, Tokenizer] = {}


def load(path: str) -> Tokenizer:
    """The tokenizer of a file, compiled once per process."""
    if path not in _LOADED:
        _LOADED[path] = Tokenizer(path)
    return _LOADED[path]


def encode_decode(
    docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
    with_tokens: bool = False,
) -> DataFrame:
    """``keep`` columns, n_tokens, ids_sha256, decoded_sha256 and, if asked for, the tokens and the
    decoded text. One row per row of ``docs``.

    ``path`` names the vocabulary file, present on every machine as part of an installed package.
    A null text counts as empty: no tokens, digests of nothing. Texts of any length are encoded
    whole; their words are found by the tokenizer's pattern, so only the longest word is ever
    walked at once. Repeated rows and ties stay as they are, other columns are not read.
    """
    fields = [
        StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()),
        StructField("decoded_sha256", StringType()),
    ]
    if with_tokens:
        fields += [StructField("tokens", ArrayType(IntegerType())), StructField("decoded", StringType())]

    def factory():
        tokenizer = load(path)

        def work(texts):
            out = [[] for _ in fields]
            for t in texts:
                ids = tokenizer.encode(t or "")
                decoded = tokenizer.decode(ids.tolist())
                out[0].append(len(ids))
                out[1].append(hashlib.sha256(ids.tobytes()).hexdigest())
                out[2].append(hashlib.sha256(decoded.encode()).hexdigest())
                if with_tokens:
                    out[3].append(ids.astype("int32"))
                    out[4].append(decoded)
            return out

        work.finish = tokenizer.trim
        return work

    return map_texts(docs, text, list(keep), fields, factory)
