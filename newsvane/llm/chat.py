"""Chat formatting: records of many layouts to canonical turns, and turns to a template with a loss mask.

1. Fingerprint. The set of a record's nested field paths (``messages[].role``), sorted and hashed,
   tells its layout. Declared layouts say which paths hold turns, roles and texts; from the paths a
   layout requires and may have, all its fingerprints are known beforehand, so a record's layout is
   one look-up. Records of no known layout are kept aside with their fingerprint.
2. Canonical turns: one row per turn, (key, turn, place, role, text). A layout of one turn per
   record, or of all turns in one, ends in the same rows, so no conversation is gathered.
3. Template. A turn is written between marks; control strings in its text get an escape character in
   front, and so does the escape character itself, so that marks are never found in texts and
   texts come back as they were. The loss mask covers the texts of assistant turns.
4. Reading back goes over the pieces in order, one conversation after the other, and holds a piece at
   a time: conversations may have any length.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from newsvane.llm.common import bounded_batches

# The template's control strings and its escape character.
OPEN, CLOSE, ASIDE, END, ROLE = "[INST]", "[/INST]", "<<SYS>>", "</s>", "<<ROLE>>"
CONTROLS = (OPEN, CLOSE, ASIDE, END, ROLE)
ESCAPE = "\\"

_TO_ESCAPE = "|".join(re.escape(c) for c in (ESCAPE, *CONTROLS))
_ESCAPED = re.compile(re.escape(ESCAPE) + "(.)", re.DOTALL)
# What a piece is read back with: an escaped character, a control string, or text.
_PARTS = re.compile(re.escape(ESCAPE) + ".|" + "|".join(re.escape(c) for c in CONTROLS), re.DOTALL)


@dataclass(frozen=True)
class Layout:
    """Where a kind of record has its turns.

    ``turns`` is the path of a list of turns with ``role`` and ``text`` inside it; without it the
    record itself is one turn, numbered by ``order``. ``parts`` are (path, role) of records that hold
    one text per path; paths of ``parts`` with the same role are joined by a blank line. ``optional``
    paths may be missing; ``ignored`` ones may be there.
    """

    name: str
    turns: str | None = None
    role: str | None = None
    text: str | None = None
    order: str | None = None
    parts: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()
    ignored: tuple[str, ...] = ("conv_id", "id")
    roles: dict[str, str] = field(default_factory=dict)

    def required(self) -> set[str]:
        if self.parts:
            return {path for path, _ in self.parts} - set(self.optional)
        inside = f"{self.turns}[]." if self.turns else ""
        paths = {inside + p for p in (self.role, self.text) if p}
        paths |= {self.order} if self.order else set()
        return (paths | ({self.turns} if self.turns else set())) - set(self.optional)

    def fingerprints(self) -> Iterator[str]:
        maybe = sorted({*self.optional, *self.ignored})
        for some in itertools.product([False, True], repeat=len(maybe)):
            yield fingerprint_of(self.required() | {p for p, there in zip(maybe, some) if there})


# Names of roles that mean one of ours.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

LAYOUTS = (
    Layout("turn rows", role="role", text="text", order="turn"),
    Layout("messages", turns="messages", role="role", text="content", ignored=("conv_id", "id", "model"), roles=ROLES),
    Layout("conversations", turns="conversations", role="from", text="value", roles=ROLES),
    Layout("turns", turns="turns", role="role", text="text", roles=ROLES),
    Layout("instruction", parts=(("system", "system"), ("instruction", "user"), ("input", "user"), ("output", "assistant")),
           optional=("system", "input")),
    Layout("prompt and response", parts=(("system", "system"), ("prompt", "user"), ("response", "assistant")), optional=("system",)),
    Layout("prompt and completion", parts=(("prompt", "user"), ("completion", "assistant"))),
    Layout("question and answer", parts=(("context", "user"), ("question", "user"), ("answer", "assistant")), optional=("context",)),
)


def paths_of(value, inside: str = "") -> set[str]:
    """The nested field paths of a value read from JSON; a list adds ``[]`` and the paths of its entries."""
    if isinstance(value, dict):
        found = set()
        for name, entry in value.items():
            # A dot or bracket in a name is not one of a path.
            path = inside + ("." if inside else "") + re.sub(r"([.\[\]\\])", r"\\\1", name)
            found |= {path} | paths_of(entry, path)
        return found
    if isinstance(value, list):
        return set().union(*(paths_of(entry, inside + "[]") for entry in value))
    return set()


def fingerprint_of(paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode("utf-8", "surrogatepass")).hexdigest()[:16]


def _known(layouts: Sequence[Layout]) -> dict[str, Layout]:
    known: dict[str, Layout] = {}
    for layout in layouts:
        for found in layout.fingerprints():
            if known.setdefault(found, layout) is not layout:
                raise ValueError(f"layouts {known[found].name!r} and {layout.name!r} have a fingerprint in common")
        if layout.turns:
            # A list without entries has no paths inside.
            empty = {layout.turns}
            for some in itertools.product([False, True], repeat=len(layout.ignored)):
                known.setdefault(fingerprint_of(empty | {p for p, there in zip(layout.ignored, some) if there}), layout)
    return known


def _as_text(value) -> str:
    if value is None:
        return ""
    text = value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    # JSON can name half a character, which no text holds.
    return text if text.isascii() else text.encode("utf-8", "replace").decode()


def layout_of(record: dict, known: dict[str, Layout]) -> tuple[str, Layout | None]:
    """The fingerprint of a record, and its layout if that is known and its turns are turns."""
    found = fingerprint_of(paths_of(record))
    layout = known.get(found)
    if layout and layout.turns:
        # Entries that are no objects have no paths.
        entries = record[layout.turns]
        if not isinstance(entries, list | None) or not all(isinstance(e, dict | None) for e in entries or ()):
            return found, None
    return found, layout


def turns_in(record: dict, layout: Layout) -> Iterator[tuple[int | None, int, str, str]]:
    """(turn, place, role, text) of a record, by its layout."""
    if layout.parts:
        place = 0
        for role, paths in itertools.groupby(layout.parts, key=lambda p: p[1]):
            texts = [_as_text(record[p]) for p, _ in paths if p in record]
            if texts:
                yield None, place, role, "\n\n".join(t for t in texts if t)
                place += 1
        return
    for place, entry in enumerate((record[layout.turns] or ()) if layout.turns else [record]):
        entry = entry or {}
        name = _as_text(entry.get(layout.role))
        order = record.get(layout.order) if layout.order else None
        turn = order if isinstance(order, int) and abs(order) < 1 << 63 else None
        yield turn, place, layout.roles.get(name, name), _as_text(entry.get(layout.text))


TURN_FIELDS = [
    StructField("layout", StringType()), StructField("fingerprint", StringType()), StructField("turn", LongType()),
    StructField("place", LongType()), StructField("role", StringType()), StructField("text", StringType()),
]


def canonical_turns(
    records: DataFrame, key: str = "conv_id", record: str = "record", layouts: Sequence[Layout] = LAYOUTS
) -> DataFrame:
    """(``key``, layout, fingerprint, turn, place, role, text): one row per turn of JSON records.

    ``turn`` is the record's own number, if its layout has one, ``place`` the place in its list. A
    null role or text is empty; texts that are no strings are written as JSON. A record that is null,
    no JSON object, or of no known layout gives one row with its fingerprint (null if it cannot be
    read) and nulls from ``turn`` on, so that nothing vanishes; a list without turns gives no row.
    Keys may be null or shared; other columns are not read.
    """
    schema = StructType([StructField(key, records.schema[key].dataType), *TURN_FIELDS])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known(layouts)
        for batch in batches:
            from_row, out = [], []
            for at, text in enumerate(batch.column(1).to_pylist()):
                try:
                    # No number is read as one that JSON does not have.
                    value = None if text is None else json.loads(text, parse_constant=str)
                except (ValueError, RecursionError):
                    value = None
                if not isinstance(value, dict):
                    rows = [(None, None, None, None, None, None)]
                else:
                    found, layout = layout_of(value, known)
                    rows = (
                        [(layout.name, found, *turn) for turn in turns_in(value, layout)]
                        if layout
                        else [(None, found, None, None, None, None)]
                    )
                out += rows
                from_row += [at] * len(rows)
            if out:
                keys = batch.column(0).take(pa.array(from_row)).cast(arrow.field(0).type)
                columns = [pa.array(c, arrow.field(k + 1).type) for k, c in enumerate(zip(*out))]
                yield pa.RecordBatch.from_arrays([keys, *columns], schema=arrow)

    chosen = records.select(F.col(f"`{key}`"), F.col(f"`{record}`").cast("string").alias("__record"))
    return bounded_batches(chosen).mapInArrow(run, schema)


def escaped(text: Column) -> Column:
    """The text with the escape character before every control string and every escape character."""
    return F.regexp_replace(text, f"({_TO_ESCAPE})", ESCAPE * 2 + "$1")


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turns(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """(``key``, turn, place, role, text, piece, loss_start, loss_stop): canonical turns with their part of
    the formatted text.

    A conversation's formatted text is its pieces in the order of turn, place, role and piece. User
    turns stand between ``[INST]`` and ``[/INST]``, system turns between ``<<SYS>>`` and
    ``[/INST]``, assistant turns end with ``</s>``; any other role is named between two ``<<ROLE>>`` before
    its text, which ends with ``</s>``. The loss mask is loss_start to loss_stop within the piece
    (characters, end exclusive), empty for all but assistant turns. Rows of no known layout are left
    out: they are the caller's to look at.
    """
    body = escaped(F.coalesce("text", F.lit("")))
    role = F.coalesce("role", F.lit(""))
    before = (
        F.when(role == "user", OPEN).when(role == "system", ASIDE).when(role == "assistant", "")
        .otherwise(F.concat(F.lit(ROLE), escaped(role), F.lit(ROLE)))
    )
    after = F.when(role.isin("user", "system"), CLOSE).otherwise(END)
    learned = role == "assistant"
    parts = turns.where(F.col("layout").isNotNull()).select(
        F.col(f"`{key}`"), "turn", "place", role.alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        before.alias("__before"), body.alias("__body"), after.alias("__after"),
    )
    start = F.when(learned, F.length("__before")).otherwise(F.lit(0))
    stop = F.when(learned, F.length("__before") + F.length("__body")).otherwise(F.lit(0))
    return parts.select(
        F.col(f"`{key}`"), "turn", "place", "role", "text",
        F.concat("__before", "__body", "__after").alias("piece"), start.alias("loss_start"), stop.alias("loss_stop"),
    )


def read_piece(piece: str) -> list[tuple[str, str]]:
    """(role, text) of the turns in a formatted text, unescaped."""
    turns, role, at = [], "assistant", 0
    named_from = None
    for found in _PARTS.finditer(piece):
        mark = found.group()
        if mark[0] == ESCAPE:
            continue
        body = unescaped(piece[at : found.start()])
        if mark == OPEN:
            role = "user"
        elif mark == ASIDE:
            role = "system"
        elif mark == ROLE:
            # The second of the two ends the name.
            if named_from is None:
                named_from = found.end()
            else:
                role, named_from = body, None
        else:
            turns.append((role, body))
            role = "assistant"
        at = found.end()
    return turns


def read_back(formatted: DataFrame, key: str = "conv_id", with_turns: bool = False) -> DataFrame:
    """(``key``, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read from the pieces alone.

    turns_sha256 digests role, line end, text, line end of every turn; loss_chars and loss_sha256
    count and digest what the loss mask covers, unescaped; formatted_chars counts the characters of
    the whole. Pieces of one key are sorted by turn (null first), place, role and piece and read one
    after the other, so equal rows count each. The sort spills; a digest runs through a conversation
    in one task, which holds one batch of pieces. Without rows the result is empty. ``with_turns``
    adds the turns, for conversations that fit in memory.
    """
    fields = [
        StructField(key, formatted.schema[key].dataType), StructField("n_turns", LongType()),
        StructField("turns_sha256", StringType()), StructField("loss_chars", LongType()),
        StructField("loss_sha256", StringType()), StructField("formatted_chars", LongType()),
    ]
    if with_turns:
        turn = StructType([StructField("role", StringType()), StructField("text", StringType())])
        fields.append(StructField("turns", ArrayType(turn)))
    schema = StructType(fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, started, done = None, False, []
        count, chars, size, turns, loss, listed = 0, 0, 0, None, None, []

        def finished() -> tuple:
            row = (now, count, turns.hexdigest(), chars, loss.hexdigest(), size)
            return (*row, listed) if with_turns else row

        def batch_of(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow
            )

        for batch in batches:
            columns = (batch.column(k).to_pylist() for k in range(4))
            for owner, piece, start, stop in zip(*columns):
                if not started or owner != now:
                    if started:
                        done.append(finished())
                    now, started, count, chars, size, listed = owner, True, 0, 0, 0, []
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                for role, text in read_piece(piece):
                    count += 1
                    turns.update(f"{role}\n{text}\n".encode())
                    if with_turns:
                        listed.append({"role": role, "text": text})
                covered = unescaped(piece[start:stop])
                chars += len(covered)
                loss.update(covered.encode())
                size += len(piece)
            if done:
                yield batch_of(done)
                done = []
        if started:
            yield batch_of([finished()])

    order = [F.col(f"`{key}`"), *(F.col(c).asc_nulls_first() for c in ("turn", "place", "role", "piece"))]
    pieces = formatted.select(F.col(f"`{key}`"), "turn", "place", "role", "piece", "loss_start", "loss_stop")
    sorted_pieces = pieces.repartition(F.col(f"`{key}`")).sortWithinPartitions(*order)
    return bounded_batches(sorted_pieces.select(F.col(f"`{key}`"), "piece", "loss_start", "loss_stop")).mapInArrow(run, schema)
