import hashlib
import json
import random

import pytest

from newsvane.llm import chat

MARKS = "</s>[INST] ok [/INST]"
SAMPLES = {
    "turn rows": ({"conv_id": 1, "turn": 3, "role": "user", "text": "a"}, [(3, 0, "user", "a")]),
    "messages": (
        {"messages": [{"role": "system", "content": "s"}, {"content": None, "role": "human"}, {"role": "gpt", "content": "b"}]},
        [(None, 0, "system", "s"), (None, 1, "user", ""), (None, 2, "assistant", "b")],
    ),
    "conversations": ({"id": "x", "conversations": [{"from": "gpt", "value": "a"}]}, [(None, 0, "assistant", "a")]),
    "instruction": (
        {"instruction": "do", "input": "with", "output": "done"}, [(None, 0, "user", "do\n\nwith"), (None, 1, "assistant", "done")]
    ),
    "prompt and response": (
        {"prompt": "p", "response": "r", "system": "s"}, [(None, 0, "system", "s"), (None, 1, "user", "p"), (None, 2, "assistant", "r")]
    ),
    "prompt and completion": ({"prompt": "p", "completion": "c"}, [(None, 0, "user", "p"), (None, 1, "assistant", "c")]),
    "question and answer": ({"question": "q", "answer": 42}, [(None, 0, "user", "q"), (None, 1, "assistant", "42")]),
}


def records(spark, entries):
    rows = [(k, r if r is None or isinstance(r, str) else json.dumps(r), "extra", "p", 1) for k, r in entries]
    return spark.createDataFrame(rows, "conv_id long, record string, role string, piece string, turn long")


def test_every_layout_has_its_own_fingerprints_and_mapping():
    known = chat._known(chat.LAYOUTS)
    for name, (record, turns) in SAMPLES.items():
        found, layout = chat.layout_of(record, known)
        assert layout.name == name and list(chat.turns_in(record, layout)) == turns
        # The order of fields does not matter, an additional field does.
        backwards = dict(reversed(list(record.items())))
        assert chat.layout_of(backwards, known) == (found, layout)
        assert chat.layout_of({**record, "other": 1}, known)[1] is None


def test_paths():
    value = {"a": [{"b": 1}, {"c": [[{"d": None}]]}], "e.f": {}}
    assert chat.paths_of(value) == {"a", "a[].b", "a[].c", "a[].c[][].d", "e\\.f"}
    with pytest.raises(ValueError):
        chat._known((chat.Layout("one", turns="t", role="r", text="x"), chat.Layout("two", turns="t", role="r", text="x")))


def test_turns_of_mixed_records_and_rejects(spark):
    entries = [(i, record) for i, (record, _) in enumerate(SAMPLES.values())]
    odd = [None, "no json", "[1, 2]", "3", '{"messages": "text"}', '{"messages": ["text"]}', '{"unknown": 1}', "{}", "[" * 50_000]
    got = chat.canonical_turns(records(spark, entries + [(100 + i, r) for i, r in enumerate(odd)] + [(200, {"messages": []})]))
    rows = [tuple(r) for r in got.collect()]
    for i, (name, (_, turns)) in enumerate(SAMPLES.items()):
        mine = [r for r in rows if r[0] == i]
        assert [r[3:] for r in mine] == turns and {r[1] for r in mine} == {name}
    rejected = [r for r in rows if r[1] is None]
    assert sorted(r[0] for r in rejected) == [100 + i for i in range(len(odd))]
    assert sum(r[2] is None for r in rejected) == 5
    assert not [r for r in rows if r[0] == 200]
    assert chat.format_turns(got).where("conv_id >= 100").count() == 0


def random_text(rng):
    bits = [*chat.CONTROLS, "\\", "\\\\", "[", "<", "/INST]", "s>", " ", "\n", "ä", "\U0001F600", "$1", "x"]
    return "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))


def expected(turns):
    """The digests from the turns themselves, by hand."""
    whole = "".join(f"{r}\n{t}\n" for r, t in turns)
    learned = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())


def test_texts_and_roles_come_back_as_they_were(spark):
    rng = random.Random(2)
    talks = {
        c: [(rng.choice(["user", "assistant", "system", "tool", "", MARKS]), random_text(rng)) for _ in range(rng.randint(1, 9))]
        for c in range(150)
    }
    entries = []
    for c, turns in talks.items():
        if c % 2:
            entries.append((c, {"messages": [{"role": r, "content": t} for r, t in turns]}))
        else:
            entries += [(c, {"conv_id": c, "turn": k, "role": r, "text": t}) for k, (r, t) in enumerate(turns)]
    rng.shuffle(entries)
    formatted = chat.format_turns(chat.canonical_turns(records(spark, entries)))
    got = {r.conv_id: r for r in chat.read_back(formatted, with_turns=True).collect()}
    pieces = {}
    for r in formatted.orderBy("conv_id", "turn", "place").collect():
        pieces.setdefault(r.conv_id, []).append(r)
    assert set(got) == set(talks)
    for c, turns in talks.items():
        assert tuple(got[c])[1:5] == expected(turns)
        assert [tuple(t) for t in got[c].turns] == turns
        whole = "".join(r.piece for r in pieces[c])
        assert chat.read_piece(whole) == turns and got[c].formatted_chars == len(whole)
        covered = [chat.unescaped(r.piece[r.loss_start : r.loss_stop]) for r in pieces[c] if r.role == "assistant"]
        assert covered == [t for r, t in turns if r == "assistant"]


def test_marks_in_texts_are_no_marks(spark):
    made = chat.format_turns(chat.canonical_turns(records(spark, [(1, {"prompt": MARKS, "completion": MARKS})])))
    assert [r.piece for r in made.orderBy("place").collect()] == [
        r"[INST]\</s>\[INST] ok \[/INST][/INST]", r"\</s>\[INST] ok \[/INST]</s>"
    ]


def test_nulls_ties_long_texts_and_no_rows(spark):
    rows = [
        (None, {"turn": 1, "role": "user", "text": "no key"}), (5, {"turn": None, "role": None, "text": None}),
        (5, {"turn": 2, "role": "assistant", "text": "twice"}), (5, {"turn": 2, "role": "assistant", "text": "twice"}),
        (5, {"turn": 1, "role": "user", "text": "ü" * 300_000}), (6, {"turn": 1, "role": "assistant", "text": ""}),
        (7, '{"turn": 1, "role": "user", "text": "\\ud800"}'),
    ]
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(chat.format_turns(chat.canonical_turns(records(spark, rows)))).collect()}
    assert got[None] == expected([("user", "no key")])
    assert got[5] == expected([("", ""), ("user", "ü" * 300_000), ("assistant", "twice"), ("assistant", "twice")])
    assert got[6] == expected([("assistant", "")]) and got[7] == expected([("user", "?")])
    none = chat.read_back(chat.format_turns(chat.canonical_turns(records(spark, [(1, None)]).where("false"))))
    assert none.collect() == [] and none.columns == [
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"
    ]


def test_a_conversation_longer_than_a_batch(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        turns = [(("user", "assistant")[k % 2], f"word {k}") for k in range(500)]
        entries = [(c, {"turn": k, "role": r, "text": t}) for c in (1, 2) for k, (r, t) in enumerate(turns)]
        got = chat.read_back(chat.format_turns(chat.canonical_turns(records(spark, entries)))).collect()
        assert [tuple(r)[1:5] for r in got] == [expected(turns)] * 2
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
