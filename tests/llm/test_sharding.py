from collections import Counter

import pytest

from newsvane.llm import sharding


def brute(shards, slots):
    """Preference lists written out in full, claimed in turns."""
    lists = []
    for s in shards:
        offset, step = sharding._number(s, "offset") % slots, sharding._number(s, "step") % (slots - 1) + 1
        lists.append([(offset + j * step) % slots for j in range(slots)])
    owner = {}
    while len(owner) < slots:
        for number, wanted in enumerate(lists):
            if len(owner) < slots:
                owner[next(s for s in wanted if s not in owner)] = number
    return [owner[s] for s in range(slots)]


@pytest.mark.parametrize("count, slots", [(1, 2), (3, 7), (5, 101), (7, 211)])
def test_table_as_by_hand(count, slots):
    shards = [f"s{i}" for i in range(count)]
    assert sharding.fill_table(shards, slots) == brute(shards, slots)


def test_even_and_steady():
    shards = [f"s{i}" for i in range(20)]
    table = sharding.fill_table(shards, 10_007)
    sizes = Counter(table).values()
    assert max(sizes) - min(sizes) <= 1
    fewer = sharding.fill_table(shards[:-1], 10_007)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 19)
    assert moved < 0.1 * 10_007


@pytest.mark.parametrize("shards, slots", [([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2)])
def test_refuses_wrong_tables(shards, slots):
    with pytest.raises(ValueError):
        sharding.fill_table(shards, slots)


def test_odd_documents(odd_docs, no_docs):
    got = sharding.place(odd_docs, "doc_id").select("doc_id", "slot", "shard").collect()
    assert len(got) == odd_docs.count()
    owners = sharding.fill_table(sharding.SHARDS)
    assert all(r.shard == sharding.SHARDS[owners[r.slot]] for r in got)
    assert len({(r.slot, r.shard) for r in got if r.doc_id == 6}) == 1
    assert len({r.slot for r in got if r.doc_id is None}) == 1
    assert sharding.place(no_docs, "doc_id").collect() == []
