import random
import re

import numpy as np
import pytest

from newsvane.llm import components, near_dup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(docs, size, percent):
    sets = [shingles(t, size) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            linked = sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both)
            if None not in (docs[a][0], docs[b][0]) and (linked or (docs[a][0] == docs[b][0] and sets[a] and sets[b])):
                root[find(a)] = find(b)
    out = []
    for k, (doc_id, _) in enumerate(docs):
        smallest = min((d for j, (d, _) in enumerate(docs) if find(j) == find(k) and d is not None), default=None)
        out.append((doc_id, len(sets[k]), doc_id if doc_id is None else smallest, doc_id is None or doc_id == smallest))
    return sorted(out, key=str)


def run(df, size, percent):
    return sorted((tuple(r) for r in near_dup.near_duplicates(df, shingle=size, percent=percent).collect()), key=str)


def variants(rng, bases, copies):
    docs = []
    for _ in range(bases):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([2, 6, 8, 9, 14, 40, 150, 700]))]
        for _ in range(rng.randint(1, copies)):
            words = list(base)
            for _ in range(int(rng.random() ** 2 * len(words) / 12 + 0.5)):
                at = rng.randrange(len(words))
                words[at : at + 1] = rng.choice([[], ["NEW"], [f"n{rng.randrange(99)}"], [words[at], "more"]])
            docs.append(" ".join(words))
    rng.shuffle(docs)
    return [(3 * i + 1, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("size, percent, seed", [(3, 85, 1), (5, 80, 2), (1, 50, 3)])
def test_links_as_by_comparing_all_pairs(make_docs, size, percent, seed):
    docs = variants(random.Random(seed), 40, 9)
    assert run(make_docs(docs), size, percent) == brute(docs, size, percent)


def test_a_large_group_in_small_blocks(make_docs, monkeypatch):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(90)]
    docs = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(90)] = f"x{rng.randrange(4)}"
        docs.append((i, " ".join(words)))
    monkeypatch.setattr(near_dup, "BLOCK_ROWS", 16)
    assert run(make_docs(docs), 3, 85) == brute(docs, 3, 85)


def test_odd_documents(odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert run(odd_docs, 3, 85) == brute(docs, 3, 85)
    assert run(no_docs, 3, 85) == []


def test_estimate_is_close():
    rng = np.random.default_rng(1)
    for n in (7, 30, 400, 5000):
        one = rng.integers(0, 2**63, n, dtype=np.uint64)
        other = one.copy()
        other[: n // 8] = rng.integers(0, 2**63, n // 8, dtype=np.uint64)
        level = near_dup.level_of(n)
        true = len(set(one) & set(other)) / len(set(one) | set(other))
        got = near_dup.estimate(near_dup.sketch(one, level), near_dup.sketch(other, level)[None])[0]
        assert abs(got - true) < 0.13


def test_registers_by_hand():
    """Leading zeros and ten bits of the least hash in a bucket, one entry at a time."""
    for value in np.random.default_rng(2).integers(0, 2**63, 200, dtype=np.uint64):
        registers = near_dup.sketch(np.array([value]), 0)
        salt = near_dup._mixed(np.arange(1, 2, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        entry = int(near_dup._mixed(np.array([value]) + salt)[0])
        bits = f"{(entry << 8 | 128) & (2**64 - 1):064b}"
        zeros = bits.index("1")
        assert registers[entry >> 56] == zeros << 10 | int((bits[zeros + 1 :] + "0" * 10)[:10], 2)
        assert (registers == near_dup.EMPTY).sum() == 255


def test_band_lengths_keep_links():
    for percent in (50, 70, 80, 85, 95):
        r = near_dup.band_length(percent)
        assert (1 - (percent / 100) ** r) ** (256 // r) <= 3.3e-6 or r == 1


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in links:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    got = components.components(spark.createDataFrame(links, "u long, v long")).collect()
    assert {r.id: r.component for r in got} == {x: find(x) for x in list(root)}
    assert components.components(spark.createDataFrame([], "u long, v long")).collect() == []
