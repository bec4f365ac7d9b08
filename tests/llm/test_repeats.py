import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from newsvane.llm import repeats

L = repeats.LENGTH


def brute(texts):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + L] for d in data for i in range(len(d) - L + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - L + 1):
            if count[d[i : i + L]] > 1:
                gone[i : i + L] = [True] * L
        kept = bytes(b for b, g in zip(d, gone) if not g)
        runs = sum(g and not p for g, p in zip(gone, [False, *gone]))
        out.append((len(d), len(d) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return out


def run(make_docs, texts, **options):
    df = make_docs([(i, t) for i, t in enumerate(texts)])
    got = {r.doc_id: r for r in repeats.remove_repeats(df, with_text=True, **options).collect()}
    for r in got.values():
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256
        assert sum(s["stop"] - s["start"] for s in r.spans) == r.n_removed
    return [tuple(got[i])[1:5] for i in range(len(texts))]


def noise(rng, n, letters="abcdefghij é "):
    return "".join(rng.choice(letters) for _ in range(n))


def planted(rng):
    passages = [noise(rng, n) for n in (L - 60, L - 20, L, L + 1, 700, 1500)]
    texts = []
    for k in range(60):
        p = rng.choice(passages)
        start = rng.randint(0, 40)
        cut = p[start : len(p) - rng.randint(0, 40)]
        if rng.random() < 0.5:
            at = rng.randrange(max(1, len(cut)))
            cut = cut[:at] + "#" + cut[at + 1 :]
        texts.append(noise(rng, rng.randint(0, 900)) + cut + noise(rng, rng.randint(0, 900)))
    return texts + texts[:3] + [noise(rng, 300) * 4, "ab" * 700, "x" * 1200, "x" * 405, None, "", "short", "short"]


@pytest.mark.parametrize("seed", [1, 2])
def test_planted_passages(make_docs, seed):
    texts = planted(random.Random(seed))
    assert run(make_docs, texts) == brute(texts)


def test_keys_counted_by_hash_give_the_same(make_docs):
    texts = planted(random.Random(3))
    assert run(make_docs, texts, hot=2) == brute(texts)


def test_small_batches_give_the_same(make_docs, monkeypatch):
    texts = planted(random.Random(4))
    monkeypatch.setattr(repeats, "BATCH", 3)
    assert run(make_docs, texts) == brute(texts)


def test_exact_lengths(make_docs):
    rng = random.Random(5)
    p = "".join(rng.choice("abcdef") for _ in range(L))
    texts = ["1" + p + "2", "3" + p + "4", "5" + p[:-1] + "6", "7" + p[1:] + "8", p]
    assert run(make_docs, texts) == brute(texts)


def test_equal_stretches_of_a_text_are_one_row(spark, monkeypatch):
    """A line said 300 times is dealt once per text: no key grows with the repeats inside texts."""
    rng = random.Random(8)
    line = noise(rng, 600)
    texts = [noise(rng, 500) + line * 300 + noise(rng, 500), line * 40, noise(rng, 3000)]
    staged, kept = repeats.staged, {}
    monkeypatch.setattr(repeats, "staged", lambda df, name: kept.setdefault(name, staged(df, name)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r) for r in repeats.remove_repeats(df).collect())
    assert [r[1:] for r in got] == brute(texts)
    stretches = kept["repeat-stretches"]
    assert stretches.groupBy("key", "stretch", "d1", "d2").count().where("count > 1").count() == 0
    assert kept["repeat-live"].count() < 60


def colliding_texts(rng, n=430):
    """Two texts of ``n`` bytes with one XXH64 at Spark's seed: what the first eight bytes change in a
    lane of the hash, the eight bytes behind the next stripe undo."""
    p1, p2, mask = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, (1 << 64) - 1

    def lane(word):
        x = (42 + p1 + p2 + int.from_bytes(word, "little") * p2) & mask
        return ((x << 31 | x >> 33) & mask) * p1 & mask

    word = lambda: bytes(rng.randint(32, 126) for _ in range(8))
    one, two, between, rest = word(), word(), word() * 3, "".join(rng.choice("abcdef") for _ in range(n - 40)).encode()
    while True:
        other = word()
        undo = (int.from_bytes(two, "little") + (lane(one) - lane(other)) * pow(p2, -1, 1 << 64)) & mask
        if max(undo.to_bytes(8, "little")) < 128:
            return [(a + between + b + rest).decode() for a, b in ((one, two), (other, undo.to_bytes(8, "little")))]


def test_texts_of_one_hash_are_told_apart(make_docs):
    a, b = colliding_texts(random.Random(9))
    assert a != b and xxhash.xxh64_intdigest(a.encode(), 42) == xxhash.xxh64_intdigest(b.encode(), 42)
    texts = [a, a, b]
    assert run(make_docs, texts) == brute(texts)
    assert brute(texts)[2][1] == 0


def test_index_of_aligned_rows():
    """The match ends of random aligned rows, against comparing every pair."""
    rng = np.random.default_rng(6)
    n, width = 40, repeats.WIDTH
    base = rng.integers(97, 100, width, dtype=np.uint8)
    rows = np.tile(base, (n, 1))
    for r in range(n):
        for at in rng.integers(0, width, rng.integers(0, 4)):
            rows[r, at] = rng.integers(97, 100)
    held = np.column_stack([rng.integers(0, 60, n), width - rng.integers(0, 60, n)])
    group = np.sort(rng.integers(0, 4, n))
    got = repeats.match_ends(rows, held, group)
    for r in range(n):
        for end in range(L - 1, width):
            start = end - L + 1
            inside = held[:, 0] <= start
            inside &= held[:, 1] > end
            same = inside & (group == group[r]) & (rows[:, start : end + 1] == rows[r, start : end + 1]).all(1)
            same[r] = False
            assert got[r, end - L + 1] == (inside[r] and same.any())


def test_odd_documents(odd_docs, no_docs):
    texts = [r.text for r in odd_docs.collect()]
    got = sorted(tuple(r)[1:] for r in repeats.remove_repeats(odd_docs).collect())
    assert got == sorted(brute(texts))
    assert repeats.remove_repeats(no_docs).collect() == []
