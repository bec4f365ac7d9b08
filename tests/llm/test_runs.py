import hashlib
import random

import pytest

from newsvane.llm import runs


def brute(words):
    found = []
    for period in range(1, len(words) // 4 + 1):
        equal = [words[k] == words[k + period] for k in range(len(words) - period)] + [False]
        start = None
        for k, same in enumerate(equal):
            if same and start is None:
                start = k
            if not same and start is not None:
                length = k - start + period
                part = words[start : start + length]
                smallest = not any(part[d:] == part[:-d] for d in range(1, period))
                if length >= max(6, 4 * period) and smallest:
                    found.append((start, length, period))
                start = None
    return sorted(found, key=lambda r: (r[0], r[2]))


def texts(seed, count):
    rng = random.Random(seed)
    for _ in range(count):
        n, letters = rng.randint(0, 70), rng.choice([1, 2, 2, 3, 6])
        words = [str(rng.randint(0, letters)) for _ in range(n)]
        if n > 5 and rng.random() < 0.6:
            at = rng.randrange(n)
            period = 1 + rng.randrange((n - at) // 3 + 1)
            words = words[:at] + [words[at + (i - at) % period] for i in range(at, n)]
            if rng.random() < 0.4:
                words = words[: rng.randrange(n)] + words[at:] + words
        yield words


def test_automaton_and_filter_equal_brute_force():
    every = list(texts(1, 1500))
    found = runs.runs_of([" \t".join(w).encode() for w in every])
    total = 0
    for words, (split, got) in zip(every, found):
        assert [w.decode() for w in split] == words
        assert got == brute(words) == sorted(runs.repetitions(words), key=lambda r: (r[0], r[2]))
        total += len(got)
    assert total > 800


def test_long_periodic_words_take_few_steps():
    rng = random.Random(3)
    block = [rng.randint(0, 10**6) for _ in range(3000)]
    assert runs.repetitions(block * 5) == [(0, 15000, 3000)]
    assert runs.repetitions([1] * 20000) == [(0, 20000, 1)]


def expected(words):
    found = brute(words)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    dropped = {k for s, n, p in found for k in range(s + p, s + n)}
    left = " ".join(w for k, w in enumerate(words) if k not in dropped)
    top = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else (None, None, None)
    milli = 1000 * top[1] // top[2] if found else None
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(found), *top, milli, digest(listed), digest(left)), found, left


def test_rows(spark, make_docs):
    every = list(texts(7, 200))
    docs = make_docs([(i, " ".join(w)) for i, w in enumerate(every)])
    got = {r.doc_id: r for r in runs.find_runs(docs, with_text=True).collect()}
    for i, words in enumerate(every):
        values, found, left = expected(words)
        assert tuple(got[i])[1:8] == values
        assert [tuple(r) for r in got[i].runs] == found and got[i].collapsed == left


def test_ties_go_to_the_first_run_then_the_smallest_period():
    assert runs.best_run([(9, 8, 1), (3, 16, 2), (3, 8, 1), (0, 10, 2)]) == (3, 8, 1)
    assert runs.best_run([]) is None


def test_odd_rows(spark, odd_docs, no_docs):
    got = runs.find_runs(odd_docs)
    assert got.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    ]
    rows = got.collect()
    assert len(rows) == odd_docs.count()
    nothing = hashlib.sha256(b"").hexdigest()
    for r in rows:
        if r.doc_id in (1, 2, 3):
            assert tuple(r)[1:] == (0, None, None, None, None, nothing, nothing)
    # 30 000 lines of three words, the first from 977: one run of period 3 x 977.
    long = next(r for r in rows if r.doc_id == 5)
    assert (long.n_runs, long.start, long.length, long.period) == (1, 0, 90_000, 2931)
    assert runs.find_runs(no_docs).collect() == []


def test_words_are_split_at_ascii_blanks_only(spark, make_docs):
    spaces = "a b c\x1cd"
    got = runs.find_runs(make_docs([(1, "\v\f\r\n\t ".join([spaces] * 6)), (2, spaces * 9)])).collect()
    assert [(r.n_runs, r.length) for r in got] == [(1, 6), (0, None)]


@pytest.mark.parametrize("size", [1, 2, 3, 511, 513])
def test_neighbouring_texts_do_not_meet(size):
    found = runs.runs_of([b"same same same"] * size + [b"same " * 6])
    assert [r for _, r in found] == [[]] * size + [[(0, 6, 1)]]
