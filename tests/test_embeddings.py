import math
from collections import Counter

import numpy as np
import pytest

from newsvane.operators import embeddings

DOCS = [["x", "y", "x", "z", "y", "rare"], ["y", "y", "z"], [], None, ["x"], ["z", "x", "y", "x"]]


@pytest.fixture
def docs(rows):
    return rows([(i, t) for i, t in enumerate(DOCS)], "id bigint, tokens array<string>")


def counted(window=2, min_count=2):
    words = Counter(w for d in DOCS if d for w in d)
    pairs = Counter()
    for d in DOCS:
        for i, w in enumerate(d or ()):
            for k in range(1, window + 1):
                if i + k < len(d) and words[w] >= min_count and words[d[i + k]] >= min_count:
                    pairs[tuple(sorted((w, d[i + k])))] += window + 1 - k
    return pairs


def test_counts_of_near_words(docs):
    got = {(r.a, r.b): r.n for r in embeddings.cooccurrence(docs, "tokens", 2, 2).collect()}
    assert got == dict(counted())


def test_association_by_hand(docs):
    pairs = counted()
    sides = Counter()
    for (a, b), n in pairs.items():
        sides[a] += n
        sides[b] += n
    every = sum(sides.values())
    want = {}
    for (a, b), n in pairs.items():
        share = (2 if a == b else 1) * n * every / (sides[a] * sides[b])
        if share > 1:
            want[a, b] = math.log(share)
    got = {(r.a, r.b): r.ppmi for r in embeddings.ppmi(embeddings.cooccurrence(docs, "tokens", 2, 2)).collect()}
    assert got == pytest.approx(want, abs=1e-6) and want


def matrix(n, seed=4):
    rng = np.random.default_rng(seed)
    groups = rng.integers(0, 4, n)
    made = np.zeros((n, n))
    for i in range(n):
        for j in range(i, n):
            if rng.random() < 0.5:
                made[i, j] = made[j, i] = round(rng.random() + 3 * (groups[i] == groups[j]), 6)
    return made


def test_vectors_span_the_leading_eigenvectors_in_any_layout(spark, rows):
    m = matrix(40)
    data = [(f"w{i:02}", f"w{j:02}", float(m[i, j])) for i in range(40) for j in range(i, 40) if m[i, j] > 0]
    df = rows(data, "a string, b string, ppmi double")
    first = {r.term: r.vector for r in embeddings.word_vectors(df.repartition(2), 4, 12).collect()}
    again = {r.term: r.vector for r in embeddings.word_vectors(df.repartition(7, "b"), 4, 12).collect()}
    assert first == again and len(first) == 40
    got = np.array([first[f"w{i:02}"] for i in range(40)])
    values, vectors = np.linalg.eigh(m)
    order = np.argsort(-np.abs(values))[:4]
    # Columns are eigenvectors times the root of their eigenvalues.
    lengths = (got**2).sum(axis=0)
    assert lengths[:2] == pytest.approx(np.abs(values[order])[:2], rel=0.02)
    span = vectors[:, order[:2]]
    unit = got[:, :2] / np.sqrt(lengths[:2])
    assert np.linalg.norm(span.T @ unit, 2) == pytest.approx(1, abs=0.01)
    assert np.linalg.norm(unit - span @ (span.T @ unit)) < 0.1


def test_fewer_words_than_numbers(rows):
    df = rows([("a", "b", 1.5), ("b", "b", 0.5)], "a string, b string, ppmi double")
    got = {r.term: r.vector for r in embeddings.word_vectors(df, 5, 3).collect()}
    assert set(got) == {"a", "b"} and all(len(v) == 5 and v[2:] == [0.0] * 3 for v in got.values())
    assert all(np.isfinite(v).all() for v in got.values())


def test_pairs_are_combined_as_numbers_in_small_pieces(rows, monkeypatch):
    """Blocks, chunks and buckets cut anywhere give the same counts, and no pair of texts is shuffled."""
    rng = np.random.default_rng(3)
    lists = [[None if w == "w7" else w for w in (f"w{int(x)}" for x in rng.zipf(1.5, n) if x < 60)] for n in range(120)]
    df = rows([(i, t) for i, t in enumerate(lists)], "id bigint, tokens array<string>").repartition(3)
    words = Counter(w for d in lists for w in d if w)
    want = Counter()
    for d in lists:
        for i, w in enumerate(d):
            for k in range(1, 6):
                if i + k < len(d) and words.get(w, 0) >= 3 and words.get(d[i + k], 0) >= 3:
                    want[tuple(sorted((w, d[i + k])))] += 6 - k
    monkeypatch.setattr(embeddings.pair_counts, "BLOCK_TOKENS", 40)
    monkeypatch.setattr(embeddings.pair_counts, "PAIRS_AT_ONCE", 100)
    made = embeddings.cooccurrence(df, "tokens")
    assert {(r.a, r.b): r.n for r in made.collect()} == dict(want)
    assert "hashpartitioning(bucket" in made._jdf.queryExecution().executedPlan().toString()
    scored = {(r.a, r.b): (r.n, r.ppmi) for r in embeddings.corpus_ppmi(df, "tokens").collect()}
    assert scored and scored == {(r.a, r.b): (r.n, r.ppmi) for r in embeddings.ppmi(made).collect()}


@pytest.mark.parametrize("lists", [[], [[]], [None], [["a"]], [["a", "b"]]])
def test_no_pair_of_known_words(rows, lists):
    df = rows([(t,) for t in lists], "tokens array<string>")
    assert embeddings.cooccurrence(df, "tokens").collect() == [] == embeddings.corpus_ppmi(df, "tokens").collect()


def test_packed_numbers_come_back():
    pack, unpack = embeddings.pair_counts.pack, embeddings.pair_counts.unpack
    for keys in ([], [0], [5, 5, 1 << 56], list(range(0, 1 << 40, 1 << 33))):
        values = np.array(keys, np.int64) * 3 - 7
        got = unpack(*pack(np.array(keys, np.uint64), values))
        assert got[0].tolist() == keys and got[1].tolist() == values.tolist()


def test_vectors_do_not_depend_on_the_grid(rows, monkeypatch):
    """Many groups, many pieces of the block and few pairs at once: the same vectors, and no row per entry is joined."""
    m = matrix(40)
    data = [(f"w{i:02}", f"w{j:02}", float(m[i, j])) for i in range(40) for j in range(i, 40) if m[i, j] > 0]
    df = rows(data, "a string, b string, ppmi double").repartition(3)
    whole = {r.term: r.vector for r in embeddings.word_vectors(df, 4, 2).collect()}
    blocks = embeddings.vector_blocks
    for name, value in (("GROUP_WORDS", 3), ("ROW_WORDS", 1 << 20), ("PAIRS_AT_ONCE", 50), ("ENTRIES_AT_ONCE", 5)):
        monkeypatch.setattr(blocks, name, value)
    monkeypatch.setattr(embeddings, "BROADCAST_LIMIT_BYTES", 4 * 4 * 3 * 5)
    monkeypatch.setattr(blocks.Grid, "of", staticmethod(lambda words, tasks: blocks.Grid(14, 3, 4)))
    cut = {r.term: r.vector for r in embeddings.word_vectors(df, 4, 2).collect()}
    assert cut == whole and len(cut) == 40


def test_nothing_that_grows_with_the_corpus_is_broadcast(rows, monkeypatch):
    """The block of a round never, words and their counts only below the limit; the same vectors either way."""
    rng = np.random.default_rng(6)
    lists = [[f"w{int(x)}" for x in rng.zipf(1.4, 40) if x < 50] for _ in range(60)]
    df = rows([(t,) for t in lists], "tokens array<string>").repartition(3)
    sent = []

    def watched(frame, broadcast=embeddings.F.broadcast):
        sent.append(set(frame.columns))
        return broadcast(frame)

    monkeypatch.setattr(embeddings.F, "broadcast", watched)
    whole = {r.term: r.vector for r in embeddings.fit(df, "tokens", 4, rounds=2).collect()}
    assert sent and not any("x" in columns for columns in sent)
    sent.clear()
    monkeypatch.setattr(embeddings, "BROADCAST_LIMIT_BYTES", 0)
    assert {r.term: r.vector for r in embeddings.fit(df, "tokens", 4, rounds=2).collect()} == whole and whole
    assert not any(columns & {"x", "term", "id", "n", "ns"} for columns in sent)


def test_a_round_moves_the_block_once_to_the_rows(spark, rows):
    """The cells are read where they lie, and a task has all cells of its rows."""
    m = matrix(40)
    entries = rows([(i, j, float(m[i, j])) for i in range(40) for j in range(i, 40) if m[i, j] > 0], "first int, second int, ppmi double")
    blocks = embeddings.vector_blocks
    grid, numbers = blocks.Grid(6, 7, 2), blocks.cell_numbers(3, 6)
    pieces = entries.selectExpr("first", "second", "CAST(rint(ppmi * 64) AS bigint) AS w").mapInArrow(
        blocks.cut_into_cells(grid, numbers), blocks.PIECE_SCHEMA
    )
    cells = embeddings.Cells(pieces, grid, numbers)
    x = np.random.default_rng(1).integers(-(1 << 22), 1 << 22, (42, 3)).astype("<i4")
    x[40:] = 0
    parts = [(c, blocks.squeezed(np.ascontiguousarray(x[c::6])), numbers[:, c].tolist()) for c in range(6)]
    product = cells.times(rows(parts, blocks.BLOCK_SCHEMA), 3)
    plan = product._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("hashpartitioning(cell") == 1
    got = np.zeros((42, 3), np.int64)
    for r in product.collect():
        got[r.p :: 6] = blocks.loosened(r.y, "<i8").reshape(-1, 3)
    want = np.zeros((42, 42), np.int64)
    want[:40, :40] = np.rint(m * 64).astype(np.int64)
    assert (got == want @ x.astype(np.int64)).all()
    cells.discard()


def test_numbers_of_cells_are_dealt_by_rows(spark):
    blocks = embeddings.vector_blocks
    ids = [0, 1, 41, 1 << 33, (1 << 62) + 5]
    made = spark.createDataFrame([(i,) for i in ids], "id bigint").selectExpr("hash(id) AS h").collect()
    assert [r.h for r in made] == blocks.spark_hash(np.array(ids)).tolist()
    numbers = blocks.cell_numbers(5, 9)
    assert (np.diff(numbers.ravel()) > 0).all() and (blocks.spark_hash(numbers) % 5 == np.arange(5)[:, None]).all()


@pytest.mark.parametrize("large", [1 << 20, 1 << 31])
def test_products_of_cells_are_exact(large):
    """Rows longer than a piece, rows of every length, and numbers beyond what doubles hold whole."""
    blocks = embeddings.vector_blocks
    rng = np.random.default_rng(9)
    lengths = [1, 2, 5, 9, 9, 100, 1792, 1793, 4000, 3]
    rows = np.repeat(np.arange(0, 20, 2), lengths)
    columns = np.concatenate([rng.permutation(4096)[:n] for n in lengths])
    weights = rng.integers(-(large - 1), large, len(rows))
    block = rng.integers(-(1 << 22), 1 << 22, (4096, 5)).astype("<i4")
    cell = blocks._cell([7, 0, 0], rows, columns, weights)
    held = [np.frombuffer(cell[c][0].as_py(), t) for c, t in (("rows", "<i4"), ("shapes", "<i4"), ("columns", "<u2"), ("weights", "<i4"))]
    sums = np.zeros((20, 5), np.int64)
    blocks.add_product(sums, *held, block)
    want = np.zeros((20, 5), np.int64)
    np.add.at(want, rows, block[columns] * weights[:, None])
    assert (sums == want).all()
    for x in (sums, block, np.array([-(1 << 63), (1 << 63) - 1, 0, -1])):
        assert (blocks.loosened(blocks.squeezed(x), x.dtype.str).reshape(x.shape) == x).all()
