"""Inference inside one task: the mixtures of a block's documents under given topics.

Only numpy, pandas and Arrow are used, and the functions are pickled by value, so executors need no copy
of this package.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MICROS = 1_000_000
# The bound is summed in thousandths, so that it stays far below 64 bits on any corpus, and stands
# beside the statistics under a number that no term has.
MILLIS, BOUND = 1000, -1
_INNER_STEPS, _INNER_TOLERANCE = 30, 1e-3
# So many documents of a block stop together; so many steps are gone before it is seen which have.
_DOCUMENTS_AT_ONCE, _STEPS_AT_ONCE = 32, 10
# Blocks of about so many words are inferred together, in batches of so many cells: a batch's weights
# fit into the cache. Filling takes about the part of a batch that ``_WASTE`` and ``_SPARE`` allow.
_WORDS_AT_ONCE, _CELLS_AT_ONCE, _WASTE, _SPARE = 500_000, 12_000, 1.15, 8


def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents, sorted by slice and block, as blocks of vocabulary indices; words outside the vocabulary
    are left out.

    A row that leads its slice's documents brings the vocabulary. A block may go on in the next batch.
    """
    names = ["ticker", "slice", "block", "k"]
    lead, known, places = None, None, None
    block, parts = None, []
    for batch in batches:
        column = dict(zip(batch.schema.names, batch.columns))
        leads, of = column["lead"].to_pylist(), list(zip(*(column[n].to_pylist() for n in names)))
        cuts = [i for i in range(batch.num_rows) if not i or leads[i] or leads[i - 1] or of[i] != of[i - 1]]
        for i, end in zip(cuts, [*cuts[1:], batch.num_rows]):
            if leads[i]:
                lead, known, places = of[i][:2], column["known"][i].values, column["known_places"][i].values.to_numpy()
                continue
            if of[i] != block and parts:
                yield _block_of(block, parts)
                parts = []
            block = of[i]
            tokens = column["tokens"].slice(i, end - i)
            lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy().astype(np.int64)
            documents, words = np.repeat(np.arange(len(lengths)), lengths), tokens.flatten()
            found = pc.index_in(words, value_set=known) if lead == block[:2] else pa.nulls(len(words), pa.int32())
            kept = found.is_valid().to_numpy(zero_copy_only=False)
            documents = documents[kept]
            codes = places[found.drop_null().to_numpy()] if len(documents) else np.zeros(0, dtype=np.int32)
            # Sorted once here, not in every round.
            codes = codes[np.lexsort((codes, documents))].astype(np.int32)
            counted = np.bincount(documents, minlength=len(lengths)).astype(np.int32)
            parts.append((column["id"].slice(i, end - i), counted, codes))
    if parts:
        yield _block_of(block, parts)


def _block_of(block: tuple, parts: list[tuple]) -> pa.RecordBatch:
    """One row from a block's documents: (ticker, slice, block, k, ids, lengths, terms)."""
    ids, lengths, terms = (list(x) for x in zip(*parts))
    lists = [pa.concat_arrays(ids), pa.array(np.concatenate(lengths)), pa.array(np.concatenate(terms))]
    lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int32()]
    made = [*(pa.array([v], t) for v, t in zip(block, types)), *lists]
    return pa.RecordBatch.from_arrays(made, names=["ticker", "slice", "block", "k", "ids", "lengths", "terms"])


def _digamma(x: np.ndarray) -> np.ndarray:
    """Move the argument up by six, where the asymptotic series is exact to double precision."""
    below = sum(1.0 / (x + i) for i in range(6))
    x = x + 6.0
    inverse = 1.0 / (x * x)
    series = inverse * (1 / 12 - inverse * (1 / 120 - inverse * (1 / 252 - inverse / 240)))
    return np.log(x) - 0.5 / x - series - below


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """As the digamma function: moved up by six, then the series."""
    below = np.log(x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5))
    x = x + 6.0
    inverse = 1.0 / (x * x)
    series = (1 / 12 - inverse * (1 / 360 - inverse * (1 / 1260 - inverse / 1680))) / x
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + series - below


def _expected_logs(dirichlet: np.ndarray) -> np.ndarray:
    return _digamma(dirichlet) - _digamma(dirichlet.sum(axis=1, keepdims=True))


def _exp_digamma(x: np.ndarray) -> np.ndarray:
    """exp of `_digamma` without a logarithm, and with the six fractions as one."""
    y = x * (x + 5.0)
    below = (x + x + 5.0) * ((3.0 * y + 20.0) * y + 24.0) / (y * (y + 4.0) * (y + 6.0))
    x = x + 6.0
    part = 1.0 / x
    inverse = part * part
    series = inverse * (1 / 12 - inverse * (1 / 120 - inverse * (1 / 252 - inverse / 240)))
    return x * np.exp(-0.5 * part - series - below)


def _expected(dirichlet: np.ndarray) -> np.ndarray:
    return _exp_digamma(dirichlet) / _exp_digamma(dirichlet.sum(axis=1, keepdims=True))


def _prior_gain(dirichlet: np.ndarray, prior: float) -> float:
    """What rows of Dirichlet weights add to the variational bound, under a symmetric prior."""
    rows, width = dirichlet.shape
    cells = (prior - dirichlet) * _expected_logs(dirichlet) + _log_gamma(dirichlet)
    one = np.array([prior, prior * width])
    of_prior = np.diff(_log_gamma(one))[0] - (width - 1) * _log_gamma(one[:1])[0]
    return float(cells.sum() - _log_gamma(dirichlet.sum(axis=1)).sum() + rows * of_prior)


def _pairs(lengths: np.ndarray, terms: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every (document, term) pair once: how many each document has, their terms, how often they occur.

    The stored terms of a document are sorted already.
    """
    keys = np.repeat(np.arange(len(lengths)) * width, lengths) + terms
    if (keys[1:] < keys[:-1]).any():
        keys.sort()
    firsts = np.flatnonzero(np.diff(keys, prepend=-1))
    documents, w = np.divmod(keys[firsts], width)
    return np.bincount(documents, minlength=len(lengths)), w, np.diff(firsts, append=len(keys))


def _batches(per: np.ndarray, w: np.ndarray, counts: np.ndarray, beta: np.ndarray) -> list[tuple]:
    """Documents with about as many pairs side by side: (documents, weights of their pairs' terms as
    (document, topic, pair), counts, places of the pairs, which of these are pairs and no filling).

    A batch stays in the processor's cache through all its steps. Filling counts nothing.
    """
    order = np.argsort(per, kind="stable")
    sizes, starts = per[order], (np.cumsum(per) - per)[order]
    filled = np.ascontiguousarray(np.vstack([beta, np.zeros((1, beta.shape[1]))]).T)
    made, end, least = [], len(order), int(np.searchsorted(sizes, 1))
    while end > least:
        wide = int(sizes[end - 1])
        near = int(np.searchsorted(sizes, (wide - _SPARE) / _WASTE))
        first = min(end - 1, max(least, near, end - max(1, _CELLS_AT_ONCE // wide)))
        inside = np.arange(wide) < sizes[first:end, None]
        at = np.where(inside, starts[first:end, None] + np.arange(wide), 0)
        cells = np.take(filled, np.where(inside, w[at], len(beta)), axis=1).transpose(1, 0, 2)
        made.append((order[first:end], cells, np.where(inside, counts[at], 0.0)[:, None, :], at, inside))
        end = first
    return made


def _follow(path: np.ndarray, batch: tuple, alpha: float) -> None:
    """The steps of a batch's documents, from ``path[0]``, into ``path``."""
    documents, cells, counts, *_ = batch
    gamma, ratio, turned = path[0, documents], np.empty_like(counts), cells.transpose(0, 2, 1)
    for step in range(1, len(path)):
        # A document's scale cancels, so its weights need not add up to anything.
        theta = _exp_digamma(gamma)
        np.matmul(theta[:, None, :], cells, out=ratio)
        np.divide(counts, np.maximum(ratio, 1e-100, out=ratio), out=ratio)
        gamma = alpha + theta * np.matmul(ratio, turned)[:, 0]
        path[step, documents] = gamma


def _settle(lengths: np.ndarray, groups: np.ndarray, batches: list[tuple], k: int) -> np.ndarray:
    """Document weights. A group of documents stops where its mean change falls below the tolerance."""
    alpha = 1.0 / k
    gamma = np.full((len(lengths), k), alpha) + lengths[:, None] / k
    firsts = np.flatnonzero(np.diff(groups, prepend=-1))
    cells, running = np.bincount(groups) * k, np.ones(len(firsts), dtype=bool)
    for done in range(0, _INNER_STEPS, _STEPS_AT_ONCE):
        path = np.repeat(gamma[None], min(_STEPS_AT_ONCE, _INNER_STEPS - done) + 1, axis=0)
        for batch in batches:
            _follow(path, batch, alpha)
        change = np.add.reduceat(np.abs(np.diff(path, axis=0)).sum(axis=2), firsts, axis=1) / cells
        small = change < _INNER_TOLERANCE
        stops = np.where(small.any(axis=0), small.argmax(axis=0) + 1, len(path) - 1)
        moved = np.flatnonzero(running[groups])
        gamma[moved] = path[stops[groups[moved]], moved]
        running &= ~small.any(axis=0)
        batches = [b for b in batches if running[groups[b[0]]].any()]
        if not batches:
            break
    return gamma


def _infer_blocks(blocks: list[tuple[np.ndarray, np.ndarray]], beta: np.ndarray) -> list[tuple]:
    """For every block (lengths, terms) what `_infer` finds; documents of all of them share batches."""
    width, k = beta.shape
    paired = [_pairs(lengths, terms, width) for lengths, terms in blocks]
    per, w, counts = (np.concatenate([p[i] for p in paired]) for i in range(3))
    lengths = np.concatenate([b[0] for b in blocks])
    if not len(lengths):
        return [(np.zeros((0, k)), np.zeros(0, dtype=np.int64), np.zeros((0, k)), 0.0) for _ in blocks]
    # Groups are runs of documents of one block.
    in_block = np.concatenate([np.arange(len(b[0])) for b in blocks])
    groups = np.cumsum(in_block % _DOCUMENTS_AT_ONCE == 0) - 1
    batches = _batches(per, w, counts, beta)
    gamma = _settle(lengths, groups, batches, k)
    theta, whole = _expected(gamma), np.empty(len(w))
    for documents, cells, _, at, inside in batches:
        sums = np.matmul(theta[documents, None, :], cells)[:, 0]
        whole[at[inside]] = np.maximum(sums[inside], 1e-100)
    logs, ratio, found, d, e = np.log(whole), counts / whole, [], 0, 0
    for (own, _), (pairs_of, terms, n) in zip(blocks, paired):
        mine, pairs = slice(d, d + len(own)), slice(e, e + len(terms))
        seen = np.flatnonzero(np.bincount(terms, minlength=width))
        sums = np.empty((len(seen), k))
        for j in range(k):
            weights = np.repeat(theta[mine, j], pairs_of) * ratio[pairs]
            sums[:, j] = np.bincount(terms, weights=weights, minlength=width)[seen]
        bound = float(n @ logs[pairs]) + _prior_gain(gamma[mine], 1.0 / k)
        found.append((gamma[mine], seen, sums * beta[seen], bound))
        d, e = mine.stop, pairs.stop
    return found


def _infer(lengths: np.ndarray, terms: np.ndarray, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Document weights of a block, its term statistics (terms, sums per topic) and its part of the bound."""
    return _infer_blocks([(lengths, terms)], beta)[0]


def _inferred(blocks: pa.Table, lead: pa.Table, max_topics: int):
    """Every block of a slice as (its row, what `_infer` finds), and the topics' weights, (topic, term).

    ``lead`` is the one row with the ticker's topics. Blocks are taken in their order, a few at a time.
    """
    weights = np.empty((len(lead["places"][0].values), max_topics))
    weights[lead["places"][0].values.to_numpy()] = lead["weights"][0].values.to_numpy().reshape(weights.shape)
    weights = weights[:, : blocks["k"][0].as_py()].T
    beta = np.ascontiguousarray(_expected(weights).T)

    def found():
        rows, taken, words = [], [], 0
        order = np.argsort(blocks["block"].to_numpy())
        for i in order:
            rows.append(int(i))
            taken.append(tuple(blocks[c][int(i)].values.to_numpy().astype(np.int64) for c in ("lengths", "terms")))
            words += len(taken[-1][1])
            if words >= _WORDS_AT_ONCE or i == order[-1]:
                yield from zip(rows, _infer_blocks(taken, beta))
                rows, taken, words = [], [], 0

    return found(), weights


def statistics_of(max_topics: int):
    """Term statistics and the bound, added up over the blocks of a slice. Blocks are rounded to whole
    numbers first, so the sums are the same in every order."""
    names = [f"s{j}" for j in range(max_topics)]
    schema = pa.schema([("ticker", pa.string()), ("term_index", pa.int32()), *[(n, pa.int64()) for n in names]])

    def statistics(blocks: pa.Table, lead: pa.Table) -> pa.Table:
        if not blocks.num_rows or not lead.num_rows:
            return schema.empty_table()
        found, weights = _inferred(blocks, lead, max_topics)
        k, width = weights.shape
        sums = np.zeros((width, k), dtype=np.int64)
        # The topics' own part is counted once, by the ticker's first slice.
        bound = round(_prior_gain(weights, 1.0 / k) * MILLIS) if lead["slice"][0].as_py() == 0 else 0
        for _, (_, terms, sums_of_block, gained) in found:
            sums[terms] += np.floor(sums_of_block * MICROS + 0.5).astype(np.int64)
            bound += round(gained * MILLIS)
        terms = np.flatnonzero(sums.any(axis=1))
        table = np.zeros((len(terms) + 1, max_topics), dtype=np.int64)
        table[:-1, :k], table[-1, 0] = sums[terms], bound
        ticker = pa.array([lead["ticker"][0].as_py()] * len(table), pa.string())
        return pa.table([ticker, pa.array([*terms, BOUND], pa.int32()), *table.T.copy()], schema=schema)

    return statistics


def assign_with(max_topics: int):
    schema = pa.schema([("ticker", pa.string()), ("id", pa.string()), ("distribution", pa.list_(pa.float64()))])

    def assign(blocks: pa.Table, lead: pa.Table) -> pa.Table:
        if not blocks.num_rows or not lead.num_rows:
            return schema.empty_table()
        found, weights = _inferred(blocks, lead, max_topics)
        parts = [schema.empty_table()]
        for row, (gamma, *_) in found:
            ids = blocks["ids"][row].values
            share = gamma / gamma.sum(axis=1, keepdims=True)
            ticker = pa.array([lead["ticker"][0].as_py()] * len(ids), pa.string())
            ends = pa.array(np.arange(0, share.size + 1, len(weights)), pa.int32())
            parts.append(pa.table([ticker, ids, pa.ListArray.from_arrays(ends, share.ravel())], schema=schema))
        return pa.concat_tables(parts).combine_chunks()

    return assign


def lay_out(distances: pd.DataFrame) -> pd.DataFrame:
    """Classical scaling of one ticker's topics: a square as wide as it has topics."""
    topics = sorted({*distances["topic_a"], *distances["topic_b"]})
    place = {t: i for i, t in enumerate(topics)}
    squares = np.zeros((len(topics), len(topics)))
    for a, b, d in zip(distances["topic_a"], distances["topic_b"], distances["js_divergence"]):
        squares[place[a], place[b]] = squares[place[b], place[a]] = d * d
    centred = -0.5 * (squares - squares.mean(axis=0) - squares.mean(axis=1)[:, None] + squares.mean())
    values, directions = np.linalg.eigh(centred)
    out = pd.DataFrame({"ticker": distances["ticker"].iloc[0], "topic": topics, "x": 0.0, "y": 0.0})
    for axis, j in zip("xy", range(len(topics) - 1, -1, -1)):
        at = directions[:, j] * np.sqrt(max(values[j], 0.0))
        far = np.flatnonzero(np.abs(at) >= 5e-7)
        # A direction has no sign of its own: the first topic off the middle lies on the positive side.
        out[axis] = at if len(far) and at[far[0]] > 0 else -at
    return out
