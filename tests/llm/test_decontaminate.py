import re

from newsvane.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[i : i + 13]), set()).add(str(item))
    out = set()
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (got := windows.get(tuple(w[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    found |= got
        out.add((doc_id, len(w), len(hit), tuple(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def run(docs, benchmark):
    got = decontaminate.report(docs, benchmark).collect()
    assert all(r.n_hit == sum(s["last"] - s["first"] + 1 for s in r.spans) for r in got)
    return {(r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids), r.contaminated) for r in got}


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, key string, words string")


LONG = " ".join(f"w{i}" for i in range(40))


def test_hits_of_all_lengths(spark, make_docs):
    benchmark = [(1, LONG), (10, LONG[:60]), (2, "Short ITEM here"), (3, "one"), (4, None), (5, ""), (6, "..."), (9, "ÉTÉ été x")]
    docs = [
        (1, "before " + LONG.upper() + " behind"), (2, "a short item, here. " + "b " * 100), (3, "one"), (4, "short item"),
        (5, " ".join(f"w{i}" for i in range(5, 18)) + " tail" * 400), (6, LONG + " gap " + LONG), (7, "Été été x"), (8, "ÉTÉ été X"),
        (9, " ".join(f"w{i}" for i in range(12))), (10, "w3-w4;w5 " * 5),
    ]
    df = items(spark, [(i, t, "k", "w") for i, t in benchmark])
    assert run(make_docs(docs), df) == brute(docs, benchmark)


def test_a_share_of_one_in_twenty_counts(spark, make_docs):
    benchmark = items(spark, [(1, "alpha beta", "", "")])
    docs = [(1, "alpha beta" + " x" * 38), (2, "alpha beta" + " x" * 39)]
    assert {(r[0], r[4]) for r in run(make_docs(docs), benchmark)} == {(1, True), (2, False)}


def test_odd_documents(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    benchmark = [(1, "the same row twice"), (1, "the same row twice"), (2, "one id"), (None, "no id but")]
    df = items(spark, [(i, t, "", "") for i, t in benchmark])
    assert run(odd_docs, df) == brute(rows, [b for b in benchmark if b[0] is not None])
    assert decontaminate.report(no_docs, df).collect() == []
    empty = items(spark, [])
    assert not any(r[2] for r in run(odd_docs, empty))
    assert decontaminate.clean(odd_docs, empty).count() == odd_docs.count()
    left = decontaminate.clean(odd_docs, df)
    assert left.columns == odd_docs.columns
    assert 6 not in {r.doc_id for r in left.collect()} and left.where("doc_id IS NULL").count() == 2


def test_unbroadcast_windows_give_the_same(spark, make_docs, monkeypatch):
    from newsvane import session

    docs, benchmark = [(1, LONG), (2, "w1 w2"), (3, None)], [(1, LONG)]
    df = items(spark, [(i, t, "", "") for i, t in benchmark])
    monkeypatch.setattr(session, "BROADCAST_LIMIT_BYTES", 0)
    assert run(make_docs(docs), df) == brute(docs, benchmark)
