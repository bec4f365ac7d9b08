import pytest

from newsvane.llm import fixity

SCHEMA = "page_id long, url string, html string, node string, hash string, records string, bytes string, above string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "", "", "", "", "") for r in rows], SCHEMA)


def record(page_id, url, html):
    url, html = url or "", html or ""
    return (
        f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{page_id}>\r\nWARC-Target-URI: {url}"
        f"\r\nContent-Length: {len(html.encode())}\r\n\r\n{html}\r\n\r\n"
    ).encode()


def brute(one, other):
    def by_id(rows):
        out = {}
        for r in rows:
            if r[0] is not None:
                out.setdefault(r[0], []).append(record(*r))
        return {k: sorted(v) for k, v in out.items()}

    a, b = by_id(one), by_id(other)
    out, place = [], 0
    for page_id in sorted(a.keys() | b.keys()):
        size = sum(map(len, a.get(page_id, [])))
        if a.get(page_id) != b.get(page_id):
            status = "extra" if page_id not in a else "missing" if page_id not in b else "changed"
            out.append((page_id, status, place, place + size, sum(map(len, b[page_id])) if page_id in b else None))
        place += size
    return out


def run(spark, one, other):
    return sorted(tuple(r) for r in fixity.audit(pages(spark, one), pages(spark, other)).collect())


ONE = [(i, f"http://x/{i}", "é" * (i % 50)) for i in range(0, 6000, 7)] + [(-5, "u", "h"), (-70, None, None), (None, "u", "h"), (14, "again", "b")]


@pytest.mark.parametrize(
    "change",
    [
        lambda rows: rows,
        lambda rows: rows[::-1],
        lambda rows: [r for r in rows if r[0] != 700],
        lambda rows: [(*r[:2], "!") if r[0] in (0, 4200, -5) else r for r in rows],
        lambda rows: rows + [(90_000, "u", ""), (3, None, "x"), (21, "twice", None)],
        lambda rows: [],
    ],
)
def test_finds_what_differs(spark, change):
    assert run(spark, ONE, change(ONE)) == brute(ONE, change(ONE))


def test_empty_replicas(spark):
    assert run(spark, [], []) == []
    assert run(spark, [], [(1, "u", "h")]) == brute([], [(1, "u", "h")])


def test_roots_are_equal_only_for_equal_replicas(spark):
    def root(rows):
        return fixity.build_tree(pages(spark, rows), 4, "t")[-1].collect()

    assert root(ONE) == root(ONE[::-1]) and len(root(ONE)) == 1
    assert root(ONE) != root([(*r[:2], "x") if r[0] == 7 else r for r in ONE])
