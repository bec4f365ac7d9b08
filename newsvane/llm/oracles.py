"""SQL for the queries that SQL can express."""

from __future__ import annotations

from newsvane.llm import sharding

TOPK = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
    CAST(list_sum(list_transform(generate_series(1, len(a.v)), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


DECONTAMINATE = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + 12], ' ') AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM windows
), places AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, lengths WHERE len(w) >= n)
), hits AS (SELECT DISTINCT doc_id, i, n, item_id FROM places JOIN windows USING (n, win)
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY 1
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY 1
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""


NEAR_DUP = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM d
), e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s
), pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v, a.n AS nu, b.n AS nv, count(*) AS n
  FROM e a JOIN e b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (SELECT u, v FROM pairs WHERE 100 * n >= 85 * (nu + nv - n)
), reach(doc_id, root) USING KEY (doc_id) AS (
  SELECT doc_id, doc_id FROM d
  UNION
  SELECT l.u, min(r.root) FROM reach r JOIN links l ON l.v = r.doc_id
  JOIN recurring.reach AS now ON now.doc_id = l.u WHERE r.root < now.root GROUP BY l.u
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, root AS component_id, s.doc_id = root AS kept
FROM s JOIN reach USING (doc_id)
"""


FIXITY = """
WITH one AS (
  SELECT page_id, strlen('WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:' || page_id || '>\r\nWARC-Target-URI: '
    || coalesce(url, '') || '\r\nContent-Length: ' || strlen(coalesce(html, '')) || '\r\n\r\n' || coalesce(html, '') || '\r\n\r\n') AS bytes,
    coalesce(url, '') AS url, coalesce(html, '') AS html
  FROM pages
), changed AS (
  SELECT page_id, url, CASE WHEN page_id % 97 = 13 THEN html || '~' ELSE html END AS html FROM one WHERE page_id % 101 <> 7
  UNION ALL
  SELECT page_id + 10000000, url, html FROM one WHERE page_id % 103 = 5
), other AS (
  SELECT page_id, url, html, strlen('WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:' || page_id || '>\r\nWARC-Target-URI: '
    || url || '\r\nContent-Length: ' || strlen(html) || '\r\n\r\n' || html || '\r\n\r\n') AS bytes
  FROM changed
), every AS (
  SELECT coalesce(a.page_id, b.page_id) AS page_id, a.page_id IS NULL AS extra, b.page_id IS NULL AS missing,
    a.url = b.url AND a.html = b.html AS same, coalesce(a.bytes, 0) AS bytes, b.bytes AS other_bytes
  FROM one a FULL JOIN other b ON a.page_id = b.page_id
), placed AS (
  SELECT *, coalesce(sum(bytes) OVER (ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM every
)
SELECT page_id, CASE WHEN extra THEN 'extra' WHEN missing THEN 'missing' ELSE 'changed' END AS status,
  CAST(start AS BIGINT) AS start, CAST(start + bytes AS BIGINT) AS stop, other_bytes
FROM placed WHERE extra OR missing OR NOT same
"""


REPEATS = """
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, encode(coalesce(text, '')) AS b FROM documents
), sized AS (SELECT *, octet_length(b) AS n FROM docs
), starts AS (SELECT row, b, unnest(generate_series(1, n - 399)) AS p FROM sized WHERE n >= 400
), hashed AS (SELECT row, p, md5_number(array_slice(b, p, p + 399)) AS h FROM starts
), twice AS (SELECT h FROM hashed GROUP BY h HAVING count(*) > 1
), hits AS (SELECT row, p, p - lag(p) OVER (PARTITION BY row ORDER BY p) AS gap FROM hashed SEMI JOIN twice USING (h)
), numbered AS (SELECT row, p, count(*) FILTER (gap IS NULL OR gap > 400) OVER (PARTITION BY row ORDER BY p) AS run FROM hits
), runs AS (SELECT row, run, min(p) AS first, max(p) + 399 AS last FROM numbered GROUP BY 1, 2
), gaps AS (
  SELECT row, coalesce(lag(last) OVER (PARTITION BY row ORDER BY first), 0) + 1 AS a, first - 1 AS z FROM runs
  UNION ALL SELECT row, max(last) + 1, max(n) FROM runs JOIN sized USING (row) GROUP BY row
), kept AS (
  SELECT row, coalesce(string_agg(hex(array_slice(b, a, z)), '' ORDER BY a) FILTER (z >= a), '') AS x
  FROM gaps JOIN docs USING (row) GROUP BY row
), removed AS (SELECT row, sum(last - first + 1) AS n_removed, count(*) AS n_spans FROM runs GROUP BY row)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(CASE WHEN x IS NULL THEN b ELSE unhex(x) END) AS kept_sha256
FROM sized LEFT JOIN removed USING (row) LEFT JOIN kept USING (row)
"""


CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), pieces AS (
  SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS learned,
    length(regexp_replace(text, '(\\|\[INST\]|\[/INST\]|<<SYS>>|</s>|<<ROLE>>)', '\\\1', 'g'))
      + CASE role WHEN 'user' THEN 13 WHEN 'system' THEN 14 WHEN 'assistant' THEN 4
        ELSE 20 + length(regexp_replace(role, '(\\|\[INST\]|\[/INST\]|<<SYS>>|</s>|<<ROLE>>)', '\\\1', 'g')) END AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(length(learned)) AS BIGINT) AS loss_chars,
  sha256(string_agg(learned, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM pieces GROUP BY conv_id
"""


# crc32 bit by bit; words of three that stand twice in a text, q words apart, for consecutive places make a
# stretch of period q; a stretch inside one of a smaller period has that period.
RUNS = """
WITH ids AS (
  SELECT doc_id, text, 4294967295 - list_reduce(
    list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS h
  FROM documents
), split AS (
  SELECT doc_id, h, h // 10 AS g, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM ids
), placed AS (
  SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN g % len(w) END AS a FROM split
), planted AS (
  SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(generate_series(0, n - 1),
    lambda i: CASE WHEN i >= a THEN w[1 + a + (i - a) % (1 + (n - a) // (3 + g % 8))] ELSE w[i + 1] END) END AS w
  FROM placed
), threes AS (
  SELECT doc_id, i, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] AS three
  FROM (SELECT doc_id, w, unnest(generate_series(0, n - 3)) AS i FROM planted WHERE n >= 6)
), often AS (
  SELECT * FROM threes SEMI JOIN (SELECT doc_id, three FROM threes GROUP BY ALL HAVING count(*) > 2) USING (doc_id, three)
), apart AS (
  SELECT doc_id, a.i, b.i - a.i AS q FROM often a JOIN often b USING (doc_id, three) WHERE b.i > a.i
), islands AS (
  SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM apart
), stretches AS (
  SELECT doc_id, min(i) AS start, count(*) + 2 + q AS length, q AS period FROM islands GROUP BY doc_id, q, island
  HAVING count(*) + 2 + q >= greatest(6, 4 * q)
), runs AS (
  SELECT * FROM stretches s ANTI JOIN stretches t ON s.doc_id = t.doc_id AND t.period < s.period
    AND t.start <= s.start AND t.start + t.length >= s.start + s.length
), listed AS (
  SELECT doc_id, count(*) AS n_runs,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listing
  FROM runs GROUP BY doc_id
), best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) AS r
    FROM runs) WHERE r = 1
), dropped AS (
  SELECT DISTINCT doc_id, unnest(generate_series(start + period, start + length - 1)) AS i FROM runs
), left_over AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS x
  FROM (SELECT doc_id, unnest(w) AS x, unnest(generate_series(0, n - 1)) AS i FROM planted SEMI JOIN listed USING (doc_id))
  ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
)
SELECT p.doc_id, coalesce(n_runs, 0) AS n_runs, best.start, best.length, best.period,
  1000 * best.length // best.period AS exponent_milli, sha256(coalesce(listing, '')) AS runs_sha256,
  sha256(coalesce(x, array_to_string(w, ' '))) AS collapsed_sha256
FROM planted p LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN left_over USING (doc_id)
"""


def _sharding() -> str:
    """Placement only: the table is filled turn by turn, which the tests repeat by brute force."""
    owners = ", ".join(map(str, sharding.fill_table(sharding.SHARDS)))
    return f"""
WITH slots AS (
  SELECT doc_id, CAST(CAST('0x' || md5(CAST(doc_id AS VARCHAR))[1:15] AS BIGINT) % {sharding.SLOTS} AS BIGINT) AS slot
  FROM documents
), owners AS (SELECT [{owners}] AS owner)
SELECT doc_id, slot, 'shard-' || lpad(CAST(owner[slot + 1] AS VARCHAR), 3, '0') AS shard FROM slots, owners
"""


def build() -> dict[str, str]:
    return {
        "op3_decontaminate": DECONTAMINATE,
        "op4_near_dup": NEAR_DUP,
        "op5_sharding": _sharding(),
        "op8_repeats": REPEATS,
        "op9_fixity": FIXITY,
        "op10_topk": TOPK,
        "op12_chat": CHAT,
        "op13_runs": RUNS,
    }
