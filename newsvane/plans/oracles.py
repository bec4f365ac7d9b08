"""The same queries in ANSI SQL, for checking on another engine.

Written from the definitions of the operators, not from Spark plans. Views named like the given
tables must exist.
"""

from __future__ import annotations

from collections.abc import Sequence

from newsvane import dictionaries as dic
from newsvane.functions.text import HTML_NAMES
from newsvane.plans import views

STOP_LIST = ", ".join(f"'{w}'" for w in dic.STOPWORDS)


def _tokens(text: str) -> str:
    words = f"string_split_regex(lower(coalesce({text}, '')), '[^a-z]+')"
    return f"list_filter({words}, lambda w: length(w) > 1 AND w NOT IN ({STOP_LIST}))"


def _micros(x: str) -> str:
    return f"CAST(floor(({x}) * 1e6 + 0.5e0) AS BIGINT)"


def _round(x: str, digits: int) -> str:
    return f"(floor(({x}) * 1e{digits} + 0.5e0) / 1e{digits})"


def _ctes(*parts: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in parts) + "\n"


NEWS = (
    "news",
    f"""SELECT source AS ticker, doc_id AS id, split_part(text, '.', 1) AS title, text AS summary,
    {views.FIRST_DAY_SECONDS} + (doc_id // {views.TICKERS}) % {views.DAYS} * 86400 + (doc_id * 37) % 86400 AS seconds,
    DATE '{views.FIRST_DAY}' + CAST((doc_id // {views.TICKERS}) % {views.DAYS} AS INTEGER) AS trade_date
    FROM documents""",
)
TOKENIZED = (
    "tokenized",
    f"SELECT *, {_tokens('title')} AS title_tokens, {_tokens('summary')} AS summary_tokens FROM news",
)
PRICES = (
    "prices",
    f"""SELECT 'src' || (user_id % {views.TICKERS}) AS ticker, CAST(ts AS DATE) AS trade_date,
    arg_min(value, row(ts, event_id)) AS open_price, max(value) AS high_price, min(value) AS low_price,
    arg_max(value, row(ts, event_id)) AS close_price, count(*) AS volume FROM events GROUP BY 1, 2""",
)
LEXICON = (
    "lexicon",
    f"SELECT * FROM ({dic.values_clause(dic.LEXICON)}) AS t(w, valence_tenths, polarity_milli, subjectivity_milli)",
)
MODIFIERS = (
    "modifiers",
    f"""SELECT * FROM ({dic.values_clause(dic.MODIFIERS)}) AS t(w, booster_milli, is_negation, intensity_milli)
    WHERE w NOT IN (SELECT w FROM lexicon)""",
)
LEMMAS = ("lemmas", f"SELECT * FROM ({dic.values_clause(list(dic.LEMMAS.items()))}) AS t(token, lemma)")


def _lemma_list(tokens: str) -> str:
    entries = ", ".join(f"'{k}': '{v}'" for k, v in dic.LEMMAS.items())
    return f"list_transform({tokens}, lambda w: coalesce(map_extract_value(MAP {{{entries}}}, w), w))"


NLP = (
    "nlp",
    f"""SELECT *, {_lemma_list('title_tokens')} AS title_lemmas, {_lemma_list('summary_tokens')} AS summary_lemmas
    FROM tokenized""",
)


def _scoring(source: str, slots: Sequence[tuple[str, str]]) -> tuple[tuple[str, str], ...]:
    """CTEs ending in `sums`: one row per (id, slot) with integer sums; needs LEXICON and MODIFIERS."""
    texts = " UNION ALL ".join(
        f"SELECT id, '{slot}' AS slot, list_concat([''], {column}) AS words FROM {source}" for slot, column in slots
    )
    before = ", ".join(f"CASE WHEN spot > {d} THEN words[spot - {d} + 1] END AS b{d}" for d in (1, 2, 3))
    joins = " ".join(f"LEFT JOIN modifiers m{d} ON m{d}.w = h.b{d}" for d in (1, 2, 3))
    steps = "valence_tenths / 10e0 AS v0"
    valence = [("base", f"""SELECT h.*, m1.booster_milli / 1000e0 AS s1, m2.booster_milli / 1000e0 AS s2,
        m3.booster_milli / 1000e0 AS s3, coalesce(m1.is_negation, FALSE) AS n1, coalesce(m2.is_negation, FALSE) AS n2,
        coalesce(m3.is_negation, FALSE) AS n3, m1.intensity_milli / 1000e0 AS i1, {steps}
        FROM hits h {joins}""")]
    previous = "base"
    for d, damping in ((1, "1e0"), (2, "0.95e0"), (3, "0.9e0")):
        boost = f"coalesce(s{d} * {damping}, 0e0)"
        lifted = f"CASE WHEN v{d - 1} < 0 THEN v{d - 1} - {boost} ELSE v{d - 1} + {boost} END"
        valence.append((f"step{d}", f"SELECT *, ({lifted}) * CASE WHEN n{d} THEN -0.74e0 ELSE 1e0 END AS v{d} FROM {previous}"))
        previous = f"step{d}"
    weight = "CASE WHEN turn = 0 OR spot + 1 = turn THEN 1e0 WHEN spot + 1 < turn THEN 0.5e0 ELSE 1.5e0 END"
    negated = "(n1 OR (i1 IS NOT NULL AND n2))"
    factor = f"CASE WHEN {negated} THEN 1e0 / coalesce(i1, 1e0) ELSE coalesce(i1, 1e0) END"
    polarity = "least(greatest(polarity_milli / 1000e0 * factor, -1e0), 1e0)"
    return (
        ("texts", texts),
        ("words", """SELECT id, slot, words, coalesce(list_position(words, 'but'), 0) AS turn,
            unnest(words) AS w, generate_subscripts(words, 1) - 1 AS spot FROM texts"""),
        ("entries", "SELECT *, 1 AS is_hit FROM lexicon UNION ALL SELECT '', 0, 0, 0, 0"),
        ("hits", f"SELECT id, slot, turn, spot, e.*, {before} FROM words JOIN entries e USING (w)"),
        *valence,
        ("factors", f"SELECT *, {negated} AS negated, {factor} AS factor FROM step3"),
        ("parts", f"""SELECT id, slot, is_hit,
            CASE WHEN is_hit = 1 THEN {_micros(f'v3 * {weight}')} ELSE 0 END AS vd,
            {_micros(f'{polarity} * CASE WHEN negated THEN -0.5e0 ELSE 1e0 END')} AS pol,
            {_micros('least(subjectivity_milli / 1000e0 * factor, 1e0)')} AS sub FROM factors"""),
        ("sums", """SELECT id, slot, CAST(sum(vd) AS BIGINT) AS vd, CAST(sum(pol) AS BIGINT) AS pol,
            CAST(sum(sub) AS BIGINT) AS sub, CAST(sum(is_hit) AS BIGINT) AS hits FROM parts GROUP BY id, slot"""),
    )


_COMPOUND = _round("(vd / 1e6) / sqrt((vd / 1e6) * (vd / 1e6) + 15e0)", 4)
_POLARITY = "CASE WHEN hits = 0 THEN 0e0 ELSE (pol / hits) / 1e6 END"
_SUBJECTIVITY = "CASE WHEN hits = 0 THEN 0e0 ELSE (sub / hits) / 1e6 END"
_THREE = "CASE WHEN {s} >= {c} THEN 'positive' WHEN {s} <= -{c} THEN 'negative' ELSE 'neutral' END"


def _compound_label(s: str) -> str:
    return _THREE.format(s=s, c="0.05e0")


def _polarity_label(s: str) -> str:
    return _THREE.format(s=s, c="0.1e0")


def _subjectivity_label(s: str) -> str:
    return f"CASE WHEN {s} >= 0.5e0 THEN 'subjective' ELSE 'objective' END"


_SLOTS = [(f"{f}_{v}", f"{f}_{v}s") for f in ("title", "summary") for v in ("lemma", "token")]
_SCORES = f"{_COMPOUND} AS compound, {_POLARITY} AS polarity, {_SUBJECTIVITY} AS subjectivity"

SCORED = (
    NEWS, TOKENIZED, LEXICON, MODIFIERS,
    *_scoring("tokenized", [("text", "summary_tokens")]),
    ("scored", f"SELECT ticker, id, trade_date, {_SCORES} FROM sums JOIN news USING (id)"),
)
LONG = (
    NEWS, TOKENIZED, NLP, LEXICON, MODIFIERS,
    *_scoring("nlp", _SLOTS),
    ("slot_scores", f"SELECT id, slot, {_SCORES} FROM sums"),
)
DAILY = (
    *SCORED, PRICES,
    ("daily", f"""SELECT ticker, trade_date, close_price, {_round('(s / n) / 1e6', 6)} AS avg_score, n AS news_count
        FROM (SELECT ticker, trade_date, CAST(sum({_micros('compound')}) AS BIGINT) AS s, count(*) AS n
              FROM scored GROUP BY 1, 2) JOIN prices USING (ticker, trade_date)"""),
)


def _rolled(source: str, partition: str) -> tuple[tuple[str, str], ...]:
    frame = f"OVER ({partition} ORDER BY trade_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"
    score, close = _micros("avg_score"), _micros("close_price")
    spread = "CAST(n * q - s * s AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE)"
    return (
        ("window_sums", f"""SELECT *, count(*) {frame} AS n, CAST(sum({close}) {frame} AS BIGINT) AS c,
            CAST(sum({score}) {frame} AS BIGINT) AS s, CAST(sum({score} * {score}) {frame} AS BIGINT) AS q FROM {source}"""),
        ("deviations", f"SELECT *, CASE WHEN n > 1 THEN sqrt({spread}) END AS sd FROM window_sums"),
        ("rolled", f"""SELECT * EXCLUDE (n, c, s, q, sd), {_round('(c / n) / 1e6', 6)} AS sma_20,
            {_round('(s / n) / 1e6', 6)} AS sentiment_mean_20, {_round('sd / 1e6', 6)} AS sentiment_std_20,
            {_round(f'({score} - s / n) / CASE WHEN sd = 0 THEN 1e0 ELSE sd END', 6)} AS sentiment_z_score
            FROM deviations"""),
    )


_SIGNAL = """CAST(CASE WHEN close_price > sma_20 AND sentiment_z_score > 1.5e0 THEN 1
    WHEN close_price < sma_20 AND sentiment_z_score < -1.5e0 THEN -1 ELSE 0 END AS INTEGER)"""
ROLLED = (*DAILY, *_rolled("daily", "PARTITION BY ticker"))
SIGNALS = (
    *ROLLED,
    ("signals", f"""SELECT ticker, trade_date, close_price, sma_20, avg_score AS avg_vader_score, sentiment_z_score,
        news_count, {_SIGNAL} AS signal FROM rolled WHERE sma_20 IS NOT NULL AND sentiment_z_score IS NOT NULL"""),
)
_STATE = """CAST(CASE WHEN last_value(CASE WHEN signal <> 0 THEN signal END IGNORE NULLS) OVER
    (PARTITION BY ticker ORDER BY trade_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 1
    THEN 1 ELSE 0 END AS INTEGER)"""
_FEE = _micros("{p} * 20e0 * 0.001e0")
ORDERS = (
    *SIGNALS,
    ("states", f"""SELECT *, {_STATE} AS position FROM signals
        WHERE ticker IN (SELECT ticker FROM signals GROUP BY 1 HAVING count(*) >= 5)"""),
    ("orders", """SELECT *, position - coalesce(lag(position) OVER t, 0) AS placed, lead(trade_date) OVER t AS fill_date,
        lead(close_price) OVER t AS fill_price FROM states WINDOW t AS (PARTITION BY ticker ORDER BY trade_date)"""),
)
TRADES = (
    *ORDERS,
    ("trades", f"""SELECT ticker, CAST(row_number() OVER (PARTITION BY ticker ORDER BY trade_date) AS INTEGER) AS trade_no,
        trade_date AS signal_date, CASE WHEN placed = 1 THEN 'buy' ELSE 'sell' END AS side, fill_date, fill_price,
        20 AS quantity, {_FEE.format(p='fill_price')} / 1e6 AS fee
        FROM orders WHERE placed <> 0 AND fill_date IS NOT NULL"""),
)
CURVE = (
    *ORDERS,
    ("filled", f"""SELECT ticker, trade_date, {_micros('close_price')} AS price,
        coalesce(lag(placed) OVER (PARTITION BY ticker ORDER BY trade_date), 0) AS filled,
        {_FEE.format(p='close_price')} AS fee FROM orders"""),
    ("held", """SELECT *, 20 * sum(filled) OVER (PARTITION BY ticker ORDER BY trade_date) * price AS worth,
        -filled * price * 20 - abs(filled) * fee AS cash_move FROM filled"""),
    ("moves", """SELECT *, worth - coalesce(lag(worth) OVER (PARTITION BY ticker ORDER BY trade_date), 0) AS worth_move
        FROM held"""),
    ("per_day", """SELECT trade_date, sum(cash_move) AS cash_move, sum(worth_move) AS worth_move, sum(filled) AS opened
        FROM moves GROUP BY 1"""),
    ("totals", """SELECT trade_date, CAST(sum(opened) OVER d AS BIGINT) AS open_positions,
        CAST(10000000000 + sum(cash_move) OVER d AS BIGINT) AS cash, CAST(sum(worth_move) OVER d AS BIGINT) AS worth
        FROM per_day WINDOW d AS (ORDER BY trade_date)"""),
    ("curve", """SELECT trade_date, open_positions, cash / 1e6 AS cash, worth / 1e6 AS holdings,
        (cash + worth) / 1e6 AS equity FROM totals"""),
)
QUALITY = ("quality_docs", "SELECT t.*, l.quality FROM tokenized t LEFT JOIN labels l ON l.doc_id = t.id")
DOC_TOKENS = ("docs", "SELECT ticker, id, list_concat(title_tokens, summary_tokens) AS tokens FROM tokenized")


def _day(column: str = "trade_date") -> str:
    return f"CAST({column} AS VARCHAR) AS {column}"


def _text(column: str, name: str | None = None) -> str:
    return f"array_to_string({column}, ' ') AS {name or column}"


def _paired(names: tuple[str, str], left: str, right: str) -> tuple[str, str]:
    a, b = names
    return (
        "compared",
        f"""SELECT *, {_round(f'abs({b}_score - {a}_score)', 4)} AS score_diff, {a}_label <> {b}_label AS is_conflict,
        CASE WHEN {a}_label <> {b}_label THEN {b}_label ELSE {a}_label END AS final_label
        FROM (SELECT id, score AS {a}_score, label AS {a}_label FROM ({left}))
        JOIN (SELECT id, score AS {b}_score, label AS {b}_label FROM ({right})) USING (id)
        JOIN (SELECT source AS ticker, doc_id AS id FROM documents) USING (id)""",
    )


def _variant(name: str) -> str:
    return f"SELECT id, compound AS score, {_compound_label('compound')} AS label FROM slot_scores WHERE slot = 'title_{name}'"


VARIANTS = (*LONG, _paired(("token", "lemma"), _variant("token"), _variant("lemma")))
SCORERS = (
    *SCORED,
    _paired(
        ("polarity", "compound"),
        f"SELECT id, polarity AS score, {_polarity_label('polarity')} AS label FROM scored",
        f"SELECT id, compound AS score, {_compound_label('compound')} AS label FROM scored",
    ),
)


def _report() -> str:
    laid_out = "text"
    from newsvane.plans.registry import REPORT_LAYOUT

    for old, new in REPORT_LAYOUT:
        laid_out = f"replace({laid_out}, '{old}', '{new}')"
    return laid_out


def _clean_report() -> str:
    blanks = "' ' || chr(9) || chr(13) || chr(12)"
    lines = f"list_transform(string_split(coalesce({_report()}, ''), chr(10)), lambda x: trim(x, {blanks}))"
    text = f"array_to_string(list_filter({lines}, lambda x: x <> ''), chr(10))"
    for pattern, replacement in (
        (r"([a-zA-Z]+)-\s*\n\s*([a-zA-Z]+)", r"\1\2"),
        (r"\.{2,}", " "),
        (r"(?m)^[ \t]*[0-9]+[ \t]*$", ""),
        (r"[^\S\n]{2,}", " "),
    ):
        text = f"regexp_replace({text}, '{pattern}', '{replacement}', 'g')"
    return text


def _names() -> str:
    """The named characters as rows."""
    rows = ", ".join(f"('{name}', '{text.replace(chr(39), chr(39) * 2)}')" for name, text in HTML_NAMES.items())
    return f"SELECT map_from_entries(list((name, text))) AS names FROM (VALUES {rows}) AS t(name, text)"


def _html(source: str, key: str, html: str) -> str:
    """Text of an HTML column: split at ampersands, references decoded piece by piece, joined again."""
    bare = rf"regexp_replace(coalesce({html}, ''), '(?is)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->', '', 'g')"
    bare = f"regexp_replace({bare}, '(?s)<[^>]+>', '', 'g')"
    return _ctes(
        ("entities", _names()),
        ("pieces", f"SELECT {key}, unnest(string_split({bare}, '&')) AS piece, generate_subscripts(string_split({bare}, '&'), 1) AS spot FROM {source}"),
        ("named", r"""SELECT *, regexp_extract(piece, '^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);', 1) AS name FROM pieces"""),
        ("coded", """SELECT *, CASE WHEN lower(left(name, 2)) = '#x' THEN CAST('0x' || substr(name, 3) AS BIGINT)
            WHEN left(name, 1) = '#' THEN CAST(substr(name, 2) AS BIGINT) END AS code FROM named"""),
        ("decoded", """SELECT *, CASE WHEN code = 160 THEN ' '
            WHEN code > 0 AND code <= 1114111 AND code NOT BETWEEN 55296 AND 57343 THEN chr(CAST(code AS INTEGER))
            WHEN code IS NULL AND name <> '' THEN names[name] END AS found FROM coded, entities"""),
    ) + f"""SELECT {key}, trim(string_agg(CASE WHEN spot = 1 THEN piece WHEN found IS NOT NULL
        THEN found || substr(piece, length(name) + 2) ELSE '&' || piece END, '' ORDER BY spot)) AS text
        FROM decoded GROUP BY {key}"""


_RANK_TERMS = "CAST(row_number() OVER ({p} ORDER BY n DESC, term) AS INTEGER)"


def _exploded(source: str, tokens: str, *keep: str) -> str:
    return f"SELECT {', '.join([*keep, f'unnest({tokens}) AS term'])} FROM {source}"


def _matrix_columns() -> str:
    columns = []
    for slot, _ in _SLOTS:
        for score, label, value, rule in (
            ("tb_pol", "tb_label", "polarity", _polarity_label),
            ("tb_sub", "tb_sub_label", "subjectivity", _subjectivity_label),
            ("vd_comp", "vd_label", "compound", _compound_label),
        ):
            picked = f"max(CASE WHEN slot = '{slot}' THEN {value} END)"
            columns += [f"{picked} AS {score}_{slot}", f"{rule(picked)} AS {label}_{slot}"]
    return ", ".join(columns)


def _long_rows() -> str:
    return " UNION ALL ".join(
        f"""SELECT id, split_part(slot, '_', 1) AS field, split_part(slot, '_', 2) AS variant, '{scorer}' AS scorer,
        {value} AS score, {rule(value)} AS label FROM slot_scores"""
        for scorer, value, rule in (
            ("tb_pol", "polarity", _polarity_label),
            ("tb_sub", "subjectivity", _subjectivity_label),
            ("vd_comp", "compound", _compound_label),
        )
    )


def build() -> dict[str, str]:
    from newsvane.plans.registry import ENTITY_FORMS, VECTOR_SIZE, unfiltered_words

    sql: dict[str, str] = {}

    # --- sources and fetches
    sql["json_array_explode"] = """SELECT event_id, 'a' || event_id AS uuid, event_type AS title, props AS summary,
        strftime(ts, '%Y-%m-%d') AS published FROM events
        UNION ALL SELECT event_id, 'b' || event_id, event_type, props, strftime(ts, '%Y-%m-%d') FROM events
        WHERE event_id % 3 <> 0"""
    sql["ticker_from_path"] = r"""SELECT page_id,
        regexp_extract(regexp_replace(url, '[?#].*$', '') || '.json', '([^/]+)\.json$', 1) AS ticker FROM pages"""
    sql["fetch_plan"] = """SELECT replace(replace(s_name, '#', '.'), '.', '-') AS symbol, CAST(n AS INTEGER) AS chunk,
        CAST(greatest(DATE '2024-01-30' - CAST((n + 1) * 30 AS INTEGER), DATE '2024-01-30' - 365) AS VARCHAR) AS from_date,
        CAST(DATE '2024-01-30' - CAST(n * 30 AS INTEGER) AS VARCHAR) AS to_date
        FROM supplier, range(0, 13) AS r(n)"""
    # Day by day: what is wanted and not landed, then days in a row.
    sql["fetch_gaps"] = """WITH symbols AS (SELECT s_suppkey, replace(replace(s_name, '#', '.'), '.', '-') AS symbol FROM supplier),
        wanted AS (SELECT symbol, CAST(d AS DATE) AS d
            FROM symbols, generate_series(DATE '2024-01-30' - 365, DATE '2024-01-30', INTERVAL 1 DAY) AS r(d)),
        landed AS (SELECT DISTINCT symbol, CAST(ts AS DATE) + k AS d FROM events JOIN symbols ON s_suppkey = user_id % 40 + 1,
            (SELECT unnest([-1, 0, 1]) AS k) WHERE user_id % 3 <> 0
            AND event_id % 3 - 1 >= 0 AND k BETWEEN 0 AND event_id % 3 - 1),
        missing AS (SELECT symbol, d, d - CAST(row_number() OVER (PARTITION BY symbol ORDER BY d) AS INTEGER) AS island
            FROM wanted ANTI JOIN landed USING (symbol, d))
        SELECT symbol, CAST(min(d) AS VARCHAR) AS from_date, CAST(max(d) AS VARCHAR) AS to_date FROM missing GROUP BY symbol, island"""
    sql["dedup_latest"] = """SELECT user_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS run_date, value, event_id
        FROM events QUALIFY row_number() OVER
        (PARTITION BY user_id, event_type ORDER BY CAST(ts AS DATE) DESC, value DESC, event_id DESC) = 1"""
    sql["news_normalize"] = _ctes(NEWS) + """SELECT ticker, id, title, summary,
        strftime(make_timestamp(seconds * 1000000), '%Y-%m-%d %H:%M:%S') AS published_at FROM news"""
    sql["market_normalize"] = _ctes(PRICES) + """SELECT ticker,
        CASE WHEN volume % 7 <> 0 THEN CAST(trade_date AS VARCHAR) END AS trade_date,
        open_price, high_price, low_price, close_price, volume FROM prices"""

    # --- filters and joins
    sql["signals_asof"] = _ctes(*SIGNALS) + f"""SELECT * REPLACE (CAST(trade_date AS VARCHAR) AS trade_date) FROM signals
        WHERE trade_date <= DATE '2024-01-20'"""
    sql["price_sanity_filter"] = _ctes(PRICES) + f"SELECT ticker, {_day()}, close_price FROM prices WHERE close_price < 100"
    sql["drop_incomplete"] = _ctes(NEWS) + """SELECT ticker, id, title, quality FROM news
        JOIN labels ON doc_id = id WHERE title IS NOT NULL AND quality IS NOT NULL"""
    sql["news_on_date"] = _ctes(NEWS) + """SELECT ticker, id, title,
        count(*) OVER () AS articles FROM news WHERE trade_date = DATE '2024-01-05'"""
    sql["min_group_gate"] = """SELECT event_id, user_id FROM events
        QUALIFY count(*) OVER (PARTITION BY user_id) >= 68"""
    sql["cap_per_ticker"] = _ctes(NEWS) + """SELECT ticker, id, title,
        CAST(row_number() OVER (PARTITION BY ticker ORDER BY id) AS INTEGER) AS rank FROM news QUALIFY rank <= 20"""
    returns = _round("(close_price - open_price) / open_price", 4) + " AS intraday_return"
    sql["news_price_join"] = _ctes(NEWS, PRICES) + f"""SELECT ticker, id, {_day()}, title, open_price, close_price, {returns}
        FROM news JOIN prices USING (ticker, trade_date)"""
    sql["merge_articles"] = _ctes(NEWS, PRICES) + f"""SELECT ticker, {_day()}, 'a' || id AS uuid, title,
        trim(summary) AS cleaned_text, open_price, close_price, {returns} FROM news JOIN prices USING (ticker, trade_date)"""
    sql["market_mood_join"] = _ctes(*SCORED, PRICES) + f"""SELECT {_day()}, ticker, close_price,
        {_round('(s / n) / 1e6', 6)} AS market_score, n AS market_news FROM prices JOIN
        (SELECT trade_date, CAST(sum({_micros('compound')}) AS BIGINT) AS s, count(*) AS n FROM scored GROUP BY 1)
        USING (trade_date)"""
    sql["topic_name_lookup"] = f"""SELECT vec_id, CAST(label AS INTEGER) AS topic_id,
        coalesce(name, '{dic.DEFAULT_TOPIC_NAME}') AS topic_name,
        'topic - ' || label || ' - ' || coalesce(name, '{dic.DEFAULT_TOPIC_NAME}') AS display_name
        FROM embeddings LEFT JOIN ({dic.values_clause(dic.TOPIC_NAMES)}) AS t(topic, name) ON topic = label"""
    sql["distinct_tickers"] = "SELECT DISTINCT source AS ticker FROM documents"
    sql["dedup_text"] = """SELECT min(doc_id) AS id, arg_min(source, doc_id) AS ticker, text AS summary, count(*) AS copies
        FROM documents GROUP BY text, CASE WHEN text IS NULL THEN doc_id END"""
    sql["daily_return"] = _ctes(PRICES) + f"SELECT ticker, {_day()}, open_price, close_price, {returns} FROM prices"
    where = "'?run_date=2024-01-30&ticker=' || source"
    sql["artifact_manifest"] = f"""SELECT source AS ticker, '2024-01-30' AS report_date,
        'report_terms' || {where} AS wordcloud_url, 'report_topic_terms' || {where} AS ldavis_url
        FROM documents GROUP BY source HAVING count(*) >= 5"""

    # --- text
    cleaned = r"trim(regexp_replace(regexp_replace(lower(text), '[^a-z\s]', ' ', 'g'), '\s+', ' ', 'g'))"
    sql["clean_text"] = f"SELECT doc_id, {cleaned} AS clean FROM documents"
    sql["tokenize"] = _ctes(NEWS, TOKENIZED) + f"""SELECT id, {_text('summary_tokens', 'tokens')},
        CAST(len(summary_tokens) AS INTEGER) AS n_tokens FROM tokenized"""
    sql["tokenize_long"] = _ctes(NEWS, TOKENIZED) + """SELECT id, unnest(summary_tokens) AS token,
        CAST(generate_subscripts(summary_tokens, 1) - 1 AS INTEGER) AS pos FROM tokenized"""
    sql["tokens_to_text"] = _ctes(NEWS, TOKENIZED) + f"""SELECT id, {_text('title_tokens', 'title_text')},
        CASE WHEN id % 5 <> 0 THEN array_to_string(summary_tokens, ' ') ELSE '' END AS summary_text FROM tokenized"""
    both = "list_concat(CASE WHEN id % 5 <> 0 THEN title_tokens ELSE [] END, summary_tokens)"
    sql["combined_tokens"] = _ctes(NEWS, TOKENIZED) + f"""SELECT id, {_text(both, 'tokens')},
        CAST(len({both}) AS INTEGER) AS n_tokens FROM tokenized"""
    sql["lemmatize"] = _ctes(NEWS, TOKENIZED, NLP) + f"""SELECT id, {_text('summary_lemmas', 'lemmas')},
        CAST(len(summary_lemmas) AS INTEGER) AS n_lemmas FROM nlp"""
    lists = ", ".join(_text(c) for c in ("title_tokens", "title_lemmas", "summary_tokens", "summary_lemmas"))
    sql["news_nlp"] = _ctes(NEWS, TOKENIZED, NLP) + f"SELECT ticker, id, {lists} FROM nlp"
    sql["html_to_text"] = _html("pages", "page_id", "html")
    written = "text"
    for letter, reference in ENTITY_FORMS:
        written = f"replace({written}, '{letter}', '{reference}')"
    sql["html_entities"] = _html("documents", "doc_id", written)
    sql["report_line_clean"] = f"SELECT doc_id, {_clean_report()} AS clean FROM documents"
    words = rf"string_split_regex({_clean_report()}, '[^\p{{L}}\p{{N}}]+')"
    kept = f"list_filter(list_transform({words}, lambda w: lower(w)), lambda w: w <> '' AND w NOT IN ({STOP_LIST}))"
    sql["report_tokens"] = f"""SELECT doc_id, array_to_string(list_filter({_lemma_list(kept)},
        lambda w: regexp_full_match(w, '[a-z]+')), ' ') AS tokens FROM documents"""

    # --- sentiment
    sql["vader_score"] = _ctes(*SCORED) + "SELECT ticker, id, compound FROM scored"
    words = f"string_split_regex(lower({unfiltered_words('summary')}), '[^a-z]+')"
    every_word = ("every_word", f"SELECT id, list_filter({words}, lambda w: length(w) > 1) AS tokens FROM news")
    sql["vader_score_unfiltered"] = _ctes(
        NEWS, every_word, LEXICON, MODIFIERS, *_scoring("every_word", [("text", "tokens")])
    ) + f"SELECT ticker, id, {_SCORES} FROM sums JOIN news USING (id)"
    narrow = ", ".join(
        f"max(CASE WHEN slot = '{f}_lemma' THEN {m} END) AS {f}_{m}, max(CASE WHEN slot = '{f}_lemma' THEN {rule(m)} END) AS {f}_{m}_sentiment"
        for f in ("title", "summary") for m, rule in (("polarity", _polarity_label), ("subjectivity", _subjectivity_label))
    )
    sql["narrow_scores"] = _ctes(*LONG) + f"""SELECT ticker, id, {_text('title_lemmas', 'title_text')},
        {_text('summary_lemmas', 'summary_text')}, s.* EXCLUDE (id)
        FROM nlp JOIN (SELECT id, {narrow} FROM slot_scores GROUP BY id) s USING (id)"""
    sql["polarity_subjectivity"] = _ctes(*SCORED) + "SELECT ticker, id, polarity, subjectivity FROM scored"
    sql["sentiment_labels"] = _ctes(*SCORED) + f"""SELECT id, {_compound_label('compound')} AS compound_label,
        {_polarity_label('polarity')} AS polarity_label, {_subjectivity_label('subjectivity')} AS subjectivity_label
        FROM scored"""
    sql["sentiment_matrix"] = _ctes(*LONG) + f"""SELECT ticker, id, {_matrix_columns()}
        FROM slot_scores JOIN news USING (id) GROUP BY ticker, id"""
    sql["scores_long_union"] = _ctes(*LONG) + _long_rows()
    sql["lexicon_induction"] = _ctes(NEWS, TOKENIZED, QUALITY) + f"""SELECT w, in_one, in_zero,
        {_round('ln(((in_one + 1e0) / (docs_one + 2e0)) / ((in_zero + 1e0) / (docs_zero + 2e0)))', 6)} AS log_odds
        FROM (SELECT w, count(*) FILTER (quality = 1) AS in_one, count(*) FILTER (quality = 0) AS in_zero
              FROM (SELECT quality, unnest(list_distinct(summary_tokens)) AS w FROM quality_docs WHERE quality IS NOT NULL)
              GROUP BY w HAVING count(*) >= 5),
             (SELECT count(*) FILTER (quality = 1) AS docs_one, count(*) FILTER (quality = 0) AS docs_zero FROM quality_docs)"""

    # --- comparisons
    sql["compare_token_lemma"] = _ctes(*VARIANTS) + "SELECT * FROM compared"
    sql["compare_scorers"] = _ctes(*SCORERS) + "SELECT * FROM compared"
    sql["label_match_counts"] = _ctes(*VARIANTS) + """SELECT CASE WHEN is_conflict THEN 'mismatch' ELSE 'match' END
        AS label_match, count(*) AS articles FROM compared GROUP BY 1"""
    mean = f"CAST(sum({_micros('score_diff')}) AS BIGINT) / count(*) / 1e6"
    sql["avg_score_diff"] = _ctes(*VARIANTS) + f"""SELECT {_round(mean, 6)} AS average_score_diff,
        count(*) AS articles FROM compared"""
    sql["top_score_diffs"] = _ctes(*VARIANTS) + """SELECT ticker, id, token_score, lemma_score, score_diff,
        CAST(row_number() OVER (ORDER BY score_diff DESC, ticker, id) AS INTEGER) AS rank FROM compared QUALIFY rank <= 200"""
    gap = f"CAST(sum({_micros('abs(compound_score - polarity_score)')}) AS BIGINT) / count(*) / 1e6"
    opposed = """(polarity_label = 'positive' AND compound_label = 'negative')
        OR (polarity_label = 'negative' AND compound_label = 'positive')"""
    sql["scorer_agreement_report"] = _ctes(*SCORERS) + f"""SELECT {_round(gap, 4)} AS mean_abs_diff,
        {_round('avg(CASE WHEN is_conflict THEN 0e0 ELSE 1e0 END) * 100e0', 2)} AS agreement_pct,
        {_round(f'avg(CASE WHEN {opposed} THEN 1e0 ELSE 0e0 END) * 100e0', 2)} AS opposite_pct,
        {_round('corr(compound_score, polarity_score)', 4)} AS pearson FROM compared"""

    # --- signals and trading
    dated = "* REPLACE (CAST(trade_date AS VARCHAR) AS trade_date)"
    sql["daily_sentiment"] = _ctes(*DAILY) + f"SELECT {dated} FROM daily"
    market = (
        "market",
        f"""SELECT trade_date, {_round(f"CAST(sum({_micros('close_price')}) AS BIGINT) / count(*) / 1e6", 6)} AS close_price,
        {_round(f"CAST(sum({_micros('avg_score')} * news_count) AS BIGINT) / CAST(sum(news_count) AS BIGINT) / 1e6", 6)}
        AS avg_score, CAST(sum(news_count) AS BIGINT) AS news_count FROM daily GROUP BY 1""",
    )
    sql["market_daily_sentiment"] = _ctes(*DAILY, market) + f"SELECT {dated} FROM market"
    sql["sma20"] = _ctes(*ROLLED) + f"SELECT ticker, {_day()}, close_price, sma_20 FROM rolled"
    sql["sentiment_z"] = _ctes(*ROLLED) + f"""SELECT ticker, {_day()}, avg_score, sentiment_mean_20, sentiment_std_20,
        sentiment_z_score FROM rolled"""
    sql["market_sentiment_z"] = _ctes(*DAILY, market, *_rolled("market", "")) + f"SELECT {dated}, {_SIGNAL} AS signal FROM rolled"
    sql["trading_signals"] = _ctes(*SIGNALS) + f"SELECT {dated} FROM signals"
    sql["position_state"] = _ctes(*SIGNALS) + f"SELECT ticker, {_day()}, signal, {_STATE} AS position FROM signals"
    sql["trades"] = _ctes(*TRADES) + """SELECT * REPLACE (CAST(signal_date AS VARCHAR) AS signal_date,
        CAST(fill_date AS VARCHAR) AS fill_date) FROM trades"""
    gross = "(exit_price - fill_price) * quantity"
    sql["trade_pnl"] = _ctes(*TRADES) + f"""SELECT ticker, CAST(fill_date AS VARCHAR) AS entry_date,
        fill_price AS entry_price, CAST(exit_date AS VARCHAR) AS exit_date, exit_price, quantity,
        {_round(gross, 6)} AS gross_pnl, {_round(f'{gross} - fee - exit_fee', 6)} AS net_pnl, exit_date IS NULL AS is_open
        FROM (SELECT *, lead(fill_date) OVER t AS exit_date, lead(fill_price) OVER t AS exit_price,
              lead(fee) OVER t AS exit_fee FROM trades WINDOW t AS (PARTITION BY ticker ORDER BY trade_no))
        WHERE side = 'buy'"""
    sql["equity_curve"] = _ctes(*CURVE) + f"SELECT {dated} FROM curve"
    sql["backtest_summary"] = _ctes(*CURVE) + f"""SELECT 10000e0 AS initial_cash, v AS final_value,
        {_round('v - 10000e0', 6)} AS pnl, {_round('(v - 10000e0) / 10000e0 * 100e0', 4)} AS pnl_pct, min_cash, days
        FROM (SELECT arg_max(equity, trade_date) AS v, min(cash) AS min_cash, count(*) AS days FROM curve)"""
    sql["signal_chart_data"] = _ctes(*SIGNALS) + f"""SELECT * EXCLUDE (shift, trade_date), {_day()},
        CASE WHEN close_price > sma_20 THEN 'above' WHEN close_price < sma_20 THEN 'below' END AS band,
        CASE signal WHEN 1 THEN 'buy' WHEN -1 THEN 'sell' END AS marker,
        CASE signal WHEN 1 THEN {_round('close_price - shift', 6)} WHEN -1 THEN {_round('close_price + shift', 6)} END
        AS marker_price, CASE WHEN sentiment_z_score > 0 THEN 'green' ELSE 'red' END AS z_colour,
        1.5e0 AS z_upper, -1.5e0 AS z_lower
        FROM (SELECT *, CAST(sum({_micros('close_price')}) OVER (PARTITION BY ticker) AS BIGINT)
              / count(*) OVER (PARTITION BY ticker) / 1e6 * 0.02e0 AS shift FROM signals)"""

    # --- terms
    sql["term_topn"] = _ctes(NEWS, TOKENIZED) + f"""SELECT term, n, {_RANK_TERMS.format(p='')} AS rank
        FROM (SELECT term, count(*) AS n FROM ({_exploded('tokenized', 'title_tokens')}) GROUP BY 1) QUALIFY rank <= 200"""
    ranked = _RANK_TERMS.format(p="PARTITION BY ticker")
    per_ticker = "SELECT ticker, term, count(*) AS n FROM ({e}) GROUP BY 1, 2"
    sql["term_topn_per_ticker"] = _ctes(NEWS, TOKENIZED) + f"""SELECT ticker, term, n, {ranked} AS rank
        FROM ({per_ticker.format(e=_exploded('tokenized', 'summary_tokens', 'ticker'))}) QUALIFY rank <= 100"""
    pairs = "SELECT ticker, a || ' ' || b AS term FROM pairs WHERE b IS NOT NULL"
    sql["bigram_topn"] = _ctes(
        NEWS, TOKENIZED,
        ("long", """SELECT ticker, id, unnest(summary_tokens) AS a, generate_subscripts(summary_tokens, 1) AS i FROM tokenized"""),
        ("pairs", "SELECT ticker, a, lead(a) OVER (PARTITION BY id ORDER BY i) AS b FROM long"),
    ) + f"SELECT ticker, term, n, {ranked} AS rank FROM ({per_ticker.format(e=pairs)}) QUALIFY rank <= 100"
    def x_ln_x(x: str) -> str:
        return f"CASE WHEN ({x}) > 0 THEN ({x}) * ln(CAST(({x}) AS DOUBLE)) ELSE 0e0 END"

    cells = " + ".join(map(x_ln_x, ("n", "na - n", "nb - n", "c - na - nb + n", "c")))
    margins = " + ".join(map(x_ln_x, ("na", "nb", "c - na", "c - nb")))
    sql["collocations_per_ticker"] = _ctes(
        NEWS, TOKENIZED,
        ("long", """SELECT ticker, id, unnest(summary_tokens) AS a, generate_subscripts(summary_tokens, 1) AS i FROM tokenized"""),
        ("behind", "SELECT ticker, a, lead(a) OVER (PARTITION BY id ORDER BY i) AS b FROM long"),
        ("singles", "SELECT ticker, a, count(*) AS n FROM long GROUP BY 1, 2"),
        ("totals", "SELECT ticker, count(*) AS c FROM long GROUP BY 1"),
        ("pairs", "SELECT ticker, a, b, count(*) AS n FROM behind WHERE b IS NOT NULL GROUP BY ALL"),
        ("margins", """SELECT p.ticker, p.a, p.b, p.n, x.n AS na, y.n AS nb, c FROM pairs p JOIN totals t ON t.ticker = p.ticker
            JOIN singles x ON x.ticker = p.ticker AND x.a = p.a JOIN singles y ON y.ticker = p.ticker AND y.a = p.b"""),
        ("found", f"""SELECT ticker, a, b, n, {_round(f'2e0 * (({cells}) - ({margins}))', 6)} AS score
            FROM margins WHERE c > na AND c > nb AND {_round(f'2e0 * (({cells}) - ({margins}))', 6)} > 30"""),
        ("taken", """SELECT ticker, a, sum(n) AS n FROM
            (SELECT ticker, a, n FROM found UNION ALL SELECT ticker, b, n FROM found) GROUP BY 1, 2"""),
        ("every", """SELECT s.ticker, s.a AS term, 1 AS words, CAST(s.n - coalesce(t.n, 0) AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS score
            FROM singles s LEFT JOIN taken t ON t.ticker = s.ticker AND t.a = s.a WHERE s.n > coalesce(t.n, 0)
            UNION ALL SELECT ticker, a || ' ' || b, 2, n, score FROM found"""),
    ) + f"SELECT ticker, term, words, n, score, {ranked} AS rank FROM every QUALIFY rank <= 100"
    sql["doc_frequency_pruned"] = _ctes(NEWS, TOKENIZED) + f"""SELECT term, count(DISTINCT id) AS df,
        (SELECT count(*) FROM documents) AS documents FROM ({_exploded('tokenized', 'summary_tokens', 'id')}) GROUP BY term
        HAVING count(DISTINCT id) >= 2 AND count(DISTINCT id) <= 0.4e0 * (SELECT count(*) FROM documents)"""
    sql["vocabulary"] = _ctes(NEWS, TOKENIZED, DOC_TOKENS) + f"""SELECT
        CAST({_RANK_TERMS.format(p='')} - 1 AS INTEGER) AS term_index, term, n, df
        FROM (SELECT term, count(*) AS n, count(DISTINCT id) AS df FROM ({_exploded('docs', 'tokens', 'id')}) GROUP BY 1)
        WHERE df >= 5 QUALIFY term_index < 10000"""
    sql["vocabulary_per_ticker"] = _ctes(NEWS, TOKENIZED, DOC_TOKENS) + f"""SELECT ticker,
        CAST({ranked} - 1 AS INTEGER) AS term_index, term, n
        FROM ({per_ticker.format(e=_exploded('docs', 'tokens', 'ticker'))}) QUALIFY term_index < 5000"""
    def sequences(docs: str) -> str:
        return _ctes(
            NEWS, TOKENIZED, ("docs", docs),
            ("ranked", f"""SELECT term, row_number() OVER (ORDER BY n DESC, term) AS i
                FROM (SELECT term, count(*) AS n FROM ({_exploded('docs', 'tokens')}) GROUP BY 1) WHERE n >= 2"""),
            ("places", "SELECT ticker, id, p, tokens[p] AS term FROM docs, range(1, 51) AS r(p)"),
        ) + """SELECT ticker, id, string_agg(CAST(coalesce(i, 0) AS VARCHAR), ',' ORDER BY p) AS sequence
            FROM places LEFT JOIN ranked USING (term) GROUP BY ticker, id"""

    sql["sequence_encode"] = sequences(DOC_TOKENS[1])
    sql["sequence_encode_shared_ids"] = sequences(
        f"{DOC_TOKENS[1]} UNION ALL SELECT ticker || '-B', id, title_tokens FROM tokenized"
    )
    sql["lemmatize_by_join"] = _ctes(NEWS, TOKENIZED, NLP) + f"""SELECT ticker, id, {_text('summary_lemmas', 'lemmas')},
        CAST(len(summary_lemmas) AS INTEGER) AS n_lemmas FROM nlp"""
    sql["term_lift"] = _ctes(
        NEWS, TOKENIZED, QUALITY,
        ("words", "SELECT quality, unnest(summary_tokens) AS term FROM quality_docs WHERE quality IS NOT NULL"),
        ("pairs", "SELECT quality, term, count(*) AS n_label_term FROM words GROUP BY 1, 2"),
    ) + f"""SELECT quality, term, n_label_term, n_term,
        {_round('(n_label_term / n_label) / (n_term / n_all)', 6)} AS lift
        FROM pairs JOIN (SELECT term, count(*) AS n_term FROM words GROUP BY 1 HAVING count(*) >= 5) USING (term)
        JOIN (SELECT quality, count(*) AS n_label FROM words GROUP BY 1) USING (quality),
        (SELECT count(*) AS n_all FROM words)"""

    vocabulary = f"""SELECT {_RANK_TERMS.format(p='')} - 1 AS term_index, term
        FROM (SELECT term, count(*) AS n, count(DISTINCT id) AS df FROM ({_exploded('docs', 'tokens', 'id')}) GROUP BY 1)
        WHERE df >= 5 QUALIFY term_index < 10000"""
    sql["count_vectors"] = _ctes(
        NEWS, TOKENIZED, DOC_TOKENS, ("words", vocabulary),
        ("counted", f"SELECT id, term, count(*) AS n FROM ({_exploded('docs', 'tokens', 'id')}) GROUP BY 1, 2"),
        ("lists", """SELECT id, string_agg(CAST(term_index AS VARCHAR), ',' ORDER BY term_index) AS indices,
            string_agg(CAST(n AS VARCHAR), ',' ORDER BY term_index) AS counts FROM counted JOIN words USING (term) GROUP BY 1"""),
    ) + "SELECT ticker, id, coalesce(indices, '') AS indices, coalesce(counts, '') AS counts FROM docs LEFT JOIN lists USING (id)"
    sql["vocabulary_pruned_per_ticker"] = _ctes(NEWS, TOKENIZED) + f"""SELECT ticker,
        CAST({ranked} - 1 AS INTEGER) AS term_index, term, n
        FROM (SELECT ticker, term, count(*) AS n, count(DISTINCT id) AS df
              FROM ({_exploded('tokenized', 'title_tokens', 'ticker', 'id')}) GROUP BY 1, 2)
        JOIN (SELECT ticker, count(*) AS documents FROM tokenized GROUP BY 1) USING (ticker)
        WHERE df >= 2 AND df <= 0.9e0 * documents QUALIFY term_index < 500"""

    # --- topics
    counted = (
        NEWS, TOKENIZED, QUALITY,
        ("words", "SELECT ticker, quality, unnest(summary_tokens) AS term FROM quality_docs WHERE quality IS NOT NULL"),
        ("per_term", """SELECT ticker, term, count(*) AS n, count(*) FILTER (quality = 0) AS c0,
            count(*) FILTER (quality = 1) AS c1 FROM words GROUP BY 1, 2"""),
        ("per_ticker", "SELECT ticker, count(*) AS terms, sum(c0) AS t0, sum(c1) AS t1, sum(n) AS corpus FROM per_term GROUP BY 1"),
        ("topic_terms", """SELECT ticker, 0 AS topic, term, n, corpus, (c0 + 1) / (t0 + terms) AS p FROM per_term JOIN per_ticker USING (ticker)
            UNION ALL SELECT ticker, 1, term, n, corpus, (c1 + 1) / (t1 + terms) FROM per_term JOIN per_ticker USING (ticker)"""),
    )
    sql["topic_relevance"] = _ctes(*counted) + f"""SELECT ticker, CAST(topic AS INTEGER) AS topic, term,
        {_round('p', 9)} AS probability, {_round('0.6e0 * ln(p) + 0.4e0 * ln(p / (n / corpus))', 6)} AS relevance FROM topic_terms"""
    sql["topic_distance"] = _ctes(*counted) + f"""SELECT ticker, CAST(0 AS INTEGER) AS topic_a, CAST(1 AS INTEGER) AS topic_b,
        {_round('sum(0.5e0 * (a.p * ln(a.p / ((a.p + b.p) / 2)) + b.p * ln(b.p / ((a.p + b.p) / 2))))', 6)} AS js_divergence
        FROM topic_terms a JOIN topic_terms b USING (ticker, term) WHERE a.topic = 0 AND b.topic = 1 GROUP BY ticker"""
    languages = ("de", "en", "es", "fr")
    spoken = (
        NEWS, TOKENIZED,
        ("said", f"""SELECT ticker, list_position({list(languages)}, lang) - 1 AS topic, unnest(summary_tokens) AS term
            FROM tokenized JOIN documents ON doc_id = id WHERE list_contains({list(languages)}, lang)"""),
        ("per_term", "SELECT ticker, term, count(*) AS n FROM said GROUP BY 1, 2"),
        ("per_topic", "SELECT ticker, topic, count(*) AS t FROM said GROUP BY 1, 2"),
        ("per_ticker", "SELECT ticker, count(*) AS terms, sum(n) AS corpus FROM per_term GROUP BY 1"),
        ("cells", "SELECT ticker, topic, term, count(*) AS c FROM said GROUP BY 1, 2, 3"),
        ("topic_terms", """SELECT ticker, k.topic, term, n, corpus, coalesce(t, 0) AS t, (coalesce(c, 0) + 1) / (coalesce(t, 0) + terms) AS p
            FROM per_term JOIN per_ticker USING (ticker) CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS topic) k
            LEFT JOIN per_topic USING (ticker, topic) LEFT JOIN cells USING (ticker, topic, term)"""),
    )
    # Eigenvectors by squaring: the power of a matrix, made positive by a shift, has the leading one in
    # all its columns; its own part is then taken out for the next.
    power = [("m0_0", """SELECT ticker, i, j, -0.5e0 * (s - avg(s) OVER (PARTITION BY ticker, i) - avg(s) OVER (PARTITION BY ticker, j)
        + avg(s) OVER (PARTITION BY ticker)) AS x FROM squares""")]
    for axis in (0, 1):
        power.append((f"p{axis}_0", f"""SELECT ticker, i, j, x + CASE WHEN i = j THEN shift ELSE 0 END AS x FROM m{axis}_0
            JOIN (SELECT ticker, max(s) AS shift FROM (SELECT ticker, i, sum(abs(x)) AS s FROM m{axis}_0 GROUP BY 1, 2) GROUP BY 1) USING (ticker)"""))
        for r in range(14):
            power.append((f"p{axis}_{r + 1}", f"""SELECT ticker, i, j, x / greatest(max(abs(x)) OVER (PARTITION BY ticker), 1e-300) AS x
                FROM (SELECT a.ticker, a.i, b.j, sum(a.x * b.x) AS x FROM p{axis}_{r} a JOIN p{axis}_{r} b ON a.ticker = b.ticker AND a.j = b.i GROUP BY 1, 2, 3)"""))
        power += [
            (f"c{axis}", f"""SELECT ticker, arg_max(i, row(x, -i)) AS j FROM p{axis}_14 WHERE i = j GROUP BY 1"""),
            (f"v{axis}", f"""SELECT ticker, i, x / sqrt(sum(x * x) OVER (PARTITION BY ticker)) AS v FROM p{axis}_14 JOIN c{axis} USING (ticker, j)"""),
            (f"e{axis}", f"""SELECT ticker, sum(a.v * m.x * b.v) AS e FROM m{axis}_0 m JOIN v{axis} a USING (ticker, i)
                JOIN v{axis} b ON b.ticker = m.ticker AND b.i = m.j GROUP BY 1"""),
            (f"at{axis}", f"""SELECT ticker, i, v * sqrt(greatest(e, 0)) AS spot FROM v{axis} JOIN e{axis} USING (ticker)"""),
            (f"axis{axis}", f"""SELECT ticker, i, CASE WHEN side >= 0 THEN spot ELSE -spot END AS spot FROM at{axis}
                LEFT JOIN (SELECT ticker, arg_min(spot, i) AS side FROM at{axis} WHERE abs(spot) >= 5e-7 GROUP BY 1) USING (ticker)"""),
            (f"m{axis + 1}_0", f"""SELECT m.ticker, m.i, m.j, x - e * a.v * b.v AS x FROM m{axis}_0 m JOIN e{axis} USING (ticker)
                JOIN v{axis} a ON a.ticker = m.ticker AND a.i = m.i JOIN v{axis} b ON b.ticker = m.ticker AND b.i = m.j"""),
        ]
    sql["topic_layout"] = _ctes(
        *spoken,
        ("distances", f"""SELECT ticker, a.topic AS a, b.topic AS b,
            {_round('sum(0.5e0 * (a.p * ln(a.p / ((a.p + b.p) / 2)) + b.p * ln(b.p / ((a.p + b.p) / 2))))', 6)} AS d
            FROM topic_terms a JOIN topic_terms b USING (ticker, term) WHERE a.topic < b.topic GROUP BY 1, 2, 3"""),
        ("squares", """SELECT ticker, a AS i, b AS j, d * d AS s FROM distances UNION ALL SELECT ticker, b, a, d * d FROM distances
            UNION ALL SELECT ticker, k, k, 0 FROM (SELECT DISTINCT ticker FROM distances), (SELECT unnest([0, 1, 2, 3]) AS k)"""),
        *power,
    ) + f"""SELECT ticker, CAST(i AS INTEGER) AS topic, {_round('x.spot', 6)} + 0e0 AS x, {_round('y.spot', 6)} + 0e0 AS y
        FROM axis0 x JOIN axis1 y USING (ticker, i)"""
    sql["term_saliency"] = _ctes(
        *spoken,
        ("given", """SELECT ticker, term, n, corpus, t / corpus AS share, p / sum(p) OVER (PARTITION BY ticker, term) AS q
            FROM topic_terms WHERE t > 0"""),
        ("distinct_terms", "SELECT ticker, term, max(n) AS n, max(corpus) AS corpus, sum(q * ln(q / share)) AS d FROM given GROUP BY 1, 2"),
    ) + f"""SELECT ticker, term, {_round('d', 6)} AS distinctiveness, {_round('n / corpus * d', 9)} AS saliency,
        CAST(row_number() OVER (PARTITION BY ticker ORDER BY saliency DESC, term) AS INTEGER) AS rank
        FROM distinct_terms QUALIFY rank <= 30"""
    sql["topic_sizes"] = f"""SELECT 'L' || label AS ticker, CAST(spot - 1 AS INTEGER) AS topic,
        {_round('avg(size / total)', 9)} AS prevalence, count(*) AS documents
        FROM (SELECT label, unnest(sizes) AS size, generate_subscripts(sizes, 1) AS spot, list_sum(sizes) AS total
              FROM (SELECT label, list_transform(embedding, lambda x: abs(CAST(x AS DOUBLE))) AS sizes FROM embeddings))
        GROUP BY 1, 2"""

    # --- vectors
    near_words = (
        NEWS, TOKENIZED, DOC_TOKENS,
        ("long", "SELECT id, unnest(tokens) AS w, generate_subscripts(tokens, 1) AS i FROM docs"),
        ("known", "SELECT w FROM long GROUP BY 1 HAVING count(*) >= 3"),
        ("pairs", """SELECT least(x.w, y.w) AS a, greatest(x.w, y.w) AS b, CAST(sum(6 - (y.i - x.i)) AS BIGINT) AS n
            FROM long x JOIN long y ON x.id = y.id AND y.i BETWEEN x.i + 1 AND x.i + 5
            WHERE x.w IN (FROM known) AND y.w IN (FROM known) GROUP BY 1, 2"""),
    )
    sql["cooccurrence"] = _ctes(*near_words) + "SELECT a, b, n FROM pairs"
    sql["ppmi"] = _ctes(
        *near_words,
        ("sides", "SELECT w, CAST(sum(n) AS DOUBLE) AS n FROM (SELECT a AS w, n FROM pairs UNION ALL SELECT b, n FROM pairs) GROUP BY 1"),
        ("shares", """SELECT a, b, p.n, CASE WHEN a = b THEN 2 ELSE 1 END * CAST(p.n AS DOUBLE) * (SELECT sum(n) FROM sides) / (x.n * y.n) AS share
            FROM pairs p JOIN sides x ON x.w = a JOIN sides y ON y.w = b"""),
    ) + f"SELECT a, b, n, {_round('ln(share)', 6)} AS ppmi FROM shares WHERE share > 1 AND {_round('ln(share)', 6)} > 0"
    sql["dominant_topic"] = """SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT)
        AS dominant_topic_id FROM embeddings"""
    fixed = f"list_transform(embedding, lambda x: {_micros('CAST(x AS DOUBLE)')})"
    dot = "CAST(list_sum(list_transform(list_zip({a}, {b}), lambda p: p[1] * p[2])) AS DOUBLE)"
    sql["embedding_topk"] = _ctes(
        ("fixed", f"SELECT vec_id, {fixed} AS v FROM embeddings"),
        ("cosines", f"""SELECT f.vec_id, {_round(dot.format(a='f.v', b='q.v') + f" / sqrt({dot.format(a='f.v', b='f.v')} * {dot.format(a='q.v', b='q.v')})", 6)}
            AS cosine FROM fixed f JOIN fixed q ON q.vec_id = 0 AND f.vec_id <> 0"""),
    ) + """SELECT vec_id, cosine, CAST(row_number() OVER (ORDER BY cosine DESC, vec_id) AS INTEGER) AS rank
        FROM cosines QUALIFY rank <= 15"""
    word_table = (
        NEWS, TOKENIZED, DOC_TOKENS, ("words", vocabulary),
        ("stored", f"SELECT term, {fixed} AS v FROM words JOIN embeddings ON vec_id = term_index"),
    )
    known = "SELECT id, term, count(*) AS n FROM (SELECT id, unnest(tokens) AS term FROM docs) GROUP BY 1, 2"
    sql["word2vec_docs"] = _ctes(
        *word_table,
        ("sums", f"""SELECT id, p, sum(n) AS known_words, sum(n * v[p]) AS s
            FROM ({known}) JOIN stored USING (term), range(1, {VECTOR_SIZE + 1}) AS r(p) GROUP BY 1, 2"""),
        ("means", f"""SELECT id, CAST(max(known_words) AS BIGINT) AS known_words,
            string_agg(CAST(CAST(floor((s / known_words / 1e6) * 1e6 + 0.5e0) AS BIGINT) AS VARCHAR), ',' ORDER BY p) AS vector
            FROM sums GROUP BY 1"""),
    ) + "SELECT ticker, id, coalesce(known_words, 0) AS known_words, vector FROM docs LEFT JOIN means USING (id)"
    sql["word2vec_synonyms"] = _ctes(
        *word_table,
        ("query", "SELECT term, v FROM stored JOIN words USING (term) WHERE term_index = 0"),
        ("near", f"""SELECT q.term AS query, f.term AS word, {_round(dot.format(a='f.v', b='q.v') + f" / sqrt({dot.format(a='f.v', b='f.v')} * {dot.format(a='q.v', b='q.v')})", 6)} AS similarity
            FROM stored f, query q WHERE f.term <> q.term"""),
    ) + "SELECT query, word, similarity FROM near QUALIFY row_number() OVER (ORDER BY similarity DESC, word) <= 15"
    train = "((id % 1000000007) * 2654435761) % 4294967296 < 3435973836"
    sql["held_out_labels"] = _ctes(*SCORED) + f"""SELECT {_polarity_label('polarity')} AS label,
        count(*) FILTER ({train}) AS train_articles, count(*) FILTER (NOT {train}) AS test_articles FROM scored GROUP BY 1"""
    number = "CASE {l} WHEN 'positive' THEN 0e0 WHEN 'neutral' THEN 1e0 ELSE 2e0 END"
    numbered = ("numbered", f"""SELECT {number.format(l=_polarity_label('polarity'))} AS label_index,
        {number.format(l=_compound_label('compound'))} AS prediction FROM scored""")
    sql["label_confusion"] = _ctes(*SCORED, numbered) + "SELECT label_index, prediction, count(*) AS articles FROM numbered GROUP BY 1, 2"
    sql["label_accuracy"] = _ctes(*SCORED, numbered) + f"""SELECT
        {_round('avg(CASE WHEN label_index = prediction THEN 1e0 ELSE 0e0 END)', 6)} AS accuracy, count(*) AS articles FROM numbered"""
    sql["train_test_split"] = """SELECT doc_id,
        CASE WHEN ((doc_id % 1000000007) * 2654435761) % 4294967296 < 3435973836 THEN 1 ELSE 0 END AS is_train
        FROM documents"""
    sql["label_index"] = _ctes(*SCORED) + f"""SELECT label, articles,
        CAST(row_number() OVER (ORDER BY articles DESC, label) - 1 AS BIGINT) AS label_index
        FROM (SELECT {_polarity_label('polarity')} AS label, count(*) AS articles FROM scored GROUP BY 1)"""
    sql["topic_k_choice"] = """SELECT source AS ticker, count(*) AS documents,
        CAST(greatest(2, least(10, count(*) // 2)) AS INTEGER) AS k FROM documents GROUP BY source HAVING count(*) >= 5"""
    targets = [f"{scorer}_{field}_token" for field in ("title", "summary") for scorer in ("tb_pol", "tb_sub")]
    sql["score_gram"] = f"""WITH vectors AS ({sql['word2vec_docs']}), scores AS ({sql['sentiment_matrix']}),
        design AS (SELECT list_concat([1000000], list_transform(string_split(vector, ','), lambda x: CAST(x AS BIGINT)),
            [{', '.join(_micros(t) for t in targets)}]) AS m FROM vectors JOIN scores USING (ticker, id) WHERE vector IS NOT NULL)
        SELECT CAST(i - 1 AS INTEGER) AS i, CAST(j - 1 AS INTEGER) AS j, CAST(sum(CAST(m[i] AS HUGEINT) * m[j]) AS VARCHAR) AS total
        FROM design, range(1, 70) AS a(i), range(1, 70) AS b(j) WHERE i <= j GROUP BY ALL"""
    return sql
