import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from newsvane.config import Settings, TopicSettings
from newsvane.dictionaries import LEMMAS, STOPWORDS, lemma_table, lexicon_table, modifier_table
from newsvane.operators import news as news_ops
from newsvane.plans import daily
from newsvane.sources import raw_zone, tables
from newsvane.streaming import ingest

DAY = dt.date(2024, 3, 5)


def epoch(day, hour=9):
    return int(dt.datetime(day.year, day.month, day.day, hour, tzinfo=dt.timezone.utc).timestamp())


def put(root, kind, day, ticker, records):
    folder = root / kind / f"{day:%Y/%m/%d}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{ticker}.json").write_text(json.dumps(records, indent=1))


def article(i, day=DAY, text="strong growth and profit"):
    return {"id": i, "headline": f"Best {text}", "summary": text, "datetime": epoch(day)}


def bar(day, close):
    return {"Date": f"{day}", "Open": close - 1, "High": close + 1, "Low": close - 2, "Close": close, "Volume": 10}


@pytest.fixture
def database(spark, request):
    name = "db_" + "".join(c if c.isalnum() else "_" for c in request.node.name.lower())
    tables.create_database(spark, name)
    return name


def test_daily_scan_takes_the_ticker_from_the_file_name(spark, tmp_path):
    put(tmp_path, "news", DAY, "BRK-B", [article(1), article(2)])
    put(tmp_path, "news", DAY, "AAPL", [article(3)])
    put(tmp_path, "news", DAY + dt.timedelta(days=1), "AAPL", [article(4)])
    got = raw_zone.read_daily(spark, str(tmp_path), "news", DAY)
    assert sorted((r["ticker"], r["id"]) for r in got.collect()) == [("AAPL", 3), ("BRK-B", 1), ("BRK-B", 2)]
    published = news_ops.normalize_news(got).select(F.to_date("published_at")).distinct().collect()
    assert published == [(DAY,)]


def test_history_scan_drops_malformed_records_and_reads_names_with_blanks(spark, tmp_path):
    put(tmp_path, "market", DAY, "AAPL", [{**bar(DAY, 10.0), "Stock Splits": 2.0, "Dividends": 0.5}])
    (tmp_path / "market" / "broken.json").write_text('[{"Date": "2024-03-05", "Close": ')
    got = news_ops.normalize_market_history(raw_zone.read_history(spark, str(tmp_path / "market"), "market"))
    rows = got.where("ticker = 'AAPL'").collect()
    assert len(rows) == 1 and got.where("close IS NOT NULL").count() == 1
    assert (rows[0]["trade_date"], rows[0]["stock_splits"], rows[0]["dividends"]) == (DAY, 2.0, 0.5)


def test_malformed_dates_become_null(rows):
    raw = rows(
        [("A", "not a date", 1.0, 1.0, 1.0, 1.0, 1)],
        "ticker string, Date string, Open double, High double, Low double, Close double, Volume bigint",
    )
    assert news_ops.normalize_market(raw).first()["trade_date"] is None


def test_article_files(spark, tmp_path):
    content = {"id": "u1", "title": "T", "summary": "<p>x</p>", "pubDate": "2024-03-05T10:00:00Z"}
    records = [{"id": "1", "content": content}, {"id": "2", "content": {**content, "id": None}}]
    (tmp_path / "AAPL.json").write_text(json.dumps(records, indent=2))
    got = raw_zone.read_articles(spark, f"{tmp_path}/*.json").collect()
    assert [(r["ticker"], r["uuid"], r["title"]) for r in got] == [("AAPL", "u1", "T")]


def test_articles_merge_with_prices(rows):
    articles = rows(
        [("A", "u1", "T", "<p>x &amp; y</p>", "2024-03-05T10:00:00Z"), ("A", "u2", "T", None, "2024-03-09T10:00:00Z")],
        "ticker string, uuid string, title string, summary string, published string",
    )
    bars = rows([("A", DAY, 10.0, 11.0)], "ticker string, trade_date date, open_price double, close_price double")
    assert [tuple(r) for r in news_ops.merge_articles(articles, bars).collect()] == [
        ("A", DAY, "u1", "T", "x & y", 10.0, 11.0, 0.1)
    ]


def test_landing_round_trip_and_listing(spark, tmp_path, rows):
    zone = str(tmp_path / "zone")
    fetched = rows(
        [("news", DAY, "A", 1, "h", "s", 5), ("news", DAY, "B", 2, "h", "s", 6)],
        "kind string, run_date date, ticker string, id bigint, headline string, summary string, datetime bigint",
    )
    raw_zone.land(fetched, zone)
    raw_zone.land(fetched, zone)
    got = raw_zone.read_landed(spark, zone, "news").select("ticker", "id", "run_date").orderBy("id").collect()
    assert [tuple(r) for r in got] == [("A", 1, DAY), ("B", 2, DAY)]
    listed = raw_zone.list_files(spark, zone)
    assert listed.count() == 2 and listed.where("length > 0").count() == 2


def test_writing_a_day_twice_adds_nothing(spark, rows, database):
    df = rows([("A", 1), ("B", 2)], "ticker string, id bigint")
    table = f"{database}.t"
    assert tables.write_day(df, table, DAY) == 2
    assert tables.write_day(df, table, DAY) == 2
    tables.write_day(df, table, DAY + dt.timedelta(days=1))
    assert spark.read.table(table).count() == 4
    assert tables.read_day(spark, table, DAY).count() == 2
    assert tables.list_tables(spark, database) == ["t"]
    assert tables.preview(spark, table, 3).count() == 3


def test_replacing_a_table_can_read_the_old_one(spark, rows, database):
    table = f"{database}.r"
    tables.replace_table(rows([(1,)], "id bigint"), table)
    grown = spark.read.table(table).union(rows([(2,)], "id bigint"))
    assert tables.replace_table(grown, table) == 2
    assert sorted(r["id"] for r in spark.read.table(table).collect()) == [1, 2]


def test_a_failing_rebuild_keeps_the_old_table(spark, rows, database):
    table = f"{database}.k"
    tables.replace_table(rows([(1,)], "id bigint"), table)
    with pytest.raises(Exception):
        tables.replace_table(rows([(0,)], "id bigint").select((F.lit(1) / F.col("id")).alias("id")), table)
    assert spark.read.table(table).count() == 1


def test_readers_find_the_old_table_until_the_view_moves(spark, rows, database, monkeypatch):
    """A failure after the new version is written and before readers are pointed at it."""
    table = f"{database}.v"
    tables.replace_table(rows([(1,)], "id bigint"), table)
    sql = spark.sql
    asked = []

    def failing(text, *args, **kwargs):
        asked.append(text)
        if text.startswith("CREATE OR REPLACE VIEW"):
            assert spark.read.table(table).count() == 1
            raise RuntimeError("stopped here")
        return sql(text, *args, **kwargs)

    monkeypatch.setattr(spark, "sql", failing)
    with pytest.raises(RuntimeError):
        tables.replace_table(rows([(1,), (2,)], "id bigint"), table)
    monkeypatch.setattr(spark, "sql", sql)
    assert spark.read.table(table).count() == 1 and not any("DROP" in text for text in asked)
    tables.replace_table(rows([(1,), (2,), (3,)], "id bigint"), table)
    assert spark.read.table(table).count() == 3 and tables.list_tables(spark, database) == ["v"]
    versions = [t.name for t in spark.catalog.listTables(database) if tables.VERSION in t.name]
    assert len(versions) == 2


def test_a_plain_table_becomes_a_version(spark, rows, database):
    table = f"{database}.p"
    rows([(1,)], "id bigint").write.saveAsTable(table)
    tables.replace_table(rows([(2,)], "id bigint"), table)
    assert [r["id"] for r in spark.read.table(table).collect()] == [2]


def test_writes_leave_the_session_alone(spark, rows, database):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        df = rows([("A", 1)], "ticker string, id bigint")
        for day in (DAY, DAY + dt.timedelta(days=1), DAY):
            tables.write_day(df, f"{database}.s", day)
        assert spark.read.table(f"{database}.s").count() == 2
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "static"
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def test_large_dictionaries_are_joined(spark, rows, monkeypatch):
    news = rows([("A", 1, None, "rising prices", "gains rose"), (None, None, None, "x rising", None)],
                "ticker string, id bigint, published_at timestamp, title string, summary string")
    inline = daily.analyse_news(news, STOPWORDS, LEMMAS).collect()
    from newsvane.dictionaries import lemma_table

    by_table = daily.analyse_news(news, STOPWORDS, lemma_table(spark)).collect()
    monkeypatch.setattr(daily, "INLINE_DICTIONARY_LIMIT", 3)
    by_size = daily.analyse_news(news, STOPWORDS, LEMMAS).collect()
    assert sorted(inline, key=str) == sorted(by_table, key=str) == sorted(by_size, key=str)
    assert {tuple(r["title_lemmas"]) for r in inline} == {("rise", "price"), ("rise",)}


def test_exports(spark, rows, tmp_path):
    df = rows([(1, "a"), (2, "b")], "id bigint, t string")
    tables.write_parquet(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
    tables.export_csv(df.limit(1), str(tmp_path / "c"), single_row=True)
    assert len(list((tmp_path / "c").glob("*.csv"))) == 1
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["id", "t"]


def test_stream_stores_every_article_once(spark, tmp_path, database):
    zone, table = tmp_path / "zone", f"{database}.stream"
    put(zone, "news", DAY, "A", [article(1), article(2), article(2)])
    path = f"{zone}/news/*/*/*/*.json"

    def run():
        ingest.ingest_available(
            spark, path, table, str(tmp_path / "checkpoint"), STOPWORDS, LEMMAS
        ).awaitTermination()
        return sorted((r["ticker"], r["id"], r["run_date"]) for r in spark.read.table(table).collect())

    assert run() == [("A", 1, DAY), ("A", 2, DAY)]
    assert run() == [("A", 1, DAY), ("A", 2, DAY)]
    later = DAY + dt.timedelta(days=1)
    put(zone, "news", later, "A", [article(2), article(3, later)])
    assert run() == [("A", 1, DAY), ("A", 2, DAY), ("A", 3, later)]


def test_stream_scores_and_knows_articles_after_long(spark, tmp_path, database):
    zone, table, scores = tmp_path / "zone", f"{database}.stream", f"{database}.scores"
    scoring = ingest.Scoring(scores, lexicon_table(spark), modifier_table(spark))
    path = f"{zone}/news/*/*/*/*.json"
    # The same article twice in one batch, under two run dates: the later one counts.
    put(zone, "news", DAY, "A", [article(1), article(2, text="weak loss")])
    put(zone, "news", DAY + dt.timedelta(days=1), "A", [article(2, text="good gain")])

    def run(**options):
        query = ingest.ingest_available(
            spark, path, table, str(tmp_path / "checkpoint"), STOPWORDS, LEMMAS, scoring, **options
        )
        assert query.awaitTermination(120)
        return query

    run()
    assert [(r.id, r.summary) for r in spark.read.table(table).orderBy("id").collect()] == [
        (1, "strong growth and profit"), (2, "good gain")
    ]
    scored = spark.read.table(scores).orderBy("id").collect()
    by_hand = daily.score_articles(spark.read.table(table), scoring.lexicon, scoring.modifiers, scoring.cuts).orderBy("id")
    assert [r.vd_comp_summary_token for r in scored] == [r.vd_comp_summary_token for r in by_hand.collect()]
    # Half a year later both come again with one that is new; the query is a new one on the old checkpoint.
    later = DAY + dt.timedelta(days=180)
    put(zone, "news", later, "A", [article(1, text="changed"), article(2), article(3, later)])
    query = run()
    for name in (table, scores):
        assert sorted((r.id, r.run_date) for r in spark.read.table(name).collect()) == [
            (1, DAY), (2, DAY + dt.timedelta(days=1)), (3, later)
        ]
    # What is known is state, not a scan of the tables.
    plan = query._jsq.toString() + query.lastProgress["sources"][0]["description"]
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 3 and database not in plan


def test_state_expires_and_rows_without_a_key_stay(spark, tmp_path, database):
    zone, table = tmp_path / "zone", f"{database}.stream"
    path = f"{zone}/news/*/*/*/*.json"

    def run():
        ingest.ingest_available(
            spark, path, table, str(tmp_path / "checkpoint"), STOPWORDS, LEMMAS, horizon_ms=1
        ).awaitTermination(120)
        return spark.read.table(table)

    put(zone, "news", DAY, "A", [article(1), article(None), article(None)])
    assert run().count() == 3
    # A run in which the article does not come lets its state go.
    put(zone, "news", DAY, "B", [article(5)])
    run()
    put(zone, "news", DAY + dt.timedelta(days=1), "A", [article(1)])
    assert run().where("ticker = 'A' AND id = 1").count() == 2


def test_a_repeated_batch_replaces_itself(spark, rows, database):
    batch = rows(
        [("A", 1, "h", "s", epoch(DAY), DAY)],
        "ticker string, id bigint, headline string, summary string, datetime bigint, run_date date",
    )
    for _ in range(2):
        ingest.store_batch(batch, 0, f"{database}.b", STOPWORDS, LEMMAS)
    assert spark.read.table(f"{database}.b").count() == 1


def test_all_jobs_of_two_days(spark, tmp_path, database):
    cfg = Settings(raw_zone=str(tmp_path), database=database, topics=TopicSettings(iterations=2))
    days = [DAY, DAY + dt.timedelta(days=1)]
    with pytest.raises(LookupError):
        daily.run_all(spark, cfg, DAY)
    for name, words in {
        daily.STOPWORDS_TABLE: spark.createDataFrame([(w,) for w in STOPWORDS], "w string"),
        daily.LEMMAS_TABLE: lemma_table(spark), daily.LEXICON_TABLE: lexicon_table(spark), daily.MODIFIERS_TABLE: modifier_table(spark),
    }.items():
        words.write.saveAsTable(cfg.table(name))
    texts = ["strong growth and profit", "weak loss and lawsuit risk", "good gain but plunge fear"]
    for n, run_date in enumerate(days):
        for ticker in ("AAPL", "MSFT"):
            fetched = [article(100 * n + i, run_date, texts[(i + n) % 3]) for i in range(4)]
            put(tmp_path, "news", run_date, ticker, fetched)
            # The price feed sends the last days again on every run.
            put(tmp_path, "market", run_date, ticker, [bar(d, 10.0 + i) for i, d in enumerate(days[: n + 1])])
    for run_date in days:
        results = daily.run_all(spark, cfg, run_date)
    before = {t: spark.read.table(f"{database}.{t}").count() for t in tables.list_tables(spark, database)}
    assert before["daily_news_nlp"] == 16 and before["comprehensive_sentiment_scores"] == 16
    assert before["trading_signals"] == 2  # the first day of each ticker has no deviation
    # On the first day a ticker has four articles: too few for topics and for a report.
    assert before["daily_news_topics"] == 16 and before["report_manifest"] == 2
    assert len(spark.read.table(f"{database}.comprehensive_sentiment_scores").columns) == 30
    assert results["backtest_job"].count() == 1
    # The manifest names the tables that hold what it lists.
    for r in results["report_job"].collect():
        for url in (r["wordcloud_url"], r["ldavis_url"]):
            name, _, where = url.partition("?")
            day, ticker = (part.split("=")[1] for part in where.split("&"))
            assert spark.read.table(name).where((F.col("run_date") == day) & (F.col("ticker") == ticker)).count() > 0
    for name in (
        "report_bigrams", "report_collocations", "report_topic_distance", "report_topic_sizes", "report_topic_layout",
        "report_term_saliency",
    ):
        assert before[name] > 0
    reports = str(tmp_path / "reports")
    cfg = Settings(raw_zone=str(tmp_path), database=database, report_root=reports, topics=cfg.topics)
    report = daily.comparison_job(spark, cfg, days[-1]).collect()
    assert len(report) == 1 and 0 <= report[0]["agreement_pct"] <= 100
    assert spark.read.option("header", True).csv(f"{reports}/agreement_*").count() == 1
    predicted = daily.prediction_job(spark, cfg, days[-1], size=4, min_count=1, rounds=2)
    assert len(spark.read.table(f"{database}.news_score_heads").collect()) == 4
    assert predicted.count() == 16 and "pred_tb_pol_title_token" in predicted.columns
    before = {t: spark.read.table(f"{database}.{t}").count() for t in tables.list_tables(spark, database)}
    daily.run_all(spark, cfg, days[-1])
    after = {t: spark.read.table(f"{database}.{t}").count() for t in tables.list_tables(spark, database)}
    assert after == before


def test_gaps_are_the_days_that_did_not_land(rows):
    import random

    rng = random.Random(5)
    first = dt.date(2024, 1, 1)

    def windows(symbols, count, longest):
        out = []
        for _ in range(count):
            start = rng.randint(0, 60)
            out.append((rng.choice(symbols), first + dt.timedelta(days=start), first + dt.timedelta(days=start + rng.randint(-1, longest))))
        return out

    plan, landed = windows("ABCD", 25, 20), windows("ABC", 20, 6) + [("A", None, first), (None, first, first), ("E", first, first)]
    schema = "symbol string, from_date date, to_date date"

    def days(rows_):
        return {(s, d + dt.timedelta(days=k)) for s, d, e in rows_ if s and d and e for k in range((e - d).days + 1)}

    got = [tuple(r) for r in news_ops.fetch_gaps(rows(plan, schema), rows(landed, schema)).collect()]
    assert days(got) == days(plan) - days(landed) and len(days(got)) == sum((e - d).days + 1 for _, d, e in got)
    # Windows are as long as they can be but where a plan's own windows part.
    merged = [tuple(r) for r in news_ops.merged_windows(rows(got, schema)).collect()]
    assert sorted(merged) == sorted(got)
    assert news_ops.fetch_gaps(rows(plan, schema).where("false"), rows(landed, schema)).collect() == []


def test_schema_of_drifting_files_and_what_is_no_record(spark, tmp_path):
    texts = {
        "AAPL": '[{"Date": "2024-01-01", "Close": 1, "Stock Splits": 0.5, "none": null}, {"Date": "x", "Close": 2, "more": {"VOID": [1]}}, 7, null]',
        "2024/MSFT": '{"Date": "2024-01-02", "Close": 3, "mixed": "high"}',
        "2024/GOOG": '[{"mixed": 4}, {}]',
        "BROKEN": '[{"Date": "2024',
        "EMPTY": "[]",
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.json").parent.mkdir(exist_ok=True)
        (tmp_path / f"{name}.json").write_text(text)
    made, rejects = raw_zone.read_inferred(spark, str(tmp_path))
    kinds = dict(made.dtypes)
    assert kinds == {
        "ticker": "string", "Close": "bigint", "Date": "string", "Stock Splits": "double", "mixed": "string",
        "more": "struct<VOID:array<bigint>>", "none": "string",
    }
    got = sorted(((r.ticker, r.Date, r.Close, r["Stock Splits"], r.mixed) for r in made.collect()), key=str)
    assert got == sorted([
        ("AAPL", "2024-01-01", 1, 0.5, None), ("AAPL", "x", 2, None, None), ("MSFT", "2024-01-02", 3, None, "high"),
        ("GOOG", None, None, None, "4"), ("GOOG", None, None, None, None),
    ], key=str)
    left = sorted((r.file.rsplit("/", 1)[1], r.place, r.reason) for r in rejects.collect())
    assert left == [("AAPL.json", 2, "no object"), ("AAPL.json", 3, "no object"), ("BROKEN.json", None, "no JSON, or too large")]
