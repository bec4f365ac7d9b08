import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from newsvane.config import SignalSettings
from newsvane.operators import compare, news, signals, trading

DAY = dt.date(2024, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def daily(rows, values, ticker="A"):
    data = [(ticker, day(i), float(c), float(s), 1) for i, (c, s) in enumerate(values)]
    return rows(data, "ticker string, trade_date date, close_price double, avg_score double, news_count bigint")


def signal_rows(rows, per_ticker):
    data = [
        (t, day(i), float(c), s) for t, bars in per_ticker.items() for i, (s, c) in enumerate(bars)
    ]
    return rows(data, "ticker string, trade_date date, close_price double, signal int")


def test_first_row_has_no_deviation_and_equal_rows_give_zero(rows):
    got = signals.rolling_statistics(daily(rows, [(10, 0.1)] * 3)).orderBy("trade_date").collect()
    assert got[0]["sentiment_z_score"] is None
    assert [r["sentiment_std_20"] for r in got[1:]] == [0.0, 0.0]
    assert [r["sentiment_z_score"] for r in got[1:]] == [0.0, 0.0]


def test_window_is_twenty_rows(rows):
    got = signals.rolling_statistics(daily(rows, [(i, i / 100) for i in range(21)])).orderBy("trade_date").collect()
    assert got[19]["sma_20"] == 9.5
    assert got[20]["sma_20"] == 10.5
    expected = statistics.stdev([i / 100 for i in range(1, 21)])
    assert got[20]["sentiment_std_20"] == pytest.approx(expected, abs=1e-6)


@pytest.mark.parametrize(
    "close, sma, z, signal",
    [(2.0, 1.0, 1.5, 0), (2.0, 1.0, 1.6, 1), (1.0, 1.0, 2.0, 0), (1.0, 2.0, -1.6, -1), (2.0, 1.0, -1.6, 0)],
)
def test_signal_boundaries(rows, close, sma, z, signal):
    df = rows([(close, sma, z)], "close_price double, sma_20 double, sentiment_z_score double")
    assert df.select(signals.signal_column()).first()[0] == signal


def test_weekend_news_is_dropped_and_duplicate_prices_resolved(rows):
    scored = rows(
        [("A", 1, day(0), 0.5), ("A", 2, day(0), 0.1), ("A", 3, day(5), 0.9)],
        "ticker string, id bigint, trade_date date, compound double",
    )
    bars = rows(
        [("A", day(0), 10.0, 1), ("A", day(0), 11.0, 2)],
        "ticker string, trade_date date, close_price double, run_date int",
    )
    got = signals.daily_sentiment(scored, news.dedup_fetches(bars, "ticker", "trade_date"), "compound").collect()
    assert [tuple(r) for r in got] == [("A", day(0), 11.0, 0.3, 2)]


def test_known_trades(rows):
    bars = list(zip([0, -1, 1, 1, -1, 1], [10, 11, 12, 13, 14, 15]))
    got = trading.trades(signal_rows(rows, {"A": bars})).orderBy("trade_no").collect()
    assert [(r["side"], r["fill_date"], r["fill_price"]) for r in got] == [
        ("buy", day(3), 13.0), ("sell", day(5), 15.0),
    ]


def state_machine(bars, cfg):
    """Event loop for one ticker: pending order fills at the next bar, then the signal is looked at."""
    holding, pending, fills = False, 0, []
    for i, (signal, close) in enumerate(bars):
        if pending:
            fills.append((i, pending, close))
            holding, pending = pending == 1, 0
        if not holding and signal == 1:
            pending = 1
        elif holding and signal == -1:
            pending = -1
    return fills


def test_trades_and_equity_match_an_event_loop(rows):
    draw, cfg = random.Random(11), SignalSettings()
    per_ticker = {
        f"T{t}": [(draw.choice([-1, 0, 0, 1]), round(draw.uniform(5, 50), 2)) for _ in range(draw.randint(3, 40))]
        for t in range(12)
    }
    df = signal_rows(rows, per_ticker)
    expected = {
        (t, day(i), side, price)
        for t, bars in per_ticker.items() if len(bars) >= cfg.min_bars
        for i, side, price in state_machine(bars, cfg)
    }
    got = {
        (r["ticker"], r["fill_date"], 1 if r["side"] == "buy" else -1, r["fill_price"])
        for r in trading.trades(df, cfg).collect()
    }
    assert got == expected and len(got) > 20

    for r in trading.trades(df, cfg).collect():
        assert r["side"] == ("buy" if r["trade_no"] % 2 else "sell")

    curve = trading.equity_curve(df, cfg).orderBy("trade_date").collect()
    for r in curve:
        cash, worth = cfg.initial_cash, 0.0
        for t, bars in per_ticker.items():
            if len(bars) < cfg.min_bars:
                continue
            for _, date, side, price in (e for e in expected if e[0] == t):
                if date <= r["trade_date"]:
                    cash -= side * price * cfg.lot_size + price * cfg.lot_size * cfg.fee_rate
            shares = sum(s * cfg.lot_size for tt, d, s, _ in expected if tt == t and d <= r["trade_date"])
            known = [c for i, (_, c) in enumerate(bars) if day(i) <= r["trade_date"]]
            worth += shares * known[-1]
        assert r["cash"] == pytest.approx(cash, abs=1e-4)
        assert r["equity"] == pytest.approx(cash + worth, abs=1e-4)

    summary = trading.backtest_summary(trading.equity_curve(df, cfg), cfg).first()
    assert summary["final_value"] == curve[-1]["equity"]
    assert summary["min_cash"] == min(r["cash"] for r in curve)


def test_round_trips(rows):
    bars = list(zip([1, 0, -1, 0, 1, 0], [10, 11, 12, 13, 14, 15]))
    got = trading.trade_pnl(trading.trades(signal_rows(rows, {"A": bars}))).orderBy("entry_date").collect()
    closed, still_open = got
    assert closed["gross_pnl"] == 40.0
    assert closed["net_pnl"] == pytest.approx(40 - 20 * 11 * 0.001 - 20 * 13 * 0.001)
    assert (still_open["is_open"], still_open["net_pnl"]) == (True, None)


def test_constant_scores_have_no_correlation_and_raise_no_error(rows):
    df = rows(
        [(1, 0.5, "positive", 0.1, "positive"), (2, 0.5, "positive", 0.2, "negative")],
        "id bigint, a_score double, a_label string, b_score double, b_label string",
    )
    report = compare.agreement_report(compare.compare_pair(df, ("a", "b")), ("a", "b")).first()
    assert report["pearson"] is None
    assert (report["agreement_pct"], report["opposite_pct"], report["mean_abs_diff"]) == (50.0, 50.0, 0.35)


def test_pairing_goes_by_the_whole_key(rows):
    schema = "ticker string, id bigint, score double, label string"
    left = rows([("A", 1, 0.5, "x"), ("B", 1, 0.2, "x"), ("A", 2, 0.1, "y")], schema)
    right = rows([("A", 1, 0.4, "x"), ("B", 1, 0.9, "z")], schema)
    got = {tuple(r) for r in compare.pair_scorings(left, right, ["ticker", "id"], ("a", "b")).collect()}
    assert got == {("A", 1, 0.5, "x", 0.4, "x"), ("B", 1, 0.2, "x", 0.9, "z")}


def test_comparisons_aggregate_once_per_article(spark):
    """The two scores of an article stand on one row: one aggregate, and only titles are scored."""
    from newsvane.plans.registry import QUERIES

    for name in ("compare_token_lemma", "compare_scorers"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution()
        executed = plan.executedPlan().toString()
        assert "SortAggregate" not in executed
        assert plan.optimizedPlan().toString().count("Aggregate [") == 1
    assert "substring_index(text" in QUERIES["compare_token_lemma"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()


def test_document_plans_begin_with_the_scan(spark):
    from newsvane.plans.registry import QUERIES

    for name in ("clean_text", "tokenize", "lemmatize", "html_to_text", "report_line_clean"):
        assert "Exchange" not in QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()


def test_as_of_signals_filter_below_the_windows(spark):
    from newsvane.plans.registry import QUERIES

    plan = QUERIES["signals_asof"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    # Spark turns the filter on a day into one on the moment the next day begins, at both scans.
    limit = "2024-01-21 00:00:00"
    assert plan.count(limit) == 2
    assert plan.index("Window") < plan.index(limit)


def test_chart_data(rows):
    df = rows(
        [("A", day(0), 10.0, 9.0, 2.0, 1), ("A", day(1), 10.0, 11.0, -2.0, -1), ("A", day(2), 10.0, 10.0, 0.0, 0)],
        "ticker string, trade_date date, close_price double, sma_20 double, sentiment_z_score double, signal int",
    )
    got = signals.signal_chart_data(df).orderBy("trade_date").collect()
    assert [(r["band"], r["marker"], r["marker_price"], r["z_colour"]) for r in got] == [
        ("above", "buy", 9.8, "green"), ("below", "sell", 10.2, "red"), (None, None, None, "red"),
    ]


def test_fetch_plan_covers_the_year_and_shares_ends(rows):
    plan = news.fetch_plan(rows([("BRK-B",)], "symbol string"), dt.date(2024, 12, 31)).orderBy("chunk").collect()
    assert (plan[0]["to_date"], plan[-1]["from_date"]) == (dt.date(2024, 12, 31), dt.date(2024, 1, 1))
    assert all(a["from_date"] == b["to_date"] for a, b in zip(plan, plan[1:]))
    assert rows([("BRK.B",)], "s string").select(news.market_symbol(F.col("s"))).first()[0] == "BRK-B"
