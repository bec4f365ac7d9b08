"""Long-only trades on signals, as window expressions over one row per ticker and day.

A buy signal opens a position when flat, a sell signal closes it when held; orders fill at the
next bar's price, and an order on the last bar never fills. All money is counted in millionths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from newsvane.config import SignalSettings
from newsvane.functions.numeric import micros_sql, round_sql

_BY_DATE = "(PARTITION BY ticker ORDER BY trade_date)"
_SO_FAR = "(PARTITION BY ticker ORDER BY trade_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def position_state(signals: DataFrame) -> DataFrame:
    """Position wanted after each bar: the last signal that was not 0 decides."""
    last = f"last(CASE WHEN signal <> 0 THEN signal END, true) OVER {_SO_FAR}"
    return signals.selectExpr("*", f"CASE WHEN {last} = 1 THEN 1 ELSE 0 END AS position")


def _orders(signals: DataFrame, settings: SignalSettings) -> DataFrame:
    """Every bar with the order placed on it (+1 buy, -1 sell, 0 none) and that order's fill.

    All windows share one partitioning, so the bars are shuffled once. Tickers with too few bars
    are left out.
    """
    counted = signals.selectExpr("*", "count(*) OVER (PARTITION BY ticker) AS bars")
    traded = counted.where(f"bars >= {settings.min_bars}").drop("bars")
    return position_state(traded).selectExpr(
        "*",
        f"position - coalesce(lag(position) OVER {_BY_DATE}, 0) AS placed",
        f"lead(trade_date) OVER {_BY_DATE} AS fill_date",
        f"lead(close_price) OVER {_BY_DATE} AS fill_price",
    )


def _fee_micros(price: str, settings: SignalSettings) -> str:
    return micros_sql(f"{price} * {float(settings.lot_size)}D * {settings.fee_rate}D")


def trades(signals: DataFrame, settings: SignalSettings = SignalSettings()) -> DataFrame:
    """Filled orders, numbered per ticker."""
    filled = _orders(signals, settings).where("placed <> 0 AND fill_date IS NOT NULL")
    return filled.selectExpr(
        "ticker",
        f"row_number() OVER {_BY_DATE} AS trade_no",
        "trade_date AS signal_date",
        "CASE WHEN placed = 1 THEN 'buy' ELSE 'sell' END AS side",
        "fill_date",
        "fill_price",
        f"{settings.lot_size} AS quantity",
        f"{_fee_micros('fill_price', settings)} / 1e6D AS fee",
    )


def trade_pnl(filled: DataFrame) -> DataFrame:
    """Round trips: every buy with the sell that closes it, if any."""
    paired = filled.selectExpr(
        "*",
        *[
            f"lead({c}) OVER (PARTITION BY ticker ORDER BY trade_no) AS exit_{n}"
            for c, n in (("fill_date", "date"), ("fill_price", "price"), ("fee", "fee"))
        ],
    ).where("side = 'buy'")
    gross = "(exit_price - fill_price) * quantity"
    return paired.selectExpr(
        "ticker",
        "fill_date AS entry_date",
        "fill_price AS entry_price",
        "exit_date",
        "exit_price",
        "quantity",
        f"{round_sql(gross, 6)} AS gross_pnl",
        f"{round_sql(f'{gross} - fee - exit_fee', 6)} AS net_pnl",
        "exit_date IS NULL AS is_open",
    )


def equity_curve(signals: DataFrame, settings: SignalSettings = SignalSettings()) -> DataFrame:
    """Cash and value of the whole portfolio per day, tickers without a bar keeping their last price.

    Each ticker contributes the day-to-day change of its own cash and holdings; summing the changes
    up to a day gives the portfolio without pairing every ticker with every day.
    """
    lot = settings.lot_size
    moved = _orders(signals, settings).selectExpr(
        "ticker",
        "trade_date",
        f"{micros_sql('close_price')} AS price",
        f"coalesce(lag(placed) OVER {_BY_DATE}, 0) AS filled",
        f"{_fee_micros('close_price', settings)} AS fee",
    )
    held = moved.selectExpr(
        "*",
        f"sum(filled) OVER {_SO_FAR} * {lot} * price AS worth",
        f"-filled * price * {lot} - abs(filled) * fee AS cash_move",
    )
    daily = (
        held.selectExpr("*", f"worth - coalesce(lag(worth) OVER {_BY_DATE}, 0) AS worth_move")
        .groupBy("trade_date")
        .agg({"cash_move": "sum", "worth_move": "sum", "filled": "sum"})
    )
    # One row per day: the whole table is as long as the calendar.
    days = "(ORDER BY trade_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    start = int(settings.initial_cash * 1_000_000)
    return daily.selectExpr(
        "trade_date",
        f"sum(`sum(filled)`) OVER {days} AS open_positions",
        f"{start} + sum(`sum(cash_move)`) OVER {days} AS cash",
        f"sum(`sum(worth_move)`) OVER {days} AS worth",
    ).selectExpr(
        "trade_date",
        "open_positions",
        "cash / 1e6D AS cash",
        "worth / 1e6D AS holdings",
        "(cash + worth) / 1e6D AS equity",
    )


def backtest_summary(curve: DataFrame, settings: SignalSettings = SignalSettings()) -> DataFrame:
    """One row: final value, profit, profit in percent, and the least cash ever held."""
    start = f"{settings.initial_cash}D"
    final = "max_by(equity, trade_date)"
    totals = curve.selectExpr(f"{final} AS final_value", "min(cash) AS min_cash", "count(*) AS days")
    return totals.selectExpr(
        f"{start} AS initial_cash",
        "final_value",
        f"{round_sql(f'final_value - {start}', 6)} AS pnl",
        f"{round_sql(f'(final_value - {start}) / {start} * 100D', 4)} AS pnl_pct",
        "min_cash",
        "days",
    )
