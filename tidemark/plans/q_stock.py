"""Registered price queries: panel, calendar gate, returns and targets."""

from __future__ import annotations

from tidemark.operators import panel as P
from tidemark.operators import targets as TG
from tidemark.plans import oracle as O
from tidemark.plans.registry import register, rounded
from tidemark.session import cut_lineage
from tidemark.sources import fixtures as FX


# events keep the reference's first-symbol gate; the orders fixture counts
# every order date as a trading day
GATES = {"events": "first_symbol", "orders": "any"}


def panel_inputs(spark, sf_dir, source="events"):
    """(bars, symbol dimension, trading dates). Bars and dimension are read by
    the gate, the grid and the panel, so they are derived once and kept as
    checkpoints in the shared folder."""
    b = cut_lineage(FX.bars(spark, sf_dir, source))
    s = cut_lineage(FX.symbols_from_bars(b))
    d = P.trading_dates(b, s, GATES[source])
    return b, s, d


def target_table(spark, sf_dir, source="events"):
    b, s, d = panel_inputs(spark, sf_dir, source)
    return TG.daily_targets(P.dense_panel(b, s, d))


@register("trading_day_gate", O.with_(O.BARS_EVENTS, O.SYMBOLS, O.TDATES) +
          "SELECT localDate FROM tdates")
def q_trading_day_gate(spark, sf_dir):
    b, s, d = panel_inputs(spark, sf_dir)
    return d


@register("dense_panel_zero_fill", O.with_(O.BARS_EVENTS, O.SYMBOLS, O.TDATES, O.PANEL) +
          "SELECT localDate, id, round(close, 6) AS close, round(high, 6) AS high, "
          "round(low, 6) AS low, round(open, 6) AS open, volume FROM panel")
def q_dense_panel(spark, sf_dir):
    b, s, d = panel_inputs(spark, sf_dir)
    return rounded(P.dense_panel(b, s, d).drop("pos"))


def _lr_query(h):
    sql = (O.with_(O.BARS_EVENTS, O.SYMBOLS, O.TDATES, O.PANEL, O.RETURNS) +
           f"SELECT localDate, id, round(log_return_{h}d, 6) AS log_return_{h}d FROM lr")

    @register(f"log_return_{h}d", sql)
    def q(spark, sf_dir):
        b, s, d = panel_inputs(spark, sf_dir)
        r = TG.log_returns(P.dense_panel(b, s, d), horizons=(h,))
        return rounded(r.select("localDate", "id", f"log_return_{h}d"))
    return q


for _h in (1, 3, 5):
    _lr_query(_h)


@register("cross_section_stats",
          O.with_(O.BARS_EVENTS, O.SYMBOLS, O.TDATES, O.PANEL, O.RETURNS, O.XSTATS) +
          "SELECT localDate, round(mean_1d, 6) AS mean_1d, round(std_1d, 6) AS std_1d, "
          "n_symbols FROM xstats")
def q_cross_section_stats(spark, sf_dir):
    b, s, d = panel_inputs(spark, sf_dir)
    r = TG.log_returns(P.dense_panel(b, s, d), horizons=(1,))
    return rounded(TG.cross_section_stats(r))


def _target_col_query(col):
    sql = O.with_(*O.target_chain()) + f"SELECT localDate, id, round({col}, 6) AS {col} FROM targets"
    if col == "direction_1d":
        sql = O.with_(*O.target_chain()) + "SELECT localDate, id, direction_1d FROM targets"

    @register(col, sql)
    def q(spark, sf_dir):
        return rounded(target_table(spark, sf_dir).select("localDate", "id", col))
    return q


for _c in ("zscore_1d", "rank_1d", "direction_1d"):
    _target_col_query(_c)


TARGETS_SELECT = ("SELECT localDate, id, round(log_return_1d, 6) AS log_return_1d, "
                  "round(log_return_3d, 6) AS log_return_3d, round(log_return_5d, 6) AS log_return_5d, "
                  "round(zscore_1d, 6) AS zscore_1d, round(rank_1d, 6) AS rank_1d, direction_1d "
                  "FROM targets")


@register("daily_targets", O.with_(*O.target_chain()) + TARGETS_SELECT)
def q_daily_targets(spark, sf_dir):
    return rounded(target_table(spark, sf_dir).drop("pos"))


@register("incremental_history",
          O.with_(*O.target_chain(O.BARS_ORDERS)) + TARGETS_SELECT +
          " WHERE localDate > DATE '1998-06-30'")
def q_incremental_history(spark, sf_dir):
    """Targets for dates after a cut computed from the new slice plus the
    seeded 5-row history only; the oracle is the full computation."""
    b, s, d = panel_inputs(spark, sf_dir, "orders")
    t = TG.incremental_targets(P.dense_panel(b, s, d), "1998-06-30")
    return rounded(t.drop("pos"))
