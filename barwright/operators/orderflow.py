"""Order-flow features C1-C10 from exchange bar fields.

Columns: tbb_ratio, tbq_ratio, intensity, r1, signed_volume and, per window w,
rv_w, intensity_mean_w, vol_mean_w, sv_mean_w, hl_mean_w.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from barwright.operators.windows import Frames

# The default rolling windows (in bars) of the order-flow set.
DEFAULT_WINDOWS = (60, 300, 900)
REQUIRED = ("volume", "quote_volume", "taker_buy_base", "taker_buy_quote", "num_trades")


def orderflow_columns(windows: Sequence[int] = DEFAULT_WINDOWS) -> list[str]:
    cols = ["tbb_ratio", "tbq_ratio", "intensity", "r1", "signed_volume"]
    for w in windows:
        cols += [f"rv_{w}", f"intensity_mean_{w}", f"vol_mean_{w}", f"sv_mean_{w}", f"hl_mean_{w}"]
    return cols


def add_orderflow(df: DataFrame, frames: Frames, windows: Sequence[int] = DEFAULT_WINDOWS) -> DataFrame:
    """Append C1-C10. Returns the input unchanged when an exchange field is missing.

    Written with the same SQL window builder as the native indicators, so
    window calls shared by several columns (running counts, sums) are
    computed once.
    """
    from barwright.functions.native import Sql
    from barwright.functions.registry import run_stages

    if not set(REQUIRED).issubset(df.columns):
        return df
    w = Sql(frames.keys, frames.order, frames.threshold)
    tbb = "(`taker_buy_base` / CASE WHEN `volume` = 0 THEN 1D ELSE `volume` END)"
    tbq = "(`taker_buy_quote` / CASE WHEN `quote_volume` = 0 THEN 1D ELSE `quote_volume` END)"
    sv = f"(({tbb} * 2D - 1D) * `volume`)"
    hl = "(`high` - `low`)"
    r1 = f"(ln(`close`) - {w.lag('ln(`close`)')})"
    stage1 = [("tbb_ratio", tbb), ("tbq_ratio", tbq), ("intensity", "`num_trades`"), ("r1", r1),
              ("signed_volume", sv)]
    for n in windows:
        stage1 += [(f"intensity_mean_{n}", w.mean("CAST(`num_trades` AS DOUBLE)", n)),
                   (f"vol_mean_{n}", w.mean("`volume`", n)),
                   (f"sv_mean_{n}", w.mean(sv, n)),
                   (f"hl_mean_{n}", w.mean(hl, n))]
    # r1 is itself a window expression, so its rolling sum is a second stage
    # over the same partitioning (no extra shuffle or sort).
    stage2 = [(f"rv_{n}", w.sum("(`r1` * `r1`)", n)) for n in windows]
    out = run_stages(df, w, [stage1, stage2])
    return out.selectExpr(*[f"`{c}`" for c in df.columns + orderflow_columns(windows)])
