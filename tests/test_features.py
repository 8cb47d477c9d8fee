"""Feature build properties on the sf0.01 fixture bars."""

from pyspark.sql import functions as F

from conftest import SF01


def _bars(spark, sf=SF01, interval="30m"):
    from barwright.plans.common import bars

    return bars(spark, sf, interval)


def test_warmup_stitch_equals_brute_force(spark):
    from barwright.operators.chunks import stitch_warmup

    b = _bars(spark).select("symbol", "interval", "date", "open_time")
    got = {tuple(r) for r in stitch_warmup(b, 5).select("symbol", "chunk_date", "open_time").collect()}
    rows = b.collect()
    by_day = {}
    for r in rows:
        by_day.setdefault((r.symbol, r.date), []).append(r.open_time)
    import datetime as dt

    want = set()
    for (s, d), ts in by_day.items():
        want |= {(s, d, t) for t in ts}
        want |= {(s, d + dt.timedelta(days=1), t) for t in sorted(ts)[-5:]}
    assert got == want


def test_shuffled_input_same_result(spark):
    from barwright.plans.features import build_features

    specs = [{"kind": "sma", "length": 5}, {"kind": "rsi", "length": 5}, {"kind": "obv"}]
    b = _bars(spark)
    a = build_features(b, specs=specs, orderflow_windows=(6,), mode="daily")
    s = build_features(b.repartition(7).orderBy(F.rand(3)), specs=specs, orderflow_windows=(6,), mode="daily")
    cols = ["symbol", "open_time", "SMA_5", "RSI_5", "OBV", "rv_6"]
    assert a.select(*cols).exceptAll(s.select(*cols)).count() == 0
    assert a.count() == s.count()


def test_daily_equals_continuous_when_warmup_covers(spark):
    from barwright.plans.features import build_features

    specs = [{"kind": "sma", "length": 4}, {"kind": "willr", "length": 4}]
    b = _bars(spark)
    d = build_features(b, specs=specs, orderflow_windows=None, mode="daily", warmup=48)
    c = build_features(b, specs=specs, orderflow_windows=None, mode="continuous")
    j = d.alias("d").join(c.alias("c"), ["symbol", "open_time"])
    # where the chunk had enough rows, the finite-window values agree
    bad = j.where(F.col("d.SMA_4").isNotNull() & (F.abs(F.col("d.SMA_4") - F.col("c.SMA_4")) > 1e-9)).count()
    assert bad == 0


def test_null_count_is_window_minus_one(spark):
    from barwright.plans.features import build_features

    b = _bars(spark)
    f = build_features(b, specs=[{"kind": "sma", "length": 10}], orderflow_windows=None, mode="continuous")
    per = f.groupBy("symbol").agg(F.sum(F.col("SMA_10").isNull().cast("int")).alias("n")).collect()
    assert all(r.n == 9 for r in per)


def test_invalid_specs_warned(spark):
    from barwright.functions.registry import plan_specs

    warnings = []
    plan = plan_specs([{"length": 3}, {"kind": "nope"}, {"kind": "sma", "length": -1},
                       {"kind": "sma", "bogus": 1}, {"kind": "sma", "length": 3}], warnings)
    assert len(warnings) == 4
    assert plan.outputs == ["SMA_3"]


def test_default_set_names():
    from barwright.functions.registry import plan_specs
    from barwright.functions.specs import default_specs

    plan = plan_specs(default_specs()[1])
    assert len(default_specs()[1]) == 207
    assert len(plan.outputs) == 332
    for probe in ("RSI_14", "MACD_12_26_9", "BBM_20_2.0_2.0", "VWAP_D", "OBV", "LOGRET_1", "HA_close"):
        assert probe in plan.outputs


def test_flagship_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert len(df.columns) > 300


def test_halo_stitch_equals_brute_force(spark):
    from barwright.operators.chunks import stitch_halo

    b = _bars(spark).select("symbol", "interval", "date", "open_time")
    halo = 70  # longer than a day of 30-minute bars: spans several days
    got = {tuple(r) for r in stitch_halo(b, halo).select("symbol", "chunk_date", "open_time").collect()}
    series = {}
    for r in b.collect():
        series.setdefault(r.symbol, []).append((r.open_time, r.date))
    want = set()
    for s, rows in series.items():
        rows.sort()
        first_of_day = {}
        for i, (t, d) in enumerate(rows):
            first_of_day.setdefault(d, i)
            want.add((s, d, t))
        for d, i0 in first_of_day.items():
            for t, _ in rows[max(0, i0 - halo):i0]:
                want.add((s, d, t))
    assert got == want


def test_continuous_mode_matches_whole_series(spark):
    from barwright.plans.features import build_features

    b = _bars(spark)
    f = build_features(b, specs=[{"kind": "sma", "length": 100}], orderflow_windows=None, mode="continuous")
    per = f.groupBy("symbol").agg(F.sum(F.col("SMA_100").isNull().cast("int")).alias("n")).collect()
    assert all(r.n == 99 for r in per)  # one series per symbol, no restart at day boundaries


def test_exact_warmup_covers_nested_windows():
    from barwright.functions.registry import halo_rows, warmup_rows

    specs = [{"kind": "entropy", "length": 60}, {"kind": "kst"}, {"kind": "ichimoku", "lookahead": False}]
    assert warmup_rows(specs) == 65           # the per-day tool's rule: longest parameter + 5
    assert halo_rows(specs) >= 2 * 60 - 1     # entropy needs 2L - 1 rows
    assert halo_rows([{"kind": "kst"}]) >= 45  # roc 30 + sma 15
    assert halo_rows([], (60, 300, 900)) == 900


def test_chunk_stage_has_one_exchange(spark):
    """Window stages and the Arrow kernel share the one chunk exchange."""
    from barwright.plans.features import build_features

    specs = [{"kind": "sma", "length": 5}, {"kind": "rsi", "length": 5}, {"kind": "psar"}, {"kind": "bbands", "length": 5, "std": 2.0}]
    f = build_features(_bars(spark), specs=specs, orderflow_windows=(6,), mode="daily")
    plan = f._jdf.queryExecution().executedPlan().toString().split("\n")
    top = next(i for i, line in enumerate(plan) if "FlatMapGroupsInArrow" in line or "FlatMapGroupsInPandas" in line)
    below = [line for line in plan[top:] if "Exchange" in line]
    assert below and "REPARTITION_BY_COL" in below[0]  # no fixed width: adaptive execution may narrow it
    between = plan[top:plan.index(next(line for line in plan[top:] if "REPARTITION_BY_COL" in line))]
    assert sum("Sort [" in line for line in between) <= 1
    assert all("Exchange" not in line for line in plan[:top])


def test_spec_problems_are_told_not_raised(spark):
    """Bad parameters, clashes and refused look-ahead end as warnings; the other specs are built."""
    from barwright.functions.registry import plan_specs

    told = []
    plan = plan_specs([
        {"kind": "ema", "length": "14"}, {"kind": "ema", "length": 2.5}, {"kind": "mad", "length": 0.5}, {"kind": "sma", "length": 2.5},
        {"kind": "ichimoku", "lookahead": True}, {"kind": "kc", "length": 20, "scalar": 1.0}, {"kind": "kc", "length": 20, "scalar": 3.0},
        {"kind": "sma", "length": 5}, {"kind": "log_return", "length": 5}], told)
    assert "SMA_5" in plan.outputs and "LOGRET_5" in plan.outputs and "SMA_2.5" not in plan.outputs
    assert len(told) >= 5 and any("lookahead" in w for w in told)


def test_continuous_mode_tells_what_stays_null(spark):
    from barwright.plans.features import build_features

    told = []
    build_features(_bars(spark), specs=[{"kind": "psar"}], orderflow_windows=None, mode="continuous", warnings=told)
    assert told


def test_look_back_follows_the_builders():
    from barwright.functions.registry import look_back

    assert look_back({"kind": "ichimoku", "senkou": 520}) >= 519 + 25
    assert look_back({"kind": "entropy", "length": 60}) >= 2 * 60 - 2
    assert look_back({"kind": "dpo", "length": 20}) >= 19 + 11


def test_a_nan_leaves_the_window(spark):
    """One NaN or infinite close empties the windows that hold it, and no later ones."""
    from barwright.plans.features import build_features

    rows = [(i * 1000, float(100 + i % 7)) for i in range(400)]
    rows[50], rows[200] = (50_000, float("nan")), (200_000, float("inf"))
    b = spark.createDataFrame(rows, "open_time long, close double").selectExpr(
        "open_time", "close open", "close high", "close low", "close", "1D volume", "open_time + 999 close_time", "1D quote_volume",
        "1L num_trades", "0D taker_buy_base", "0D taker_buy_quote", "'x' exchange", "'S' symbol", "'1s' interval", "DATE'1970-01-01' date")
    f = build_features(b, specs=[{"kind": "sma", "length": 20}, {"kind": "sma", "length": 5}], orderflow_windows=None, mode="daily").toPandas()
    for n in (5, 20):
        assert f[f"SMA_{n}"].notna().sum() == 400 - (n - 1) - 2 * n


def test_flat_windows_have_no_spread(spark):
    from barwright.plans.features import build_features

    rows = [(i * 1000, 2.0 + (i // 200) * 0.1) for i in range(800)]
    b = spark.createDataFrame(rows, "open_time long, close double").selectExpr(
        "open_time", "close open", "close high", "close low", "close", "1D volume", "open_time + 999 close_time", "1D quote_volume",
        "1L num_trades", "0D taker_buy_base", "0D taker_buy_quote", "'x' exchange", "'S' symbol", "'1s' interval", "DATE'1970-01-01' date")
    specs = [{"kind": "zscore", "length": 60}, {"kind": "variance", "length": 150}]
    f = build_features(b, specs=specs, orderflow_windows=None, mode="daily").toPandas().sort_values("open_time").reset_index()
    assert f["ZS_60"][150:199].isna().all() and f["ZS_60"][205:250].notna().all()
    assert (f["VAR_150"][350:399] == 0).all()


def test_no_struct_keeps_bars_from_hash_aggregation(spark):
    plan = _bars(spark)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
