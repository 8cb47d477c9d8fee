"""Scans, presets and fault isolation."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import SF001


def test_foreign_layout_scan(spark, scratch):
    from barwright.plans.common import bars
    from barwright.sources.tables import read_foreign_layout

    b = bars(spark, SF001, "1h").drop("interval", "date")
    pdf = b.toPandas()
    pdf["day"] = (pdf["open_time"] // 86_400_000)
    days = sorted(pdf["day"].unique())[:3]
    n = 0
    for (sym, day), g in pdf[pdf["day"].isin(days)].groupby(["symbol", "day"]):
        d = dt.date(1970, 1, 1) + dt.timedelta(days=int(day))
        path = f"{scratch}/root/{sym.upper()}/1s/{d.isoformat()}.parquet"
        import os

        os.makedirs(os.path.dirname(path), exist_ok=True)
        pq.write_table(pa.Table.from_pandas(g.drop(columns="day"), preserve_index=False), path)
        n += len(g)
    df = read_foreign_layout(spark, f"{scratch}/root", "1s")
    assert df.count() == n
    row = df.select("symbol", "interval", "date", F.to_date(F.timestamp_millis("open_time")).alias("d")).first()
    assert row.interval == "1s" and row.date == row.d and row.symbol.isupper()


def test_preset_symbols(spark):
    from barwright.plans.jobs import preset_symbols

    syms = [r.symbol for r in preset_symbols(spark).collect()]
    assert len(syms) == 14 and syms[0] == "BTCUSDT" and all(s.endswith("USDT") for s in syms)


def test_missing_inputs(spark):
    from barwright.plans.common import bars
    from barwright.plans.jobs import missing_inputs

    b = bars(spark, SF001, "1h")
    syms = b.select("symbol").distinct()
    miss = missing_inputs(b, syms, dt.date(2023, 12, 30), dt.date(2024, 1, 2))
    got = {(r.symbol, r.date) for r in miss.collect()}
    assert all(d < dt.date(2024, 1, 1) for _, d in got) or len(got) > 0
    assert {d for _, d in got} >= {dt.date(2023, 12, 30), dt.date(2023, 12, 31)}


def test_kernel_fault_isolation(spark):
    from barwright.functions import registry
    from barwright.plans.common import bars
    from barwright.plans.features import build_features

    def broken(a, length=3):
        if len(a["close"]) > 0:
            raise RuntimeError("boom")
        return {f"BROKEN_{length}": a["close"]}

    registry.register_indicator("broken", broken, kernel=True)
    try:
        plan = registry.plan_specs([{"kind": "broken", "length": 3}])
        assert plan.outputs == []  # naming itself fails on the ramp: rejected at plan time
    except RuntimeError:
        pass

    def flaky(a, length=3):
        if len(a["close"]) % 2 == 1:
            raise RuntimeError("too long")
        return {f"FLAKY_{length}": a["close"] * 0 + 1}

    registry.register_indicator("flaky", flaky, kernel=True)
    f = build_features(bars(spark, SF001, "1h"), specs=[{"kind": "flaky", "length": 3}, {"kind": "ema", "length": 3}],
                       orderflow_windows=None, mode="daily", warmup=0)
    pdf = f.select("FLAKY_3", "EMA_3").toPandas()
    assert pdf["FLAKY_3"].isna().any() and pdf["FLAKY_3"].notna().any()
    assert pdf["EMA_3"].notna().any()


def test_discovery(spark):
    from barwright.plans.common import bars
    from barwright.sources.tables import list_days, list_symbols

    b = bars(spark, SF001, "1h")
    syms = [r.symbol for r in list_symbols(b).collect()]
    assert syms == sorted(syms) and len(syms) == b.select("symbol").distinct().count()
    assert list_days(b).count() == b.select("symbol", "interval", "date").distinct().count()


def test_keys_come_from_the_listing(spark, scratch):
    """Keys of a stored table by its folders: odd symbols keep their spelling, and no file is opened."""
    from barwright.plans.common import bars
    from barwright.sources.tables import existing_keys, keys_in_range, write_partitioned

    b = bars(spark, SF001, "1h").where("date <= '2024-01-03'")
    odd = b.withColumn("symbol", F.when(F.col("symbol") == "click", "007").otherwise(F.concat("symbol", F.lit(" a+b"))))
    write_partitioned(odd, f"{scratch}/t")
    want = {tuple(r) for r in odd.select("symbol", "interval", "date").distinct().collect()}
    assert {tuple(r) for r in existing_keys(spark, f"{scratch}/t").collect()} == want
    some = keys_in_range(spark, f"{scratch}/t", symbols=["007"], interval="1h")
    assert {tuple(r) for r in some.collect()} == {k for k in want if k[0] == "007"}
    assert existing_keys(spark, f"{scratch}/none") is None and keys_in_range(spark, f"{scratch}/none").count() == 0
    for f in (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{scratch}/t").select("path").collect()):
        with open(f.path.removeprefix("file:").replace("%20", " "), "w") as broken:
            broken.write("no parquet")  # a scan of rows or footers would fail
    assert {tuple(r) for r in existing_keys(spark, f"{scratch}/t").collect()} == want
