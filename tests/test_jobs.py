"""Jobs end to end on a scratch folder: ingest, features, increments, validate."""

import datetime as dt
import json

from pyspark.sql import functions as F

from conftest import SF001


def test_ingest_features_validate(spark, scratch):
    from barwright.plans.common import bars
    from barwright.plans.jobs import FeatureJob, run_features, run_ingest, run_validate
    from barwright.sources.klines import raw_from_bars
    from barwright.sources.tables import read_bars

    b = bars(spark, SF001, "1h")
    raw = raw_from_bars(b, 1).drop("date")
    bar_root, feat_root = f"{scratch}/bars", f"{scratch}/features"
    now = dt.datetime(2024, 2, 15, tzinfo=dt.timezone.utc)
    rep = run_ingest(spark, raw, "1h", bar_root, now=now)
    assert rep.count() > 0
    assert read_bars(spark, bar_root).count() == b.count()
    # one file per symbol-day
    files = read_bars(spark, bar_root).select(F.col("_metadata.file_path")).distinct().count()
    assert files == b.select("symbol", "date").distinct().count()

    specs = [{"kind": "rsi", "length": 3}, {"kind": "sma", "length": 3}, {"kind": "obv"}]
    job = FeatureJob(bar_root, feat_root, specs=specs, custom_windows=(3, 6), start=dt.date(2024, 1, 5),
                     end=dt.date(2024, 1, 20))
    n1 = run_features(spark, job).count()
    assert n1 > 0
    written = spark.read.parquet(feat_root)
    assert written.agg(F.min("date")).first()[0] >= dt.date(2024, 1, 5)
    # one file per symbol-day without a second shuffle before the write
    assert (written.select(F.col("_metadata.file_path")).distinct().count()
            == written.select("symbol", "date").distinct().count())
    rows1 = written.count()
    # second run: everything exists -> nothing to do
    assert run_features(spark, job).count() == 0
    assert spark.read.parquet(feat_root).count() == rows1
    # forced run rewrites only its partitions
    job.force = True
    run_features(spark, job)
    assert spark.read.parquet(feat_root).count() == rows1

    reports = run_validate(spark, feat_root, step_ms=3_600_000, first_n=5).collect()
    assert len(reports) == spark.read.parquet(feat_root).select("symbol", "date").distinct().count()
    r = json.loads(reports[0].report)
    assert r["open_time_monotonic"] is True
    assert r["missing_base_cols"] == []
    assert "OBV_notnull_ratio_all" in r and len(r["top_null_cols_all"]) <= 15
    assert r["path"].endswith(".parquet") and r["shape"][1] > 10


def test_ingest_closed_days_only_and_empty_pages(spark, scratch):
    from barwright.plans.common import bars
    from barwright.plans.jobs import run_ingest
    from barwright.schema import BAR_SCHEMA
    from barwright.sources.klines import klines_from_raw, raw_from_bars
    from barwright.sources.tables import read_bars

    b = bars(spark, SF001, "1h")
    raw = raw_from_bars(b, 1).drop("date")
    now = dt.datetime(2024, 1, 10, 12, tzinfo=dt.timezone.utc)
    run_ingest(spark, raw, "1h", f"{scratch}/bars", now=now)
    got = read_bars(spark, f"{scratch}/bars")
    assert got.agg(F.max("date")).first()[0] == dt.date(2024, 1, 9)  # today and later are not closed
    assert got.count() == b.where(F.col("date") <= dt.date(2024, 1, 9)).count()

    empty = spark.createDataFrame([("BTCUSDT", 1, "[]")], "symbol STRING, ingest_seq BIGINT, payload STRING")
    typed = klines_from_raw(empty, "1h")
    assert typed.count() == 0
    assert [f.name for f in BAR_SCHEMA.fields] == [c for c in typed.columns if c in {f.name for f in BAR_SCHEMA.fields}]


def test_validator_sees_each_file(spark, scratch):
    """Files of one run may differ in columns and order; each report speaks of its own file."""
    import json

    from barwright.plans.jobs import run_validate

    base = ["open", "high", "low", "close", "volume", "quote_volume", "num_trades", "taker_buy_base", "taker_buy_quote"]
    cols = ", ".join(f"CAST(id AS DOUBLE) {c}" for c in base)
    whole = spark.range(20).selectExpr("id * 1000 open_time", *cols.split(", "), "CAST(NULL AS DOUBLE) empty")
    whole.coalesce(1).write.parquet(f"{scratch}/f/a")
    whole.drop("volume").withColumnRenamed("empty", "x_right").orderBy(F.col("open_time").desc()).coalesce(1).write.parquet(f"{scratch}/f/b")
    got = {r.file_path.split("/")[-2]: json.loads(r.report) for r in run_validate(spark, f"{scratch}/f/*").collect()}
    assert got["a"]["shape"] == [20, 11] and got["b"]["shape"] == [20, 10]
    assert got["a"]["missing_base_cols"] == [] and got["b"]["missing_base_cols"] == ["volume"]
    assert got["a"]["right_cols"] == [] and got["b"]["right_cols"] == ["x_right"]
    assert got["a"]["all_null_cols"] == ["empty"] and got["b"]["all_null_cols"] == ["x_right"]
    assert got["a"]["open_time_monotonic"] and not got["b"]["open_time_monotonic"]
    assert got["a"]["open_time_unique_diffs"] == [1000] and got["b"]["open_time_unique_diffs"] == [-1000]


def test_job_status(spark, scratch):
    from barwright.plans.common import bars
    from barwright.plans.jobs import FeatureJob, job_status, run_features
    from barwright.sources.tables import write_partitioned

    b = bars(spark, SF001, "1h").where("date between '2024-01-02' and '2024-01-05'")
    write_partitioned(b, f"{scratch}/bars")
    symbols = sorted(r.symbol for r in b.select("symbol").distinct().collect())
    one = FeatureJob(f"{scratch}/bars", f"{scratch}/out", specs=[{"kind": "sma", "length": 3}], with_custom=False,
                     start=dt.date(2024, 1, 3), end=dt.date(2024, 1, 3), interval="1h")
    run_features(spark, one)
    job = FeatureJob(f"{scratch}/bars", f"{scratch}/out", symbols=[symbols[0], "NONE"], start=dt.date(2024, 1, 1), end=dt.date(2024, 1, 4), interval="1h")
    got = {(r.symbol, r.date.day): r.status for r in job_status(spark, job).collect()}
    assert [got[symbols[0], d] for d in (1, 2, 3, 4)] == ["missing", "wanted", "skipped", "wanted"]
    assert all(got["NONE", d] == "missing" for d in (1, 2, 3, 4))


def test_ingest_range_rejects_and_other_time_zones(spark, scratch):
    from barwright.plans.common import bars
    from barwright.plans.jobs import run_ingest
    from barwright.sources.klines import klines_rejects, raw_from_bars
    from barwright.sources.tables import read_bars

    b = bars(spark, SF001, "1h")
    raw = raw_from_bars(b, 1).drop("date")
    symbol = raw.first().symbol
    now = dt.datetime(2024, 2, 15, tzinfo=dt.timezone.utc)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Seoul")
    try:
        run_ingest(spark, raw, "1h", f"{scratch}/in", now=now, symbols=[symbol], start=dt.date(2024, 1, 5), end=dt.date(2024, 1, 8))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    got = read_bars(spark, f"{scratch}/in")
    want = b.where(F.col("symbol") == symbol).where("date between '2024-01-05' and '2024-01-08'")
    assert got.count() == want.count() > 0 and got.select("open_time", "date").exceptAll(want.select("open_time", "date")).count() == 0
    bad = spark.createDataFrame([("A", 1, "[[1,2"), ("A", 1, '[["x", 1], [5, 2]]'), ("B", 1, "[]")], "symbol string, ingest_seq long, payload string")
    assert {tuple(r) for r in klines_rejects(bad, "1h").collect()} == {("A", 1, 1), ("B", 0, 0)}


def test_jobs_on_files_by_symbol_and_granularity(spark, scratch):
    """SYMBOL/GRAN/DATE.parquet as input: same features as from our own table; files out of range are not opened."""
    import os

    from barwright.plans.common import bars
    from barwright.plans.jobs import FeatureJob, feature_status, job_status, run_features, run_validate
    from barwright.sources.tables import foreign_keys, read_foreign_layout, write_partitioned

    b = bars(spark, SF001, "1h").where("date between '2024-01-02' and '2024-01-07'")
    write_partitioned(b, f"{scratch}/bars")
    for (sym, day), g in b.toPandas().groupby(["symbol", "date"]):
        for path in (f"{scratch}/files/{sym}/1h/{day}.parquet", f"{scratch}/flat/{sym}/{day}.parquet"):
            os.makedirs(os.path.dirname(path), exist_ok=True)
            g.drop(columns=["interval", "date", "symbol"]).to_parquet(path, index=False)
    symbols = sorted({r.symbol for r in b.select("symbol").distinct().collect()})
    for sym, gran, day in ((symbols[0], "1h", "2024-01-31"), (symbols[0], "5m", "2024-01-03"), ("OTHER", "1h", "2024-01-03")):
        os.makedirs(f"{scratch}/files/{sym}/{gran}", exist_ok=True)
        with open(f"{scratch}/files/{sym}/{gran}/{day}.parquet", "w") as f:
            f.write("no parquet file")
    common = dict(specs=[{"kind": "sma", "length": 3}, {"kind": "rsi", "length": 3}], custom_windows=(3,), symbols=symbols,
                  start=dt.date(2024, 1, 3), end=dt.date(2024, 1, 6), interval="1h")
    outs = {}
    for layout, root in (("partitions", "bars"), ("files", "files"), ("flat", "flat")):
        job = FeatureJob(f"{scratch}/{root}", f"{scratch}/out-{layout}", layout=layout, **common)
        assert {r.status for r in job_status(spark, job).collect()} <= {"wanted", "missing"}
        done = run_features(spark, job)
        assert {r.status for r in feature_status(spark, job, done).collect()} <= {"ok", "missing"}
        out = spark.read.parquet(f"{scratch}/out-{layout}")
        outs[layout] = sorted(map(str, out.select(sorted(out.columns)).collect()))
        assert run_features(spark, job).count() == 0
    assert outs["files"] == outs["partitions"] == outs["flat"] and outs["files"]
    assert foreign_keys(spark, f"{scratch}/files", "1h").count() == b.select("symbol", "date").distinct().count() + 3
    assert {f.name for f in read_foreign_layout(spark, f"{scratch}/flat", None).schema} >= {"symbol", "interval", "date"}
    reports = run_validate(spark, f"{scratch}/flat", step_ms=3_600_000, layout="flat").collect()
    assert len(reports) == b.select("symbol", "date").distinct().count()
    assert json.loads(reports[0].report)["missing_base_cols"] == []


def test_footers_of_files_with_odd_names(spark, scratch):
    from barwright.plans.jobs import file_columns

    spark.range(3).selectExpr("id a", "id b", "'x y%z' k").coalesce(1).write.partitionBy("k").parquet(f"{scratch}/odd name/t")
    assert [r["columns"] for r in file_columns(spark, f"{scratch}/odd name/t").collect()] == [["a", "b"]]


def test_published_table_changes_whole(spark, scratch):
    import pytest

    from barwright.plans.common import bars
    from barwright.schema import BAR_TABLE_SCHEMA
    from barwright.sources import publish as p

    b = bars(spark, SF001, "1h").where("date between '2024-01-02' and '2024-01-05'").cache()
    root = f"{scratch}/table"
    with pytest.raises(FileNotFoundError):
        p.read_published(spark, root)
    rows = lambda df: sorted(map(str, df.select(sorted(b.columns)).collect()))
    assert p.publish(b.limit(0), root) == 0 and p.publish(b, root) == 1
    before = rows(b)
    assert rows(p.read_published(spark, root)) == before == rows(p.read_published(spark, root, BAR_TABLE_SCHEMA))
    # a write that ends between partitions: some files of the new batch are there, the table is as it was
    symbols = sorted(r.symbol for r in b.select("symbol").distinct().collect())
    broken = b.repartition("symbol", "interval", "date").withColumn("close", F.expr(f"CASE WHEN symbol = '{symbols[-1]}' THEN raise_error('lost') ELSE 0D END").cast("double"))
    with pytest.raises(Exception, match="lost"):
        p.publish(broken, root, clustered=True)
    assert rows(p.read_published(spark, root)) == before and p.published_version(spark, root)[0] == 1
    # a reader from before a write keeps its days; a new reader has the new ones
    old = p.read_published(spark, root)
    day = b.where("date = '2024-01-03'").withColumn("close", F.lit(-1.0))
    assert p.publish(day, root) == 2
    assert rows(old) == before
    now = p.read_published(spark, root)
    assert rows(now) == rows(b.withColumn("close", F.expr("CASE WHEN date = '2024-01-03' THEN -1D ELSE close END")))
    assert rows(p.read_published(spark, root, symbols=symbols[:1], start=dt.date(2024, 1, 3), end=dt.date(2024, 1, 4))) == rows(
        now.where(f"symbol = '{symbols[0]}' and date between '2024-01-03' and '2024-01-04'"))
    assert p.read_published(spark, root, symbols=["NONE"]).count() == 0
    assert p.published_keys(spark, root).count() == b.select("symbol", "date").distinct().count()
    # of two writers of one version the second fails
    with pytest.raises(p.PublishConflict):
        p._commit(spark, root, 2, "other")
    # a commit whose line is missing does not count
    open(f"{root.removeprefix('file:')}/commits/{3:012d}", "w").close()
    assert p.published_version(spark, root)[0] == 2 and rows(p.read_published(spark, root)) == rows(now)
    assert len(p.stale_batches(spark, root)) == 2  # the empty and the broken write


def test_features_into_a_published_table(spark, scratch):
    from barwright.plans.common import bars
    from barwright.plans.jobs import FeatureJob, feature_status, run_features
    from barwright.sources.publish import published_version, read_published
    from barwright.sources.tables import write_partitioned

    b = bars(spark, SF001, "1h").where("date between '2024-01-02' and '2024-01-06'")
    write_partitioned(b, f"{scratch}/bars")
    job = FeatureJob(f"{scratch}/bars", f"{scratch}/out", specs=[{"kind": "sma", "length": 3}], with_custom=False,
                     start=dt.date(2024, 1, 3), end=dt.date(2024, 1, 4), interval="1h", published=True)
    assert run_features(spark, job).count() > 0
    job.end = dt.date(2024, 1, 6)
    done = run_features(spark, job)
    assert {r.date.day for r in done.select("date").distinct().collect()} == {5, 6}
    assert {r.status for r in feature_status(spark, job, done).collect()} == {"ok", "skipped"}
    out = read_published(spark, f"{scratch}/out")
    assert out.count() == b.where("date >= '2024-01-03'").count() and published_version(spark, f"{scratch}/out")[0] == 2
    job.force = True
    run_features(spark, job)
    assert read_published(spark, f"{scratch}/out").count() == out.count()
