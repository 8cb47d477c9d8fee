"""Quality report of feature files.

One report row per file: shape, missing base columns, `_right` collisions,
open_time monotonicity in file order, the five smallest distinct spacings,
the rate of the expected spacing, the fifteen columns with the most NULLs
(over all rows and over the first `first_n` rows), all-NULL columns and the
non-NULL ratio of the probe columns.

Everything is one plan: a lag window per file (file order), one wide grouped
aggregation, an unpivot of the per-column rates and two small top-k windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright.schema import BASE_COLUMNS

# Probe columns whose non-NULL ratio is reported, and report sizes.
PROBES = ["RSI_14", "MACD_12_26_9", "BBM_20_2.0_2.0", "VWAP_D", "OBV", "LOGRET_1", "HA_close"]
TOP_K = 15
FIRST_N = 200
N_DIFFS = 5


def _q(c: str):
    return F.col(f"`{c}`")


def _is_missing(df: DataFrame, c: str):
    t = df.schema[c].dataType
    if isinstance(t, (T.DoubleType, T.FloatType)):
        return _q(c).isNull() | F.isnan(_q(c))
    return _q(c).isNull()


def _ranked(arr, top_k: int):
    """Top-k of an array<struct<col, pos, rate>>: rate descending, column position on ties."""
    def cmp(a, b):
        return (F.when(a["rate"] > b["rate"], -1).when(a["rate"] < b["rate"], 1)
                .when(a["pos"] < b["pos"], -1).when(a["pos"] > b["pos"], 1).otherwise(0))
    top = F.slice(F.array_sort(arr, cmp), 1, top_k)
    return F.transform(top, lambda s_: F.struct(s_["col"].alias("col"), s_["rate"].alias("rate")))


def quality_report(
    df: DataFrame,
    file_key: Sequence[str],
    order_col: str,
    step_ms: int = 1000,
    first_n: int = FIRST_N,
    probes: Sequence[str] = PROBES,
    top_k: int = TOP_K,
    exclude: Sequence[str] = (),
    file_columns: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Return (summary per file, top NULL-rate columns per file and scope).

    `file_key` names the file (e.g. `_metadata.file_path` copied to a column,
    or symbol/interval/date); `order_col` is the row order inside the file
    (e.g. `_metadata.row_index`). The key and `exclude` (helper columns such as
    a row index) are left out of the file's column lists. `file_columns` has the
    key and `columns array<string>`, the columns that each file itself holds; without
    it every file is taken to hold all columns of `df`.

    One pass: a lag window per file, then an aggregation by file and spacing and one by
    file, whose row carries every rate and the smallest spacings; the all-NULL list and
    both top-k lists are array expressions over that row.
    """
    keys = list(file_key)
    helper = set(keys) | set(exclude)
    cols = [c for c in df.columns if c not in helper]
    numeric = [c for c in cols if c not in BASE_COLUMNS]

    w = Window.partitionBy(*keys).orderBy(order_col)
    has_ot = "open_time" in cols
    diff = (F.col("open_time") - F.lag("open_time").over(w)) if has_ot else F.lit(None).cast("long")
    x = df.select(*[F.col(k) for k in keys], F.row_number().over(w).alias("__rn"), diff.alias("__diff"),
                  *[_is_missing(df, c).cast("double").alias(f"__m{i}") for i, c in enumerate(numeric)])
    head = F.col("__rn") <= first_n
    n = len(numeric)

    # First by (file, spacing), then by file: both levels keep the partitioning of the lag window.
    spaced = x.groupBy(*keys, "__diff").agg(
        F.count(F.lit(1)).alias("__n"), F.count(F.when(head, 1)).alias("__nh"),
        *[F.sum(f"__m{i}").alias(f"__s{i}") for i in range(n)], *[F.sum(F.when(head, F.col(f"__m{i}"))).alias(f"__t{i}") for i in range(n)])
    by_size = Window.partitionBy(*keys).orderBy(F.col("__diff").asc_nulls_last())
    small = (F.col("__k") <= N_DIFFS) & F.col("__diff").isNotNull()
    rows = F.sum("__n")
    step_rate = F.try_divide(F.sum(F.when(F.col("__diff") == step_ms, F.col("__n")).otherwise(0)), F.sum(F.when(F.col("__diff").isNotNull(), F.col("__n"))))
    per_file = spaced.withColumn("__k", F.row_number().over(by_size)).groupBy(*keys).agg(
        rows.alias("n_rows"),
        F.coalesce(F.bool_and(F.col("__diff") >= 0), F.lit(has_ot)).alias("open_time_monotonic"),
        (step_rate if has_ot else F.lit(0.0)).alias("open_time_step_rate"),
        F.sort_array(F.collect_list(F.when(small, F.col("__diff")))).alias("open_time_unique_diffs"),
        *[(F.sum(f"__s{i}") / rows).alias(f"__a{i}") for i in range(n)],
        *[F.try_divide(F.sum(f"__t{i}"), F.sum("__nh")).alias(f"__h{i}") for i in range(n)])

    every = F.array(*[F.lit(c) for c in cols]).cast("array<string>")
    if file_columns is not None:
        per_file = per_file.join(file_columns.select(*keys, F.col("columns").alias("__cols")), keys, "left")
        per_file = per_file.withColumn("__cols", F.array_except(F.coalesce("__cols", every), F.array(*map(F.lit, helper))))
    else:
        per_file = per_file.withColumn("__cols", every)

    def rates(tag: str):
        return F.filter(all_rates(tag), lambda s_: F.array_contains("__cols", s_["col"]))

    def all_rates(tag: str):
        return F.array(*[F.struct(F.lit(c).alias("col"), F.lit(i).alias("pos"), F.col(f"__{tag}{i}").alias("rate"))
                         for i, c in enumerate(numeric)])

    empty_top = F.array().cast("array<struct<col:string,rate:double>>")
    summary = per_file.select(
        *keys,
        F.array(F.col("n_rows"), F.size("__cols").cast("long")).alias("shape"),
        F.array_except(F.array(*[F.lit(c) for c in BASE_COLUMNS]), F.col("__cols")).alias("missing_base_cols"),
        F.filter("__cols", lambda c: c.endswith("_right")).alias("right_cols"),
        "open_time_monotonic", "open_time_step_rate", "open_time_unique_diffs",
        (F.transform(F.filter(rates("a"), lambda s_: s_["rate"] == 1.0), lambda s_: s_["col"]) if numeric
         else F.array().cast("array<string>")).alias("all_null_cols"),
        (_ranked(rates("a"), top_k) if numeric else empty_top).alias("top_null_cols_all"),
        (_ranked(rates("h"), top_k) if numeric else empty_top).alias("top_null_cols_head"),
        *[(1.0 - F.col(f"__{tag}{numeric.index(p)}")).alias(f"{p}_notnull_ratio_{scope}")
          for p in probes if p in numeric for scope, tag in (("all", "a"), ("head", "h"))],
    )
    top = summary.select(*keys, F.explode(F.array(
        F.struct(F.lit("all").alias("scope"), F.col("top_null_cols_all").alias("t")),
        F.struct(F.lit("head").alias("scope"), F.col("top_null_cols_head").alias("t")))).alias("__s"))
    top = (top.select(*keys, "__s.scope", F.posexplode("__s.t").alias("__p", "__e"))
           .select(*keys, "scope", (F.col("__p") + 1).alias("rank"), "__e.col", "__e.rate"))
    return summary, top


def report_json(summary: DataFrame, file_key: Sequence[str], step_ms: int | None = None) -> DataFrame:
    """One JSON document per file (S15), the top-NULL lists as {column: rate} maps.

    The document also carries the original field names: `path` (the first key
    column) and, for a 1 s step, `open_time_1s_rate`.
    """
    keys = list(file_key)

    def as_map(c: str):
        return F.map_from_entries(F.transform(F.col(c), lambda s_: F.struct(s_["col"], s_["rate"])))

    full = summary.withColumn("top_null_cols_all", as_map("top_null_cols_all")) \
                  .withColumn("top_null_cols_head", as_map("top_null_cols_head")) \
                  .withColumn("path", F.col(keys[0]).cast("string"))
    if step_ms == 1000:
        full = full.withColumn("open_time_1s_rate", F.col("open_time_step_rate"))
    return full.select(*keys, F.to_json(F.struct(*[c for c in full.columns if c not in keys])).alias("report"))
