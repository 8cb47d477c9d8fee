"""Registered queries against their DuckDB oracles at sf0.01 (the driver's check).

A representative subset runs by default; BARWRIGHT_FULL=1 runs every query.
"""

import os

import pytest

from conftest import SF01

SUBSET = ["bars_30m", "orderflow_continuous", "orderflow_daily", "klines_clean", "day_completeness",
          "quality_summary", "quality_top_nulls", "ind_bbands", "ind_aroon", "ind_vwap", "ind_pvi",
          "ind_rsi", "ind_macd", "ind_kurtosis", "ind_cci"]


def _names():
    import __spark_entry__ as e

    names = list(e.queries())
    return names if os.environ.get("BARWRIGHT_FULL") else [n for n in names if n in SUBSET]


@pytest.fixture(scope="module")
def con():
    from oracle_check import duck

    return duck(SF01)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    from oracle_check import compare

    res = compare(spark, name, SF01, con)
    if res.get("oracle") == "none":
        assert res["spark_rows"] > 0
        return
    assert res["cols_match"], res
    assert res["spark_rows"] == res["duck_rows"], res
    assert res["match"], res
