import datetime as dt

import pytest

from barwright.schema import effective_end, interval_to_ms, parse_symbols, parse_utc_date


def test_interval_grammar():
    assert interval_to_ms("1s") == 1000
    assert interval_to_ms("5m") == 300_000
    assert interval_to_ms("1h") == 3_600_000
    assert interval_to_ms("1d") == 86_400_000
    assert interval_to_ms("1w") == 7 * 86_400_000
    for bad in ("1M", "m", "0s", "1y", ""):
        with pytest.raises(ValueError):
            interval_to_ms(bad)


def test_parse_dates():
    now = dt.datetime(2024, 10, 4, 12, tzinfo=dt.timezone.utc)
    assert parse_utc_date("2024-10-01") == dt.date(2024, 10, 1)
    assert parse_utc_date("2024-10-01T23:30:00Z") == dt.date(2024, 10, 1)
    # offset times are converted to UTC first
    assert parse_utc_date("2024-10-02T01:00:00+09:00") == dt.date(2024, 10, 1)
    assert parse_utc_date("yesterday", now) == dt.date(2024, 10, 3)


def test_end_cap():
    now = dt.datetime(2024, 10, 4, 12, tzinfo=dt.timezone.utc)
    assert effective_end(dt.date(2024, 10, 9), now) == dt.date(2024, 10, 3)
    assert effective_end(dt.date(2024, 10, 9), now, allow_today=True) == dt.date(2024, 10, 9)
    assert effective_end(None, now) == dt.date(2024, 10, 3)


def test_symbols():
    assert parse_symbols(" btcusdt, ,ETHusdt ,") == ["BTCUSDT", "ETHUSDT"]
