"""Sources and sinks: event tables, raw klines, bar and feature tables."""
