"""Structured Streaming forms of the ingest: closed bars from an event stream,
and an incremental, idempotent merge of re-fetched klines into day partitions."""
