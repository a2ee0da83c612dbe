"""Incremental ingest, rollup and flagging under Structured Streaming."""
