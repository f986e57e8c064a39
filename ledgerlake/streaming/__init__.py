"""Structured Streaming forms of the incremental operators."""
from .heal import heal_rows, heal_stream
from .raw import ingest_stream, read_raw_stream, split_lines
from .stream import counters_stream, dedupe_stream, read_stream, upsert_stream, work_dir
