"""Incremental ingest of arriving event files (Structured Streaming).

The reference job has no streaming operator; this is the event scan (S1) run
incrementally: files dropped into a directory (one per year, as the source
data arrives) are appended exactly once to the year-partitioned Parquet
staging table that the reports read.
"""

from curbline.streaming.ingest import ingest_mixed_csvs, ingest_violation_csvs

__all__ = ["ingest_mixed_csvs", "ingest_violation_csvs"]
