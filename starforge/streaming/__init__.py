"""Structured Streaming forms of the batch steps: ingest once, windowed alarm, micro-batch upsert."""

from .stream import (alarms_from_periods, end_stream, ingest_new_files, keyed_alarm, marker_folder, read_alarms,
                     stream_alarm, stream_upsert, window_counts_stream)

__all__ = ["alarms_from_periods", "end_stream", "ingest_new_files", "keyed_alarm", "marker_folder", "read_alarms",
           "stream_alarm", "stream_upsert", "window_counts_stream"]
