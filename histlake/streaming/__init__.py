"""Structured Streaming jobs: triggered (``availableNow``) file ingest,
streaming reference tables, and SCD1 / SCD2 maintained per micro-batch."""

from histlake.streaming.cdc import scd_stream  # noqa: F401
from histlake.streaming.ingest import ingest_stream, stage_files  # noqa: F401
from histlake.streaming.reference import (distinct_stream, grouped_max_stream,  # noqa: F401
                                          new_keys_stream)
from histlake.streaming.history import History  # noqa: F401
from histlake.streaming.latest import latest_stream  # noqa: F401
