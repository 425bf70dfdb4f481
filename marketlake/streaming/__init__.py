"""Incremental landing of bronze files with Structured Streaming.

The source pipeline is batch only (full-refresh tables); its one
continuously-fed edge is the landing folder that files are dropped into.
`land_new_files` turns that edge into an `availableNow` file stream: each run
lands only files not seen before (tracked in a checkpoint under the shared
`spark.checkpoint.dir`) and stops, so it can be scheduled like a batch task
and survives restarts without re-landing or losing files.
"""

from marketlake.streaming.landing import land_new_files

__all__ = ["land_new_files"]
