"""Incremental panels with Structured Streaming.

The batch operators need no streaming counterpart: the column functions of
``chronopanel.functions`` and row-wise operators apply to streaming
DataFrames unchanged. What a stream adds is the panel aggregate kept up to
date as files arrive; ``panel_stream`` builds it with an event-time
watermark so finished periods are emitted once and state stays bounded.
"""

from .incremental import panel_stream, start_panel_stream  # noqa: F401
