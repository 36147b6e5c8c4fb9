"""Structured Streaming: validation of newly landed files and enriched reading events."""

from tidewright.streaming.landing import landing_stream, notice_stream, stream_enrich, stream_validate

__all__ = ["landing_stream", "notice_stream", "stream_enrich", "stream_validate"]
