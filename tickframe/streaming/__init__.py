"""Structured Streaming twins of batch operators."""

from .resample import stream_events, stream_resample_last

__all__ = ["stream_events", "stream_resample_last"]
