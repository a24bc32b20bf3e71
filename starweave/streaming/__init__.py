"""Structured Streaming entry points."""

from .events import session_events_stream

__all__ = ["session_events_stream"]
