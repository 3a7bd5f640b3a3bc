"""Incremental loads."""

from tierforge.streaming.bronze_stream import bronze_stream

__all__ = ["bronze_stream"]
