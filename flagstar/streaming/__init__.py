"""Incremental (Structured Streaming) form of the Silver stage."""

from flagstar.streaming.silver_stream import refine_stream

__all__ = ["refine_stream"]
