"""Operational sources and the stand-in built from the driver test tables."""

from starloom.sources.source import SOURCE_KEYS, Source

__all__ = ["SOURCE_KEYS", "Source"]
