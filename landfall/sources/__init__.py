"""Readers: files to contract columns plus ``_raw``, ``_missing`` and ``_error``."""

from landfall.sources.feed import parse_feed, read_feed

__all__ = ["parse_feed", "read_feed"]
