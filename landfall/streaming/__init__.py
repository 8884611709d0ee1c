"""The same intake for a folder that keeps receiving files."""

from landfall.streaming.folder import land_new_files

__all__ = ["land_new_files"]
