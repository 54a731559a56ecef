"""Readers and writers."""

from . import delimited, files, geojson, sinks, xlsx

__all__ = ["delimited", "files", "geojson", "sinks", "xlsx"]
