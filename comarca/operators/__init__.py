"""DataFrame building blocks."""

from . import aggregate, joins, latest, layout, ordering, reshape, tables

__all__ = ["aggregate", "joins", "latest", "layout", "ordering", "reshape", "tables"]
