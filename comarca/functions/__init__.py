"""Pure column expressions: text keys, locale numbers, periods, bands."""

from . import numbers, periods, text

__all__ = ["numbers", "periods", "text"]
