"""Assembled plans: sources tidied, geography, indicators, serving, batch runs."""

from . import batch, bulletins, geo, indicators, population, providers, scorecards, serving

__all__ = ["batch", "bulletins", "geo", "indicators", "population", "providers", "scorecards", "serving"]
