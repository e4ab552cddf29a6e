"""Hourly panel analytics on Spark: feeds in, (hour, entity) features, models and metrics out."""

__version__ = "0.1.0"
