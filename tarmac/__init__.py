"""Flight-delay analytics as Spark DataFrame jobs."""

from tarmac.settings import DEFAULTS, Settings

__all__ = ["DEFAULTS", "Settings"]
