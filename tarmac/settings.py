"""Thresholds and windows of the flight-delay reports."""

from __future__ import annotations

from dataclasses import dataclass

SECOND_MS = 1_000
HOUR_MS = 3_600 * SECOND_MS
DAY_MS = 24 * HOUR_MS


@dataclass(frozen=True)
class Settings:
    """Parameters shared by every report.

    The defaults are fixed values: they decide the published numbers.
    """

    carriers: tuple[str, ...] = ("AA", "DL", "UA", "WN")
    late_minutes: float = 15.0
    severe_minutes: float = 30.0
    list_length: int = 20
    top_k: int = 10
    min_flights: int = 30
    watermark: str = "60 seconds"


DEFAULTS = Settings()

# Tumbling window lengths, aligned to the Unix epoch.
WINDOWS_MS = {"1h": HOUR_MS, "6h": 6 * HOUR_MS, "120d": 120 * DAY_MS}
