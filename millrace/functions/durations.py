"""Durations as a number of milliseconds or as text such as "2 seconds"."""

from __future__ import annotations

_MS = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}


def millis(duration: int | str) -> int:
    if isinstance(duration, int):
        return duration
    amount, unit = duration.split()
    return int(amount) * _MS[unit.rstrip("s")]


def text(duration: int | str) -> str:
    return duration if isinstance(duration, str) else f"{duration} milliseconds"
