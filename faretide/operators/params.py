"""Parameter rules of the reports. The lists and bounds are fixed values."""

from __future__ import annotations

METRICS = ("trip_count", "revenue", "avg_fare")
INTERVALS = ("hour", "day", "week")
FORMATS = ("json", "csv")

RECENT_LIMIT = (1, 1000)
RECENT_HOURS = (1, 720)
ZONE_LIMIT = (1, None)
WEATHER_HOURS = (1, 8760)


def one_of(name: str, value: str, allowed: tuple[str, ...]) -> str:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {', '.join(allowed)}, not {value!r}")
    return value


def between(name: str, value: int | None, bounds: tuple[int, int | None]) -> int | None:
    """``value``, if it is None or within the bounds; None for no upper bound."""
    low, high = bounds
    if value is not None and (value < low or (high is not None and value > high)):
        upper = "up" if high is None else f"to {high}"
        raise ValueError(f"{name} must be from {low} {upper}, not {value!r}")
    return value


def borough_list(boroughs: str | list[str] | None) -> list[str] | None:
    """Borough names from a list or a comma-separated text."""
    if not boroughs:
        return None
    return boroughs.split(",") if isinstance(boroughs, str) else list(boroughs)
