"""Argument checks."""

from __future__ import annotations

import math


def within(name: str, value: float, low: float, high: float = math.inf) -> None:
    """``low <= value <= high``; NaN fails."""
    if not low <= value <= high:
        span = f"at least {low}" if high == math.inf else f"between {low} and {high}"
        raise ValueError(f"{name} must be {span}, not {value}")
