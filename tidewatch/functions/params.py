"""Checks on query arguments, done before any plan is built."""

from __future__ import annotations

import re

# The wording of refused arguments, "invalid <name>" and "<name> is required".
_INTEGER = re.compile(r"[+-]?[0-9]+")


def bounded_int(name: str, value, default: int, low: int, high: int) -> int:
    """`value` as an integer in [low, high]; blank means `default`."""
    if value is None or value == "":
        return default
    if isinstance(value, str) and _INTEGER.fullmatch(value):
        value = int(value)
    if isinstance(value, bool) or not isinstance(value, int) or not low <= value <= high:
        raise ValueError(f"invalid {name}")
    return value


def required_name(name: str, value: str | None) -> str:
    """`value` without surrounding blanks; it must not be empty."""
    trimmed = (value or "").strip()
    if not trimmed:
        raise ValueError(f"{name} is required")
    return trimmed


def positive_int(name: str, value: int) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or value < 1:
        raise ValueError(f"{name} must be at least 1")
    return value
