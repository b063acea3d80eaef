"""Settings from the environment."""

from __future__ import annotations

import os


def flag(name: str, default: bool | None = None) -> bool | None:
    """1, true, yes, y and on in any case are true, other values false; unset or blank is ``default``."""
    value = os.environ.get(name, "").strip().lower()
    return value in ("1", "true", "yes", "y", "on") if value else default


def integer(name: str) -> int | None:
    """The number; None where unset or blank."""
    value = os.environ.get(name, "").strip()
    return int(value) if value else None


def text(name: str) -> str | None:
    """The value, trimmed; None where unset or blank."""
    return os.environ.get(name, "").strip() or None
