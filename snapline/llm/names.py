"""Column names of an operator's own beside those of a user's table."""

from __future__ import annotations

from collections.abc import Iterable


def free(taken: Iterable[str], name: str) -> str:
    """``name``, with as many underscores in front as no column has; case does not tell columns apart."""
    taken = {c.lower() for c in taken}
    while name.lower() in taken:
        name = f"_{name}"
    return name
