"""Row conditions shared by the metric sources."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_text(name: str) -> Column:
    """Neither NULL nor the empty string."""
    return F.col(name).isNotNull() & (F.col(name) != "")


def whitelist(group: str, member: str, allowed: Mapping[str, Iterable[str] | None]) -> Column:
    """``group`` is listed, and ``member`` is among that group's values (None = any)."""
    tests = []
    for value, members in allowed.items():
        test = F.col(group) == value
        if members is not None:
            test = test & F.col(member).isin(list(members))
        tests.append(test)
    return reduce(or_, tests, F.lit(False))


def not_like_any(name: str, patterns: Iterable[str]) -> Column:
    """``name`` matches none of the LIKE patterns; ``_`` and ``%`` stay wildcards."""
    return reduce(and_, (~F.col(name).like(p) for p in patterns), F.lit(True))
