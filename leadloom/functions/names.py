"""Rules on column names and short feature lists."""

from __future__ import annotations

import re
from collections.abc import Iterable

# Name parts of columns that do not explain anything to the business.
UNEXPLAINED_PARTS = ("MISSING", "OTHER", "_NA")


def spaces_to_underscores(name: str) -> str:
    return name.replace(" ", "_")


def alnum_only(name: str) -> str:
    """Every character that is neither a letter nor a digit becomes an underscore."""
    return re.sub(r"[^\w]", "_", name)


def matching(names: Iterable[str], keywords: Iterable[str]) -> list[str]:
    """Names in which one of the patterns occurs."""
    pattern = re.compile("|".join(keywords))
    return [n for n in names if pattern.search(n)]


def unexplained(names: Iterable[str], parts: Iterable[str] = UNEXPLAINED_PARTS) -> list[str]:
    """Names that contain one of the parts, whatever the case."""
    wanted = tuple(p.upper() for p in parts)
    return [n for n in names if any(p in n.upper() for p in wanted)]


def duplicates(names: Iterable[str]) -> list[str]:
    seen: set[str] = set()
    again = []
    for name in names:
        if name.lower() in seen:
            again.append(name)
        seen.add(name.lower())
    return again
