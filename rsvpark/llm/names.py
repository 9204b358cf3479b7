"""Helper column names that a caller's table does not have."""

from __future__ import annotations

from collections.abc import Iterable


def fresh(taken: Iterable[str], *wanted: str) -> list[str]:
    """Each wanted name, with underscores before it until no column of ``taken`` (any case) has it."""
    used = {c.lower() for c in taken}
    out = []
    for name in wanted:
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out
