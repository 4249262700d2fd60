"""Names for columns that a step adds on its way."""

from __future__ import annotations

from collections.abc import Iterable


def free(columns: Iterable[str], *wanted: str) -> list[str]:
    """The wanted names, each with underscores added until no column has it (whatever its case)."""
    taken, found = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found
