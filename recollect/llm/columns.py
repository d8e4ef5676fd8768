"""Names for helper columns beside a caller's own."""

from __future__ import annotations

from collections.abc import Sequence


def unused(columns: Sequence[str], *names: str) -> list[str]:
    """The names, each with underscores added until no column has it in any case."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
