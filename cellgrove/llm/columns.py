"""Names of added columns."""

from __future__ import annotations


def free_name(name: str, taken: list[str]) -> str:
    """``name``, or the first of name_1, name_2, ... that no column in ``taken`` has (case aside)."""
    used, out, n = {c.lower() for c in taken}, name, 0
    while out.lower() in used:
        n += 1
        out = f"{name}_{n}"
    return out
