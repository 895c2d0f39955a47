"""Column names as the user gave them, blanks and dots included."""

from __future__ import annotations


def quoted(name: str) -> str:
    """The name in backticks, as ``col`` and SQL read it."""
    return "`" + name.replace("`", "``") + "`"


def unused(name: str, taken: list[str]) -> str:
    """``name``, with underscores in front until no column of ``taken`` has it."""
    while name.lower() in {t.lower() for t in taken}:
        name = "_" + name
    return name
