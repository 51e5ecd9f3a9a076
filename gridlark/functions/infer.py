"""Column types from evidence of cells."""

from __future__ import annotations

import re

from gridlark.model import BOOL, DURATION, ISO, NUM, NUM_DATE, NUM_DATETIME, NUM_TIME, TEXT

_WHOLE = re.compile(r"[^.eE]*(?:\.0*)?")


def cell_type(kind: int, text: str) -> str | None:
    """The type that a cell speaks for, if any."""
    if kind == NUM:
        return "bigint" if _WHOLE.fullmatch(text) else "double"
    if kind == ISO:
        if "1900-01-01" in text or "1904-01-01" in text:
            return "time"
        return "date" if "00:00:00" in text or "T" not in text else "timestamp"
    return {BOOL: "boolean", NUM_DATETIME: "timestamp", NUM_DATE: "date", NUM_TIME: "time", DURATION: "time", TEXT: "varchar"}.get(kind)


def unify(types: set[str]) -> str:
    if len(types) == 1:
        return next(iter(types))
    if types and types <= {"bigint", "double"}:
        return "double"
    if types and types <= {"timestamp", "date", "time"}:
        return "timestamp"
    return "varchar"
