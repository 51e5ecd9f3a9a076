"""A1 references and ranges."""

from __future__ import annotations

import functools
import re

from gridlark.model import Range, SheetError

MAX_COLUMNS = 16384
_RANGE = re.compile(r"([A-Z]*)([0-9]*)(?::([A-Z]*)([0-9]*))?")


@functools.cache
def column_letters(index: int) -> str:
    """0 is A, 26 is AA."""
    out, n = "", index + 1
    while n:
        n, digit = divmod(n - 1, 26)
        out = chr(65 + digit) + out
    return out


@functools.cache
def column_index(letters: str) -> int:
    n = 0
    for c in letters.upper():
        n = n * 26 + ord(c) - 64
    return n - 1


def reference(row: int, col: int) -> str:
    return f"{column_letters(col)}{row + 1}"


def parse_range(text: str) -> Range:
    """``[col][row][:[col][row]]``; either part may be missing."""
    upper = text.strip().upper()
    m = _RANGE.fullmatch(upper)
    bad = SheetError(f"Invalid range format '{upper}'")
    if not m:
        raise bad
    cols = [None if not x else column_index(x) for x in (m[1], m[3])]
    rows = [None if not x else int(x) - 1 for x in (m[2], m[4])]
    if any(c is not None and c >= MAX_COLUMNS for c in cols) or any(r is not None and r < 0 for r in rows):
        raise bad
    for lo, hi in (cols, rows):
        if lo is not None and hi is not None and lo > hi:
            raise bad
    return Range(cols[0], rows[0], cols[1], rows[1])
