"""Number formats: which numbers are dates, times or both."""

from __future__ import annotations

import re

from gridlark.model import NUM, NUM_DATE, NUM_DATETIME, NUM_TIME

#: Built-in number formats by id.
DATETIME_IDS, DATE_IDS, TIME_IDS = {22}, {14, 15, 16, 17}, {18, 19, 20, 21, 45, 46, 47}
_LITERAL = re.compile(r'[\\_].|"[^"]*"?|\[[^\]]*\]?', re.DOTALL)


def builtin_kind(number: int) -> int:
    return NUM_DATETIME if number in DATETIME_IDS else NUM_DATE if number in DATE_IDS else NUM_TIME if number in TIME_IDS else NUM


def custom_kind(code: str) -> int:
    """Y or D outside of literals makes a date, H or S a time; M alone decides nothing."""
    seen = set(_LITERAL.sub("", code).upper())
    date, time = bool(seen & {"Y", "D"}), bool(seen & {"H", "S"})
    return NUM_DATETIME if date and time else NUM_DATE if date else NUM_TIME if time else NUM


def format_kind(number: int, custom: dict[int, str]) -> int:
    return custom_kind(custom[number]) if number in custom else builtin_kind(number)
