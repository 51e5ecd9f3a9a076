"""Typed conversion and display of cells, for one cell and for Arrow columns."""

from __future__ import annotations

import datetime as dt
import math
import re
from decimal import Decimal

import numpy as np
import pyarrow as pa

from gridlark.model import BOOL, DURATION, ISO, NUM, NUM_DATE, NUM_DATETIME, NUM_TIME, TEXT, SheetError

EPOCH = dt.date(1970, 1, 1)
DAY_US = 86_400_000_000
#: Names of error codes.
ERROR_NAMES = {0x00: "#NULL!", 0x07: "#DIV/0!", 0x0F: "#VALUE!", 0x17: "#REF!", 0x1D: "#NAME?", 0x24: "#NUM!", 0x2A: "#N/A", 0x2B: "#GETTING_DATA"}
ARROW_TYPES = {"boolean": pa.bool_(), "bigint": pa.int64(), "double": pa.float64(), "varchar": pa.string(), "timestamp": pa.timestamp("us"), "date": pa.date32(), "time": pa.time64("ns")}

_INTEGER = re.compile(r"[0-9-]*")
_FLOAT = re.compile(r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?")
_ISO = re.compile(r"(\d{4})-(\d\d)-(\d\d)(?:[T ](\d\d):(\d\d)(?::(\d\d)(\.\d+)?)?Z?)?")
_ISO_TIME = re.compile(r"(\d\d):(\d\d)(?::(\d\d)(\.\d+)?)?")
_DURATION = re.compile(r"P(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)(\.\d+)?S)?)?")


def error_name(code: int) -> str:
    return ERROR_NAMES.get(code, "#ERROR!")


def float_text(x: float) -> str:
    """Shortest text without exponent; whole numbers without a point."""
    out = repr(x)
    if "e" in out or "n" in out:
        out = format(Decimal(out), "f")
    return out[:-2] if out.endswith(".0") else out


def _fail(text: str, kind: str) -> SheetError:
    return SheetError(f"parse '{text}' to {kind} failed")


def _serial(text: str, kind: str) -> float:
    if not _FLOAT.fullmatch(text):
        raise _fail(text, kind)
    return float(text)


def serial_days(whole: int, date1904: bool) -> int:
    """Days since 1970 of a serial's whole part. Serial 60 is the day that never was, and counts as 59."""
    if date1904:
        return whole - 24107
    return whole - 25568 - (whole >= 60)


def _micros(h: str | None, m: str | None, s: str | None, fraction: str | None) -> int:
    return ((int(h or 0) * 60 + int(m or 0)) * 60 + int(s or 0)) * 1_000_000 + round(float("0" + (fraction or "")) * 1e6)


def _duration(text: str, kind: str) -> int:
    m = _DURATION.fullmatch(text)
    if not m:
        raise _fail(text, kind)
    return int(m[1] or 0) * DAY_US + _micros(*m.groups()[1:])


def _iso(text: str, kind: str) -> tuple[int, int, bool]:
    """Days, microseconds of the day, and whether a time was given."""
    m = _ISO.fullmatch(text)
    try:
        days = (dt.date(int(m[1]), int(m[2]), int(m[3])) - EPOCH).days
    except (TypeError, ValueError) as e:
        raise _fail(text, kind) from e
    return days, _micros(*m.groups()[3:]), m[4] is not None


def to_date(kind: int, text: str, date1904: bool) -> int:
    if kind in (NUM_DATE, NUM_DATETIME, NUM_TIME):
        return serial_days(math.trunc(_serial(text, "date")), date1904)
    if kind == ISO:
        days, micros, _ = _iso(text, "date")
        if not micros:
            return days
    if kind == DURATION:
        _duration(text, "date")
        return 0
    raise _fail(text, "date")


def to_time(kind: int, text: str, date1904: bool) -> int:
    micros = None
    if kind in (NUM_DATE, NUM_DATETIME):
        x = _serial(text, "time")
        micros = min(round((x - math.floor(x)) * DAY_US), DAY_US - 1)
    elif kind == NUM_TIME:
        micros = round(_serial(text, "time") * DAY_US)
    elif kind == ISO:
        m = _ISO_TIME.fullmatch(text)
        micros = _micros(*m.groups()) if m else _iso(text, "time")[1]
    elif kind == DURATION:
        micros = _duration(text, "time")
    if micros is None or not 0 <= micros < DAY_US:
        raise _fail(text, "time")
    return micros


def to_timestamp(kind: int, text: str, date1904: bool) -> int:
    if kind in (NUM_DATE, NUM_DATETIME, NUM_TIME):
        x = _serial(text, "timestamp")
        whole = math.trunc(x)
        return round((serial_days(whole, date1904) + (x - whole)) * float(DAY_US))
    if kind == ISO:
        days, micros, _ = _iso(text, "timestamp")
        return days * DAY_US + micros
    if kind == DURATION:
        return _duration(text, "timestamp")
    raise _fail(text, "timestamp")


def to_bigint(kind: int, text: str, date1904: bool) -> int:
    try:
        out = int(_INTEGER.match(text)[0])
    except ValueError as e:
        raise _fail(text, "bigint") from e
    if not -(2**63) <= out < 2**63:
        raise _fail(text, "bigint")
    return out


def to_double(kind: int, text: str, date1904: bool) -> float:
    return _serial(text, "double")


def to_boolean(kind: int, text: str, date1904: bool) -> bool:
    return text == "1"


def _clock(millis: int) -> str:
    s, ms = divmod(millis, 1000)
    return f"{s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d}" + (f".{ms:03d}" if ms else "")


def display(kind: int, text: str, date1904: bool) -> str:
    """The text form of a cell."""
    if kind == BOOL:
        return "true" if text == "1" else "false"
    if kind in (NUM_DATE, NUM_DATETIME, NUM_TIME):
        x = _serial(text, "varchar")
        whole = math.trunc(x)
        if kind == NUM_TIME:
            return _clock(round(x * 86_400_000))
        millis = round((x - whole) * 86_400_000) if kind == NUM_DATETIME else 0
        days = serial_days(whole + millis // 86_400_000, date1904)
        try:
            day = (EPOCH + dt.timedelta(days)).isoformat()
        except OverflowError as e:
            raise _fail(text, "varchar") from e
        return day if kind == NUM_DATE else f"{day} {_clock(millis % 86_400_000)}"
    if kind == ISO:
        return text.replace("T", " ")
    if kind == DURATION and (m := _DURATION.fullmatch(text)):
        return f"{int(m[1] or 0) * 24 + int(m[2] or 0)}:{int(m[3] or 0)}:{int(m[4] or 0)}{m[5] or ''}"
    return text


CASTS = {"boolean": to_boolean, "bigint": to_bigint, "double": to_double, "varchar": display, "timestamp": to_timestamp, "date": to_date, "time": to_time}
_NUMBERS, _TEXTS = {0, NUM}, {0, NUM, TEXT}


def arrow_column(target: str, kinds: list[int], values: list[str | None], date1904: bool, where, error_as_null: bool) -> pa.Array:
    """A column of a batch. ``where(i)`` names the cell of position i for an error."""
    seen = set(kinds)
    if target == "varchar" and seen <= _TEXTS:
        return pa.array(values, pa.string())
    if target in ("bigint", "double") and seen <= _NUMBERS:
        try:
            return pa.array(values, pa.string()).cast(ARROW_TYPES[target])
        except pa.ArrowInvalid:
            pass
    if target in ("date", "timestamp") and len(seen - {0}) == 1 and seen <= {0, NUM_DATE, NUM_DATETIME}:
        try:
            x = np.array(pa.array(values, pa.string()).cast(pa.float64()).fill_null(0))
        except pa.ArrowInvalid:
            x = np.full(1, np.nan)
        if np.isfinite(x).all() and (np.abs(x) < 3e6).all():
            whole = np.trunc(x).astype(np.int64)
            days = whole - 24107 if date1904 else whole - 25568 - (whole >= 60)
            mask = np.array(kinds) == 0
            if target == "date":
                return pa.array(days.astype(np.int32), pa.date32(), mask=mask)
            return pa.array(np.rint((days + (x - whole)) * float(DAY_US)).astype(np.int64), pa.timestamp("us"), mask=mask)
    cast, out = CASTS[target], []
    for i, (kind, text) in enumerate(zip(kinds, values, strict=True)):
        if not kind:
            out.append(None)
            continue
        try:
            out.append(cast(kind, text, date1904))
        except SheetError as e:
            if not error_as_null:
                raise SheetError(f"Cell '{where(i)}': {e}") from e
            out.append(None)
    if target == "time":  # the type that Spark takes TIME from
        out = [None if x is None else x * 1000 for x in out]
    return pa.array(out, ARROW_TYPES[target])
