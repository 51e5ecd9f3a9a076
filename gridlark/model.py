"""Data model: cell kinds, column types, ranges, scan options, analysed tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Kinds of cells; a cell is (column, kind, text), blank ones don't occur.
BOOL, NUM, NUM_DATETIME, NUM_DATE, NUM_TIME, ISO, DURATION, TEXT, ERROR = range(1, 10)
Cell = tuple[int, int, str]
Row = tuple[int, list[Cell]]

#: Accepted names of each type, and its Spark type.
TYPE_NAMES = {
    "boolean": ("BOOL", "BOOLEAN"),
    "bigint": ("INT", "BIGINT", "INTEGER"),
    "double": ("FLOAT", "DOUBLE", "DECIMAL", "NUMERIC"),
    "varchar": ("TEXT", "STRING", "VARCHAR"),
    "timestamp": ("DATETIME", "TIMESTAMP"),
    "date": ("DATE",),
    "time": ("TIME",),
}
SPARK_TYPES = {"boolean": T.BooleanType(), "bigint": T.LongType(), "double": T.DoubleType(), "varchar": T.StringType(), "timestamp": T.TimestampNTZType(), "date": T.DateType(), "time": T.TimeType(6)}


class SheetError(Exception):
    """An error of a workbook, its selection or a cell."""


def column_type(name: str) -> str:
    for kind, names in TYPE_NAMES.items():
        if name.upper() in names:
            return kind
    raise SheetError(f"Invalid column type '{name}'")


@dataclass(frozen=True)
class Range:
    """0-based inclusive bounds; None is open."""

    col_lo: int | None = None
    row_lo: int | None = None
    col_hi: int | None = None
    row_hi: int | None = None


@dataclass(frozen=True)
class Options:
    """Options of a scan. ``sheets`` None: all; ``split_bytes``: uncompressed XML of a partition of a large XLSX sheet."""

    sheets: tuple[str, ...] | None = None
    range: Range = field(default_factory=Range)
    header: bool = True
    union_by_name: bool = False
    columns: tuple[tuple[str, str], ...] = ()
    analyze_rows: int = 10
    nulls: frozenset[str] = frozenset({""})
    error_as_null: bool = False
    skip_empty_rows: bool = False
    end_at_empty_row: bool = False
    file_name_column: str | None = None
    sheet_name_column: str | None = None
    split_bytes: int = 16 << 20


@dataclass(frozen=True)
class Table:
    """What the analysis of a sheet found. ``first_row``: first data row, None if it isn't known."""

    sheet: str
    columns: tuple[tuple[str, str], ...]
    first_row: int | None
    col_lo: int
    col_hi: int
