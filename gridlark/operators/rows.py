"""Selection of cells and policies for empty rows, over a stream of non-empty rows."""

from __future__ import annotations

from collections.abc import Iterator

from gridlark.functions import a1
from gridlark.model import ERROR, Cell, Options, Row, SheetError


def selected(rows: Iterator[Row], options: Options, col_lo: int | None, col_hi: int | None, row_lo: int | None, row_hi: int | None, place: str) -> Iterator[Row]:
    """Rows with the cells that lie within bounds and are not null; rows without any are left out."""
    nulls, lo, hi = options.nulls, col_lo or 0, a1.MAX_COLUMNS if col_hi is None else col_hi
    for row, cells in rows:
        if row_lo is not None and row < row_lo:
            continue
        if row_hi is not None and row > row_hi:
            return
        kept: list[Cell] = []
        for cell in cells:
            col, kind, text = cell
            if not lo <= col <= hi or text in nulls:
                continue
            if kind == ERROR:
                if options.error_as_null:
                    continue
                raise SheetError(f"Cell '{place}!{a1.reference(row, col)}': {text}")
            kept.append(cell)
        if kept:
            yield row, kept


def with_gaps(rows: Iterator[Row], first: int | None, last: int | None, skip: bool, end: bool) -> Iterator[tuple[int, list[Cell]]]:
    """Rows with blank ones in between as empty lists. ``first``: the row that must come first; ``last``: the row to pad to."""
    after = None if skip else first
    for row, cells in rows:
        if end:
            if after is not None and row != after:
                return
        elif not skip and after is not None:
            for blank in range(after, row):
                yield blank, []
        yield row, cells
        after = row + 1
    if last is not None and not skip and not end:
        for blank in range(after if after is not None else last + 1, last + 1):
            yield blank, []
