"""Analysis of a sheet from a bounded sample: names, types and bounds of its columns."""

from __future__ import annotations

from gridlark.functions import a1, casts, globs, infer
from gridlark.model import Options, Table, column_type
from gridlark.operators.rows import selected


def analyze(book, sheet: str, options: Options) -> Table | None:
    """None for a sheet that is to be skipped as empty."""
    r = options.range
    sample: list = []
    for row, cells in selected(book.rows(sheet, r.row_lo, r.row_hi), options, r.col_lo, r.col_hi, r.row_lo, r.row_hi, f"[{book.name}]{sheet}"):
        if sample and row >= sample[0][0] + options.analyze_rows:
            break
        sample.append((row, cells))
        if options.analyze_rows <= 1:
            break
    columns = [c[0] for _, cells in sample for c in cells]
    lo = r.col_lo if r.col_lo is not None else min(columns, default=None)
    hi = r.col_hi if r.col_hi is not None else max(columns, default=None)
    if not sample and options.header or lo is None or hi is None or lo > hi:
        return None
    first = r.row_lo if r.row_lo is not None else sample[0][0] if sample else None
    names, types = {}, {}
    for row, cells in sample:
        for col, kind, text in cells:
            if options.header and row == first:
                names[col] = casts.display(kind, text, book.date1904)
            elif (t := infer.cell_type(kind, text)) is not None:
                types.setdefault(col, set()).add(t)
    out = []
    for col in range(lo, hi + 1):
        name = names.get(col, a1.column_letters(col))
        forced = next((column_type(t) for pattern, t in options.columns if globs.matches(pattern, name)), None)
        out.append((name, forced or infer.unify(types.get(col, set()))))
    return Table(sheet, tuple(out), None if first is None else first + options.header, lo, hi)
