"""Planning on the driver: files, sheets, schema, and the tasks of a scan."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import types as T

from gridlark.functions import a1, globs
from gridlark.model import SPARK_TYPES, Options, SheetError, Table, column_type
from gridlark.operators.analyze import analyze
from gridlark.sources.books import open_book

NO_SHEETS = "No worksheets matched the wildcard pattern in any of the files"
_SHOWN = {"bigint": "BigInt"}


def parse_options(**given) -> Options:
    """Options from user values; unset ones are left out or None."""
    known = {k: v for k, v in given.items() if v is not None}
    sheets = known.pop("sheets", None)
    if "sheet" in known:
        sheets = [known.pop("sheet")]
    columns = tuple((str(k), str(v)) for k, v in dict(known.pop("columns", {})).items())
    for pattern, kind in columns:
        globs.compiled(pattern)
        column_type(kind)
    area = a1.parse_range(known.pop("range")) if "range" in known else None
    nulls = frozenset(known.pop("nulls")) if "nulls" in known else frozenset({""})
    if "analyze_rows" in known:
        known["analyze_rows"] = int(known["analyze_rows"])
    unknown = set(known) - set(Options.__dataclass_fields__)
    if unknown:
        raise SheetError(f"Unknown option '{min(unknown)}'")
    extra = {"range": area} if area else {}
    return Options(sheets=None if sheets is None else tuple(sheets), columns=columns, nulls=nulls, **known, **extra)


@dataclass(frozen=True)
class Task:
    """A scan of one sheet, or of a range of bytes of its part. ``offsets``: for each output column its column in the sheet."""

    path: str
    sheet: str
    first_row: int | None
    row_hi: int | None
    offsets: tuple[int | None, ...]
    col_lo: int
    col_hi: int
    part: tuple[int, int | None] = (0, None)


@dataclass(frozen=True)
class Plan:
    columns: tuple[tuple[str, str], ...]
    tasks: tuple[Task, ...]
    options: Options

    def schema(self) -> T.StructType:
        extra = [x for x in (self.options.sheet_name_column, self.options.file_name_column) if x]
        return T.StructType([T.StructField(n, SPARK_TYPES[t], True) for n, t in self.columns] + [T.StructField(x, T.StringType(), True) for x in extra])


def prefixed(prefix: str, error: SheetError) -> SheetError:
    text = str(error)
    return error if text.startswith(f"{prefix}: ") else SheetError(f"{prefix}: {text}")


def opened(path: str):
    try:
        return open_book(path)
    except SheetError as e:
        raise prefixed(path, e) from e


def chosen(book, patterns: list[str] | None, limit: int | None = None) -> list[str]:
    names = [s for s in book.sheets if patterns is None or any(globs.matches(p, s) for p in patterns)]
    return names[:limit]


def _unique(columns: tuple[tuple[str, str], ...]) -> tuple[tuple[str, str], ...]:
    """Repeated names get ``_1``, ``_2``: Spark can't refer to equal ones."""
    out, seen = [], set()
    for name, kind in columns:
        new, k = name, 0
        while new.lower() in seen:
            k += 1
            new = f"{name}_{k}"
        seen.add(new.lower())
        out.append((new, kind))
    return tuple(out)


def _cuts(book, sheet: str, options: Options) -> list[tuple[int, int | None]]:
    """The byte ranges that a sheet's part is read in."""
    size = book.part_size(sheet)
    if not book.splittable or options.end_at_empty_row or size < 2 * options.split_bytes or not book.has_row_numbers(sheet):
        return [(0, None)]
    n = size // options.split_bytes
    at = [size * k // n for k in range(n)]
    return list(zip(at, [*at[1:], None], strict=True))


def plan_single(path: str, options: Options, *, tasks: bool = True) -> Plan:
    book = opened(path)
    try:
        names = chosen(book, None if options.sheets is None else list(options.sheets), 1)
        table = analyze(book, names[0], options) if names else None
        if table is None:
            raise SheetError(f"Spreadsheet '{path}': no sheets matched wildcard '{(options.sheets or ('*',))[0]}'")
        places = tuple(range(table.col_lo, table.col_hi + 1))
        cuts = _cuts(book, table.sheet, options) if tasks else []
        return Plan(_unique(table.columns), tuple(Task(path, table.sheet, table.first_row, options.range.row_hi, places, table.col_lo, table.col_hi, cut) for cut in cuts), options)
    except SheetError as e:
        raise prefixed(path, e) from e
    finally:
        book.close()


def analyzed(path: str, options: Options, none_means_all: bool, tasks: bool = False) -> list[tuple[Table, list[tuple[int, int | None]]]]:
    """The analysed sheets of a workbook, with the byte ranges to read if ``tasks``. The workbook is closed again."""
    book = opened(path)
    patterns = globs.sheet_globs(options.sheets, path)
    if patterns == [] and none_means_all:
        patterns = None
    try:
        tables = [t for s in chosen(book, patterns) if (t := analyze(book, s, options)) is not None]
        return [(t, _cuts(book, t.sheet, options) if tasks else []) for t in tables]
    except SheetError as e:
        raise prefixed(path, e) from e
    finally:
        book.close()


#: What the analysis of a workbook found: its path, and its sheets with the byte ranges to read.
Found = tuple[str, list[tuple[Table, list[tuple[int, int | None]]]]]


def found_text(found: list[Found]) -> str:
    return json.dumps([[path, [[t.sheet, t.columns, t.first_row, t.col_lo, t.col_hi, cuts] for t, cuts in tables]] for path, tables in found])


def found_of(text: str) -> list[Found]:
    table = lambda sheet, columns, *rest: Table(sheet, tuple((n, k) for n, k in columns), *rest)
    return [(path, [(table(*x[:5]), [(lo, hi) for lo, hi in x[5]]) for x in tables]) for path, tables in json.loads(text)]


def plan_multi(paths: list[str], options: Options, *, tasks: bool = True, found: list[Found] | None = None) -> Plan:
    """The plan of several workbooks. ``found``: their analysis, if it was made already (by tasks of a cluster, say)."""
    columns: dict[str, str] = {}
    scans: list[tuple[str, Table, dict[str, int], list[tuple[int, int | None]]]] = []
    first: tuple[Table, dict[str, int]] | None = None
    for path, tables in found if found is not None else ((x, analyzed(x, options, True, tasks)) for x in globs.expand(paths)):
        for table, cuts in tables:
            places: dict[str, int] = {}
            if options.union_by_name or first is None:
                for k, (name, kind) in enumerate(table.columns):
                    if columns.setdefault(name, kind) != kind:
                        shown = [_SHOWN.get(x, x.capitalize()) for x in (columns[name], kind)]
                        raise SheetError(f"[{path}]{table.sheet}!{name}: expected {shown[0]}, actual {shown[1]}")
                    places[name] = table.col_lo + k
            first = first or (table, places)
            scans.append((path, table, places, cuts))
    if first is None:
        raise SheetError(NO_SHEETS)
    out: list[Task] = []
    for path, table, places, cuts in scans:
        shape, used = (table, places) if options.union_by_name else first
        where = tuple(used.get(n) for n in columns)
        out += [Task(path, table.sheet, shape.first_row, options.range.row_hi, where, shape.col_lo, shape.col_hi, cut) for cut in cuts]
    return Plan(tuple(columns.items()), tuple(out), options)
