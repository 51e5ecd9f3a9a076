"""Execution of a scan task: rows of a sheet as Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

from gridlark.functions import a1
from gridlark.functions.casts import ARROW_TYPES, arrow_column
from gridlark.model import SheetError
from gridlark.operators.rows import selected, with_gaps
from gridlark.plans.planner import Plan, Task
from gridlark.sources.books import open_book

BATCH_ROWS = 8192


def _last_before(book, task: Task, pick) -> int | None:
    """The last row that isn't empty before the task's part."""
    near = book.rows_before(task.sheet, task.part[0])
    last = max((row for row, _ in pick(iter(near))), default=None) if near else None
    if last is None:
        last = max((row for row, _ in pick(book.rows(task.sheet, task.first_row, task.row_hi, (0, task.part[0])))), default=None)
    return last


def scan(plan: Plan, task: Task, data: bytes | None = None) -> Iterator[pa.RecordBatch]:
    options, book = plan.options, open_book(task.path, data)
    place = f"[{task.path}]{task.sheet}"
    pick = lambda rows: selected(rows, options, task.col_lo, task.col_hi, task.first_row, task.row_hi, place)
    first = task.first_row
    if task.part[0] and not options.skip_empty_rows and (last := _last_before(book, task, pick)) is not None:
        first = last + 1
    pad = task.row_hi if task.part[1] is None else None
    rows = with_gaps(pick(book.rows(task.sheet, task.first_row, task.row_hi, task.part)), first, pad, options.skip_empty_rows, options.end_at_empty_row)
    slots: dict[int, list[int]] = {}
    for slot, col in enumerate(task.offsets):
        if col is not None:
            slots.setdefault(col, []).append(slot)
    extra = [x for x in (options.sheet_name_column and task.sheet, options.file_name_column and task.path) if x]
    names = plan.schema().names
    width = len(plan.columns)
    single = {c: s[0] for c, s in slots.items()}

    def batch(numbers: list[int], kinds: list[list[int]], values: list[list[str | None]]) -> pa.RecordBatch:
        out = []
        for k, (_, target) in enumerate(plan.columns):
            col = task.offsets[k]
            if col is None:
                out.append(pa.nulls(len(numbers), ARROW_TYPES[target]))
            else:
                out.append(arrow_column(target, kinds[k], values[k], book.date1904, lambda i, c=col: f"{place}!{a1.reference(numbers[i], c)}", options.error_as_null))
        out += [pa.array([x] * len(numbers), pa.string()) for x in extra]
        return pa.record_batch(out, names=names)

    numbers: list[int] = []
    kinds: list[list[int]] = [[] for _ in range(width)]
    values: list[list[str | None]] = [[] for _ in range(width)]

    def fresh() -> tuple[list[list[int]], list[list[str | None]]]:
        return [[0] * BATCH_ROWS for _ in range(width)], [[None] * BATCH_ROWS for _ in range(width)]

    kinds, values = fresh()
    for row, cells in rows:
        at = len(numbers)
        numbers.append(row)
        for col, kind, text in cells:
            k = single.get(col)
            if k is not None:
                kinds[k][at] = kind
                values[k][at] = text
        if at + 1 == BATCH_ROWS:
            yield batch(numbers, kinds, values)
            numbers = []
            kinds, values = fresh()
    if numbers:
        n = len(numbers)
        yield batch(numbers, [x[:n] for x in kinds], [x[:n] for x in values])


def scan_checked(plan: Plan, task: Task, multi: bool, data: bytes | None = None) -> Iterator[pa.RecordBatch]:
    try:
        yield from scan(plan, task, data)
    except SheetError as e:
        raise SheetError(f"{task.path}: {task.sheet}: {e}" if multi else f"{task.path}: {e}") from e
