"""Structured streaming over a folder of workbooks: files are the unit of arrival; the schema is that of a sample workbook."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from gridlark.functions.globs import local_path
from gridlark.model import SheetError
from gridlark.operators.analyze import analyze
from gridlark.operators.scan import scan_checked
from gridlark.plans.planner import Plan, Task, chosen, parse_options, plan_multi
from gridlark.sources.books import open_book


def _task(plan: Plan, book, path: str, sheet: str) -> Task | None:
    """The scan of a sheet with the sample's bounds, or by name with its own; None for a sheet without columns."""
    if not plan.options.union_by_name:
        return replace(plan.tasks[0], path=path, sheet=sheet, part=(0, None))
    table = analyze(book, sheet, plan.options)
    if table is None:
        return None
    places = {name: table.col_lo + k for k, (name, _) in enumerate(table.columns)}
    return Task(path, sheet, table.first_row, plan.options.range.row_hi, tuple(places.get(n) for n, _ in plan.columns), table.col_lo, table.col_hi)


def stream_sheets(spark: SparkSession, folder: str, sample: str, *, glob: str = "*", max_files: int = 100, skip_unreadable: bool = False, **options) -> DataFrame:
    """A streaming DataFrame of the sheets of workbooks dropped into ``folder``, with the sample's schema: read by position, or by name with ``union_by_name``.

    Each file is read by Spark's binary file source, so the folder may be in any store that Spark reads; files are below 2 GB. A workbook that can't be
    opened ends the stream, or is left out if ``skip_unreadable``; errors of cells end it in any case, unless ``error_as_null``.
    """
    plan = plan_multi([sample], parse_options(**options), tasks=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                path = local_path(path)
                patterns = None if plan.options.sheets is None else list(plan.options.sheets)
                try:
                    book = open_book(path, content)
                    tasks = [t for sheet in chosen(book, patterns) if (t := _task(plan, book, path, sheet))]
                except SheetError:
                    if skip_unreadable:
                        continue
                    raise
                for task in tasks:
                    yield from scan_checked(plan, task, True, content)

    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    found = files.option("pathGlobFilter", glob).option("maxFilesPerTrigger", max_files).load(folder)
    return found.select("path", "content").mapInArrow(run, plan.schema())
