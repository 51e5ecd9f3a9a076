"""Spark data source ``sheet``: one partition for each sheet, or for each range of a large XLSX sheet, of Arrow batches."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import replace

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from gridlark.model import SheetError
from gridlark.operators.scan import scan_checked
from gridlark.plans.planner import Plan, Task, found_of, parse_options, plan_multi, plan_single

_FLAGS = ("header", "union_by_name", "error_as_null", "skip_empty_rows", "end_at_empty_row")
_NUMBERS = ("analyze_rows", "split_bytes")
_JSON = ("sheets", "nulls", "columns")
_TEXTS = ("sheet", "range", "file_name_column", "sheet_name_column")


def parse_text_options(options: dict[str, str]) -> tuple[list[str], bool, dict]:
    """Paths, whether several files or sheets are meant, and typed options, from a data source's options."""
    given = {k.lower(): v for k, v in options.items()}
    paths = json.loads(given.pop("paths")) if "paths" in given else [given.pop("path")] if "path" in given else []
    if not paths:
        raise SheetError("a path is required")
    several = given.pop("multiple", None)
    multi = len(paths) > 1 or "sheets" in given or "union_by_name" in given if several is None else several.lower() == "true"
    out: dict = {}
    for key, value in given.items():
        if key in _FLAGS:
            out[key] = value.strip().lower() in ("true", "1")
        elif key in _NUMBERS:
            out[key] = int(value)
        elif key in _JSON:
            out[key] = json.loads(value)
        elif key in _TEXTS:
            out[key] = value
        else:
            raise SheetError(f"Unknown option '{key}'")
    return paths, multi, out


def make_plan(options: dict[str, str], *, tasks: bool = True) -> tuple[Plan, bool]:
    analysis = options.get("analysis")
    paths, multi, typed = parse_text_options({k: v for k, v in options.items() if k.lower() != "analysis"})
    parsed = parse_options(**typed)
    return (plan_multi(paths, parsed, tasks=tasks, found=found_of(analysis) if analysis else None) if multi else plan_single(paths[0], parsed, tasks=tasks)), multi


class SheetPartition(InputPartition):
    def __init__(self, task: Task):
        super().__init__(None)
        self.task = task


class SheetReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        plan, self.multi = make_plan(options)
        self.tasks, self.plan = plan.tasks, replace(plan, tasks=())

    def __getstate__(self) -> dict:
        """What a task gets: columns and options, its own work being in its partition."""
        return self.__dict__ | {"tasks": ()}

    def partitions(self) -> list[SheetPartition]:
        return [SheetPartition(t) for t in self.tasks]

    def read(self, partition: SheetPartition) -> Iterator[pa.RecordBatch]:
        return scan_checked(self.plan, partition.task, self.multi)


class SheetDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sheet"

    def schema(self) -> StructType:
        return make_plan(dict(self.options), tasks=False)[0].schema()

    def reader(self, schema: StructType) -> SheetReader:
        return SheetReader(dict(self.options))
