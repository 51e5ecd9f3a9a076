"""SQL table functions ``read_sheet``, ``read_sheets``, ``analyze_sheet`` and ``analyze_sheets``."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from gridlark.functions import globs
from gridlark.operators.scan import scan_checked
from gridlark.plans.planner import Plan, analyzed, chosen, opened, parse_options, plan_multi, plan_single

ONE = T.StructType([T.StructField(n, T.StringType()) for n in ("column_name", "column_type")])
MANY = T.StructType([T.StructField(n, T.StringType()) for n in ("file_name", "sheet_name", "column_name", "column_type")])


def analyze_one(path: str, **given) -> list[tuple[str, str]]:
    from gridlark.operators.analyze import analyze

    options, book = parse_options(**given), opened(path)
    names = chosen(book, None if options.sheets is None else list(options.sheets), 1)
    table = analyze(book, names[0], options) if names else None
    return list(table.columns) if table else []


def analyze_many(path: str, **given) -> list[tuple[str, str, str, str]]:
    """The columns of a file's sheets; a file for which no pattern applies has none."""
    return [(path, t.sheet, name, kind) for t, _ in analyzed(path, parse_options(**given), False) for name, kind in t.columns]


def _rows(plan: Plan, multi: bool) -> Iterator[tuple]:
    for task in plan.tasks:
        for batch in scan_checked(plan, task, multi):
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _values(given: dict[str, AnalyzeArgument]) -> dict:
    return {k: v.value for k, v in given.items()}


class ReadSheet:
    @staticmethod
    def analyze(path: AnalyzeArgument, **given: AnalyzeArgument) -> AnalyzeResult:
        return AnalyzeResult(plan_single(path.value, parse_options(**_values(given)), tasks=False).schema())

    def eval(self, path: str, **given) -> Iterator[tuple]:
        yield from _rows(plan_single(path, parse_options(**given)), False)


class ReadSheets:
    @staticmethod
    def analyze(paths: AnalyzeArgument, **given: AnalyzeArgument) -> AnalyzeResult:
        return AnalyzeResult(plan_multi(list(paths.value), parse_options(**_values(given)), tasks=False).schema())

    def eval(self, paths: list[str], **given) -> Iterator[tuple]:
        yield from _rows(plan_multi(list(paths), parse_options(**given)), True)


class AnalyzeSheet:
    @staticmethod
    def analyze(path: AnalyzeArgument, **given: AnalyzeArgument) -> AnalyzeResult:
        return AnalyzeResult(ONE)

    def eval(self, path: str, **given) -> Iterator[tuple]:
        yield from analyze_one(path, **given)


class AnalyzeSheets:
    @staticmethod
    def analyze(paths: AnalyzeArgument, **given: AnalyzeArgument) -> AnalyzeResult:
        return AnalyzeResult(MANY)

    def eval(self, paths: list[str], **given) -> Iterator[tuple]:
        for path in globs.expand(list(paths)):
            yield from analyze_many(path, **given)


def register_functions(spark: SparkSession) -> None:
    from pyspark.sql.functions import udtf

    for name, kind in (("read_sheet", ReadSheet), ("read_sheets", ReadSheets), ("analyze_sheet", AnalyzeSheet), ("analyze_sheets", AnalyzeSheets)):
        spark.udtf.register(name, udtf(kind))
