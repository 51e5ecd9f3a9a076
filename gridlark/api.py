"""Public functions. ``register`` makes the data source and the SQL functions known to a session."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from gridlark.functions import globs
from gridlark.model import Options, SheetError
from gridlark.operators import tvf
from gridlark.plans.planner import analyzed, found_of, found_text, parse_options
from gridlark.sources.datasource import SheetDataSource

JOB_FILES = 4


def register(spark: SparkSession) -> SparkSession:
    """Registers format ``sheet`` and the table functions, and turns the TIME type on."""
    spark.conf.set("spark.sql.timeType.enabled", "true")
    spark.dataSource.register(SheetDataSource)
    tvf.register_functions(spark)
    return spark


def _text(given: dict) -> dict[str, str]:
    out = {}
    for key, value in given.items():
        if value is not None:
            out[key] = value if isinstance(value, str) else json.dumps(sorted(value) if isinstance(value, (set, frozenset)) else value)
    return out


def read_sheet(spark: SparkSession, path: str, **options) -> DataFrame:
    """The first sheet of a workbook, or the first that ``sheet`` matches.

    Options: sheet, range, header, columns, analyze_rows, nulls, error_as_null, skip_empty_rows, end_at_empty_row,
    file_name_column, sheet_name_column, split_bytes.
    """
    spark.dataSource.register(SheetDataSource)
    return spark.read.format("sheet").options(multiple="false", **_text(options)).load(path)


def _analysis(spark: SparkSession, files: list[str], options: Options) -> str | None:
    """The sheets of many workbooks, each opened once, in a task; None if one can't be read, so that planning says why."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, path in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    found = found_text([(path, analyzed(path, options, True, True))])
                except SheetError:
                    found = None
                yield pa.record_batch([pa.array([at], pa.int64()), pa.array([found], pa.string())], names=["at", "found"])

    rows = spark.sparkContext.parallelize(list(enumerate(files)), min(len(files), 10_000))
    got = spark.createDataFrame(rows, "at long, path string").mapInArrow(run, "at long, found string").collect()
    if any(r.found is None for r in got):
        return None
    return found_text([x for r in sorted(got) for x in found_of(r.found)])


def read_sheets(spark: SparkSession, paths: str | list[str], **options) -> DataFrame:
    """Sheets of several workbooks, by position, or by name with ``union_by_name``. Options as for read_sheet, with ``sheets`` for ``sheet``.

    From ``JOB_FILES`` files on, their sheets are analysed by tasks, each workbook once; what reaches the driver are names and types of columns.
    """
    spark.dataSource.register(SheetDataSource)
    files = [paths] if isinstance(paths, str) else list(paths)
    every = globs.expand(files)
    analysis = _analysis(spark, every, parse_options(**options)) if len(every) >= JOB_FILES else None
    return spark.read.format("sheet").options(multiple="true", paths=json.dumps(files), **_text({**options, "analysis": analysis})).load()


def analyze_sheet(spark: SparkSession, path: str, **options) -> DataFrame:
    """``column_name, column_type`` of a sheet. Options: sheet, range, header, analyze_rows, nulls, error_as_null."""
    return spark.createDataFrame(tvf.analyze_one(path, **options), tvf.ONE)


def analyze_sheets(spark: SparkSession, paths: str | list[str], **options) -> DataFrame:
    """``file_name, sheet_name, column_name, column_type`` of all matching sheets; a task for each file."""
    files = globs.expand([paths] if isinstance(paths, str) else list(paths))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                if rows := tvf.analyze_many(path, **options):
                    yield pa.record_batch([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], names=tvf.MANY.names)

    rows = spark.sparkContext.parallelize([(f,) for f in files], min(len(files), 10_000))
    return spark.createDataFrame(rows, "path string").mapInArrow(run, tvf.MANY)
