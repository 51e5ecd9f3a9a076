"""Queries over workbooks that are written from tables, with the equivalent SQL on the tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from itertools import chain, islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridlark import api
from gridlark.model import SheetError
from gridlark.sources.writers import Raw, write_book, write_ods_tables

Query = Callable[[SparkSession, str], DataFrame]
XLS_ROWS = 65_536
SHEET_ROWS = 1_048_576
#: Rows of a table that a task writes to a workbook.
BOOK_ROWS = {"xlsx": 200_000, "xlsb": 200_000, "xls": 60_000, "ods": 100_000}
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def folder(spark: SparkSession) -> str:
    """A new folder for workbooks: below the shared folder if the session names one, else a temporary one."""
    root = (spark.conf.get("spark.checkpoint.dir", None) or "").removeprefix("file://").removeprefix("file:")
    if not root.startswith("/"):
        return tempfile.mkdtemp(prefix="gridlark-books-")
    out = os.path.join(root, f"books-{uuid.uuid4().hex}")
    os.makedirs(out)
    return out


def grid(spark: SparkSession, sf_dir: str, table: str, columns: list[str], order: str, convert=None) -> list[list]:
    """Header and rows of a small table as a worksheet's; they are gathered on the driver, see ``books`` for others."""
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns).orderBy(order).toArrow().to_pylist()
    return [columns, *([(convert or (lambda _, v: v))(c, r[c]) for c in columns] for r in rows)]


def as_dates(name: str, value):
    return value.date() if name.endswith("date") and value is not None else value


def _written(where: str, fmt: str, sheet: str, header: list[str], convert: Callable[[tuple], list], options: dict):
    """A task's workbooks, one but where it has more rows than a sheet holds; XLS has several sheets then."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        rows = (convert(r) for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        k = 0
        while (first := next(rows, None)) is not None:
            sheets = [(sheet, chain([header, first], islice(rows, SHEET_ROWS - 2)))]
            if fmt == "xls":
                every = [first, *rows]
                step = -(-len(every) // -(-len(every) // (XLS_ROWS - 1)))
                sheets = [(f"{sheet} {at // step}" if step < len(every) else sheet, [header, *every[at : at + step]]) for at in range(0, len(every), step)]
            # By another name until it's whole, as a task may run twice.
            name = f"part{task.partitionId():06d}-{k:03d}.{fmt}"
            path = write_book(f"{where}/_{task.taskAttemptId()}-{name}", sheets, **options)
            os.replace(path, f"{where}/{name}")
            yield pa.record_batch([pa.array([f"{where}/{name}"])], names=["path"])
            k += 1

    return run


def books(spark: SparkSession, sf_dir: str, table: str, columns: list[str], order: str, fmt: str, sheet: str, header: list[str], convert: Callable[[tuple], list], **options) -> list[str]:
    """Workbooks of a table of any size, in its order, each written by a task; the driver gets their paths."""
    where = folder(spark)
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)
    dealt = rows.repartitionByRange(max(1, -(-rows.count() // BOOK_ROWS[fmt])), order).sortWithinPartitions(order)
    found = sorted(r.path for r in dealt.mapInArrow(_written(where, fmt, sheet, header, convert, options), "path string").collect())
    return found or [write_book(f"{where}/part.{fmt}", [(sheet, [header])], **options)]


def read_books(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    """A workbook by its first sheet, several by all of theirs. (A single XLS workbook may have several sheets.)"""
    if len(paths) == 1 and not paths[0].endswith(".xls"):
        return api.read_sheet(spark, paths[0], **options)
    return api.read_sheets(spark, paths, union_by_name=True, **options)


def priced(spark: SparkSession, d: str, fmt: str) -> list[str]:
    columns = ["o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority"]
    return books(spark, d, "orders", columns, "o_orderkey", fmt, "orders", columns, lambda r: [r[0], r[1], r[2] and r[2].date(), r[3]])


def _nation(fmt: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        path = write_book(f"{folder(spark)}/nation.{fmt}", [("nation", grid(spark, d, "nation", ["n_nationkey", "n_name", "n_regionkey"], "n_nationkey"))])
        return api.read_sheet(spark, path)

    return run


for _fmt in ("xlsx", "xlsb", "xls", "ods"):
    QUERIES[f"read_{_fmt}_nation"] = _nation(_fmt)
    SQL[f"read_{_fmt}_nation"] = "select cast(n_nationkey as bigint) n_nationkey, n_name, cast(n_regionkey as bigint) n_regionkey from nation"


def _typed(fmt: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        return read_books(spark, priced(spark, d, fmt), analyze_rows=200)

    return run


for _fmt in ("xlsx", "xlsb", "xls", "ods"):
    QUERIES[f"read_{_fmt}_orders"] = _typed(_fmt)
    SQL[f"read_{_fmt}_orders"] = "select o_orderkey, o_totalprice, cast(o_orderdate as date) o_orderdate, o_orderpriority from orders"


def supplier(spark: SparkSession, d: str, fmt: str = "xlsx", convert=None) -> str:
    return write_book(f"{folder(spark)}/supplier.{fmt}", [("supplier", grid(spark, d, "supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"], "s_suppkey", convert))])


@query("select s_suppkey, s_name from supplier order by s_suppkey limit 8 offset 1")
def read_range_block(spark: SparkSession, d: str) -> DataFrame:
    df = api.read_sheet(spark, supplier(spark, d), range="A3:B10", header=False)
    return df.toDF("s_suppkey", "s_name")


@query("select s_name, s_acctbal from (select *, row_number() over (order by s_suppkey) r from supplier) where r >= 5")
def read_range_open(spark: SparkSession, d: str) -> DataFrame:
    return api.read_sheet(spark, supplier(spark, d, "ods"), range="B6", header=False).select(F.col("B").alias("s_name"), F.col("D").alias("s_acctbal"))


@query('select cast(r_regionkey as bigint) "A", r_name "B" from region')
def read_no_header(spark: SparkSession, d: str) -> DataFrame:
    rows = grid(spark, d, "region", ["r_regionkey", "r_name"], "r_regionkey")[1:]
    return api.read_sheet(spark, write_book(f"{folder(spark)}/region.xlsb", [("region", rows)]), header=False)


@query("select cast(n_nationkey as varchar) n_nationkey, n_name, cast(n_regionkey as double) n_regionkey from nation")
def columns_override(spark: SparkSession, d: str) -> DataFrame:
    path = write_book(f"{folder(spark)}/nation.xlsx", [("nation", grid(spark, d, "nation", ["n_nationkey", "n_name", "n_regionkey"], "n_nationkey"))])
    return api.read_sheet(spark, path, columns={"n_region*": "DOUBLE", "*": "varchar"})


@query("select s_suppkey, nullif(s_name, (select min(s_name) from supplier)) s_name from supplier")
def null_literals(spark: SparkSession, d: str) -> DataFrame:
    rows = grid(spark, d, "supplier", ["s_suppkey", "s_name"], "s_suppkey")
    path = write_book(f"{folder(spark)}/supplier.xls", [("s", rows)])
    return api.read_sheet(spark, path, nulls=["", min(r[1] for r in rows[1:])])


def gapped(spark: SparkSession, d: str) -> str:
    """Suppliers with a blank row after every fifth."""
    rows = grid(spark, d, "supplier", ["s_suppkey", "s_name"], "s_suppkey")
    out = rows[:1]
    for k, row in enumerate(rows[1:], 1):
        out += [row, [None, None]] if k % 5 == 0 and k + 1 < len(rows) else [row]
    return write_book(f"{folder(spark)}/gaps.xlsx", [("s", out)])


@query("select s_suppkey, s_name from supplier union all select null, null from supplier where (select count(*) from supplier where s_suppkey >= 0) > 0 and s_suppkey in (select s_suppkey from (select s_suppkey, row_number() over (order by s_suppkey) r, count(*) over () n from supplier) where r % 5 = 0 and r < n)")
def blank_rows_kept(spark: SparkSession, d: str) -> DataFrame:
    return api.read_sheet(spark, gapped(spark, d))


@query("select s_suppkey, s_name from supplier")
def skip_empty_rows(spark: SparkSession, d: str) -> DataFrame:
    return api.read_sheet(spark, gapped(spark, d), skip_empty_rows=True)


@query("select s_suppkey, s_name from supplier order by s_suppkey limit 5")
def end_at_empty_row(spark: SparkSession, d: str) -> DataFrame:
    return api.read_sheet(spark, gapped(spark, d), end_at_empty_row=True)


@query("select s_suppkey, case when s_suppkey % 3 <> 0 then s_acctbal end s_acctbal from supplier")
def error_as_null(spark: SparkSession, d: str) -> DataFrame:
    rows = grid(spark, d, "supplier", ["s_suppkey", "s_acctbal"], "s_suppkey")
    rows[1:] = [[k, Raw("error", "#DIV/0!") if k % 3 == 0 else v] for k, v in rows[1:]]
    return api.read_sheet(spark, write_book(f"{folder(spark)}/errors.xlsb", [("s", rows)]), error_as_null=True)


@query("select s_suppkey, cast(case when s_suppkey % 2 = 0 then s_suppkey else s_acctbal end as double) mixed, case when s_suppkey % 2 = 0 then cast(s_suppkey as varchar) else s_name end texts from supplier")
def infer_types_mixed(spark: SparkSession, d: str) -> DataFrame:
    rows = grid(spark, d, "supplier", ["s_suppkey", "s_acctbal", "s_name"], "s_suppkey")
    rows = [["s_suppkey", "mixed", "texts"], *([k, k, k] if k % 2 == 0 else [k, a, n] for k, a, n in rows[1:])]
    return api.read_sheet(spark, write_book(f"{folder(spark)}/mixed.xlsx", [("s", rows)]))


def _dates(date1904: bool):
    def run(spark: SparkSession, d: str) -> DataFrame:
        convert = lambda r: [r[0], r[1].date(), r[1].replace(hour=r[0] % 24, minute=30), r[1].replace(hour=r[0] % 24, minute=15).time()]
        paths = books(spark, d, "orders", ["o_orderkey", "o_orderdate"], "o_orderkey", "xlsx", "s", ["o_orderkey", "day", "moment", "clock"], convert, date1904=date1904)
        df = read_books(spark, paths)
        return df.select("o_orderkey", "day", "moment", F.expr("cast(clock as string)").alias("clock"))

    return run


for _name, _flag in (("dates_1900", False), ("dates_1904", True)):
    QUERIES[_name] = _dates(_flag)
    SQL[_name] = "select o_orderkey, cast(o_orderdate as date) as day, o_orderdate + to_hours(cast(o_orderkey % 24 as int)) + to_minutes(30) as moment, lpad(cast(o_orderkey % 24 as varchar), 2, '0') || ':15:00' as clock from orders"


def by_region(spark: SparkSession, d: str) -> str:
    """A workbook for each even or odd region key, with a sheet for each region; every second sheet has its columns turned round."""
    where = folder(spark)
    rows = grid(spark, d, "nation", ["n_nationkey", "n_name", "n_regionkey"], "n_nationkey")
    for parity, fmt in ((0, "xlsx"), (1, "ods")):
        sheets = []
        for region in sorted({r[2] for r in rows[1:]}):
            if region % 2 == parity:
                part = [["n_nationkey", "n_name"], *(r[:2] for r in rows[1:] if r[2] == region)]
                sheets.append((f"Region {region}", [r[::-1] for r in part] if region > 1 else part))
        sheets.append(("Notes", [["x"], ["y"]]) if parity else ("Empty", []))
        write_book(f"{where}/part{parity}.{fmt}", sheets)
    return where


@query("select n_name, cast(n_nationkey as bigint) n_nationkey, 'Region ' || n_regionkey sheet, 'part' || n_regionkey % 2 file from nation")
def read_sheets_by_name(spark: SparkSession, d: str) -> DataFrame:
    df = api.read_sheets(spark, f"{by_region(spark, d)}/*", sheets=["Region*"], union_by_name=True, sheet_name_column="sheet", file_name_column="file")
    return df.withColumn("file", F.regexp_extract("file", r"(part\d)\.", 1))


@query("select cast(n_nationkey as bigint) n_nationkey, n_name, n_regionkey || '' sheet from nation where n_regionkey in (0, 1)")
def read_sheets_positional(spark: SparkSession, d: str) -> DataFrame:
    df = api.read_sheets(spark, [f"{by_region(spark, d)}/part?.*"], sheets=["Region [01]"], sheet_name_column="sheet")
    return df.withColumn("sheet", F.substring("sheet", -1, 1))


@query("select cast(n_nationkey as bigint) n_nationkey, n_name from nation where n_regionkey = 0 or n_regionkey in (1, 3)")
def file_specific_globs(spark: SparkSession, d: str) -> DataFrame:
    where = by_region(spark, d)
    return api.read_sheets(spark, f"{where}/**/*", sheets=["*.xlsx=Region 0", "*.ods = Region *"], union_by_name=True)


@query("select * from (values ('s_suppkey', 'bigint'), ('s_name', 'varchar'), ('s_nationkey', 'bigint'), ('s_acctbal', 'double')) t(column_name, column_type)")
def analyze_sheet(spark: SparkSession, d: str) -> DataFrame:
    return api.analyze_sheet(spark, supplier(spark, d, "xls"))


@query("select 'part' || (r % 2) file_name, 'Region ' || r sheet_name, c column_name, case when c = 'n_name' then 'varchar' else 'bigint' end column_type from range(5) t(r), (values ('n_nationkey'), ('n_name')) u(c) union all select 'part1', 'Notes', 'x', 'varchar'")
def analyze_sheets(spark: SparkSession, d: str) -> DataFrame:
    return api.analyze_sheets(spark, f"{by_region(spark, d)}/*").withColumn("file_name", F.regexp_extract("file_name", r"(part\d)\.", 1))


@query("select n_name, count(*) n, round(sum(s_acctbal), 2) balance from supplier join nation on s_nationkey = n_nationkey group by n_name")
def sheet_join_aggregate(spark: SparkSession, d: str) -> DataFrame:
    left = api.read_sheet(spark, supplier(spark, d))
    joined = left.join(QUERIES["read_xlsb_nation"](spark, d), F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(F.count("*").alias("n"), F.round(F.sum("s_acctbal"), 2).alias("balance"))


@query("select s_nationkey, s_suppkey, cast(r as integer) r from (select cast(s_nationkey as bigint) s_nationkey, s_suppkey, row_number() over (partition by s_nationkey order by s_acctbal desc, s_suppkey) r from supplier) where r <= 2")
def sheet_window_topk(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("s_nationkey").orderBy(F.desc("s_acctbal"), "s_suppkey")
    return api.read_sheet(spark, supplier(spark, d)).withColumn("r", F.row_number().over(w)).where("r <= 2").select("s_nationkey", "s_suppkey", "r")


@query("select cast(n_nationkey as bigint) n_nationkey, n_nationkey in (select s_nationkey from supplier where s_acctbal > 0) has from nation")
def sheet_semi_anti(spark: SparkSession, d: str) -> DataFrame:
    nations, suppliers = QUERIES["read_ods_nation"](spark, d), api.read_sheet(spark, supplier(spark, d)).where("s_acctbal > 0")
    on = F.col("n_nationkey") == F.col("s_nationkey")
    has = nations.join(suppliers, on, "left_semi").select("n_nationkey", F.lit(True).alias("has"))
    return has.union(nations.join(suppliers, on, "left_anti").select("n_nationkey", F.lit(False)))


@query("select cast(n_regionkey as bigint) n_regionkey, n_name, count(*) n from nation group by rollup (1, 2)")
def sheet_rollup(spark: SparkSession, d: str) -> DataFrame:
    return QUERIES["read_xls_nation"](spark, d).rollup("n_regionkey", "n_name").agg(F.count("*").alias("n"))


@query("select cast(n_regionkey as bigint) k from nation where n_regionkey < 3 union all select cast(n_regionkey as bigint) from nation except all select cast(r_regionkey as bigint) from region")
def sheet_set_operations(spark: SparkSession, d: str) -> DataFrame:
    k = QUERIES["read_xlsx_nation"](spark, d).select(F.col("n_regionkey").alias("k"))
    return k.where("k < 3").union(k).exceptAll(read_no_header(spark, d).select(F.col("A").alias("k")))


@query("select s_suppkey, (select count(*) from nation where n_nationkey < s_nationkey) n_before from supplier")
def sheet_theta_join(spark: SparkSession, d: str) -> DataFrame:
    nations, suppliers = QUERIES["read_xlsx_nation"](spark, d), api.read_sheet(spark, supplier(spark, d))
    joined = suppliers.join(nations, F.col("n_nationkey") < F.col("s_nationkey"), "left")
    return joined.groupBy("s_suppkey").agg(F.count("n_nationkey").alias("n_before"))


@query("select o_orderpriority, count(*) n, round(avg(o_totalprice), 4) mean, min(cast(o_orderdate as date)) first_day from orders where o_totalprice > 1000 group by 1")
def sheet_sql_function(spark: SparkSession, d: str) -> DataFrame:
    """A call for each workbook; for at most 32 calls where there are more, as each is planned by itself and runs in a task."""
    paths = priced(spark, d, "xlsx")
    api.register(spark)
    calls = [f"read_sheet('{paths[0]}', sheet => 'ord*', analyze_rows => 100)"]
    if len(paths) > 1:
        some = [paths[k::32] for k in range(min(32, len(paths)))]
        calls = ["read_sheets(array({}), sheets => array('ord*'), union_by_name => true, analyze_rows => 100)".format(", ".join(f"'{x}'" for x in part)) for part in some]
    rows = " union all ".join(f"select * from {call}" for call in calls)
    return spark.sql(f"select o_orderpriority, count(*) n, round(avg(o_totalprice), 4) mean, min(o_orderdate) first_day from ({rows}) where o_totalprice > 1000 group by 1")


@query("select s_suppkey, s_acctbal > 0 positive, case when s_suppkey % 4 > 0 then s_acctbal > 5000 end rich from supplier")
def boolean_columns(spark: SparkSession, d: str) -> DataFrame:
    rows = grid(spark, d, "supplier", ["s_suppkey", "s_acctbal"], "s_suppkey")
    rows = [["s_suppkey", "positive", "rich"], *([k, v > 0, v > 5000 if k % 4 else None] for k, v in rows[1:])]
    return api.read_sheet(spark, write_book(f"{folder(spark)}/flags.xlsb", [("s", rows)]))


@query("select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day, strftime(o_orderdate, '%Y-%m-%d') || ' ' || lpad(cast(o_orderkey % 24 as varchar), 2, '0') || ':30:00' as moment, case when o_orderkey % 2 = 0 then 'true' else 'false' end flag from orders")
def display_forms(spark: SparkSession, d: str) -> DataFrame:
    """Dates, times and booleans in columns of texts."""
    convert = lambda r: [r[0], r[1].date(), r[1].replace(hour=r[0] % 24, minute=30), r[0] % 2 == 0]
    paths = books(spark, d, "orders", ["o_orderkey", "o_orderdate"], "o_orderkey", "xlsx", "s", ["o_orderkey", "day", "moment", "flag"], convert)
    return read_books(spark, paths, columns={"o_*": "bigint", "*": "varchar"})


@query("select s_suppkey, case when s_suppkey % 3 <> 0 then s_acctbal end s_acctbal, case when s_suppkey % 5 <> 0 then s_name end s_name from supplier")
def error_texts(spark: SparkSession, d: str) -> DataFrame:
    """Error codes by their names, listed as nulls."""
    rows = grid(spark, d, "supplier", ["s_suppkey", "s_acctbal", "s_name"], "s_suppkey")
    rows[1:] = [[k, Raw("error", "#DIV/0!") if k % 3 == 0 else v, Raw("error", "#N/A") if k % 5 == 0 else n] for k, v, n in rows[1:]]
    return api.read_sheet(spark, write_book(f"{folder(spark)}/errors.xls", [("s", rows)]), nulls=["", "#DIV/0!", "#N/A"])


@query("select s_suppkey, case when s_suppkey % 3 <> 0 then s_acctbal end s_acctbal, s_suppkey % 2 = 1 odd, case when s_suppkey % 7 = 0 then s_name end hidden from supplier")
def ods_cells(spark: SparkSession, d: str) -> DataFrame:
    """Error cells, booleans as 0 and 1, and values of covered cells of an OpenDocument sheet."""
    head = "".join(f'<table:table-cell office:value-type="string"><text:p>{x}</text:p></table:table-cell>' for x in ("s_suppkey", "s_acctbal", "odd", "hidden"))
    body = [f"<table:table-row>{head}</table:table-row>"]
    for k, v, n in grid(spark, d, "supplier", ["s_suppkey", "s_acctbal", "s_name"], "s_suppkey")[1:]:
        worth = '<table:table-cell office:value-type="string" calcext:value-type="error"><text:p>#DIV/0!</text:p></table:table-cell>' if k % 3 == 0 else f'<table:table-cell office:value-type="float" office:value="{v!r}"/>'
        covered = f'<table:covered-table-cell office:value-type="string"><text:p>{n}</text:p></table:covered-table-cell>' if k % 7 == 0 else "<table:covered-table-cell/>"
        body.append(f'<table:table-row><table:table-cell office:value-type="float" office:value="{k}"/>{worth}<table:table-cell office:value-type="boolean" office:boolean-value="{k % 2}"/>{covered}</table:table-row>')
    return api.read_sheet(spark, write_ods_tables(f"{folder(spark)}/cells.ods", f'<table:table table:name="s">{"".join(body)}</table:table>'), error_as_null=True)


@query("select s_suppkey, s_name from supplier union all select null, null from range(7)")
def range_padding(spark: SparkSession, d: str) -> DataFrame:
    """A range that ends seven rows below the data."""
    rows = grid(spark, d, "supplier", ["s_suppkey", "s_name"], "s_suppkey")
    return api.read_sheet(spark, write_book(f"{folder(spark)}/short.xlsx", [("s", rows)]), range=f"A1:B{len(rows) + 7}")


@query('select s_suppkey, s_name "B", s_acctbal "C" from supplier')
def missing_headers(spark: SparkSession, d: str) -> DataFrame:
    rows = grid(spark, d, "supplier", ["s_suppkey", "s_name", "s_acctbal"], "s_suppkey")
    return api.read_sheet(spark, write_book(f"{folder(spark)}/heads.xls", [("s", [["s_suppkey", None, None], *rows[1:]])]))


@query("select s_suppkey, s_name from supplier order by s_suppkey limit 5")
def both_row_flags(spark: SparkSession, d: str) -> DataFrame:
    return api.read_sheet(spark, gapped(spark, d), skip_empty_rows=True, end_at_empty_row=True)


@query("select s_suppkey from supplier where s_suppkey % 3 <> 0")
def emptiness_in_range(spark: SparkSession, d: str) -> DataFrame:
    """Rows that are empty within the selected columns only."""
    rows = grid(spark, d, "supplier", ["s_suppkey", "s_name"], "s_suppkey")
    rows[1:] = [[k if k % 3 else None, n] for k, n in rows[1:]]
    return api.read_sheet(spark, write_book(f"{folder(spark)}/part.ods", [("s", rows)]), range="A:A", skip_empty_rows=True)


@query("select s_suppkey, cast(row_number() over (order by s_acctbal, s_suppkey) as bigint) place from supplier")
def row_order(spark: SparkSession, d: str) -> DataFrame:
    """Rows come in the order of files, sheets and rows."""
    rows = grid(spark, d, "supplier", ["s_suppkey", "s_acctbal"], "s_suppkey")
    body, where = sorted(rows[1:], key=lambda r: (r[1], r[0])), folder(spark)
    third = -(-len(body) // 3)
    write_book(f"{where}/a.xlsx", [("x", [rows[0], *body[:third]]), ("y", [rows[0], *body[third : 2 * third]])])
    write_book(f"{where}/b.ods", [("z", [rows[0], *body[2 * third :]])])
    df = api.read_sheets(spark, [f"{where}/a.xlsx", f"{where}/b.ods"]).withColumn("at", F.monotonically_increasing_id())
    return df.select("s_suppkey", F.row_number().over(Window.orderBy("at")).cast("long").alias("place"))


@query("select cast(n_regionkey as bigint) n_regionkey, count(*) n from nation group by 1")
def sheet_view(spark: SparkSession, d: str) -> DataFrame:
    path = write_book(f"{folder(spark)}/nation.xlsx", [("nation", grid(spark, d, "nation", ["n_nationkey", "n_regionkey"], "n_nationkey"))])
    name = f"nation_{uuid.uuid4().hex[:8]}"
    api.register(spark)
    spark.sql(f"create temporary view {name} using sheet options (path '{path}', sheet 'nat*')")
    return spark.sql(f"select n_regionkey, count(*) n from {name} group by 1")


@query("select x || '.' || e file, cast(n_nationkey as bigint) n_nationkey from nation, (values ('a', 'xlsm'), ('a', 'xlam'), ('a', 'xla'), ('a', 'et'), ('a', 'ett')) t(x, e)")
def other_extensions(spark: SparkSession, d: str) -> DataFrame:
    where, rows = folder(spark), grid(spark, d, "nation", ["n_nationkey"], "n_nationkey")
    for end, fmt in (("xlsm", "xlsx"), ("xlam", "xlsx"), ("xla", "xls"), ("et", "xls"), ("ett", "xls")):
        os.rename(write_book(f"{where}/b.{fmt}", [("n", rows)]), f"{where}/a.{end}")
    df = api.read_sheets(spark, f"{where}/a.*", file_name_column="file")
    return df.withColumn("file", F.regexp_extract("file", r"([^/]+)$", 1))


@query("select * from (values ('encrypted.ods', 'password protected'), ('none.ods', 'empty'), ('plain.txt', 'unsupported format'), ('type.ods', 'unsupported format')) t(file, message)")
def rejected_workbooks(spark: SparkSession, d: str) -> DataFrame:
    """Why workbooks can't be read, as their error messages say."""
    where = folder(spark)
    manifest = '<m:manifest xmlns:m="urn:oasis:names:tc:opendocument:xmlns:manifest:1.0"><m:file-entry><m:encryption-data/></m:file-entry></m:manifest>'
    books = {
        "encrypted.ods": write_ods_tables(f"{where}/encrypted.ods", '<table:table table:name="s"/>', manifest=manifest),
        "none.ods": write_ods_tables(f"{where}/none.ods", ""),
        "plain.txt": f"{where}/plain.txt",
        "type.ods": write_ods_tables(f"{where}/type.ods", "", mime="application/zip"),
    }
    out = []
    for name, path in books.items():
        try:
            api.analyze_sheet(spark, path)
        except SheetError as e:
            out.append((name, str(e).rpartition(": ")[2]))
    return spark.createDataFrame(out, "file string, message string")


@query("select cast(n_nationkey as bigint) n_nationkey, n_name, n_regionkey || '' sheet from nation where n_regionkey in (0, 2, 4)")
def sheets_sql_function(spark: SparkSession, d: str) -> DataFrame:
    api.register(spark)
    return spark.sql(f"select n_nationkey, n_name, substring(sheet, -1, 1) sheet from read_sheets(array('{by_region(spark, d)}/part0.*'), sheets => array('Region*'), union_by_name => true, sheet_name_column => 'sheet')")


@query("select 'Region ' || r sheet_name, count(*) n from (values (0), (2), (4)) t(r), (values ('n_nationkey'), ('n_name')) u(c) group by 1")
def analyze_sql_function(spark: SparkSession, d: str) -> DataFrame:
    api.register(spark)
    return spark.sql(f"select sheet_name, count(*) n from analyze_sheets(array('{by_region(spark, d)}/part0.*')) group by 1")


@query("select s_suppkey, (select max(o_orderkey) from orders where o_totalprice <= s_acctbal * 20 and o_totalprice = (select max(o_totalprice) from orders where o_totalprice <= s_acctbal * 20)) o_orderkey from supplier")
def sheet_asof_join(spark: SparkSession, d: str) -> DataFrame:
    """For each supplier the dearest order of at most twenty times the balance: as-of, by a window over both sides' merged rows.

    The merged rows are ordered in ranges of prices; a range takes the last order of the ranges before it.
    """
    orders = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_totalprice").alias("at"), "o_orderkey", F.lit(None).cast("long").alias("s_suppkey"))
    asked = api.read_sheet(spark, supplier(spark, d)).select((F.col("s_acctbal") * 20).alias("at"), F.lit(None).cast("long").alias("o_orderkey"), "s_suppkey")
    both = orders.unionByName(asked).withColumn("part", F.floor(F.col("at") / 5000))
    key = F.struct("at", "o_orderkey")
    last = both.where("o_orderkey is not null").groupBy("part").agg(F.max(key).alias("last"))
    before = both.select("part").distinct().join(last, "part", "left").select("part", F.max("last").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    # Orders at the same price come first, so that they count.
    w = Window.partitionBy("part").orderBy("at", F.col("s_suppkey").isNotNull()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.max(F.when(F.col("o_orderkey").isNotNull(), key)).over(w)
    found = both.withColumn("own", own).where("s_suppkey is not null").join(before, "part", "left")
    return found.select("s_suppkey", F.coalesce("own", "before")["o_orderkey"].alias("o_orderkey"))


@query("select cast(s_nationkey as bigint) s_nationkey, quantile_disc(s_acctbal, 0.5) middle, count(distinct s_name) names from supplier group by 1")
def sheet_approximate(spark: SparkSession, d: str) -> DataFrame:
    """Mergeable sketches over a sheet: a quantile sketch, exact at this accuracy, and a sketch of distinct values, exact for few."""
    df = api.read_sheet(spark, supplier(spark, d))
    return df.groupBy("s_nationkey").agg(F.percentile_approx("s_acctbal", 0.5, 100_000).alias("middle"), F.hll_sketch_estimate(F.hll_sketch_agg("s_name", F.lit(21))).alias("names"))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Nations and their suppliers from two workbooks of different formats, joined and aggregated."""
    return sheet_join_aggregate(spark, d)
