"""Bench: one JSON line with seconds a query.

The headline is a full read of an XLSX sheet of all ``lineitem`` rows (11 columns) with an aggregate over every column; workbooks are
written before the clock starts. Times are the best of two runs, after a warm-up of the session.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from gridlark import analyze_sheet, read_sheet, read_sheets, register
from gridlark.queries import XLS_ROWS, as_dates, grid
from gridlark.sources.writers import write_book

LINEITEM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def main() -> None:
    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {"spark.driver.memory": "8g", "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.ui.showConsoleProgress": "false"}
    spark = SparkSession.builder.master(f"local[{cpus}]").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    register(spark)
    where = tempfile.mkdtemp(prefix="gridlark-bench-")
    queries: dict[str, float] = {}
    rows: dict[str, int] = {}
    try:
        lines = write_book(f"{where}/lineitem.xlsx", [("lineitem", grid(spark, d, "lineitem", LINEITEM, "l_orderkey", as_dates))])
        orders = grid(spark, d, "orders", ["o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority"], "o_orderkey", as_dates)
        # A sheet of XLS holds 65,536 rows at most, so its workbook has several.
        parts = [(f"orders {k}", [orders[0], *orders[1 + k : k + XLS_ROWS]]) for k in range(0, len(orders) - 1, XLS_ROWS - 1)]
        books = {f: write_book(f"{where}/orders.{f}", parts if f == "xls" else [("orders", orders)]) for f in ("xlsx", "xlsb", "xls", "ods")}
        whole = lambda p: read_sheets(spark, p, union_by_name=True) if p.endswith(".xls") else read_sheet(spark, p)
        for k in range(16):
            write_book(f"{where}/part{k:02d}.xlsx", [("s", [orders[0], *orders[1 + k :: 16]])])
        every = lambda df: df.agg(F.count("*").alias("n"), *(F.max(c) for c in df.columns)).first()["n"]
        timed = {
            "read_xlsx_lineitem": lambda: every(read_sheet(spark, lines)),
            "filter_group_xlsx_lineitem": lambda: read_sheet(spark, lines).where("l_shipdate <= date '1998-09-02'").groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_extendedprice")).collect(),
            **{f"read_{f}_orders": (lambda p=p: every(whole(p))) for f, p in books.items()},
            "read_sheets_16_files": lambda: every(read_sheets(spark, f"{where}/part*.xlsx", union_by_name=True)),
            "analyze_sheet_lineitem": lambda: analyze_sheet(spark, lines).count(),
        }
        analyze_sheet(spark, lines).collect()
        every(read_sheet(spark, f"{where}/part00.xlsx"))
        for name, run in timed.items():
            best = float("inf")
            for _ in range(2):
                began = time.perf_counter()
                out = run()
                best = min(best, time.perf_counter() - began)
            queries[name] = round(best, 3)
            if isinstance(out, int):
                rows[name] = out
    finally:
        shutil.rmtree(where, ignore_errors=True)
        spark.stop()
    print(json.dumps({"metric": "read_xlsx_lineitem", "value": queries["read_xlsx_lineitem"], "unit": "sec", "queries": queries, "rows": rows, "rows_per_sec": round(rows["read_xlsx_lineitem"] / queries["read_xlsx_lineitem"]), "sf": d.rpartition("/sf")[2], "cpus": int(cpus)}))
    sys.stdout.flush()


if __name__ == "__main__":
    main()
