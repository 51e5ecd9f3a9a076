"""Data source, table functions, streaming, and the registered queries against DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry
from gridlark import analyze_sheet, analyze_sheets, queries, read_sheet, read_sheets
from gridlark.sources.writers import write_book
from gridlark.streaming.sheets import stream_sheets

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def con():
    out = duckdb.connect()
    for t in TABLES:
        out.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return out


def plain(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=str)


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert plain(df.select(*names).collect()) == plain(cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.fixture(scope="module")
def books(tmp_path_factory):
    where = tmp_path_factory.mktemp("books")
    write_book(f"{where}/a.xlsx", [("One", [["k", "v"], [1, "x"], [2, "y"]]), ("Two", [["v", "k"], ["z", 3]])])
    write_book(f"{where}/b.xls", [("One", [["k", "v"], [9, "--"]])])
    return where


def test_source_and_view(spark, books):
    df = spark.read.format("sheet").option("sheet", "T*").load(f"{books}/a.xlsx")
    assert df.dtypes == [("v", "string"), ("k", "bigint")] and [tuple(r) for r in df.collect()] == [("z", 3)]
    df = spark.read.format("sheet").option("sheets", '["One"]').option("nulls", '["--"]').load([f"{books}/a.xlsx", f"{books}/b.xls"])
    assert [tuple(r) for r in df.collect()] == [(1, "x"), (2, "y"), (9, None)]
    assert df.rdd.getNumPartitions() == 2
    spark.sql(f"create or replace temp view v using sheet options (path '{books}/a.xlsx', range 'A1:A2')")
    assert [tuple(r) for r in spark.sql("select * from v").collect()] == [(1,)]


def test_functions(spark, books):
    a = f"{books}/a.xlsx"
    assert [tuple(r) for r in spark.sql(f"select * from read_sheet('{a}', header => false, columns => map('*', 'varchar'))").collect()] == [("k", "v"), ("1", "x"), ("2", "y")]
    sql = f"select * from read_sheets(array('{books}/*'), sheets => array('*.xlsx=*', 'One'), union_by_name => true, nulls => array('', '--'), file_name_column => 'f', sheet_name_column => 's')"
    got = spark.sql(sql)
    assert got.columns == ["k", "v", "s", "f"]
    assert plain(got.selectExpr("k", "v", "s", "right(f, 6)").collect()) == plain([(1, "x", "One", "a.xlsx"), (2, "y", "One", "a.xlsx"), (3, "z", "Two", "a.xlsx"), (9, None, "One", "/b.xls")])
    assert [tuple(r) for r in spark.sql(f"select * from analyze_sheet('{a}', sheet => 'Two')").collect()] == [("v", "varchar"), ("k", "bigint")]
    assert spark.sql(f"select * from analyze_sheets(array('{books}/*'))").count() == 6


def test_api(spark, books):
    assert analyze_sheet(spark, f"{books}/b.xls").collect() == [("k", "bigint"), ("v", "varchar")]
    assert [r.sheet_name for r in analyze_sheets(spark, f"{books}/*").collect()] == ["One", "One", "Two", "Two", "One", "One"]
    assert read_sheets(spark, f"{books}/*", sheets=["Two", "*b.xls=One"], union_by_name=True).count() == 2
    assert read_sheet(spark, f"{books}/a.xlsx", file_name_column="f").first().f == f"{books}/a.xlsx"
    with pytest.raises(Exception, match="no sheets matched wildcard"):
        read_sheet(spark, f"{books}/a.xlsx", sheet="Three")


def test_projection_and_filter(spark, books):
    df = read_sheet(spark, f"{books}/a.xlsx").where("k > 1").select("v")
    assert [tuple(r) for r in df.collect()] == [("y",)]


def test_time_type(spark, tmp_path):
    import datetime as dt

    path = write_book(f"{tmp_path}/t.xlsx", [("S", [["t"], [dt.time(1, 2, 3)], [dt.time(23, 0)]])])
    df = read_sheet(spark, path)
    assert [r.t for r in df.collect()] == [dt.time(1, 2, 3), dt.time(23, 0)]
    assert df.selectExpr("min(t) m", "max(hour(t)) h").first() == (dt.time(1, 2, 3), 23)


def test_stream(spark, books, tmp_path):
    import shutil

    drop = tmp_path / "drop"
    drop.mkdir()
    shutil.copy(books / "b.xls", drop / "one.xls")
    df = stream_sheets(spark, str(drop), f"{books}/b.xls", glob="*.xls", sheets=["One"], file_name_column="f")
    q = df.writeStream.format("memory").queryName("dropped").option("checkpointLocation", str(tmp_path / "ck")).start()
    try:
        q.processAllAvailable()
        write_book(f"{drop}/two.xls", [("One", [["k", "v"], [5, "w"]]), ("Other", [["k"], [6]])])
        q.processAllAvailable()
    finally:
        q.stop()
    assert plain(spark.sql("select k, v, right(f, 7) from dropped").collect()) == plain([(9, "--", "one.xls"), (5, "w", "two.xls")])


def test_stream_by_name(spark, tmp_path):
    """Columns in another order, a column less, and a file that is no workbook, left out or an error."""
    drop = tmp_path / "drop"
    drop.mkdir()
    sample = write_book(f"{tmp_path}/sample.xlsx", [("One", [["k", "v"], [0, "s"]])])
    write_book(f"{drop}/a.xlsx", [("One", [["v", "k"], ["x", 1]]), ("Two", [["k"], [2]])])
    write_book(f"{drop}/b.ods", [("One", [["extra", "k", "v"], [9, 3, "y"]])])
    (drop / "c.xlsx").write_bytes(b"no workbook")
    for skip in (True, False):
        df = stream_sheets(spark, str(drop), sample, union_by_name=True, skip_unreadable=skip, sheet_name_column="s")
        q = df.writeStream.format("memory").queryName(f"named_{skip}").option("checkpointLocation", f"{tmp_path}/ck{skip}").start()
        try:
            if skip:
                q.processAllAvailable()
                assert plain(spark.sql("select k, v, s from named_True").collect()) == plain([(1, "x", "One"), (2, None, "Two"), (3, "y", "One")])
            else:
                with pytest.raises(Exception, match="missing or corrupted"):
                    q.processAllAvailable()
        finally:
            q.stop()


def test_many_files_are_analysed_by_tasks(spark, tmp_path, monkeypatch):
    """The plan of tasks is that of the driver, in the order of files, and an unreadable file is named by planning."""
    from gridlark import api
    from gridlark.plans.planner import found_of, parse_options, plan_multi

    for k in range(6):
        write_book(f"{tmp_path}/{k}.{'xlsx' if k % 2 else 'ods'}", [("One", [["k", "v"], [k, "x"]]), ("Two", [["v", "k", "w"], ["y", k + 10, 1.5]])])
    files = [f"{tmp_path}/*"]
    for options in ({"union_by_name": True}, {"sheets": ["One"]}):
        df = read_sheets(spark, files, **options)
        monkeypatch.setattr(api, "JOB_FILES", 100)
        assert df.schema == read_sheets(spark, files, **options).schema and df.collect() == read_sheets(spark, files, **options).collect()
        monkeypatch.undo()
        parsed, every = parse_options(**options), sorted(str(p) for p in tmp_path.iterdir())
        assert plan_multi(files, parsed, found=found_of(api._analysis(spark, every, parsed))) == plan_multi(files, parsed)
    (tmp_path / "9.xlsx").write_bytes(b"no workbook")
    with pytest.raises(Exception, match="9.xlsx.* is missing or corrupted"):
        read_sheets(spark, files, union_by_name=True).collect()


@pytest.mark.parametrize("name", ["read_xlsx_orders", "read_xlsb_orders", "read_xls_orders", "read_ods_orders", "dates_1900", "dates_1904", "display_forms", "sheet_sql_function"])
def test_large_tables_are_written_by_tasks(spark, con, monkeypatch, name):
    """Orders become several workbooks, none of whose rows the driver gathers."""

    def gathered(*_):
        raise AssertionError("the driver gathers a table")

    monkeypatch.setattr(queries, "grid", gathered)
    monkeypatch.setattr(queries, "BOOK_ROWS", dict.fromkeys(queries.BOOK_ROWS, 400), raising=False)
    df = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    assert plain(df.select(*[d[0] for d in cur.description]).collect()) == plain(cur.fetchall())


def test_xls_sheets_are_even(spark, tmp_path, monkeypatch):
    """More rows than an XLS sheet holds are dealt evenly to sheets, and an empty table gives a header."""
    monkeypatch.setattr(queries, "BOOK_ROWS", {"xls": 200_000, "xlsx": 200_000})
    spark.range(70_000).write.parquet(f"{tmp_path}/t.parquet")
    paths = queries.books(spark, str(tmp_path), "t", ["id"], "id", "xls", "s", ["k"], lambda r: [r[0]])
    df = queries.read_books(spark, paths, sheet_name_column="sheet")
    assert len(paths) == 1 and [tuple(r) for r in df.groupBy("sheet").count().orderBy("sheet").collect()] == [("s 0", 35_000), ("s 1", 35_000)]
    assert df.agg({"k": "sum"}).first()[0] == 70_000 * 69_999 // 2
    spark.range(0).write.parquet(f"{tmp_path}/none.parquet")
    paths = queries.books(spark, str(tmp_path), "none", ["id"], "id", "xlsx", "s", ["k"], lambda r: [r[0]])
    assert queries.read_books(spark, paths).columns == ["k"] and queries.read_books(spark, paths).count() == 0
