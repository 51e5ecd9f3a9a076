"""Parsers, row policies, analysis and planning, mostly without Spark."""

import datetime as dt
import random
import struct
import zipfile

import pytest

from gridlark.model import BOOL, ERROR, NUM, TEXT, Options, Range, SheetError
from gridlark.operators.analyze import analyze
from gridlark.operators.rows import selected, with_gaps
from gridlark.operators.scan import scan
from gridlark.operators.tvf import analyze_many, analyze_one
from gridlark.plans.planner import parse_options, plan_multi, plan_single
from gridlark.sources import biff8, biff12, writers
from gridlark.sources.books import open_book
from gridlark.sources.writers import Raw, write_book

FORMATS = list(writers.WRITERS)


def read(path, **options):
    plan = plan_multi([str(p) for p in path], parse_options(**options)) if isinstance(path, list) else plan_single(str(path), parse_options(**options))
    return plan.schema().names, [tuple(r.values()) for t in plan.tasks for b in scan(plan, t) for r in b.to_pylist()]


def rows_of(path, **options):
    return read(path, **options)[1]


def cells(book, sheet=None):
    return list(book.rows(sheet or book.sheets[0]))


# ---- row policies: the six cases of the inventory


def policy(found, lo=None, hi=None, skip=False, end=False):
    rows = [(r, [(c, TEXT, "x") for c in cs]) for r, cs in found]
    return [(r, [c[0] for c in cs]) for r, cs in with_gaps(iter(rows), lo, hi, skip, end)]


GRID = [(1, [1, 3]), (3, [1, 3])]


def test_policies():
    assert policy([]) == []
    assert policy(GRID) == [(1, [1, 3]), (2, []), (3, [1, 3])]
    assert policy(GRID, skip=True) == [(1, [1, 3]), (3, [1, 3])]
    assert [r for r, _ in policy(GRID, 0, 5)] == [0, 1, 2, 3, 4, 5]
    assert policy(GRID, 0, 5, skip=True) == [(1, [1, 3]), (3, [1, 3])]
    assert policy([(1, [1, 3]), (2, [2]), (3, [1, 3])], None, 5, skip=True, end=True) == [(1, [1, 3]), (2, [2]), (3, [1, 3])]
    assert policy(GRID, 1, end=True) == [(1, [1, 3])] and policy(GRID, 0, end=True) == [] and policy(GRID, 0, 9, skip=True, end=True) == [(1, [1, 3])]
    assert policy([], 2, 4) == [(2, []), (3, []), (4, [])] and policy([], None, 4) == []


def test_selected():
    rows = [(0, [(0, TEXT, ""), (1, NUM, "1")]), (1, [(5, NUM, "2")]), (2, [(1, ERROR, "#N/A")])]
    assert list(selected(iter(rows[:2]), Options(), 0, 3, None, None, "p")) == [(0, [(1, NUM, "1")])]
    with pytest.raises(SheetError, match="Cell 'p!B3': #N/A"):
        list(selected(iter(rows), Options(), None, None, None, None, "p"))
    assert len(list(selected(iter(rows), Options(error_as_null=True), None, None, None, None, "p"))) == 2
    assert len(list(selected(iter(rows), Options(nulls=frozenset({"#N/A"})), 0, 1, None, None, "p"))) == 1


# ---- formats

BASIC = [
    ["id", "name", "price", "active", "d", "t", "ts"],
    [1, "a  b", 1.5, True, dt.date(2024, 1, 2), dt.time(12, 30, 5), dt.datetime(2024, 1, 2, 3, 4, 5)],
    [-2, "äé<&>\n漢\U0001f600", 1e21, False, dt.date(1904, 2, 29), dt.time(0, 0, 1), dt.datetime(1970, 1, 1, 12)],
    [None, None, None, None, None, None, None],
    [2**40, "", 0.1, None, None, None, None],
]


@pytest.mark.parametrize("fmt", FORMATS)
@pytest.mark.parametrize("date1904", [False, True])
def test_basic(tmp_path, fmt, date1904):
    path = write_book(f"{tmp_path}/a.{fmt}", [("S", BASIC)], date1904=date1904)
    names, rows = read(path)
    assert names == BASIC[0]
    assert rows == [tuple(BASIC[1]), tuple(BASIC[2]), (None,) * 7, (2**40, None, 0.1, *[None] * 4)]
    assert [t for _, t in plan_single(path, parse_options()).columns] == ["bigint", "varchar", "double", "boolean", "date", "time", "timestamp"]


@pytest.mark.parametrize("fmt", FORMATS)
def test_random_grids(tmp_path, fmt):
    rng = random.Random(fmt)
    for k in range(15):
        body = [[rng.choice([None, None, rng.randint(-9, 9), "x", "y" * rng.randint(1, 9)]) for _ in range(4)] for _ in range(rng.randint(1, 12))]
        path = write_book(f"{tmp_path}/{k}.{fmt}", [("S", [list("abcd"), *body])])
        want = [tuple(None if v is None else str(v) for v in r) for r in body]
        while want and not any(want[-1]):
            want.pop()
        options = {"columns": {"*": "varchar"}, "analyze_rows": 100}
        assert rows_of(path, **options) == want
        assert rows_of(path, skip_empty_rows=True, **options) == [r for r in want if any(r)]
        blank = next((i for i, r in enumerate(want) if not any(r)), len(want))
        assert rows_of(path, end_at_empty_row=True, **options) == want[:blank]
        assert rows_of(path, range="B2:C6", header=False, **options) == [(tuple(want[i][1:3]) if i < len(want) else (None, None)) for i in range(5)]


@pytest.mark.parametrize("fmt", FORMATS)
def test_long(tmp_path, fmt):
    body = [[i, f"text {i % 700} " + "é" * (i % 50)] for i in range(20_000)]
    path = write_book(f"{tmp_path}/a.{fmt}", [("S", [["i", "t"], *body])])
    assert rows_of(path) == [tuple(r) for r in body]


def test_headers_and_letters(tmp_path):
    rows = [[None] * 2 + ["x", "x", None, 5, dt.date(2024, 1, 1), True], [None] * 2 + [1, 2, 3, 4, 5, 6]]
    path = write_book(f"{tmp_path}/a.xlsx", [("S", [[], [], *rows])])
    assert read(path) == (["x", "x_1", "E", "5", "2024-01-01", "true"], [(1, 2, 3, 4, 5, 6)])
    assert read(path, range="D4", header=False)[0] == list("DEFGH")
    assert read([path])[0] == ["x", "E", "5", "2024-01-01", "true"] and read([path])[1] == [(2, 3, 4, 5, 6)]


def test_sampling(tmp_path):
    body = [[i] for i in range(12)] + [["late", "column"]]
    path = write_book(f"{tmp_path}/a.xlsx", [("S", [["n"], *body])])
    with pytest.raises(SheetError, match=r"Cell '\[.*a.xlsx\]S!A14': parse 'late' to bigint failed"):
        read(path)
    assert read(path, error_as_null=True)[1][-1] == (None,)
    assert read(path, analyze_rows=20)[0] == ["n", "B"]
    assert plan_single(path, parse_options(analyze_rows=1)).columns == (("n", "varchar"),)


@pytest.mark.parametrize("fmt", ["xlsx", "xlsb", "xls", "ods"])
def test_nulls_and_errors(tmp_path, fmt):
    rows = [["a", "b"], ["--", 1], [Raw("inline", "N/A"), 0], ["0", Raw("error", "#REF!")], ["x", Raw("error", "#ODD")]]
    path = write_book(f"{tmp_path}/a.{fmt}", [("S", rows)])
    with pytest.raises(SheetError, match=r"S!B4': #REF!"):
        read(path)
    got = rows_of(path, error_as_null=True, nulls=["--", "N/A", "0"])
    assert got == [(None, 1), (None, None), (None, None), ("x", None)]
    if fmt in ("xlsx", "ods"):
        assert rows_of(path, nulls=["#REF!", "#ODD"]) == [("--", 1), ("N/A", 0), ("0", None), ("x", None)]
    else:
        with pytest.raises(SheetError, match="#ERROR!"):
            read(path, nulls=["#REF!"])


def test_styled_blank_is_null(tmp_path):
    path = write_book(f"{tmp_path}/a.xlsx", [("S", [["a", "b"], [1, Raw("blank", style=1)], [2, 3]])])
    assert rows_of(path, nulls=["x"]) == [(1, None), (2, 3)]


def test_text_in_numeric_column(tmp_path):
    path = write_book(f"{tmp_path}/a.xlsx", [("S", [["a"], ["12"], ["7"]])])
    assert rows_of(path, columns={"a": "bigint"}) == [(12,), (7,)]


# ---- XLSX shapes


def xlsx(path, sheet, strings=None, styles=None, workbook=None):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("XL\\_rels\\workbook.xml.rels", '<Relationships xmlns="r"><Relationship Id="a" Type="http://x/worksheet" Target="/xl/worksheets/s.xml"/><Relationship Id="b" Type="http://x/chartsheet" Target="c.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", workbook or f'<workbook {main} xmlns:r="q"><sheets><sheet name="Chart" sheetId="2" r:id="b"/><sheet name="S" sheetId="1" state="hidden" r:id="a"/></sheets></workbook>')
        z.writestr("xl/worksheets/s.xml", sheet if sheet.startswith("<") and "worksheet" in sheet else f"<worksheet {main}><sheetData>{sheet}</sheetData></worksheet>")
        if strings:
            z.writestr("xl/sharedStrings.xml", f"<sst {main}>{strings}</sst>")
        if styles:
            z.writestr("xl/styles.xml", f"<styleSheet {main}>{styles}</styleSheet>")
    return str(path)


def test_xlsx_shapes(tmp_path):
    strings = '<si><t>plain &amp; "x"</t></si><si><r><t>ri</t></r><r><rPr><b/></rPr><t xml:space="preserve">ch </t></r><rPh sb="0" eb="1"><t>no</t></rPh></si><si><t/></si>'
    styles = '<numFmts count="1"><numFmt numFmtId="170" formatCode="yyyy&quot;y&quot;"/></numFmts><cellStyleXfs><xf numFmtId="14"/></cellStyleXfs><cellXfs><xf numFmtId="0"/><xf numFmtId="170"/></cellXfs>'
    sheet = '<row><c t="s"><v>0</v></c><c><v>1</v></c></row><row r="3"><c r="B3" s="1"><f>A1+1</f><v>45292</v></c><c t="inlineStr"><is><t>in</t></is></c><c t="str"><f>"a"</f><v>cached</v></c><c t="b"><v>1</v></c><c t="d"><v>2024-01-01T05:00:00</v></c><c t="s"><v>1</v></c><c t="e"><v>#N/A</v></c></row>'
    book = open_book(xlsx(tmp_path / "a.xlsx", sheet, strings, styles))
    assert book.sheets == ["S"]
    (r1, c1), (r2, c2) = cells(book)
    assert (r1, c1) == (0, [(0, TEXT, 'plain & "x"'), (1, NUM, "1")])
    assert r2 == 2 and [c[2] for c in c2] == ["45292", "in", "cached", "1", "2024-01-01T05:00:00", "rich ", "#N/A"]
    assert [c[0] for c in c2] == [1, 2, 3, 4, 5, 6, 7] and c2[3][1] == BOOL


def test_xlsx_prefix_and_cdata(tmp_path):
    sheet = '<x:worksheet xmlns:x="m"><x:sheetData><x:row r="1"><x:c r="A1" t="str"><x:v><![CDATA[a<b]]></x:v></x:c></x:row><x:row r="2"><x:c r="B2"><x:v>5</x:v></x:c></x:row></x:sheetData></x:worksheet>'
    assert cells(open_book(xlsx(tmp_path / "a.xlsx", sheet))) == [(0, [(0, TEXT, "a<b")]), (1, [(1, NUM, "5")])]


@pytest.mark.parametrize("gaps", [0, 40])
def test_xlsx_split(tmp_path, gaps):
    """A sheet read in many parts gives the rows of a single read, gaps included."""
    rng = random.Random(gaps)
    body = []
    for i in range(3000):
        body.append([i, f"s{i % 13}", None if i % 3 else 1.5])
        if gaps and rng.random() < 0.05:
            body += [[None] * 3] * rng.randint(1, gaps)
    path = write_book(f"{tmp_path}/a.xlsx", [("S", [["a", "b", "c"], *body, [None] * 3])])
    for options in ({}, {"skip_empty_rows": True}, {"range": "A1:C9000"}, {"range": "B100:C2000"}):
        whole = rows_of(path, **options)
        plan = plan_single(path, parse_options(split_bytes=3000, **options))
        assert len(plan.tasks) > 20
        assert [tuple(r.values()) for t in plan.tasks for b in scan(plan, t) for r in b.to_pylist()] == whole
    assert len(plan_single(path, parse_options(split_bytes=3000, end_at_empty_row=True)).tasks) == 1


# ---- BIFF details


def test_rk():
    for module in (biff12,):
        pack = lambda x: struct.unpack("<Q", struct.pack("<d", x))[0] >> 32 & 0xFFFFFFFC
        assert module.rk_value(5 << 2 | 2) == 5 and module.rk_value(1234 << 2 | 3) == 12.34
        assert module.rk_value((-7 << 2 | 2) & 0xFFFFFFFF) == -7 and module.rk_value(pack(1.5)) == 1.5 and module.rk_value(pack(150.0) | 1) == 1.5


def xls(path, records):
    head = writers._record8(0x809, struct.pack("<HHHHII", 0x600, 5, 0, 0, 0, 6)) + writers._record8(0xE0, struct.pack("<HH16x", 0, 0))
    body = writers._record8(0x809, bytes(16)) + b"".join(records) + writers._record8(0x0A)
    extra = b"".join(x for x in getattr(xls, "globals", []))
    names = [("Chart", 2), ("S", 0)]
    size = sum(4 + 6 + len(writers._short_string(n)) for n, _ in names)
    at = len(head) + len(extra) + size + 4
    head += extra + b"".join(writers._record8(0x85, struct.pack("<IH", at, k << 8) + writers._short_string(n)) for n, k in names)
    path.write_bytes(writers.compound_file({"Workbook": head + writers._record8(0x0A) + body}))
    return str(path)


def test_xls_records(tmp_path):
    rec = writers._record8
    at = lambda r, c: struct.pack("<HHH", r, c, 0)
    records = [
        rec(0xBD, struct.pack("<HH", 1, 0) + b"".join(struct.pack("<HI", 0, x << 2 | 3) for x in (150, 1234)) + struct.pack("<H", 1)),
        rec(0x06, at(2, 0) + struct.pack("<d", 2.5) + bytes(8)),
        rec(0x06, at(2, 1) + b"\0\0\0\0\0\0\xff\xff" + bytes(8)), rec(0x4BC, bytes(6)), rec(0x207, struct.pack("<HB", 2, 0) + b"hi"),
        rec(0x06, at(2, 2) + b"\1\0\1\0\0\0\xff\xff" + bytes(8)),
        rec(0x06, at(2, 3) + b"\2\0\x2a\0\0\0\xff\xff" + bytes(8)),
        rec(0x06, at(2, 4) + b"\3\0\0\0\0\0\xff\xff" + bytes(8)),
        rec(0x204, at(0, 0) + struct.pack("<HB", 3, 0) + b"abc"),
    ]
    book = open_book(xls(tmp_path / "a.xls", records))
    assert book.sheets == ["S"]
    assert cells(book) == [(0, [(0, TEXT, "abc")]), (1, [(0, NUM, "1.5"), (1, NUM, "12.34")]), (2, [(0, NUM, "2.5"), (1, TEXT, "hi"), (2, BOOL, "1"), (3, ERROR, "#N/A"), (4, TEXT, "")])]


def test_continued_strings():
    """Characters go on in another width, and formatting runs cross pieces."""
    pieces = [struct.pack("<HBH", 5, 8, 1) + b"ab", b"\1" + "cé漢".encode("utf-16-le") + b"\0\1", b"\2\3" + struct.pack("<HB", 1, 0) + b"z"]
    reader = biff8.Pieces(pieces, "latin-1")
    assert reader.string(2) == "abcé漢" and reader.string(2) == "z"


# ---- ODS


def ods(path, tables, manifest=None, mime="application/vnd.oasis.opendocument.spreadsheet", tail="</office:spreadsheet></office:body></office:document-content>"):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("mimetype", mime)
        if manifest:
            z.writestr("META-INF/manifest.xml", manifest)
        z.writestr("content.xml", f"<office:document-content {writers._ODS}><office:body><office:spreadsheet>{tables}{tail}")
    return str(path)


def test_ods_repeats(tmp_path):
    cell = '<table:table-cell office:value-type="float" office:value="{}"{}/>'
    rows = (
        '<table:table-row table:number-rows-repeated="2">' + cell.format(1, ' table:number-columns-repeated="2"') + "</table:table-row>"
        '<table:table-row table:number-rows-repeated="1000000"><table:table-cell table:number-columns-repeated="16384"/></table:table-row>'
        "<table:table-row><table:covered-table-cell/>" + '<table:table-cell office:value-type="string"><office:annotation><text:p>no</text:p></office:annotation><text:p>a<text:s text:c="2"/>b</text:p><text:p>c<text:span>d</text:span></text:p></table:table-cell></table:table-row>'
    )
    book = open_book(ods(tmp_path / "a.ods", f'<table:table table:name="T">{rows}</table:table><table:table table:name="U"/>'))
    assert book.sheets == ["T", "U"]
    got = cells(book, "T")
    assert got == [(0, [(0, NUM, "1"), (1, NUM, "1")]), (1, [(0, NUM, "1"), (1, NUM, "1")]), (1_000_002, [(1, TEXT, "a  b\ncd")])]
    assert cells(book, "U") == []
    assert rows_of(tmp_path / "a.ods", end_at_empty_row=True, header=False) == [(1, 1), (1, 1)]


def test_ods_cells(tmp_path):
    """Error cells, booleans by any of their forms, values of covered cells, nested tables, other prefixes."""
    cell = '<table:{0} office:value-type="boolean" office:boolean-value="{1}"/>'
    flags = "".join(cell.format("table-cell", x) for x in ("true", "1", "false", "0"))
    odd = '<table:table-cell office:value-type="string" calcext:value-type="error"><text:p>#DIV/0!</text:p></table:table-cell><table:table-cell office:value-type="string" calcext:value-type="string" office:string-value="v"><text:p>shown</text:p></table:table-cell>'
    inner = '<table:table-cell office:value-type="string"><text:p>a</text:p><table:table table:name="T"><table:table-row><table:table-cell office:value-type="float" office:value="9"/></table:table-row></table:table><text:p>b</text:p></table:table-cell>'
    rows = f"<table:table-row>{flags}</table:table-row><table:table-row>{odd}</table:table-row><table:table-row>{cell.format('covered-table-cell', '1')}{inner}</table:table-row>"
    path = ods(tmp_path / "a.ods", f'<table:table table:name="T">{rows}</table:table>')
    book = open_book(path)
    assert book.sheets == ["T"]
    assert cells(book) == [(0, [(0, BOOL, "1"), (1, BOOL, "1"), (2, BOOL, "0"), (3, BOOL, "0")]), (1, [(0, ERROR, "#DIV/0!"), (1, TEXT, "v")]), (2, [(0, BOOL, "1"), (1, TEXT, "a\nb")])]
    with pytest.raises(SheetError, match=r"T!A2': #DIV/0!"):
        read(path, header=False)
    with zipfile.ZipFile(path) as z:
        renamed = z.read("content.xml").decode().replace("table:", "t:").replace("xmlns:table", "xmlns:t").replace("oasis:names:tc:opendocument:xmlns:t:", "oasis:names:tc:opendocument:xmlns:table:")
    with zipfile.ZipFile(tmp_path / "b.ods", "w") as z:
        z.writestr("content.xml", renamed)
    assert cells(open_book(f"{tmp_path}/b.ods")) == cells(book)


def test_xlsx_text_is_xml(tmp_path):
    """Entities of XML and no others, and line ends as a parser gives them, on the quick path as on the other."""
    body = "<c r=\"A{0}\" t=\"str\"><v>&#128;&amp;lt;&#x41;\r\nb\rc</v></c><c r=\"B{0}\" t=\"inlineStr\"><is><t xml:space=\"preserve\"> i&quot;</t></is></c>"
    path = write_book(f"{tmp_path}/a.xlsx", [("S", [["a", "b"], [1, 2]])])
    with zipfile.ZipFile(path) as z:
        parts = {n: z.read(n) for n in z.namelist()}
    name = next(n for n in parts if "worksheets" in n)
    quick, slow = f'<row r="1">{body.format(1)}</row>', f'<row r="2"><!-- x -->{body.format(2)}</row>'
    for k, data in enumerate((quick, quick + slow)):
        sheet = f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{data}</sheetData></worksheet>'
        with zipfile.ZipFile(f"{tmp_path}/b{k}.xlsx", "w") as z:
            for n, x in parts.items():
                z.writestr(n, sheet if n == name else x)
        assert cells(open_book(f"{tmp_path}/b{k}.xlsx")) == [(r, [(0, TEXT, "\x80&lt;A\nb\nc"), (1, TEXT, ' i"')]) for r in range(k + 1)]


# ---- several files and sheets


def library(tmp_path):
    write_book(f"{tmp_path}/a.xlsx", [("Sheet1", [["x", "y"], [1, "p"]]), ("Sheet2", [["y", "x"], ["q", 2]]), ("Empty", [])])
    write_book(f"{tmp_path}/b.ods", [("Sheet1", [["x", "z"], [3, True]]), ("Data", [["x"], [4.5]])])
    return f"{tmp_path}/*"


def test_union(tmp_path):
    pattern = library(tmp_path)
    assert read([pattern], sheets=["Sheet1"]) == (["x", "y"], [(1, "p"), (3, "true")])
    assert read([pattern], sheets=["Sheet?"], union_by_name=True, sheet_name_column="s") == (["x", "y", "z", "s"], [(1, "p", None, "Sheet1"), (2, "q", None, "Sheet2"), (3, None, True, "Sheet1")])
    with pytest.raises(SheetError, match=r"\[.*b.ods\]Data!x: expected BigInt, actual Double"):
        read([pattern], union_by_name=True)
    names, rows = read([pattern], sheets=["*.ods=Data", "*.xlsx=Sheet2"], union_by_name=False, file_name_column="f")
    assert names == ["y", "x", "f"] and [r[:2] for r in rows] == [("q", 2), ("4.5", None)]
    # A file that no pattern is for: reading takes all its sheets, analysis none.
    assert len(read([pattern], sheets=["*.xlsx=Sheet1"])[1]) == 3
    assert [analyze_many(f"{tmp_path}/{f}", sheets=["*.xlsx=Sheet1"]) for f in ("a.xlsx", "b.ods")] == [[(f"{tmp_path}/a.xlsx", "Sheet1", "x", "bigint"), (f"{tmp_path}/a.xlsx", "Sheet1", "y", "varchar")], []]
    assert analyze_many(f"{tmp_path}/a.xlsx", sheets=[]) == []


def test_errors(tmp_path):
    library(tmp_path)
    a = f"{tmp_path}/a.xlsx"
    with pytest.raises(SheetError, match=f"^{a}: Spreadsheet '{a}': no sheets matched wildcard 'No.'"):
        read(a, sheet="No?")
    with pytest.raises(SheetError, match="No worksheets matched the wildcard pattern in any of the files"):
        read([a], sheets=["No*"])
    assert analyze_one(a, sheet="No*") == [] and analyze_one(a, sheet="Empty") == [] and analyze_one(a) == [("x", "bigint"), ("y", "varchar")]
    for path, message in (("t.txt", "unsupported format"), ("gone.xlsx", "No such file"), ("gone.ods?v=1", "No such file")):
        with pytest.raises(SheetError, match=message):
            read(f"{tmp_path}/{path}")
    for fmt in ("xlsx", "xlsb", "xls", "ods"):
        (tmp_path / f"bad.{fmt}").write_bytes(b"nonsense" * 100)
        with pytest.raises(SheetError, match="missing or corrupted"):
            read(tmp_path / f"bad.{fmt}")
    (tmp_path / "p.xlsx").write_bytes(writers.compound_file({"EncryptedPackage": b"x" * 5000}))
    with pytest.raises(SheetError, match="password protected"):
        read(tmp_path / "p.xlsx")
    xls.globals = [writers._record8(0x2F, b"\0\0")]
    try:
        with pytest.raises(SheetError, match="password protected"):
            read(xls(tmp_path / "p.xls", []))
    finally:
        xls.globals = []
    with pytest.raises(SheetError, match="password protected"):
        read(ods(tmp_path / "p.ods", "", '<m:manifest xmlns:m="urn:m"><m:file-entry><m:encryption-data/></m:file-entry></m:manifest>'))
    with pytest.raises(SheetError, match="unsupported format"):
        read(ods(tmp_path / "m.ods", "", mime="text/plain"))
    with pytest.raises(SheetError, match="content.xml"):
        read(ods(tmp_path / "u.ods", '<table:table table:name="T">', tail=""))
    with pytest.raises(SheetError, match=": empty"):
        read(ods(tmp_path / "e.ods", ""))
    with pytest.raises(SheetError, match="Invalid column type 'money'"):
        read(a, columns={"x": "money"})
    with pytest.raises(SheetError, match="Unknown option 'colour'"):
        read(a, colour=1)


def test_analyze_bounds(tmp_path):
    path = write_book(f"{tmp_path}/a.xlsx", [("S", [[], [None, "h", None], [None, 1, 2]]), ("E", [])])
    book = open_book(path)
    table = analyze(book, "S", Options())
    assert table.columns == (("h", "bigint"), ("C", "bigint")) and (table.first_row, table.col_lo, table.col_hi) == (2, 1, 2)
    assert analyze(book, "E", Options()) is None and analyze(book, "E", Options(header=False)) is None
    wide = analyze(book, "E", Options(header=False, range=Range(0, 0, 1, 2)))
    assert wide.columns == (("A", "varchar"), ("B", "varchar"))
    assert rows_of(path, sheet="E", header=False, range="A1:B3") == [(None, None)] * 3


def test_remote_files(tmp_path, monkeypatch):
    """Workbooks by http from a local server: whole, with a query string, missing, and empty."""
    import functools
    import http.server
    import threading

    monkeypatch.setenv("no_proxy", "*")
    for fmt in FORMATS:
        write_book(f"{tmp_path}/a.{fmt}", [("S", [["x", "y"], [1, "u"], [2, "v"]])])
    (tmp_path / "none.xlsx").write_bytes(b"")

    class Quiet(http.server.SimpleHTTPRequestHandler):
        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), functools.partial(Quiet, directory=str(tmp_path)))
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        root = f"http://127.0.0.1:{server.server_port}"
        for fmt in FORMATS:
            assert read(f"{root}/a.{fmt}") == (["x", "y"], [(1, "u"), (2, "v")])
        assert analyze_one(f"{root}/a.xlsx?version=2") == [("x", "bigint"), ("y", "varchar")]
        with pytest.raises(SheetError, match="404"):
            read(f"{root}/gone.xlsx")
        with pytest.raises(SheetError, match="No data from remote file"):
            read(f"{root}/none.xlsx")
    finally:
        server.shutdown()
