"""A1 references, globs, number formats, inference and casts, with expectations computed by hand."""

import os

import pytest

from gridlark.functions import a1, casts, globs, infer, numfmt
from gridlark.model import BOOL, DURATION, ISO, NUM, NUM_DATE, NUM_DATETIME, NUM_TIME, TEXT, Range, SheetError, column_type


def test_columns():
    for index, letters in ((0, "A"), (25, "Z"), (26, "AA"), (701, "ZZ"), (702, "AAA"), (16383, "XFD")):
        assert a1.column_letters(index) == letters and a1.column_index(letters) == index
    assert a1.reference(0, 27) == "AB1"


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("", (None, None, None, None)), ("B2", (1, 1, None, None)), ("b2:B2", (1, 1, 1, 1)), ("A:C", (0, None, 2, None)), ("5:15", (None, 4, None, 14)),
        ("B", (1, None, None, None)), ("5", (None, 4, None, None)), (":D", (None, None, 3, None)), (":10", (None, None, None, 9)), ("A2:E100", (0, 1, 4, 99)),
    ],
)
def test_range(text, want):
    assert a1.parse_range(text) == Range(*want)


@pytest.mark.parametrize("text", ["A1:B2:C3", "1A", "A0", "XFE1", "B2:A1", "A5:A1", "$A$1", "A-1"])
def test_bad_range(text):
    with pytest.raises(SheetError, match=f"Invalid range format '{text.upper()}'".replace("$", r"\$")):
        a1.parse_range(text.lower())


@pytest.mark.parametrize(
    ("pattern", "name", "want"),
    [("Sheet*", "Sheet12", True), ("sheet*", "Sheet1", False), ("S?", "S", False), ("[!a]x", "bx", True), ("[a-c]x", "dx", False), ("*.xlsx", "/data/a.xlsx", True), ("[]]", "]", True), ("a[*]", "a*", True), ("**/x", "a/b/x", True), ("**/x", "x", True), ("a.b", "axb", False)],
)
def test_glob(pattern, name, want):
    assert globs.matches(pattern, name) is want


def test_bad_globs():
    for pattern in ("[a", "a**", "***", "x/**y"):
        with pytest.raises(SheetError):
            globs.matches(pattern, "a")


def test_expand(tmp_path):
    for name in ("b.xlsx", "a.xlsx", "c.ods", "sub/d.xlsx", "sub/deep/e.xlsx"):
        os.makedirs((tmp_path / name).parent, exist_ok=True)
        (tmp_path / name).touch()
    got = lambda *p: [os.path.relpath(x, tmp_path) for x in globs.expand([f"{tmp_path}/{q}" for q in p])]
    assert got("*.xlsx") == ["a.xlsx", "b.xlsx"]
    assert got("c.ods", "?.xlsx", "a.xlsx") == ["c.ods", "a.xlsx", "b.xlsx", "a.xlsx"]
    assert got("**/*.xlsx") == ["a.xlsx", "b.xlsx", "sub/d.xlsx", "sub/deep/e.xlsx"]
    assert got("*/*.xlsx", "[") == ["sub/d.xlsx"]
    assert globs.expand([f"file://{tmp_path}/a.xlsx"]) == [f"{tmp_path}/a.xlsx"]
    assert globs.expand(["s3://b/*.xlsx"]) == ["s3://b/*.xlsx"]
    with pytest.raises(SheetError, match="No files matched wildcard 'nope1, nope2'"):
        globs.expand(["nope1", "nope2"])


def test_remote():
    for path, want in (("a.xlsx", False), ("/a/b.xlsx", False), ("C:\\a.xlsx", False), ("http://x/a.xlsx", True), ("https://x/a.xlsx", True), ("s3://b/a", True), ("gs://b/a", True), ("file:///a", False)):
        assert globs.is_remote(path) is want


def test_sheet_specs():
    assert globs.sheet_globs(("*.xlsx = Data*", "S1", "*.ods=*"), "/x/a.xlsx") == ["Data*", "S1"]
    assert globs.sheet_globs(("*.ods=*",), "/x/a.xlsx") == [] and globs.sheet_globs(None, "a") is None


def test_number_formats():
    assert [numfmt.builtin_kind(i) for i in (0, 14, 17, 18, 21, 22, 45, 47, 9)] == [NUM, NUM_DATE, NUM_DATE, NUM_TIME, NUM_TIME, NUM_DATETIME, NUM_TIME, NUM_TIME, NUM]
    for code, want in (("yyyy-mm-dd", NUM_DATE), ("h:mm", NUM_TIME), ("d/m/yy h:mm", NUM_DATETIME), ("mmm", NUM), ('0.0" days"', NUM), (r"0\d", NUM), ("[Red]0.00", NUM), ("[h]:mm", NUM), ("[h]:mm:ss", NUM_TIME), ("_d0", NUM), ("#,##0", NUM)):
        assert numfmt.custom_kind(code) == want, code


def test_inference():
    cases = [(NUM, "1", "bigint"), (NUM, "1.00", "bigint"), (NUM, "1.5", "double"), (NUM, "1E-3", "double"), (BOOL, "1", "boolean"), (ISO, "1900-01-01T10:00:00", "time"), (ISO, "2024-01-01T00:00:00", "date"), (ISO, "2024-01-01", "date"), (ISO, "2024-01-01T01:00:00", "timestamp"), (DURATION, "PT1H", "time"), (TEXT, "x", "varchar"), (NUM_DATETIME, "1", "timestamp")]
    assert [infer.cell_type(k, t) for k, t, _ in cases] == [w for _, _, w in cases]
    for types, want in (({}, "varchar"), ({"bigint", "double"}, "double"), ({"date", "time"}, "timestamp"), ({"bigint", "varchar"}, "varchar"), ({"boolean", "bigint"}, "varchar"), ({"time"}, "time")):
        assert infer.unify(set(types)) == want


def test_type_names():
    assert [column_type(x) for x in ("int", "Numeric", "TEXT", "datetime", "bool")] == ["bigint", "double", "varchar", "timestamp", "boolean"]
    with pytest.raises(SheetError, match=r"Invalid column type 'DECIMAL\(10,2\)'"):
        column_type("DECIMAL(10,2)")


def day(y, m, d):
    import datetime as dt

    return (dt.date(y, m, d) - dt.date(1970, 1, 1)).days


def test_dates():
    for serial, want in ((1, (1900, 1, 1)), (59, (1900, 2, 28)), (60, (1900, 2, 28)), (61, (1900, 3, 1)), (45292, (2024, 1, 1)), (45292.9, (2024, 1, 1))):
        assert casts.to_date(NUM_DATE, str(serial), False) == day(*want)
    assert casts.to_date(NUM_DATE, "0", True) == day(1904, 1, 1) and casts.to_date(NUM_DATE, "43830", True) == day(2024, 1, 1)
    assert casts.display(NUM_DATE, "0", True) == "1904-01-01" and casts.display(NUM_DATE, "60", False) == "1900-02-28"
    assert casts.to_date(ISO, "2024-02-29", False) == casts.to_date(ISO, "2024-02-29T00:00:00", False) == day(2024, 2, 29)
    assert casts.to_date(DURATION, "PT5H", False) == 0
    for kind, text in ((ISO, "2024-02-30"), (ISO, "2024-01-01T05:00:00"), (NUM, "5"), (TEXT, "2024-01-01")):
        with pytest.raises(SheetError, match="to date failed"):
            casts.to_date(kind, text, False)


def test_times():
    assert casts.to_time(NUM_TIME, "0.5", False) == casts.to_time(NUM_DATETIME, "45292.5", False) == 12 * 3_600_000_000
    assert casts.to_time(ISO, "2024-01-01T01:02:03.5", False) == 3_723_500_000 and casts.to_time(ISO, "2024-01-01", False) == 0
    assert casts.to_time(DURATION, "PT12H30M5.25S", False) == 45_005_250_000
    for kind, text in ((NUM_TIME, "1.5"), (DURATION, "PT24H"), (DURATION, "P1DT1H"), (NUM, "0.5")):
        with pytest.raises(SheetError):
            casts.to_time(kind, text, False)
    assert casts.display(NUM_TIME, "1.5", False) == "36:00:00" and casts.display(DURATION, "PT12H30M5S", False) == "12:30:5"
    assert casts.display(NUM_TIME, str(0.5 / 86400), False) == "00:00:00.500"


def test_timestamps():
    assert casts.to_timestamp(NUM_DATETIME, "45292.5", False) == (day(2024, 1, 1) * 86400 + 43200) * 1_000_000
    assert casts.to_timestamp(ISO, "2024-01-01 01:00", False) == (day(2024, 1, 1) * 86400 + 3600) * 1_000_000
    assert casts.to_timestamp(DURATION, "PT1H", False) == 3_600_000_000
    assert casts.display(NUM_DATETIME, "45292.9999999999", False) == "2024-01-02 00:00:00" and casts.display(NUM_DATETIME, "45292.25", False) == "2024-01-01 06:00:00"
    assert casts.display(ISO, "2024-01-01T01:00:00", False) == "2024-01-01 01:00:00"


def test_numbers():
    assert casts.to_bigint(NUM, "12.7", False) == 12 and casts.to_bigint(NUM, "-3", False) == -3
    for text in ("", "x", "--1", "9223372036854775808"):
        with pytest.raises(SheetError, match="to bigint failed"):
            casts.to_bigint(NUM, text, False)
    assert casts.to_double(NUM, "1e3", False) == 1000
    for text in ("1_0", "nan", "", "1x"):
        with pytest.raises(SheetError, match="to double failed"):
            casts.to_double(TEXT, text, False)
    assert [casts.to_boolean(TEXT, x, False) for x in ("1", "true", "0")] == [True, False, False]
    assert [casts.float_text(x) for x in (1.0, 1e21, 12.34, -0.001, 1e-7)] == ["1", "1000000000000000000000", "12.34", "-0.001", "0.0000001"]
    assert casts.error_name(0x2A) == "#N/A" and casts.error_name(0x99) == "#ERROR!"


def test_arrow_errors():
    where = lambda i: f"[f]s!A{i + 1}"
    with pytest.raises(SheetError, match=r"Cell '\[f\]s!A2': parse 'x' to bigint failed"):
        casts.arrow_column("bigint", [NUM, TEXT], ["1", "x"], False, where, False)
    assert casts.arrow_column("bigint", [NUM, TEXT, 0], ["1", "x", None], False, where, True).to_pylist() == [1, None, None]
    assert casts.arrow_column("bigint", [NUM, NUM], ["1", "2.5"], False, where, False).to_pylist() == [1, 2]
