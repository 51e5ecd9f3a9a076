"""Writers of small workbooks in all four formats, for queries over tables, tests and the bench. They aren't a sink: one process writes.

A sheet is ``(name, rows)``, with any iterable of rows (XLSX, XLSB and ODS are written as it goes), a row a list of None, bool, int, float, str, date, datetime, time or ``Raw``.
"""

from __future__ import annotations

import datetime as dt
import struct
import zipfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from xml.sax.saxutils import escape, quoteattr

from gridlark.functions.a1 import column_letters
from gridlark.functions.casts import DAY_US, ERROR_NAMES

GENERAL, DATE, DATETIME, TIME = range(4)
#: Built-in format of each style.
FORMAT_IDS = [0, 14, 22, 21]
Sheet = tuple[str, Iterable[list]]


@dataclass(frozen=True)
class Raw:
    """A cell of a given storage kind: ``error``, ``iso``, ``inline``, ``number`` (with a style) or ``blank`` (styled, without value)."""

    kind: str
    value: str = ""
    style: int = GENERAL


def serial(value: dt.date | dt.datetime | dt.time, date1904: bool = False) -> float:
    if isinstance(value, dt.time):
        return ((value.hour * 60 + value.minute) * 60 + value.second + value.microsecond / 1e6) / 86400
    days = (dt.date(value.year, value.month, value.day) - dt.date(1970, 1, 1)).days
    days = days + 24107 if date1904 else days + 25568 + (days >= -25508)
    if not isinstance(value, dt.datetime):
        return days
    return days + ((value.hour * 60 + value.minute) * 60 + value.second) / 86400 + value.microsecond / DAY_US


def style_of(value) -> int:
    return DATETIME if isinstance(value, dt.datetime) else DATE if isinstance(value, dt.date) else TIME if isinstance(value, dt.time) else GENERAL


class Strings:
    def __init__(self):
        self.index: dict[str, int] = {}
        self.count = 0

    def __call__(self, text: str) -> int:
        self.count += 1
        return self.index.setdefault(text, len(self.index))


# ---- XLSX

_RELS = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{}</Relationships>'
_REL = '<Relationship Id="rId{}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/{}" Target="{}"/>'
_MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def _xlsx_cell(ref: str, value, strings: Strings, date1904: bool) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{ref}"><v>{value!r}</v></c>'
    if isinstance(value, str):
        return f'<c r="{ref}" t="s"><v>{strings(value)}</v></c>'
    if isinstance(value, Raw):
        if value.kind == "error":
            return f'<c r="{ref}" t="e"><v>{escape(value.value)}</v></c>'
        if value.kind == "iso":
            return f'<c r="{ref}" t="d"><v>{value.value}</v></c>'
        if value.kind == "inline":
            return f'<c r="{ref}" t="inlineStr"><is><t>{escape(value.value)}</t></is></c>'
        if value.kind == "blank":
            return f'<c r="{ref}" s="{value.style}"/>'
        return f'<c r="{ref}" s="{value.style}"><v>{value.value}</v></c>'
    return f'<c r="{ref}" s="{style_of(value)}"><v>{serial(value, date1904)!r}</v></c>'


def write_xlsx(path: str, sheets: list[Sheet], *, date1904: bool = False, level: int = 1) -> None:
    strings = Strings()
    letters: list[str] = []
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED, compresslevel=level) as z:
        z.writestr("[Content_Types].xml", '<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"/>')
        rels = "".join(_REL.format(i, "worksheet", f"worksheets/sheet{i}.xml") for i in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", _RELS.format(rels))
        names = "".join(f'<sheet name={quoteattr(n)} sheetId="{i}" r:id="rId{i}"/>' for i, (n, _) in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook {_MAIN} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><workbookPr date1904="{int(date1904)}"/><sheets>{names}</sheets></workbook>')
        z.writestr("xl/styles.xml", f"<styleSheet {_MAIN}><cellXfs>" + "".join(f'<xf numFmtId="{i}"/>' for i in FORMAT_IDS) + "</cellXfs></styleSheet>")
        for i, (_, rows) in enumerate(sheets, 1):
            with z.open(f"xl/worksheets/sheet{i}.xml", "w", force_zip64=True) as f:
                f.write(f"<worksheet {_MAIN}><sheetData>".encode())
                out = []
                for r, row in enumerate(rows, 1):
                    while len(letters) < len(row):
                        letters.append(column_letters(len(letters)))
                    cells = "".join([_xlsx_cell(f"{c}{r}", v, strings, date1904) for c, v in zip(letters, row, strict=False) if v is not None])
                    if cells:
                        out.append(f'<row r="{r}">{cells}</row>')
                    if len(out) >= 5000:
                        f.write("".join(out).encode())
                        out = []
                f.write(("".join(out) + "</sheetData></worksheet>").encode())
        items = "".join(f'<si><t xml:space="preserve">{escape(x)}</t></si>' for x in strings.index)
        z.writestr("xl/sharedStrings.xml", f'<sst {_MAIN} count="{strings.count}" uniqueCount="{len(strings.index)}">{items}</sst>')


# ---- XLSB


def _record12(kind: int, body: bytes = b"") -> bytes:
    head = bytes([kind]) if kind < 128 else bytes([kind & 0x7F | 0x80, kind >> 7])
    n, size = len(body), b""
    while True:
        size += bytes([n & 0x7F | (0x80 if n > 0x7F else 0)])
        n >>= 7
        if not n:
            return head + size + body


def _wide(text: str) -> bytes:
    raw = text.encode("utf-16-le")
    return struct.pack("<I", len(raw) // 2) + raw


def write_xlsb(path: str, sheets: list[Sheet], *, date1904: bool = False) -> None:
    strings = Strings()
    codes = {v: k for k, v in ERROR_NAMES.items()}
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/_rels/workbook.bin.rels", _RELS.format("".join(_REL.format(i, "worksheet", f"worksheets/sheet{i}.bin") for i in range(1, len(sheets) + 1))))
        z.writestr("xl/workbook.bin", _record12(153, struct.pack("<I", date1904)) + b"".join(_record12(156, struct.pack("<II", 0, i) + _wide(f"rId{i}") + _wide(n)) for i, (n, _) in enumerate(sheets, 1)))
        z.writestr("xl/styles.bin", _record12(617, struct.pack("<I", 4)) + b"".join(_record12(47, struct.pack("<HH12x", 0, i)) for i in FORMAT_IDS) + _record12(618))
        for i, (_, rows) in enumerate(sheets, 1):
            with z.open(f"xl/worksheets/sheet{i}.bin", "w", force_zip64=True) as f:
                out = [_record12(129), _record12(145)]
                for r, row in enumerate(rows):
                    cells = []
                    for c, v in enumerate(row):
                        style = v.style if isinstance(v, Raw) else style_of(v)
                        head = struct.pack("<I", c) + style.to_bytes(3, "little") + b"\0"
                        if isinstance(v, Raw) and v.kind == "error":
                            cells.append(_record12(3, head + bytes([codes.get(v.value, 0xFF)])))
                        elif isinstance(v, Raw) and v.kind == "inline":
                            cells.append(_record12(6, head + _wide(v.value)))
                        elif isinstance(v, Raw) and v.kind == "number":
                            cells.append(_record12(5, head + struct.pack("<d", float(v.value))))
                        elif isinstance(v, bool):
                            cells.append(_record12(4, head + bytes([v])))
                        elif isinstance(v, int) and -(1 << 29) <= v < 1 << 29:
                            cells.append(_record12(2, head + struct.pack("<I", (v << 2 | 2) & 0xFFFFFFFF)))
                        elif isinstance(v, (int, float)):
                            cells.append(_record12(5, head + struct.pack("<d", v)))
                        elif isinstance(v, str):
                            cells.append(_record12(7, head + struct.pack("<I", strings(v))))
                        elif isinstance(v, (dt.date, dt.time)):
                            cells.append(_record12(5, head + struct.pack("<d", serial(v, date1904))))
                    if cells:
                        out += [_record12(0, struct.pack("<I13x", r)), *cells]
                    if len(out) >= 20_000:
                        f.write(b"".join(out))
                        out = []
                f.write(b"".join([*out, _record12(146), _record12(130)]))
        z.writestr("xl/sharedStrings.bin", _record12(159, struct.pack("<II", strings.count, len(strings.index))) + b"".join(_record12(19, b"\0" + _wide(x)) for x in strings.index) + _record12(160))


# ---- XLS


def _record8(kind: int, body: bytes = b"") -> bytes:
    out = struct.pack("<HH", kind, min(len(body), 8224)) + body[:8224]
    for at in range(8224, len(body), 8224):
        piece = body[at : at + 8224]
        out += struct.pack("<HH", 0x3C, len(piece)) + piece
    return out


def _short_string(text: str) -> bytes:
    return struct.pack("<BB", len(text.encode("utf-16-le")) // 2, 1) + text.encode("utf-16-le")


def _shared_table(strings: Strings) -> bytes:
    """The SST record; a string whose characters go on in a CONTINUE record repeats its flags there."""
    pieces = [struct.pack("<II", strings.count, len(strings.index))]
    for text in strings.index:
        raw = text.encode("utf-16-le")
        if len(pieces[-1]) + 5 > 8224:
            pieces.append(b"")
        pieces[-1] += struct.pack("<HB", len(raw) // 2, 1)
        while raw:
            room = (8224 - len(pieces[-1])) // 2 * 2
            pieces[-1] += raw[:room]
            raw = raw[room:]
            if raw:
                pieces.append(b"\1")
    return b"".join(struct.pack("<HH", 0xFC if i == 0 else 0x3C, len(p)) + p for i, p in enumerate(pieces))


def compound_file(streams: dict[str, bytes]) -> bytes:
    """A compound file of 512-byte sectors; streams below 4096 bytes go to the mini stream."""
    sectors: list[bytes] = []
    fat: list[int] = []

    def store(data: bytes) -> int:
        n = -(-len(data) // 512)
        start = len(sectors)
        for k in range(n):
            sectors.append(data[k * 512 : (k + 1) * 512].ljust(512, b"\0"))
            fat.append(start + k + 1 if k + 1 < n else 0xFFFFFFFE)
        return start if n else 0xFFFFFFFE

    mini, mini_fat, entries = b"", [], []
    for name, data in streams.items():
        if len(data) >= 4096:
            entries.append((name, 2, store(data), len(data)))
        else:
            start, n = len(mini_fat), -(-len(data) // 64)
            mini += data.ljust(n * 64, b"\0")
            mini_fat += [start + k + 1 if k + 1 < n else 0xFFFFFFFE for k in range(n)]
            entries.append((name, 2, start if n else 0xFFFFFFFE, len(data)))
    entries.insert(0, ("Root Entry", 5, store(mini), len(mini)))
    at_mini = store(struct.pack(f"<{len(mini_fat)}I", *mini_fat).ljust(-(-len(mini_fat) // 128) * 512, b"\xff")) if mini_fat else 0xFFFFFFFE
    table = b""
    for i, (name, kind, start, size) in enumerate(entries):
        raw = name.encode("utf-16-le") + b"\0\0"
        child = 1 if i == 0 and len(entries) > 1 else 0xFFFFFFFF
        right = i + 1 if 0 < i < len(entries) - 1 else 0xFFFFFFFF
        table += raw.ljust(64, b"\0") + struct.pack("<HBBIII", len(raw), kind, 1, 0xFFFFFFFF, right, child) + b"\0" * 36 + struct.pack("<IQ", start, size)
    directory = store(table.ljust(-(-len(table) // 512) * 512, b"\0"))
    n_fat, n_difat = 0, 0
    while n_fat * 128 < len(sectors) + n_fat + n_difat:
        n_fat += 1
        n_difat = -(-max(0, n_fat - 109) // 127)
    fat_at = [len(sectors) + k for k in range(n_fat)]
    difat_at = [len(sectors) + n_fat + k for k in range(n_difat)]
    fat += [0xFFFFFFFD] * n_fat + [0xFFFFFFFC] * n_difat
    raw = struct.pack(f"<{len(fat)}I", *fat).ljust(n_fat * 512, b"\xff")
    sectors += [raw[k * 512 : (k + 1) * 512] for k in range(n_fat)]
    for k in range(n_difat):
        part = fat_at[109 + k * 127 : 109 + (k + 1) * 127]
        after = difat_at[k + 1] if k + 1 < n_difat else 0xFFFFFFFE
        sectors.append(struct.pack("<128I", *part, *[0xFFFFFFFF] * (127 - len(part)), after))
    head = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1" + b"\0" * 16 + struct.pack("<HHHHH6x", 0x3E, 3, 0xFFFE, 9, 6)
    head += struct.pack("<IIIIIIIIII", 0, n_fat, directory, 0, 4096, at_mini, -(-len(mini_fat) // 128), difat_at[0] if difat_at else 0xFFFFFFFE, n_difat, 0)[:-4]
    head += struct.pack("<109I", *fat_at[:109], *[0xFFFFFFFF] * max(0, 109 - n_fat))
    return head + b"".join(sectors)


def _xls_sheet(rows: list[list], strings: Strings, date1904: bool) -> bytes:
    codes = {v: k for k, v in ERROR_NAMES.items()}
    out = [_record8(0x809, struct.pack("<HHHHII", 0x600, 0x10, 0, 0, 0, 6))]
    for r, row in enumerate(rows):
        for c, v in enumerate(row):
            head = struct.pack("<HHH", r, c, v.style if isinstance(v, Raw) else style_of(v))
            if isinstance(v, Raw) and v.kind == "error":
                out.append(_record8(0x205, head + bytes([codes.get(v.value, 0xFF), 1])))
            elif isinstance(v, Raw) and v.kind == "inline":
                raw = v.value.encode("utf-16-le")
                out.append(_record8(0x204, head + struct.pack("<HB", len(raw) // 2, 1) + raw))
            elif isinstance(v, Raw) and v.kind == "number":
                out.append(_record8(0x203, head + struct.pack("<d", float(v.value))))
            elif isinstance(v, bool):
                out.append(_record8(0x205, head + bytes([v, 0])))
            elif isinstance(v, int) and -(1 << 29) <= v < 1 << 29:
                out.append(_record8(0x27E, head + struct.pack("<I", (v << 2 | 2) & 0xFFFFFFFF)))
            elif isinstance(v, (int, float)):
                out.append(_record8(0x203, head + struct.pack("<d", v)))
            elif isinstance(v, str):
                out.append(_record8(0xFD, head + struct.pack("<I", strings(v))))
            elif isinstance(v, (dt.date, dt.time)):
                out.append(_record8(0x203, head + struct.pack("<d", serial(v, date1904))))
    return b"".join([*out, _record8(0x0A)])


def write_xls(path: str, sheets: list[Sheet], *, date1904: bool = False) -> None:
    strings = Strings()
    bodies = [_xls_sheet(rows, strings, date1904) for _, rows in sheets]
    head = _record8(0x809, struct.pack("<HHHHII", 0x600, 5, 0, 0, 0, 6)) + _record8(0x42, struct.pack("<H", 1200)) + _record8(0x22, struct.pack("<H", date1904))
    head += b"".join(_record8(0xE0, struct.pack("<HH16x", 0, i)) for i in FORMAT_IDS)
    tail = _shared_table(strings) + _record8(0x0A)
    bound = sum(4 + 6 + len(_short_string(n)) for n, _ in sheets)
    at = len(head) + bound + len(tail)
    for (name, _), body in zip(sheets, bodies, strict=True):
        head += _record8(0x85, struct.pack("<IH", at, 0) + _short_string(name))
        at += len(body)
    with open(path, "wb") as f:
        f.write(compound_file({"Workbook": head + tail + b"".join(bodies)}))


# ---- ODS

_ODS = 'xmlns:office="urn:oasis:names:tc:opendocument:xmlns:office:1.0" xmlns:table="urn:oasis:names:tc:opendocument:xmlns:table:1.0" xmlns:text="urn:oasis:names:tc:opendocument:xmlns:text:1.0" xmlns:calcext="urn:org:documentfoundation:names:experimental:calc:xmlns:calcext:1.0"'


def _ods_cell(v) -> str:
    if v is None or isinstance(v, Raw) and v.kind == "blank":
        return "<table:table-cell/>"
    if isinstance(v, Raw) and v.kind == "error":
        return f'<table:table-cell office:value-type="string" calcext:value-type="error"><text:p>{escape(v.value)}</text:p></table:table-cell>'
    if isinstance(v, bool):
        return f'<table:table-cell office:value-type="boolean" office:boolean-value="{str(v).lower()}"/>'
    if isinstance(v, (int, float)):
        return f'<table:table-cell office:value-type="float" office:value="{v!r}"/>'
    if isinstance(v, dt.time):
        return f'<table:table-cell office:value-type="time" office:time-value="PT{v.hour:02d}H{v.minute:02d}M{v.second:02d}S"/>'
    if isinstance(v, (dt.date, dt.datetime)):
        return f'<table:table-cell office:value-type="date" office:date-value="{v.isoformat()}"/>'
    text = v.value if isinstance(v, Raw) else v
    lines = "".join(f"<text:p>{escape(x).replace('  ', ' <text:s/>')}</text:p>" for x in text.split("\n"))
    return f'<table:table-cell office:value-type="string">{lines}</table:table-cell>'


def write_ods_tables(path: str, tables: str | Iterable[str], *, manifest: str | None = None, mime: str = "application/vnd.oasis.opendocument.spreadsheet") -> str:
    """An ODS workbook of the given ``table:table`` elements, as a text or its pieces."""
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(zipfile.ZipInfo("mimetype"), mime)
        if manifest:
            z.writestr("META-INF/manifest.xml", manifest)
        with z.open("content.xml", "w", force_zip64=True) as f:
            f.write(f'<?xml version="1.0" encoding="UTF-8"?><office:document-content {_ODS}><office:body><office:spreadsheet>'.encode())
            for piece in [tables] if isinstance(tables, str) else tables:
                f.write(piece.encode())
            f.write(b"</office:spreadsheet></office:body></office:document-content>")
    return path


def _ods_pieces(sheets: list[Sheet]) -> Iterator[str]:
    for name, rows in sheets:
        out = [f"<table:table table:name={quoteattr(name)}>"]
        for row in rows:
            out.append("<table:table-row>" + "".join(map(_ods_cell, row)) + "</table:table-row>")
            if len(out) >= 5000:
                yield "".join(out)
                out = []
        yield "".join([*out, "</table:table>"])


def write_ods(path: str, sheets: list[Sheet], *, date1904: bool = False) -> None:
    write_ods_tables(path, _ods_pieces(sheets))


WRITERS = {"xlsx": write_xlsx, "xlsb": write_xlsb, "xls": write_xls, "ods": write_ods}


def write_book(path: str, sheets: list[Sheet], **options) -> str:
    WRITERS[path.rpartition(".")[2]](path, sheets, **options)
    return path
