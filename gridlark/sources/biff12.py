"""XLSB: BIFF12 records in a ZIP."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import BinaryIO

from gridlark.functions.casts import error_name, float_text
from gridlark.functions.numfmt import format_kind
from gridlark.model import BOOL, ERROR, NUM, TEXT, Row, SheetError
from gridlark.sources.xlsx import attribute, local, parse_xml
from gridlark.sources.zipparts import Parts, relationship_target

# Record types.
ROW_HEADER, SST_ITEM, FMT, XF, BUNDLE_SHEET, WORKBOOK_PROP = 0, 19, 44, 47, 156, 153
BEGIN_CELL_XFS, END_CELL_XFS, FRT_BEGIN, FRT_END, END_SHEET_DATA = 617, 618, 35, 36, 146
RK, ERRORS, BOOLS, REALS, STRINGS, SHARED, RICH = 2, (3, 11), (4, 10), (5, 9), (6, 8), 7, 62


def records(chunks: Iterator[bytes]) -> Iterator[tuple[int, bytes]]:
    """Record types and bodies: type in up to 2, size in up to 4 bytes of 7 bits."""
    held, at, more = b"", 0, True
    while True:
        while more and len(held) - at < 6:
            chunk = next(chunks, None)
            more = chunk is not None
            held, at = held[at:] + (chunk or b""), 0
        if at >= len(held):
            return
        try:
            kind = held[at]
            at += 1
            if kind & 0x80:
                kind = kind & 0x7F | (held[at] & 0x7F) << 7
                at += 1
            size = shift = 0
            for _ in range(4):
                b = held[at]
                at += 1
                size |= (b & 0x7F) << shift
                shift += 7
                if not b & 0x80:
                    break
        except IndexError as e:
            raise SheetError("truncated record") from e
        while more and len(held) - at < size:
            chunk = next(chunks, None)
            more = chunk is not None
            held, at = held[at:] + (chunk or b""), 0
        if len(held) - at < size:
            raise SheetError("truncated record")
        yield kind, held[at : at + size]
        at += size


def wide_string(data: bytes, at: int) -> tuple[str, int]:
    n = struct.unpack_from("<I", data, at)[0]
    if n == 0xFFFFFFFF:
        return "", at + 4
    return data[at + 4 : at + 4 + 2 * n].decode("utf-16-le", "replace"), at + 4 + 2 * n


def rk_value(raw: int) -> float:
    """A packed number: 30 bits of an integer, or the high bits of a double; either may stand for hundredths."""
    if raw & 2:
        value = raw >> 2
        value = float(value - (1 << 30) if value & 1 << 29 else value)
    else:
        value = struct.unpack("<d", struct.pack("<Q", (raw & 0xFFFFFFFC) << 32))[0]
    return value / 100 if raw & 1 else value


class XlsbBook:
    splittable = False

    def __init__(self, name: str, stream: BinaryIO):
        self.name, self.parts = name, Parts(name, stream)
        kinds = {}
        for e in parse_xml(self.parts.read("xl/_rels/workbook.bin.rels"), "xl/_rels/workbook.bin.rels").iter():
            if local(e.tag) == "Relationship" and ((t := attribute(e, "Type")) is None or t.endswith("/worksheet")):
                kinds[attribute(e, "Id")] = relationship_target(attribute(e, "Target") or "")
        self.date1904, self.paths = False, {}
        for kind, body in records(self.parts.chunks("xl/workbook.bin")):
            if kind == WORKBOOK_PROP:
                self.date1904 = bool(body[0] & 1)
            elif kind == BUNDLE_SHEET:
                rid, at = wide_string(body, 8)
                if rid in kinds:
                    self.paths[wide_string(body, at)[0]] = kinds[rid]
        self.sheets = list(self.paths)
        self.formats: list[int] = []
        custom, inside = {}, False
        if self.parts.has("xl/styles.bin"):
            for kind, body in records(self.parts.chunks("xl/styles.bin")):
                if kind == FMT:
                    custom[struct.unpack_from("<H", body)[0]] = wide_string(body, 2)[0]
                elif kind in (BEGIN_CELL_XFS, END_CELL_XFS):
                    inside = kind == BEGIN_CELL_XFS
                elif kind == XF and inside:
                    self.formats.append(format_kind(struct.unpack_from("<H", body, 2)[0], custom))
        self._strings: list[str] | None = None

    def strings(self) -> list[str]:
        if self._strings is None:
            self._strings, skip = [], 0
            if self.parts.has("xl/sharedStrings.bin"):
                for kind, body in records(self.parts.chunks("xl/sharedStrings.bin")):
                    skip += (kind == FRT_BEGIN) - (kind == FRT_END)
                    if kind == SST_ITEM and not skip:
                        self._strings.append(wide_string(body, 1)[0])
        return self._strings

    def part_size(self, sheet: str) -> int:
        return self.parts.size(self.paths[sheet])

    def rows(self, sheet: str, row_lo: int | None = None, row_hi: int | None = None, part=None) -> Iterator[Row]:
        row, cells = 0, []
        for kind, body in records(self.parts.chunks(self.paths[sheet])):
            if kind == ROW_HEADER:
                if cells:
                    yield row, cells
                row, cells = struct.unpack_from("<I", body)[0], []
                if row_hi is not None and row > row_hi:
                    return
            elif kind == END_SHEET_DATA:
                break
            elif kind == RICH or 1 < kind < 12:
                if row_lo is not None and row < row_lo:
                    continue
                col, style = struct.unpack_from("<I", body)[0], int.from_bytes(body[4:7], "little")
                number = self.formats[style] if style < len(self.formats) else NUM
                if kind == RK:
                    cells.append((col, number, float_text(rk_value(struct.unpack_from("<I", body, 8)[0]))))
                elif kind in REALS:
                    cells.append((col, number, float_text(struct.unpack_from("<d", body, 8)[0])))
                elif kind in BOOLS:
                    cells.append((col, BOOL, str(body[8])))
                elif kind in ERRORS:
                    cells.append((col, ERROR, error_name(body[8])))
                elif kind in STRINGS:
                    cells.append((col, TEXT, wide_string(body, 8)[0]))
                elif kind == SHARED:
                    cells.append((col, TEXT, self.strings()[struct.unpack_from("<I", body, 8)[0]]))
                elif kind == RICH:
                    cells.append((col, TEXT, wide_string(body, 9)[0]))
        if cells:
            yield row, cells
