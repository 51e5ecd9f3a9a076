"""XLS, XLA, ET and ETT: BIFF8 records in a compound file."""

from __future__ import annotations

import codecs
import struct
from collections.abc import Iterator
from typing import BinaryIO

from gridlark.functions.casts import error_name, float_text
from gridlark.functions.numfmt import format_kind
from gridlark.model import BOOL, ERROR, NUM, TEXT, Cell, Row, SheetError
from gridlark.sources.biff12 import rk_value
from gridlark.sources.cfb import CompoundFile

# Record types.
EOF, DATE_1904, FILE_PASS, CODE_PAGE, CONTINUE, BOUND_SHEET, XF, SST, FORMAT, BOF = 0x0A, 0x22, 0x2F, 0x42, 0x3C, 0x85, 0xE0, 0xFC, 0x41E, 0x809
MUL_RK, LABEL_SST, NUMBER, LABEL, BOOL_ERR, STRING, RK, FORMULA, R_STRING = 0xBD, 0xFD, 0x203, 0x204, 0x205, 0x207, 0x27E, 0x06, 0xD6


class Pieces:
    """The body of a record with its CONTINUE records. A string's characters may go on in the next piece, which then begins with a flag byte."""

    def __init__(self, pieces: list[bytes], encoding: str):
        self.pieces, self.i, self.at, self.encoding = pieces, 0, 0, encoding

    def take(self, n: int) -> bytes:
        out = b""
        while len(out) < n:
            piece = self.pieces[self.i][self.at : self.at + n - len(out)] if self.i < len(self.pieces) else None
            if piece is None:
                raise SheetError("truncated record")
            out += piece
            self.at += len(piece)
            if len(out) < n:
                self.i, self.at = self.i + 1, 0
        return out

    def uint(self, n: int) -> int:
        return int.from_bytes(self.take(n), "little")

    def characters(self, n: int, wide: bool) -> str:
        out = []
        while n:
            if self.i < len(self.pieces) and self.at >= len(self.pieces[self.i]):
                self.i, self.at = self.i + 1, 0
                wide = bool(self.uint(1) & 1)
            if self.i >= len(self.pieces):
                raise SheetError("truncated record")
            width = 1 + wide
            k = min(n, (len(self.pieces[self.i]) - self.at) // width)
            if not k:
                raise SheetError("truncated record")
            out.append(self.take(k * width).decode("utf-16-le" if wide else "latin-1", "surrogatepass"))
            n -= k
        return "".join(out).encode("utf-16", "surrogatepass").decode("utf-16", "replace")

    def string(self, length_bytes: int) -> str:
        """A Unicode string with flags; formatting runs and phonetic data behind it are skipped."""
        n, flags = self.uint(length_bytes), self.uint(1)
        runs = self.uint(2) if flags & 8 else 0
        extra = self.uint(4) if flags & 4 else 0
        out = self.characters(n, bool(flags & 1))
        self.take(4 * runs + extra)
        return out


_HEAD, _PLACE, _SST_CELL, _NUMBER_CELL, _RK = (struct.Struct(x).unpack_from for x in ("<HH", "<HHH", "<HHHI", "<HHHd", "<HI"))


def records(data: bytes, at: int = 0) -> Iterator[tuple[int, list[bytes], int]]:
    """Record types, bodies with continuations, and offsets."""
    while at + 4 <= len(data):
        begin = at
        kind, n = struct.unpack_from("<HH", data, at)
        pieces = [data[at + 4 : at + 4 + n]]
        at += 4 + n
        while at + 4 <= len(data) and struct.unpack_from("<H", data, at)[0] == CONTINUE:
            n = struct.unpack_from("<H", data, at + 2)[0]
            pieces.append(data[at + 4 : at + 4 + n])
            at += 4 + n
        yield kind, pieces, begin


def code_page(number: int) -> str:
    name = {1200: "utf-16-le", 0x8000: "mac_roman", 0x8001: "cp1252"}.get(number, f"cp{number}")
    try:
        codecs.lookup(name)
    except LookupError:
        return "latin-1"
    return name


class XlsBook:
    splittable = False

    def __init__(self, name: str, stream: BinaryIO):
        self.name = name
        file = CompoundFile(name, stream)
        part = "Workbook" if file.has("Workbook") else "Book"
        if not file.has(part):
            raise SheetError(f"file '{part}' is missing or corrupted.")
        self.data = file.read(part)
        self.date1904, self.places, self._strings, self.encoding = False, {}, [], "latin-1"
        custom, used = {}, []
        for kind, pieces, _ in records(self.data):
            body = Pieces(pieces, self.encoding)
            if kind == EOF:
                break
            if kind == FILE_PASS:
                raise SheetError(f"Spreadsheet '{name}': password protected")
            if kind == DATE_1904:
                self.date1904 = body.uint(2) == 1
            elif kind == CODE_PAGE:
                self.encoding = code_page(body.uint(2))
            elif kind == FORMAT:
                custom[body.uint(2)] = body.string(2)
            elif kind == XF:
                used.append(struct.unpack_from("<H", pieces[0], 2)[0])
            elif kind == SST:
                body.take(4)
                self._strings = [body.string(2) for _ in range(body.uint(4))]
            elif kind == BOUND_SHEET:
                at, what = body.uint(4), body.uint(2) >> 8
                title = body.string(1)
                if what == 0:
                    self.places[title] = at
        self.formats = [format_kind(x, custom) for x in used]
        self.sheets = list(self.places)

    def part_size(self, sheet: str) -> int:
        return len(self.data)

    def _cells(self, at: int) -> Iterator[tuple[int, Cell]]:
        """The cells of a sheet, by row. Only records of texts look for continuations; those of others are passed over."""
        data, strings, kind_of, end = self.data, self._strings, self._kind, len(self.data) - 4
        pending: tuple[int, int] | None = None
        depth = 0
        while at <= end:
            kind, n = _HEAD(data, at)
            body, here = at + 4, at
            at = body + n
            if kind == BOF:
                depth += 1
            elif kind == EOF:
                depth -= 1
                if depth <= 0:
                    return
            elif depth > 1:  # an embedded chart
                continue
            elif kind == LABEL_SST:
                row, col, _, index = _SST_CELL(data, body)
                yield row, (col, TEXT, strings[index])
            elif kind == NUMBER:
                row, col, style, value = _NUMBER_CELL(data, body)
                yield row, (col, kind_of(style), float_text(value))
            elif kind == RK:
                row, col, style, raw = _SST_CELL(data, body)
                yield row, (col, kind_of(style), float_text(rk_value(raw)))
            elif kind == MUL_RK:
                row, col = _HEAD(data, body)
                for p in range(body + 4, at - 2, 6):
                    style, raw = _RK(data, p)
                    yield row, (col, kind_of(style), float_text(rk_value(raw)))
                    col += 1
            elif kind == BOOL_ERR:
                row, col, _ = _PLACE(data, body)
                yield row, (col, ERROR, error_name(data[body + 6])) if data[body + 7] else (col, BOOL, str(data[body + 6]))
            elif kind == STRING and pending:
                _, pieces, _ = next(records(data, here))
                yield pending[0], (pending[1], TEXT, Pieces(pieces, self.encoding).string(2))
                pending = None
            elif kind in (LABEL, R_STRING):
                row, col, _ = _PLACE(data, body)
                _, pieces, _ = next(records(data, here))
                text = Pieces([pieces[0][6:], *pieces[1:]], self.encoding)
                n, flags = text.uint(2), text.uint(1)
                yield row, (col, TEXT, text.characters(n, bool(flags & 1)))
            elif kind == FORMULA:
                row, col, style = _PLACE(data, body)
                what = data[body + 6]
                if data[body + 12 : body + 14] != b"\xff\xff":
                    yield row, (col, kind_of(style), float_text(_NUMBER_CELL(data, body)[3]))
                elif what == 0:
                    pending = (row, col)
                elif what == 1:
                    yield row, (col, BOOL, str(data[body + 8]))
                elif what == 2:
                    yield row, (col, ERROR, error_name(data[body + 8]))
                else:
                    yield row, (col, TEXT, "")

    def _kind(self, style: int) -> int:
        return self.formats[style] if style < len(self.formats) else NUM

    def rows(self, sheet: str, row_lo: int | None = None, row_hi: int | None = None, part=None) -> Iterator[Row]:
        """Records may come out of order within a sheet; rows are gathered, a sheet has 65,536 at most."""
        found: dict[int, list[Cell]] = {}
        mixed: set[int] = set()  # rows whose cells aren't in order of columns
        now, last, cells = -1, -1, []
        for row, cell in self._cells(self.places[sheet]):
            if row != now:
                if (row_lo is not None and row < row_lo) or (row_hi is not None and row > row_hi):
                    continue
                cells = found.setdefault(row, [])
                now, last = row, cells[-1][0] if cells else -1
            if cell[0] <= last:
                mixed.add(row)
            last = cell[0]
            cells.append(cell)
        for row in sorted(found):
            cells = found[row]
            yield row, sorted({c[0]: c for c in cells}.values()) if row in mixed else cells
