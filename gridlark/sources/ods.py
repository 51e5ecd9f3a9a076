"""ODS: content.xml in a ZIP, parsed as a stream of events."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import BinaryIO
from xml.parsers import expat

from gridlark.functions.a1 import MAX_COLUMNS
from gridlark.model import BOOL, DURATION, ERROR, ISO, NUM, TEXT, Cell, Row, SheetError
from gridlark.sources.xlsx import local, parse_xml, text_of
from gridlark.sources.zipparts import Parts

MIME = b"application/vnd.oasis.opendocument.spreadsheet"
#: Namespaces of OpenDocument.
_OFFICE = "urn:oasis:names:tc:opendocument:xmlns:office:1.0 "
_TABLE = "urn:oasis:names:tc:opendocument:xmlns:table:1.0 "
_TEXT = "urn:oasis:names:tc:opendocument:xmlns:text:1.0 "
_CALC = "urn:org:documentfoundation:names:experimental:calc:xmlns:calcext:1.0 "

_BODY, _SHEET, _ROW, _CELLS = _OFFICE + "spreadsheet", _TABLE + "table", _TABLE + "table-row", {_TABLE + "table-cell", _TABLE + "covered-table-cell"}
_P, _S, _TAB, _BREAK, _NOTE = _TEXT + "p", _TEXT + "s", _TEXT + "tab", _TEXT + "line-break", _OFFICE + "annotation"
_NAME, _COLUMNS, _ROWS = _TABLE + "name", _TABLE + "number-columns-repeated", _TABLE + "number-rows-repeated"
_S_COUNT = _TEXT + "c"
_PREFIX = re.compile(rb'xmlns:([\w.-]+)="urn:oasis:names:tc:opendocument:xmlns:table:1\.0"')
_KIND, _VALUE, _STRING, _ERROR_KIND = _OFFICE + "value-type", _OFFICE + "value", _OFFICE + "string-value", _CALC + "value-type"
_VALUES = {"boolean": (BOOL, _OFFICE + "boolean-value"), "date": (ISO, _OFFICE + "date-value"), "time": (DURATION, _OFFICE + "time-value")}


class _Sheet:
    """Event handlers that collect the rows of one sheet, as ``(cells, repeat)``; tables within cells are passed over."""

    def __init__(self, parser, sheet: str):
        self.rows: list[tuple[list[Cell], int]] = []
        self.done = False
        cells: list[Cell] = []
        text: list[str] = []
        # Depths at which the sheet, the cell, a paragraph of it and something to pass over began; 0 is none.
        depth = inside = cell = para = skip = 0
        column = repeat = span = kind = paragraphs = 0

        def start(name: str, attrs: dict[str, str]) -> None:
            nonlocal depth, inside, cell, para, skip, column, repeat, span, kind, paragraphs
            depth += 1
            if not inside:
                if name == _SHEET and not skip:
                    if not self.done and attrs.get(_NAME) == sheet:
                        inside = depth
                    else:
                        skip = depth
                return
            if skip:
                return
            if para:
                if name == _S:
                    text.append(" " * int(attrs.get(_S_COUNT, 1)))
                elif name == _TAB:
                    text.append("\t")
                elif name == _BREAK:
                    text.append("\n")
                elif name == _NOTE:
                    skip = depth
            elif cell:
                if name == _P and depth == cell + 1:
                    if kind in (TEXT, ERROR):
                        para = depth
                        if paragraphs:
                            text.append("\n")
                        paragraphs += 1
                elif name == _SHEET or name == _NOTE:
                    skip = depth
            elif name in _CELLS:
                cell, span, kind, paragraphs = depth, int(attrs.get(_COLUMNS, 1)), 0, 0
                shown = attrs.get(_KIND)
                if shown is None:
                    return
                if shown == "string":
                    kind = ERROR if attrs.get(_ERROR_KIND) == "error" else TEXT
                    if (value := attrs.get(_STRING)) is not None:
                        text.append(value)
                        kind = -kind
                elif shown in _VALUES:
                    kind, at = _VALUES[shown]
                    value = attrs.get(at, "")
                    text.append(("0" if value in ("false", "0", "") else "1") if kind == BOOL else value)
                elif (value := attrs.get(_VALUE)) is not None:
                    kind = NUM
                    text.append(value)
            elif name == _ROW:
                repeat, column = int(attrs.get(_ROWS, 1)), 0
            elif name == _SHEET:
                skip = depth

        def end(name: str) -> None:
            nonlocal depth, inside, cell, para, skip, column, cells
            if skip:
                if depth == skip:
                    skip = 0
            elif not inside:
                pass
            elif para:
                if depth == para:
                    para = 0
            elif cell:
                if depth == cell:
                    if kind:
                        value = "".join(text)
                        cells += [(column + k, abs(kind), value) for k in range(min(span, MAX_COLUMNS - column))] if span > 1 else [(column, abs(kind), value)]
                        text.clear()
                    column += span
                    cell = 0
            elif name == _ROW:
                self.rows.append((cells, repeat))
                cells = []
            elif depth == inside:
                inside, self.done = 0, True
            depth -= 1

        def data(value: str) -> None:
            if para and not skip:
                text.append(value)

        parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, data


class OdsBook:
    splittable = False
    date1904 = False

    def __init__(self, name: str, stream: BinaryIO):
        self.name, self.parts = name, Parts(name, stream)
        if self.parts.has("mimetype") and self.parts.read("mimetype") != MIME:
            raise SheetError(f"Spreadsheet '{name}': unsupported format")
        if self.parts.has("META-INF/manifest.xml"):
            root = parse_xml(self.parts.read("META-INF/manifest.xml"), "META-INF/manifest.xml")
            if any(local(e.tag) == "encryption-data" for e in root.iter()):
                raise SheetError(f"Spreadsheet '{name}': password protected")
        self.sheets = self._quick_names()
        if self.sheets is None:
            self.sheets = self._names()

    def _fed(self, parser) -> Iterator[None]:
        """Feeds the whole part, a chunk between two steps."""
        parser.buffer_text = True
        try:
            for chunk in self.parts.chunks("content.xml"):
                parser.Parse(chunk, False)
                yield
            parser.Parse(b"", True)
        except expat.ExpatError as e:
            raise SheetError("file 'content.xml' is missing or corrupted.") from e
        yield

    def _quick_names(self) -> list[str] | None:
        """The names of sheets from the tags of tables alone; None where the text isn't as writers usually emit it."""
        held, tags, prefix, depth, out = b"", None, b"", 0, []
        for chunk in self.parts.chunks("content.xml"):
            held += chunk
            if b"<!" in held or b"encoding=" in held[:200] and b"utf-8" not in held[:200].lower():
                return None
            if tags is None:
                found = _PREFIX.search(held)
                if found is None:
                    if len(held) > 1 << 16:
                        return None
                    continue
                prefix = found[1]
                tags = re.compile(rb"<(/?)" + re.escape(prefix) + rb":table((?:\s+[\w:.-]+\s*=\s*(?:\"[^\"]*\"|'[^']*'))*)\s*(/?)>")
            cut = held.rfind(b"<")
            depth = self._tables(tags, held[:cut], prefix, depth, out)
            held = held[cut:]
        return out if tags is not None and depth == 0 and held.rstrip().endswith(b">") and self._tables(tags, held, prefix, 0, out) == 0 else None

    @staticmethod
    def _tables(tags: re.Pattern, data: bytes, prefix: bytes, depth: int, out: list[str]) -> int:
        for closing, attributes, empty in tags.findall(data):
            if closing:
                depth -= 1
                continue
            if depth == 0:
                m = re.search(rb"\s" + re.escape(prefix) + rb":name\s*=\s*(?:\"([^\"]*)\"|'([^']*)')", attributes)
                out.append(text_of(m[1] or m[2] or b"") if m else "")
            depth += not empty
        return depth

    def _names(self) -> list[str]:
        parser = expat.ParserCreate(namespace_separator=" ")
        depth = body = 0
        out: list[str] = []

        def start(name: str, attrs: dict[str, str]) -> None:
            nonlocal depth, body
            depth += 1
            if name == _BODY:
                body = depth
            elif name == _SHEET and depth == body + 1:
                out.append(attrs.get(_NAME, ""))

        def end(name: str) -> None:
            nonlocal depth
            depth -= 1

        parser.StartElementHandler, parser.EndElementHandler = start, end
        for _ in self._fed(parser):
            pass
        return out

    def part_size(self, sheet: str) -> int:
        return self.parts.size("content.xml")

    def rows(self, sheet: str, row_lo: int | None = None, row_hi: int | None = None, part=None) -> Iterator[Row]:
        parser = expat.ParserCreate(namespace_separator=" ")
        found, row = _Sheet(parser, sheet), 0
        for _ in self._fed(parser):
            for cells, repeat in found.rows:
                if cells:
                    for k in range(repeat):
                        if row_hi is not None and row + k > row_hi:
                            return
                        if row_lo is None or row + k >= row_lo:
                            yield row + k, cells
                row += repeat
                if row_hi is not None and row > row_hi:
                    return
            found.rows.clear()
            if found.done:
                return
