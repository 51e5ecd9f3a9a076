"""XLSX, XLSM and XLAM: XML parts in a ZIP.

Sheets are parsed in chunks by a regular expression that covers the cells as writers emit them; a row it doesn't cover goes through
an XML parser by itself. A part may be read by several tasks: each inflates the stream, and parses the rows that begin in its range of bytes.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from typing import BinaryIO

from gridlark.functions.a1 import column_index
from gridlark.functions.numfmt import format_kind
from gridlark.model import BOOL, ERROR, ISO, NUM, TEXT, Cell, Row, SheetError
from gridlark.sources.zipparts import Parts, relationship_target

KINDS = {b"s": TEXT, b"str": TEXT, b"inlineStr": TEXT, b"b": BOOL, b"d": ISO, b"e": ERROR, b"n": NUM, b"": NUM}
_CELL = re.compile(rb'<c r="([A-Z]+)([0-9]+)"(?: s="([0-9]+)")?(?: t="([a-zA-Z]+)")?\s*(?:/>|>(?:<f[^>]*?(?:/>|>[^<]*</f>))?(?:<v>([^<]*)</v>|<v/>|<is><t(?: xml:space="preserve")?>([^<]*)</t></is>)?</c>)')
_ROWS = re.compile(rb"<((?:\w+:)?)row\b(?:[^>]*/>|.*?</\1row>)", re.DOTALL)
_ENTITY = re.compile(r"&(?:#([0-9]+)|#x([0-9A-Fa-f]+)|(amp|lt|gt|quot|apos));")
#: The entities of XML.
_ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}
_ROW_NUMBER = re.compile(rb"""<(?:\w+:)?row\b[^>]*?\sr=["']([0-9]+)["']""")
_ROW = re.compile(rb"<(?:\w+:)?row[\s>/]")
LOOK_BACK = 1 << 20


def local(tag: str) -> str:
    return tag.rpartition("}")[2]


def attribute(element: ET.Element, name: str) -> str | None:
    """An attribute by its local name."""
    return next((v for k, v in element.attrib.items() if local(k) == name), None)


def parse_xml(data: bytes, part: str) -> ET.Element:
    try:
        return ET.fromstring(data)
    except ET.ParseError as e:
        raise SheetError(f"file '{part}' is missing or corrupted.") from e


def string_text(element: ET.Element) -> str:
    """Text of a string item: its runs joined, phonetic ones left out."""
    out = []
    for child in element:
        name = local(child.tag)
        if name == "t":
            out.append(child.text or "")
        elif name == "r":
            out.append(string_text(child))
    return "".join(out)


def text_of(data: bytes) -> str:
    """Character data as an XML parser gives it: its entities and no others, line ends as line feeds."""
    out = data.decode()
    if "\r" in out:
        out = out.replace("\r\n", "\n").replace("\r", "\n")
    if "&" in out:
        out = _ENTITY.sub(lambda m: _ENTITIES[m[3]] if m[3] else chr(int(m[1]) if m[1] else int(m[2], 16)), out)
    return out


class XlsxBook:
    splittable = True

    def __init__(self, name: str, stream: BinaryIO):
        self.name, self.parts = name, Parts(name, stream)
        kinds = {}
        rels = parse_xml(self.parts.read("xl/_rels/workbook.xml.rels"), "xl/_rels/workbook.xml.rels")
        for e in rels.iter():
            if local(e.tag) == "Relationship" and ((t := attribute(e, "Type")) is None or t.endswith("/worksheet")):
                kinds[attribute(e, "Id")] = relationship_target(attribute(e, "Target") or "")
        book = parse_xml(self.parts.read("xl/workbook.xml"), "xl/workbook.xml")
        self.date1904, self.paths = False, {}
        for e in book.iter():
            if local(e.tag) == "workbookPr":
                self.date1904 = attribute(e, "date1904") in ("1", "true")
            elif local(e.tag) == "sheet":
                rid = next((v for k, v in e.attrib.items() if local(k) == "id" and k != "sheetId"), None)
                if rid in kinds:
                    self.paths[attribute(e, "name")] = kinds[rid]
        self.sheets = list(self.paths)
        self.formats = self._formats()
        self._strings: list[str] | None = None

    def _formats(self) -> list[int]:
        if not self.parts.has("xl/styles.xml"):
            return []
        custom, out = {}, []
        root = parse_xml(self.parts.read("xl/styles.xml"), "xl/styles.xml")
        for e in root.iter():
            if local(e.tag) == "numFmt" and (number := attribute(e, "numFmtId")):
                custom[int(number)] = attribute(e, "formatCode") or ""
        for e in root:
            if local(e.tag) == "cellXfs":
                out = [format_kind(int(attribute(x, "numFmtId") or 0), custom) for x in e if local(x.tag) == "xf"]
        return out

    def strings(self) -> list[str]:
        if self._strings is None:
            self._strings = []
            if self.parts.has("xl/sharedStrings.xml"):
                data = self.parts.read("xl/sharedStrings.xml")
                plain = re.findall(rb"<si><t(?: xml:space=\"preserve\")?>([^<]*)</t></si>", data)
                if len(plain) == len(re.findall(rb"<(?:\w+:)?si[\s>/]", data)):
                    self._strings = [text_of(x) for x in plain]
                else:
                    self._strings = [string_text(e) for e in parse_xml(data, "xl/sharedStrings.xml") if local(e.tag) == "si"]
        return self._strings

    def part_size(self, sheet: str) -> int:
        return self.parts.size(self.paths[sheet])

    def _slow_row(self, data: bytes, expected: int) -> tuple[int, list[Cell]]:
        """A row element of any shape; cells without a reference count on from the one before."""
        root = parse_xml(re.sub(rb"(</?|\s)[A-Za-z_][\w.-]*:", rb"\1", data), "sheet")
        row = int(root.get("r", expected + 1)) - 1
        cells, col = [], 0
        for c in root:
            if c.tag != "c":
                continue
            if ref := c.get("r"):
                m = re.fullmatch(r"\$?([A-Za-z]+)\$?([0-9]+)", ref)
                if m:
                    col, row = column_index(m[1].upper()), int(m[2]) - 1
            v, inline = c.find("v"), c.find("is")
            text = string_text(inline) if inline is not None else None if v is None else v.text or ""
            if text is not None:
                self._add(cells, col, (c.get("s") or "").encode(), (c.get("t") or "").encode(), text)
            col += 1
        return row, cells

    def _add(self, cells: list[Cell], col: int, style: bytes, kind: bytes, text: str) -> None:
        k = KINDS.get(kind, NUM)
        if kind == b"s":
            text = self.strings()[int(text)]
        elif k == NUM and style:
            k = self.formats[int(style)] if int(style) < len(self.formats) else NUM
        cells.append((col, k, text))

    def _pieces(self, sheet: str, lo: int, hi: int | None) -> Iterator[tuple[bytes, bytes]]:
        """Runs of whole row elements that begin in ``[lo, hi)``, each with the bytes before the first one."""
        held, at, before = b"", 0, b""
        started = lo == 0
        for chunk in self.parts.chunks(self.paths[sheet]):
            held += chunk
            if not started:
                if at + len(held) <= lo:
                    drop = max(0, len(held) - LOOK_BACK)
                    at, held = at + drop, held[drop:]
                    continue
                m = _ROW.search(held, max(0, lo - at))
                if m is None:
                    continue
                started, cut = True, m.start()
                before, at, held = held[:cut], at + cut, held[cut:]
            end = max((held.rfind(x) + len(x) for x in (b"</row>", b":row>") if x in held), default=0)
            if end:
                stop = None
                if hi is not None and at + end > hi:
                    stop = _ROW.search(held, max(0, hi - at))
                if stop and stop.start() < end:
                    yield held[: stop.start()], before
                    return
                yield held[:end], before
                before, at, held = b"", at + end, held[end:]
        if started and b"<" in held:
            stop = _ROW.search(held, max(0, hi - at)) if hi is not None else None
            yield held[: stop.start()] if stop else held, before

    def rows(self, sheet: str, row_lo: int | None = None, row_hi: int | None = None, part: tuple[int, int | None] = (0, None)) -> Iterator[Row]:
        """Rows that have cells, in order. ``part``: byte range of the uncompressed part whose rows are wanted."""
        expected = 0
        for data, before in self._pieces(sheet, *part):
            if before and part[0]:
                expected = next((int(x) for x in reversed(_ROW_NUMBER.findall(before))), expected)
            for row, cells in self._parse(data, expected):
                if row_hi is not None and row > row_hi:
                    return
                if cells and (row_lo is None or row >= row_lo):
                    yield row, cells
                expected = row + 1

    def rows_before(self, sheet: str, at: int) -> list[Row] | None:
        """Rows that end within ``LOOK_BACK`` bytes before an offset; None if the look back doesn't reach a row."""
        held, size = b"", 0
        for chunk in self.parts.chunks(self.paths[sheet]):
            held, size = held + chunk, size + len(chunk)
            if size > at + LOOK_BACK:
                break
            if len(held) > 3 * LOOK_BACK and size < at:
                held = held[-2 * LOOK_BACK :]
        starts = [m.start() for m in _ROW.finditer(held) if size - len(held) + m.start() < at]
        after = _ROW.search(held, max(0, at - (size - len(held))))
        if not starts:
            return None
        data = held[starts[0] : after.start() if after else len(held)]
        numbers = _ROW_NUMBER.findall(data)
        return list(self._parse(data, int(numbers[0]) - 1 if numbers else 0))

    def has_row_numbers(self, sheet: str) -> bool:
        """Whether rows carry their numbers, so that a part can be read from its middle."""
        for chunk in self.parts.chunks(self.paths[sheet]):
            return len(_ROW_NUMBER.findall(chunk)) == len(_ROW.findall(chunk[: chunk.rfind(b">") + 1])) > 0
        return False

    def _parse(self, data: bytes, expected: int) -> Iterator[tuple[int, list[Cell]]]:
        found = self._usual(data)
        if found is not None:
            yield from found
            return
        for m in _ROWS.finditer(data):  # row by row, so that an unusual cell costs no more than its row
            rows = self._usual(m[0])
            for row, cells in [self._slow_row(m[0], expected)] if rows is None else rows:
                yield row, cells
                expected = row + 1

    def _usual(self, data: bytes) -> Iterator[tuple[int, list[Cell]]] | None:
        """The rows, if all their cells are as writers usually emit them, with references."""
        found = _CELL.findall(data)
        if not found or len(found) != data.count(b"<c ") or b"<!" in data or b"<c>" in data or b"<c/>" in data or b":c " in data:
            return None
        return self._gathered(found)

    def _gathered(self, found: list[tuple[bytes, ...]]) -> Iterator[tuple[int, list[Cell]]]:
        formats, strings = self.formats, None
        now, cells = None, []
        for letters, number, style, kind, value, inline in found:
            if number != now:
                if now is not None:
                    yield int(now) - 1, cells
                now, cells = number, []
            if not kind and not inline:
                if value:
                    cells.append((column_index(letters.decode()), formats[int(style)] if style and int(style) < len(formats) else NUM, value.decode()))
            elif kind == b"s":
                if strings is None:
                    strings = self.strings()
                cells.append((column_index(letters.decode()), TEXT, strings[int(value)]))
            elif kind == b"inlineStr":
                cells.append((column_index(letters.decode()), TEXT, text_of(inline or value)))
            else:
                self._add(cells, column_index(letters.decode()), style, kind, text_of(value or inline))
        if now is not None:
            yield int(now) - 1, cells
