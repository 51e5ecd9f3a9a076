"""Opening of a workbook by its extension."""

from __future__ import annotations

import io

from gridlark.model import SheetError
from gridlark.sources.biff8 import XlsBook
from gridlark.sources.biff12 import XlsbBook
from gridlark.sources.cfb import CompoundFile
from gridlark.sources.files import open_binary
from gridlark.sources.ods import OdsBook
from gridlark.sources.xlsx import XlsxBook
from gridlark.sources.zipparts import CFB_MAGIC

#: Classes by extension.
FORMATS = {"xlsx": XlsxBook, "xlsm": XlsxBook, "xlam": XlsxBook, "xlsb": XlsbBook, "xls": XlsBook, "xla": XlsBook, "et": XlsBook, "ett": XlsBook, "ods": OdsBook}


def open_book(path: str, data: bytes | None = None):
    """The workbook of a path, or of the bytes of a file of that name."""
    extension = path.split("?")[0].rpartition(".")[2].lower()
    kind = FORMATS.get(extension)
    if kind is None:
        raise SheetError(f"Spreadsheet '{path}': unsupported format")
    stream = open_binary(path) if data is None else io.BytesIO(data)
    if kind in (XlsxBook, XlsbBook):
        magic = stream.read(8)
        stream.seek(0)
        if magic == CFB_MAGIC and CompoundFile(path, stream).has("EncryptedPackage"):
            raise SheetError(f"Spreadsheet '{path}': password protected")
    book = kind(path, stream)
    if not book.sheets:
        raise SheetError(f"Spreadsheet '{path}': empty")
    book.close = stream.close
    return book
