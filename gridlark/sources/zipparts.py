"""Parts of ZIP-based workbooks, looked up without regard to case and slash direction."""

from __future__ import annotations

import zipfile
import zlib
from collections.abc import Iterator
from typing import BinaryIO

from gridlark.model import SheetError

CFB_MAGIC = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1"


class Parts:
    def __init__(self, name: str, stream: BinaryIO):
        self.name = name
        try:
            self.zip = zipfile.ZipFile(stream)
        except zipfile.BadZipFile as e:
            raise SheetError(f"file '{name}' is missing or corrupted.") from e
        self.index = {i.filename.replace("\\", "/").lower(): i for i in self.zip.infolist()}

    def has(self, part: str) -> bool:
        return part.replace("\\", "/").lower() in self.index

    def size(self, part: str) -> int:
        return self.index[part.replace("\\", "/").lower()].file_size

    def chunks(self, part: str, size: int = 1 << 20) -> Iterator[bytes]:
        info = self.index.get(part.replace("\\", "/").lower())
        if info is None:
            raise SheetError(f"file '{part}' is missing or corrupted.")
        try:
            with self.zip.open(info) as f:
                while data := f.read(size):
                    yield data
        except (zipfile.BadZipFile, zlib.error, EOFError, RuntimeError, NotImplementedError) as e:
            raise SheetError(f"file '{part}' is missing or corrupted.") from e

    def read(self, part: str) -> bytes:
        return b"".join(self.chunks(part))


def relationship_target(target: str) -> str:
    """Path of a relationship's part, relative to ``xl/`` unless it says otherwise."""
    if target.startswith("/"):
        return target[1:]
    return target if target.startswith("xl/") else f"xl/{target}"
