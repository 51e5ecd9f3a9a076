"""Compound files: streams by name."""

from __future__ import annotations

import struct
from typing import BinaryIO

from gridlark.model import SheetError
from gridlark.sources.zipparts import CFB_MAGIC

END, FREE = 0xFFFFFFFE, 0xFFFFFFFF


class CompoundFile:
    def __init__(self, name: str, stream: BinaryIO):
        self.bad = SheetError(f"file '{name}' is missing or corrupted.")
        data = stream.read()
        if data[:8] != CFB_MAGIC or len(data) < 512:
            raise self.bad
        self.data = data
        version, _, shift, mini_shift = struct.unpack_from("<HHHH", data, 26)
        self.size, self.mini_size = 1 << shift, 1 << mini_shift
        n_fat, directory, _, cutoff, mini_fat, n_mini, difat, n_difat = self._header(data)
        self.cutoff = cutoff
        table = list(struct.unpack_from("<109I", data, 76))
        at = difat
        for _ in range(n_difat):
            if at >= END:
                break
            more = struct.unpack(f"<{self.size // 4}I", self._sector(at))
            table += more[:-1]
            at = more[-1]
        self.fat: list[int] = []
        for sector in table[:n_fat]:
            if sector < END:
                self.fat += struct.unpack(f"<{self.size // 4}I", self._sector(sector))
        entries = self._chain(directory)
        self.entries: dict[str, tuple[int, int]] = {}
        root = (END, 0)
        for p in range(0, len(entries) - 127, 128):
            n, kind = struct.unpack_from("<HB", entries, p + 64)
            start, length = struct.unpack_from("<IQ", entries, p + 116)
            length &= 0xFFFFFFFF if version == 3 else 0xFFFFFFFFFFFFFFFF
            title = entries[p : p + max(0, min(n, 64) - 2)].decode("utf-16-le", "replace")
            if kind == 5:
                root = (start, length)
            elif kind == 2:
                self.entries.setdefault(title.lower(), (start, length))
        mini = self._chain(mini_fat) if n_mini and mini_fat < END else b""
        self.mini_fat = struct.unpack(f"<{len(mini) // 4}I", mini)
        self.mini = self._chain(root[0])[: root[1]] if root[0] < END else b""

    @staticmethod
    def _header(data: bytes) -> tuple[int, ...]:
        n_fat, directory = struct.unpack_from("<II", data, 44)
        cutoff, mini_fat, n_mini, difat, n_difat = struct.unpack_from("<IIIII", data, 56)
        return n_fat, directory, 0, cutoff, mini_fat, n_mini, difat, n_difat

    def _sector(self, i: int) -> bytes:
        out = self.data[(i + 1) * self.size : (i + 2) * self.size]
        if not out:
            raise self.bad
        return out.ljust(self.size, b"\0")

    def _chain(self, at: int) -> bytes:
        out, left = [], len(self.fat) + 1
        while at < END:
            if at >= len(self.fat) or not left:
                raise self.bad
            out.append(self._sector(at))
            at, left = self.fat[at], left - 1
        return b"".join(out)

    def has(self, name: str) -> bool:
        return name.lower() in self.entries

    def read(self, name: str) -> bytes:
        start, length = self.entries[name.lower()]
        if length >= self.cutoff:
            return self._chain(start)[:length]
        out, at, left = [], start, len(self.mini_fat) + 1
        while at < END:
            if at >= len(self.mini_fat) or not left:
                raise self.bad
            out.append(self.mini[at * self.mini_size : (at + 1) * self.mini_size])
            at, left = self.mini_fat[at], left - 1
        return b"".join(out)[:length]
