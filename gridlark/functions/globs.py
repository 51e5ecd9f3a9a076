"""Globs for files, sheets and columns: ``?``, ``*``, ``**`` (a whole path component), ``[...]``, ``[!...]``."""

from __future__ import annotations

import functools
import os
import re

from gridlark.model import SheetError


@functools.cache
def compiled(pattern: str, component: bool = False) -> re.Pattern[str]:
    """A pattern as a regex. In file expansion (``component``) wildcards stay inside a path component; in matching they may cross slashes."""
    out, i, any_char = [], 0, "[^/]" if component else "."
    while i < len(pattern):
        c = pattern[i]
        i += 1
        if c == "*":
            n = 1
            while pattern[i : i + 1] == "*":
                i, n = i + 1, n + 1
            if n == 1:
                out.append(f"{any_char}*")
                continue
            start = i - n
            if n > 2 or start > 0 and pattern[start - 1] != "/" or i < len(pattern) and pattern[i] != "/":
                raise SheetError(f"Invalid glob pattern '{pattern}'")
            if i < len(pattern):
                i += 1
                out.append("(?:.*/)?")
            else:
                out.append(".*")
        elif c == "?":
            out.append(any_char)
        elif c == "[":
            negate = pattern[i : i + 1] == "!"
            end = pattern.find("]", i + negate + 1)
            if end < 0:
                raise SheetError(f"Invalid glob pattern '{pattern}'")
            body = "".join(x if x == "-" else re.escape(x) for x in pattern[i + negate : end])
            out.append(f"[{'^' * negate}{body}]")
            i = end + 1
        else:
            out.append(re.escape(c))
    try:
        return re.compile("".join(out), re.DOTALL)
    except re.error as e:
        raise SheetError(f"Invalid glob pattern '{pattern}'") from e


def matches(pattern: str, name: str) -> bool:
    return compiled(pattern).fullmatch(name) is not None


def is_remote(path: str) -> bool:
    """Whether a path is a URL of another scheme than file; a drive letter is no scheme."""
    m = re.match(r"([A-Za-z][A-Za-z0-9+.-]+):", path)
    return bool(m) and m[1].lower() != "file"


def local_path(path: str) -> str:
    return re.sub(r"^file:(//)?(?=/)", "", path) if path.lower().startswith("file:") else path


def expand(paths: list[str]) -> list[str]:
    """The files of each entry, sorted, in order of the entries. Remote URLs are kept; a malformed pattern yields nothing."""
    out: list[str] = []
    for path in paths:
        if is_remote(path):
            out.append(path)
            continue
        path = local_path(path)
        if not re.search(r"[*?\[]", path):
            out += [path] if os.path.exists(path) else []
            continue
        try:
            pattern = compiled(path, True)
        except SheetError:
            continue
        fixed = re.split(r"[*?\[]", path, maxsplit=1)[0]
        base = fixed.rpartition("/")[0] + "/" if "/" in fixed else ""
        deep = "**" in path
        depth = path.count("/") - base.count("/")
        found = []
        for top, folders, names in os.walk(base or "."):
            top = top if base else "" if top == "." else top.removeprefix("./")
            level = len([x for x in top[len(base) :].split("/") if x])
            if not deep and level >= depth:
                folders[:] = []
            found += [f for n in names if pattern.fullmatch(f := os.path.join(top, n))]
        out += sorted(found)
    if not out:
        raise SheetError(f"No files matched wildcard '{', '.join(paths)}'")
    return out


def sheet_specs(specs: tuple[str, ...]) -> list[tuple[str | None, str]]:
    """``sheetglob`` or ``fileglob=sheetglob``, as (file glob, sheet glob)."""
    out: list[tuple[str | None, str]] = []
    for spec in specs:
        file, eq, sheet = spec.partition("=")
        out.append((file.strip(), sheet.strip()) if eq else (None, spec))
        compiled(out[-1][1])
        compiled(out[-1][0] or "*")
    return out


def sheet_globs(specs: tuple[str, ...] | None, file: str) -> list[str] | None:
    """The sheet globs that apply to a file; None without any specs."""
    if specs is None:
        return None
    return [sheet for pattern, sheet in sheet_specs(specs) if pattern is None or matches(pattern, file)]
