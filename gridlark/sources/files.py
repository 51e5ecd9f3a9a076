"""Opening of files, local or remote, as seekable binary streams."""

from __future__ import annotations

import io
import re
import urllib.error
import urllib.request
from typing import BinaryIO

from gridlark.functions.globs import is_remote, local_path
from gridlark.model import SheetError


def hub_url(path: str) -> str:
    """``hf://datasets/owner/name[@revision]/file`` as its public https address."""
    m = re.fullmatch(r"hf://(datasets/|spaces/|models/)?([^/]+/[^/@]+)(?:@([^/]+))?/(.+)", path)
    if not m:
        raise SheetError(f"Invalid URL '{path}'")
    kind = "" if m[1] in (None, "models/") else m[1]
    return f"https://huggingface.co/{kind}{m[2]}/resolve/{m[3] or 'main'}/{m[4]}"


def open_binary(path: str) -> BinaryIO:
    """Remote objects are fetched whole, once for each task: http(s) and hf by urllib, other schemes by pyarrow's file systems."""
    if not is_remote(path):
        try:
            return open(local_path(path), "rb")
        except OSError as e:
            raise SheetError(f"{path}: {e.strerror or e}") from e
    try:
        if path.lower().startswith(("http:", "https:", "hf:")):
            url = hub_url(path) if path.lower().startswith("hf:") else path
            with urllib.request.urlopen(url, timeout=60) as f:
                data = f.read()
        else:
            from pyarrow import fs

            store, name = fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))
            with store.open_input_file(name) as f:
                data = f.read()
    except (OSError, ValueError, urllib.error.URLError) as e:
        raise SheetError(f"{path}: {e}") from e
    if not data:
        raise SheetError(f"{path}: No data from remote file")
    return io.BytesIO(data)
