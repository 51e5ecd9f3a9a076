"""BPE encoding and decoding with content-defined chunk reuse.

Texts are cut where a rolling (gear) hash of their bytes has its low bits clear, so equal passages give equal chunks wherever they
stand. Each chunk is encoded as cut and cached in a task (bounded by bytes, oldest first out): a chunk shared by documents is encoded once. A cut may fall
within a word or a special token, so tokens beside it may be wrong, and joins are repaired: a window of some tokens on either side is encoded anew. A side
agrees if the new tokens of a whole word there are exactly the old ones; a side that doesn't agree is widened, over further chunks if need be, until it
does or the text ends. The window's tokens between the outermost agreeing words replace the old ones.

Words end at edges: a blank, tab or line end after a character that is no white space. The pre-tokenizer of byte-level BPE begins a token there whatever
stands before or follows, and special tokens, which hold no white space, never span it; so what agrees from edge to edge is right for the whole text.

A tokenizer file whose merges are in order of ids and whose pre-tokenizer is the usual byte-level pattern is run by tiktoken's engine, which gives the same
ids at a quarter of the cost; any other by the tokenizers library itself. Tests compare both on whole texts and on characters of all planes.

Chunks are shared within a task, not between tasks: a join of all chunks over the cluster would move the whole corpus twice, and the
tokens besides. Encoding is a map, with no shuffle.

Defined cases: a null or empty text has no tokens; a null id stays null; repeated rows are encoded each (from the cache); extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections import OrderedDict
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts

CHUNK_BITS = 11  # a cut every 2**11 bytes on average
CACHE_BYTES = 16 << 20
WINDOW = 12  # tokens on either side of a join that are encoded anew at first
_GEAR = np.random.default_rng(11).integers(0, 2**32, 256, dtype=np.uint32)
_SPAN = 16  # bytes the rolling hash sees
#: Edges of words in UTF-8: before a blank, tab or line end, after a character that is neither white space nor a control character.
_EDGE = re.compile(rb"(?<=[\x21-\x7e\x80-\xff])(?<!\xc2\x85)(?<!\xc2\xa0)(?<!\xe1\x9a\x80)(?<!\xe2\x80[\x80-\x8a\xa8\xa9\xaf])(?<!\xe2\x81\x9f)(?<!\xe3\x80\x80)(?=[ \n\t\r])")
#: Fixed value: the usual pre-tokenizer of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def cuts(data: np.ndarray) -> list[int]:
    """Places of content-defined cuts in UTF-8 bytes, at starts of characters: a windowed gear hash with clear low bits."""
    g = _GEAR[data]
    h = g.copy()
    for k in range(1, min(_SPAN, len(data))):
        h[k:] += g[:-k] << np.uint32(k)
    found = np.flatnonzero((h & np.uint32((1 << CHUNK_BITS) - 1)) == 0) + 1
    out = []
    for at in found.tolist():
        while at < len(data) and data[at] & 0xC0 == 0x80:
            at += 1
        if at < len(data) and (not out or at > out[-1]):
            out.append(at)
    return out


class Codec:
    """Encoder and decoder of one tokenizer file, with a cache of chunks."""

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES, engine: str = "auto"):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        back = {c: b for b, c in byte_letters().items()}
        added = {x["id"]: x["content"].encode() for x in spec["added_tokens"]}
        pieces = {i: bytes(back[c] for c in t) for t, i in spec["model"]["vocab"].items() if i not in added} | added
        self.pieces = [pieces.get(i, b"") for i in range(max(pieces) + 1)]
        self.sizes = [len(x) for x in self.pieces]
        self.cache: OrderedDict[bytes, bytes] = OrderedDict()
        self.cache_bytes, self.held, self.hits, self.regrown = cache_bytes, 0, 0, 0
        fast = engine == "auto" and _usual(spec, back)
        self.library = self._tiktoken({x: i for i, x in pieces.items() if i not in added}, added) if fast else self._tokenizers(path)

    @staticmethod
    def _tiktoken(ranks: dict[bytes, int], added: dict[int, bytes]):
        import tiktoken

        coder = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={x.decode(): i for i, x in added.items()})
        return lambda data: coder.encode_to_numpy(data.decode(), allowed_special="all").astype("<u4").tobytes()

    @staticmethod
    def _tokenizers(path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        coder = Tokenizer.from_file(path)
        coder.no_truncation()
        coder.no_padding()
        return lambda data: np.array(coder.encode_batch_fast([data.decode()], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def chunk(self, data: bytes) -> list[int]:
        """The ids of a chunk as cut."""
        found = self.cache.get(data)
        if found is None:
            found = self.cache[data] = self.library(data)
            self.held += len(data)
            while self.held > self.cache_bytes:
                self.held -= len(self.cache.popitem(last=False)[0])
        else:
            self.hits += 1
            self.cache.move_to_end(data)
        return np.frombuffer(found, "<u4").tolist()

    def encode(self, text: str) -> np.ndarray:
        data = text.encode()
        if not data:
            return np.empty(0, "<u4")
        at = [0, *cuts(np.frombuffer(data, np.uint8)), len(data)]
        left = self.chunk(data[: at[1]])
        k = 1
        while k < len(at) - 1:
            k = self._join(data, at, k, left)
        return np.array(left, "<u4")

    def _join(self, data: bytes, at: list[int], k: int, left: list[int]) -> int:
        """Appends what follows the cut ``at[k]`` to ``left``, the right tokens of all before it; the number of the next cut."""
        cut, sizes = at[k], self.sizes
        right, k = self.chunk(data[cut : at[k + 1]]), k + 1
        before = after = WINDOW
        while True:
            while after > len(right) and k < len(at) - 1:
                right += self.chunk(data[at[k] : at[k + 1]])
                k += 1
            old_left, old_right = left[-before:], right[:after]
            lo, hi = cut - sum(sizes[i] for i in old_left), cut + sum(sizes[i] for i in old_right)
            whole = hi == at[k]  # a token may end within a character, where the window can't
            while hi < at[k] and data[hi] & 0xC0 == 0x80:
                hi += 1
            while lo > 0 and data[lo] & 0xC0 == 0x80:
                lo -= 1
            new = np.frombuffer(self.library(data[lo:hi]), "<u4").tolist()
            ends = [lo, *accumulate((sizes[i] for i in new), initial=lo)][1:]
            place = {b: i for i, b in enumerate(ends)}
            edges = {m.start() + lo for m in _EDGE.finditer(data[lo : hi + 1])}
            first = 0 if lo == 0 else self._agreed([*accumulate((sizes[i] for i in reversed(old_left)), lambda b, n: b - n, initial=cut)], old_left[::-1], place, new, edges, -1)
            # Further chunks were joined as cut, so what agrees lies in the last of them.
            edges = {x for x in edges if x >= at[k - 1]}
            last = len(new) if whole and hi == len(data) else self._agreed([*accumulate((sizes[i] for i in old_right), initial=cut)], old_right, place, new, edges, 1)
            if first is not None and last is not None and first <= last:
                break
            self.regrown += 1
            if first is None or last is not None:
                before *= 4
            if last is None or first is not None:
                after *= 4
        if lo == 0:
            left.clear()
        else:
            back = ends[first]
            there = cut
            while there > back:
                there -= sizes[left.pop()]
        left += new[first:last]
        skip, there = 0, cut
        while skip < len(right) and there < ends[last]:
            there += sizes[right[skip]]
            skip += 1
        left += right[skip:]
        return k

    def _agreed(self, bounds: list[int], old: list[int], place: dict[int, int], new: list[int], edges: set[int], step: int) -> int | None:
        """The number of new tokens before the edge nearest to the cut behind which, going away from it, a whole word has its old tokens; None without any."""
        at = None
        for k, b in enumerate(bounds):
            if b in edges and b in place:
                if at is not None:
                    i, j = place[bounds[at]], place[b]
                    if old[at:k] == (new[i:j] if step > 0 else new[j:i][::-1]):
                        return i
                at = k
        return None

    def decode(self, ids: np.ndarray) -> str:
        """As the library decodes with its special tokens kept: bytes of the tokens, broken UTF-8 replaced."""
        pieces = self.pieces
        return b"".join([pieces[i] for i in ids.tolist()]).decode("utf-8", "replace")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else the next free one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in {*own}]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _usual(spec: dict, back: dict[str, int]) -> bool:
    """Whether a tokenizer is byte-level BPE of the usual pattern, with merges in order of ids and one special token at most."""
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or model["type"] != "BPE":
        return False
    if any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return False
    added = spec["added_tokens"]
    if len(added) > 1 or any(x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"] or not x["content"] or any(c.isspace() for c in x["content"]) for x in added):
        return False
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    ids = [model["vocab"][m] for m in merged]
    special = {x["content"] for x in added}
    return ids == sorted(ids) and len(back) + len(ids) == len(model["vocab"].keys() - special) and all(model["vocab"][c] < ids[0] for c in back)


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _encode(path: str, full: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for whole in batches:
            for batch in slices(whole, "text"):
                rows = texts(batch)
                ids = [coder.encode(t) for t in rows]
                decoded = [coder.decode(x) for x in ids]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                columns = [batch.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()), pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string()), pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded], pa.string())]
                if full:
                    names += ["ids", "decoded"]
                    columns += [pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                yield pa.record_batch(columns, names=names)

    return run


def encode_documents(docs: DataFrame, tokenizer: str, *, full: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, if ``full``, ``ids`` and the ``decoded`` text. tokenizer: path of a byte-level BPE file."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_encode(tokenizer, full), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * full)
