"""Personal data: base patterns, and a skip-chain conditional random field over the document's tokens.

Base matches (e-mail, IPv4 address, payment card, phone) are exact rules. The CRF adds spans that the rules miss, for instance
``974 555 1257`` or ``(974) 555-1257`` in a document that also has ``+1 (974) 555-1257``, the user part of an address that stands elsewhere in full, or
a card number with a wrong digit. Its nodes are the tokens that hold a digit or an at sign, in every document that has any. Labels are: other, email, ip,
card, phone. Neighbouring nodes share a chain potential. Nodes of similar content share a skip potential however far apart they are: equal cores,
equal user parts, equal last digits, or the same digits in two runs of neighbours whose last seven digits are equal. Each is linked with the previous
occurrence of each of its contents, so edges grow linearly. Tokens of base matches are observed. Damped loopy belief propagation gives
marginals; tokens whose label reaches ``MARGINAL`` become spans (those of one card or phone number joined), if no base span overlaps.

The potentials are trained here, by pseudo-likelihood on generated documents with a fixed seed (none of the corpus is read for it), once on
the driver; they are ``5 x (N_FEATURES + 5 + 5)`` numbers.

Defined cases: a null or empty text has no spans; repeated rows are handled alike each; a null id stays null; extra columns are ignored by ``find_pii``
and kept by ``redact``; very long texts are handled whole, at cost linear in their length.
"""

from __future__ import annotations

import functools
import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts

KINDS = ["email", "ip", "card", "phone"]
MARGINAL = 0.8
ROUNDS, DAMPING = 12, 0.5
Span = tuple[int, int, int]  # start, end, kind

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches; each holds one at sign, so only its surroundings are looked at."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = start < at and _DOMAIN.match(text, at + 1)
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers at a time, from runs of dotted numbers; a run holds all matches that begin in it."""
    for run in _DOTTED.finditer(text):
        parts = run[0].split(".")
        at = run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in four):
                yield at, end
            at = end + 1


def base_spans(text: str) -> list[Span]:
    """The rules' matches by start, then kind."""
    out = [(a, b, 0) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [(a, b, 1) for a, b in _ips(text)]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), 2))
        if "+" in text:
            out += [(m.start(), m.end(), 3) for m in _PHONE.finditer(text) if 9 <= sum(c in "0123456789" for c in m[0]) <= 15]
    out.sort(key=lambda s: (s[0], s[2]))
    return out


# ---- conditional random field ----------------------------------------------------------------------------------------

N_LABELS = len(KINDS) + 1
CUES = [{"email", "mail", "e-mail", "contact"}, {"ip", "host", "address", "server"}, {"card", "visa", "credit", "account"}, {"phone", "tel", "call", "mobile", "fax"}]
N_FEATURES = 28
_QUAD = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
_GAP = re.compile(r"[ \t]{1,2}")


def _digits(token: str) -> str:
    return "".join(c for c in token if c in "0123456789")


def _solid(token: str) -> bool:
    """Tokens that are no part of a longer number."""
    return any(c.isalpha() or c == "@" for c in token) or len(_digits(token)) >= 12 or bool(_QUAD.fullmatch(token))


def runs_of(tokens: list[str], near: list[bool]) -> list[tuple[int, int]]:
    """For each token, first and end of the run of neighbours that may be one number with it."""
    out: list[tuple[int, int]] = []
    while (lo := len(out)) < len(tokens):
        hi = lo + 1
        while hi < len(tokens) and near[hi - 1] and not _solid(tokens[hi - 1]) and not _solid(tokens[hi]):
            hi += 1
        out += [(lo, hi)] * (hi - lo)
    return out


def features(token: str, before: str, run: list[str]) -> np.ndarray:
    digits, whole = len(_digits(token)), sum(len(_digits(x)) for x in run)
    letters = sum(c.isalpha() for c in token)
    before = before.lower().strip(":.,;()")
    user, _, domain = token.partition("@")
    out = np.zeros(N_FEATURES)
    out[0] = 1
    out[1:4] = [bool(user) and bool(domain), bool(user) and "." in domain, _QUAD.fullmatch(token) is not None]
    out[4:7] = [token.startswith("+"), "(" in token, "-" in token]
    out[7:12] = [digits <= 2, 3 <= digits <= 4, 5 <= digits <= 9, 10 <= digits <= 11, digits >= 12]
    out[12:14] = [letters > 0, letters > 0 and digits + letters >= 16]
    out[14:18] = [before in cues for cues in CUES]
    out[18:23] = [whole < 7, 7 <= whole <= 8, 9 <= whole <= 11, 12 <= whole <= 15, whole > 15]
    out[23:28] = [run[0].startswith("+"), len(run) > 1, token.count(".") in (1, 2), token[-1] in "%$" or token[0] in "$#", len(run) > 4]
    return out


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and text[start] in "\"'<[{,;:=!*#&|":
        start += 1
    while end > start and text[end - 1] in "\"'>]},;:.!?*#&|":
        end -= 1
    return start, end


def _similar(token: str) -> list[str]:
    """Contents of a token; tokens which share one are linked. Numbers of fewer than four digits have none."""
    digits = _digits(token)
    out = ["=" + token.lower()] if len(digits) > 3 or "@" in token else []
    if len(digits) >= 12:
        out += ["#" + digits[-6:], "#" + digits[:6]]
    if "@" in token:
        out.append("@" + token.split("@")[0].lower())
    if _QUAD.fullmatch(token):
        out.append("." + token.rsplit(".", 1)[0])
    elif token.count(".") == 2 and len(digits) >= 4:
        out.append("." + token)
    return out


def graph(tokens: list[str], near: list[bool]) -> list[tuple[int, int, int]]:
    """Edges ``(i, j, kind)``, i < j: kind 0 between neighbours, kind 1 between similar tokens."""
    edges = [(i, i + 1, 0) for i in range(len(tokens) - 1) if near[i]]
    seen = {(i, j) for i, j, _ in edges}
    last: dict[str, list[tuple[int, int, int]]] = {}

    def link(i: int, j: int) -> None:
        if i != j and (i, j) not in seen:
            seen.add((i, j))
            edges.append((i, j, 1))

    runs = runs_of(tokens, near)
    for j, token in enumerate(tokens):
        for key in _similar(token):
            if key in last:
                link(last[key][0][0], j)
            last[key] = [(j, 0, 0)]
        lo, hi = runs[j]
        if hi - 1 == j:  # the run's digits by their place from its end
            digits = [_digits(x) for x in tokens[lo:hi]]
            if sum(map(len, digits)) >= 7:
                ends = np.cumsum([len(x) for x in digits[::-1]])[::-1].tolist()
                own = [(lo + k, end - len(x), end) for k, (x, end) in enumerate(zip(digits, ends, strict=True))]
                key = "~" + "".join(digits)[-7:]
                for i, a, b in last.get(key, ()):
                    for k, c, d in own:
                        if a < d and c < b:
                            link(i, k)
                last[key] = own
    return edges


def beliefs(node: np.ndarray, edges: list[tuple[int, int, int]], pair: np.ndarray) -> np.ndarray:
    """Marginals by sum-product messages in the log domain, all edges at once, damped."""
    node = node - node.max(1, keepdims=True)
    if edges:
        i, j, kind = np.array(edges).T
        src, dst = np.concatenate([i, j]), np.concatenate([j, i])
        back = np.concatenate([np.arange(len(i)) + len(i), np.arange(len(i))])
        table = np.concatenate([pair[kind], pair[kind].transpose(0, 2, 1)])
        message = np.zeros((len(src), N_LABELS))
        for _ in range(ROUNDS):
            total = node.copy()
            np.add.at(total, dst, message)
            out = (total[src] - message[back])[:, :, None] + table
            top = out.max(1)
            new = top + np.log(np.exp(out - top[:, None, :]).sum(1))
            new -= new.max(1, keepdims=True)
            message = DAMPING * message + (1 - DAMPING) * new
        node = node.copy()
        np.add.at(node, dst, message)
    p = np.exp(node - node.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def generated(rng: random.Random) -> tuple[list[str], list[int]]:
    """A generated document as tokens with labels: entities in full, in part, mistyped, and numbers that only look like them."""
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    name = "".join(rng.choice("abcdefghij") for _ in range(5)) + "." + number(2)
    area, left, right = (str(rng.randint(2, 9)) + number(n) for n in (2, 2, 3))
    quad = [str(rng.randrange(256)) for _ in range(4)]
    card = next(x for x in (str(rng.randint(3, 6)) + number(15) for _ in iter(int, 1)) if luhn(x))
    at = rng.randrange(1, 15)
    wrong = card[:at] + str((int(card[at]) + rng.randint(1, 9)) % 10) + card[at + 1 :]
    fours = lambda x: [x[i : i + 4] for i in (0, 4, 8, 12)]
    full = [[f"{name}@mail{number(1)}.example.com"], [".".join(quad)], rng.choice([[card], fours(card)]), ["+1", f"({area})", f"{left}-{right}"]]
    part = [
        [[f"{name}@mail"], [f"{name}@localhost"]],
        [[".".join(quad[:3])]],
        [[wrong], fours(wrong)],
        [[area, left, right], [f"({area})", f"{left}-{right}"], [f"{area}-{left}-{right}"], [area + left + right], [f"{left}-{right}"]],
    ]
    year = lambda: str(rng.randint(1900, 2030))
    other = lambda: rng.choice([[year()], [number(rng.randint(1, 6))], [f"{number(1)}.{number(1)}"], [f"{number(1)}.{number(1)}.{number(1)}"], [f"{number(2)}.{number(2)}%"], [f"v{number(2)}"], [f"{year()}-01-{number(2)}"], [number(3), number(3), number(4)], [number(10)], [f"{number(3)}-{number(4)}"], [f"{number(20)}abcdef{number(14)}"], [f"${number(3)}"], [number(3), number(4)], ["@" + rng.choice("xyz") * 5], [number(4)]])
    kinds = [k for k in range(4) if rng.random() < 0.5]
    pieces = [(full[k], k + 1) for k in kinds] + [(rng.choice(part[k]), k + 1) for k in kinds for _ in range(rng.randint(0, 3))]
    if rng.random() < 0.2:  # a number that looks like a card stands for one
        pieces.append(([wrong], 3))
    pieces += [(other(), 0) for _ in range(rng.randint(1, 8))]
    rng.shuffle(pieces)
    words: list[tuple[str, int]] = []
    for tokens, kind in pieces:
        cue = sorted(CUES[kind - 1]) if kind and rng.random() < 0.2 else ["word", "and", "of", "the"]
        words += [(rng.choice(cue), 0)] * (rng.random() < 0.95) + [(x, kind) for x in tokens]
    return [w for w, _ in words], [k for _, k in words]


def _nodes(text: str) -> tuple[list[tuple[int, int]], list[str], list[bool]]:
    """Places and texts of the nodes, and which are next to their successor."""
    spots = [_trimmed(text, m.start(), m.end()) for m in _TOKEN.finditer(text)]
    spots = [s for s in spots if s[0] < s[1]]
    near = [_GAP.fullmatch(text, spots[i][1], spots[i + 1][0]) is not None for i in range(len(spots) - 1)]
    return spots, [text[a:b] for a, b in spots], near


def _rows(text: str, spots: list[tuple[int, int]], tokens: list[str], near: list[bool]) -> np.ndarray:
    runs, out = runs_of(tokens, near), np.empty((len(tokens), N_FEATURES))
    for i, (a, _) in enumerate(spots):
        cut = max(text.rfind(c, max(0, a - 40), max(0, a - 1)) for c in " \n")
        lo, hi = runs[i]
        out[i] = features(tokens[i], text[cut + 1 : max(0, a - 1)], tokens[lo : min(hi, lo + 8)])
    return out


@functools.cache
def potentials(documents: int = 800) -> tuple[np.ndarray, np.ndarray]:
    """Weights ``(features x labels, 2 x labels x labels)`` by gradient ascent on the pseudo-likelihood of generated documents."""
    rng, rows, target = random.Random(7), [], []
    for _ in range(documents):
        words, labels = generated(rng)
        text = " ".join(words)
        spots, tokens, near = _nodes(text)
        starts = dict(zip(np.cumsum([0, *(len(w) + 1 for w in words[:-1])]).tolist(), labels, strict=True))
        gold = [starts[text.rfind(" ", 0, a) + 1] for a, _ in spots]
        around = np.zeros((len(spots), 3, N_LABELS))
        for i, j, kind in graph(tokens, near):
            around[j, kind * 2, gold[i]] += 1
            around[i, 1 if kind == 0 else 2, gold[j]] += 1
        rows.append(np.concatenate([_rows(text, spots, tokens, near), around.reshape(len(spots), -1)], 1))
        target += gold
    x, y = np.concatenate(rows), np.eye(N_LABELS)[target]
    w, speed = np.zeros((x.shape[1], N_LABELS)), np.zeros((x.shape[1], N_LABELS))
    for _ in range(500):
        z = x @ w
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        speed = 0.9 * speed + 0.3 * (x.T @ (y - p) / len(x) - 1e-3 * w)
        w += speed
    own, (before, after, skip) = w[:N_FEATURES], w[N_FEATURES:].reshape(3, N_LABELS, N_LABELS)
    return own, np.stack([(before + after.T) / 2, (skip + skip.T) / 2])


def added_spans(text: str, base: list[Span], weights: tuple[np.ndarray, np.ndarray]) -> list[Span]:
    """The spans that the CRF adds to the base spans."""
    spots, tokens, near = _nodes(text)
    if not spots:
        return []
    own, pair = weights
    node = _rows(text, spots, tokens, near) @ own
    fixed = np.zeros(len(spots), bool)
    k, reach = 0, sorted(base)
    for i, (a, b) in enumerate(spots):
        while k < len(reach) and reach[k][1] <= a:
            k += 1
        inside = [s for s in reach[k : k + 4] if s[0] < b and a < s[1]]
        if inside:
            fixed[i] = True
            node[i] = -30
            node[i, min(s[2] for s in inside) + 1] = 0
    p = beliefs(node, graph(tokens, near), pair)
    best = np.where((p.max(1) >= MARGINAL) & ~fixed, p.argmax(1), 0)
    out: list[Span] = []
    for i in np.flatnonzero(best).tolist():
        (a, b), kind = spots[i], int(best[i]) - 1
        if kind >= 2 and i and near[i - 1] and best[i - 1] == best[i] and not _solid(tokens[i - 1]) and not _solid(tokens[i]):
            out[-1] = (out[-1][0], b, kind)
        else:
            out.append((a, b, kind))
    return _apart(out, base) if out and base else out


def _apart(spans: list[Span], base: list[Span]) -> list[Span]:
    """The spans that no base span overlaps; both in order of their starts."""
    ends = np.maximum.accumulate([b for _, b, _ in base])
    at = np.searchsorted([a for a, _, _ in base], [b for _, b, _ in spans])
    return [s for s, k in zip(spans, at.tolist(), strict=True) if not k or ends[k - 1] <= s[0]]


def all_spans(text: str, weights: tuple[np.ndarray, np.ndarray]) -> tuple[list[Span], list[Span]]:
    base = base_spans(text)
    return base, sorted(base + added_spans(text, base, weights), key=lambda s: (s[0], s[2], s[1]))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def _find(weights: tuple[np.ndarray, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                found = [all_spans(t, weights) for t in texts(batch)]
                counts = [pa.array([sum(s[2] == k for s in base) for base, _ in found], pa.int64()) for k in range(4)]
                digest = pa.array([hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found], pa.string())
                yield pa.record_batch([batch.column("doc_id"), *counts, digest, pa.array([_joined(x) for _, x in found], pa.string())], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return run


def find_pii(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts of base matches, digest of the base spans, and all spans as ``kind:start:end`` in code points."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_find(potentials()), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind in brackets."""
    parts, at = [], 0
    for a, b, k in spans:
        if a >= at:
            parts += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*parts, text[at:]])


def _redact(weights: tuple[np.ndarray, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                out = [t if t is None else masked(t, all_spans(t, weights)[1]) for t in batch.column("text").to_pylist()]
                columns = {name: batch.column(name) for name in batch.schema.names}
                columns["text"] = pa.array(out, pa.string())
                if "n_chars" in columns:
                    columns["n_chars"] = pa.array([None if t is None else len(t) for t in out], columns["n_chars"].type)
                yield pa.record_batch(list(columns.values()), names=list(columns))

    return run


def redact(docs: DataFrame) -> DataFrame:
    """The documents with personal data masked and ``n_chars``, where they have it, counted anew; other columns stay."""
    return docs.mapInArrow(_redact(potentials()), docs.schema)
