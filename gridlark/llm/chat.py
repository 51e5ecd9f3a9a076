"""Chat formatting by schema fingerprints.

Records are JSON of unknown layout. The fingerprint of a record is the SHA-256 of its sorted nested field paths (array elements as
``[]``, types of leaves dropped). It selects a declarative mapping: where the list of turns lies and which fields of an element hold
role and text, or which top-level fields are which role's text. Records become canonical turns ``(role, text)``, then one string:

    <|turn_start|>role\\ntext<|turn_end|>\\n

Control strings inside texts are escaped reversibly: an escape sign is put behind the first character of each place where one
begins, and the sign itself is doubled. In a role a line feed is escaped too. The loss mask is a list of code-point spans of the
formatted string: the escaped texts of the assistant's turns.

Defined cases: a null text or role is empty; ties of a turn number are ordered by role and text; repeated rows are repeated turns; a
conversation of no rows doesn't occur; rows without a conversation id belong to none and are left out. A record that can't be read (no JSON, a layout
without a mapping, a field that some turn lacks, a text that is no string) is set apart: its formatted string is null and ``error`` says why, naming the
paths; the other records are not affected, and ``digests`` leaves it out. Extra columns are ignored.
A conversation is one record, so it is formatted in one task; many equal conversations are spread by their ids.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import groups

START, END, ESCAPE = "<|turn_start|>", "<|turn_end|>", "␛"
#: Control strings of this and of other public templates.
CONTROLS = [START, END, "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_ESCAPES = re.compile(f"{ESCAPE}|(?=" + "|".join(map(re.escape, CONTROLS)) + ")(.)", re.S)
_UNESCAPES = re.compile(f"{ESCAPE}(.?)", re.S)

#: Mappings. ``turns``: path of the list and the names of role and text; ``fields``: (field, role) in order of the turns.
MAPPINGS: list[dict[str, Any]] = [
    {"paths": ["messages", "messages[]", "messages[].role", "messages[].content"], "turns": ("messages", "role", "content")},
    {"paths": ["conversations", "conversations[]", "conversations[].from", "conversations[].value"], "turns": ("conversations", "from", "value"), "roles": {"human": "user", "gpt": "assistant"}},
    {"paths": ["data", "data.dialog", "data.dialog[]", "data.dialog[].speaker", "data.dialog[].utterance"], "turns": ("data.dialog", "speaker", "utterance")},
    {"paths": ["prompt", "completion"], "fields": [("prompt", "user"), ("completion", "assistant")]},
    {"paths": ["instruction", "output", "system"], "fields": [("system", "system"), ("instruction", "user"), ("output", "assistant")]},
    {"paths": ["question"], "fields": [("question", "user")]},
]


def paths_of(record: Any, at: str = "") -> set[str]:
    if isinstance(record, dict):
        return {p for k, v in record.items() for p in ({f"{at}.{k}" if at else k} | paths_of(v, f"{at}.{k}" if at else k))}
    if isinstance(record, list):
        return {p for v in record for p in ({f"{at}[]"} | paths_of(v, f"{at}[]"))}
    return set()


def fingerprint(paths: set[str] | list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def registry(mappings: list[dict[str, Any]] = MAPPINGS) -> dict[str, dict[str, Any]]:
    return {fingerprint(m["paths"]): m for m in mappings}


def canonical_turns(record: Any, mappings: dict[str, dict[str, Any]]) -> list[tuple[str, str]]:
    paths = paths_of(record)
    m = mappings.get(fingerprint(paths))
    if m is None:
        raise ValueError(f"no mapping for the layout {sorted(paths)}")
    if "fields" in m:
        turns = [(role, record[field]) for field, role in m["fields"]]
    else:
        path, role, text = m["turns"]
        for key in path.split("."):
            record = record[key]
        if not all(isinstance(x, dict) and role in x and text in x for x in record):
            raise ValueError(f"a turn of {path} has no {role} or {text}")
        roles = m.get("roles", {})
        turns = [(roles.get(x[role], x[role]) if isinstance(x[role], str) else x[role], x[text]) for x in record]
    for turn in turns:
        if not all(x is None or isinstance(x, str) for x in turn):
            raise ValueError("a role or text is no string")
    return [(role or "", text or "") for role, text in turns]


def escape(text: str, role: bool = False) -> str:
    out = _ESCAPES.sub(lambda m: ESCAPE * 2 if m[1] is None else m[1] + (ESCAPE * 2 if m[1] == ESCAPE else ESCAPE), text)
    return out.replace("\n", f"{ESCAPE}n") if role else out


def unescape(text: str, role: bool = False) -> str:
    return _UNESCAPES.sub(lambda m: ESCAPE if m[1] == ESCAPE else "\n" if role and m[1] == "n" else m[1], text)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted string, and the spans under the loss mask."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role, True)}\n", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, f"{END}\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def parse_formatted(text: str) -> list[tuple[str, str]]:
    """The turns of a formatted string."""
    out, at = [], 0
    while at < len(text):
        line = text.index("\n", at)
        end = text.index(END, line)
        if not text.startswith(START, at):
            raise ValueError(f"no turn starts at {at}")
        out.append((unescape(text[at + len(START) : line], True), unescape(text[line + 1 : end])))
        at = end + len(END) + 1
    return out


def as_layout(turns: list[tuple[str, str]], choice: int) -> dict[str, Any]:
    """A record of one of the layouts that the mappings know; ``choice`` picks among those that can hold the turns."""
    roles = [r for r, _ in turns]
    if choice % 2 and roles == ["user", "assistant"]:
        return {"prompt": turns[0][1], "completion": turns[1][1]}
    if choice % 2 and roles == ["system", "user", "assistant"]:
        return {"system": turns[0][1], "instruction": turns[1][1], "output": turns[2][1]}
    if choice % 2 and roles == ["user"]:
        return {"question": turns[0][1]}
    if choice % 3 == 1 and not {"human", "gpt"} & {*roles}:
        back = {"user": "human", "assistant": "gpt"}
        return {"conversations": [{"from": back.get(r, r), "value": t} for r, t in turns]}
    if choice % 3 == 2:
        return {"data": {"dialog": [{"speaker": r, "utterance": t} for r, t in turns]}}
    return {"messages": [{"role": r, "content": t} for r, t in turns]}


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in groups(batches, ["conv_id"]):
        conv = table.column("conv_id")[0].as_py()
        turns = list(zip(table.column("role").to_pylist(), table.column("text").to_pylist(), strict=True))
        yield pa.record_batch([pa.array([conv], pa.int64()), pa.array([json.dumps(as_layout(turns, conv), ensure_ascii=False)])], names=["conv_id", "record"])


def gather_records(rows: DataFrame) -> DataFrame:
    """``(conv_id, record)`` from rows ``(conv_id, turn, role, text)``: JSON in the layouts of ``as_layout``."""
    clean = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).where("conv_id is not null")
    return clean.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(_records, "conv_id long, record string")


def _format(mappings: dict[str, dict[str, Any]]):
    def formatted(record: str | None) -> tuple[str | None, list[list[int]] | None, str | None]:
        try:
            text, spans = format_turns(canonical_turns(json.loads(record or ""), mappings))
        except (ValueError, RecursionError) as e:
            return None, None, str(e) or type(e).__name__
        return text, [list(s) for s in spans], None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [formatted(x) for x in batch.column("record").to_pylist()]
            columns = [pa.array([x[k] for x in done], t) for k, t in enumerate((pa.string(), pa.list_(pa.list_(pa.int64())), pa.string()))]
            yield pa.record_batch([batch.column("conv_id"), *columns], names=["conv_id", "formatted", "loss_spans", "error"])

    return run


def format_records(records: DataFrame, mappings: list[dict[str, Any]] = MAPPINGS) -> DataFrame:
    """``(conv_id, formatted, loss_spans, error)`` from ``(conv_id, record)``; ``error`` is null but for records that can't be read."""
    return records.select("conv_id", "record").mapInArrow(_format(registry(mappings)), "conv_id long, formatted string, loss_spans array<array<bigint>>, error string")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for conv, text, spans in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "formatted", "loss_spans")), strict=True):
            if text is None:
                continue
            turns = parse_formatted(text)
            loss = "".join(unescape(text[a:b]) for a, b in spans)
            rows.append((conv, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
        if rows:
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.record_batch([pa.array(np.array(c) if not isinstance(c[0], str) else list(c)) for c in zip(*rows, strict=True)], names=names)


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted strings hold, read back from them."""
    return formatted.mapInArrow(_digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def probe_rows(spark: SparkSession) -> DataFrame:
    """Conversation -7, whose texts are control strings of other templates."""
    text = "</s>[INST] ok [/INST]"
    return spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
