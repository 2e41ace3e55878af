"""Chat formatting of typed content parts, with reversible escaping and a loss mask.

A turn's content is a list of parts: text, image, audio or document. A visitor walks the parts in order and flattens
them: text is escaped, every other part becomes a placeholder token whose model-side length (patches of an image,
frames of an audio clip, pages of a document) is recorded with the attachment's reference and place. The template is

    <|turn|>ROLE<|says|>CONTENT<|end|>

for each turn. A control string inside a role or text gets a backslash after its first character, and a backslash is
doubled; so no control string of a text can be mistaken for the template's, and the text comes back exactly. The
content of assistant turns is under the loss mask, as code point ranges of the formatted text.

Turns are dealt by range of (conversation, turn), so a conversation of any length is spread over tasks. A task writes
segments: consecutive turns of one conversation, at most about ``SEGMENT`` characters each. What must see a whole
conversation in order (its digests) streams over its segments, one at a time, holding none of them.

Defined results: null text is empty; null role is the role "unknown"; rows of a conversation are in order of turn (nulls
first), ties by role, then by the MD5 of text and parts, in dealing and sorting alike, so the result does not depend on
partitions; repeated rows are repeated turns; a null conv_id is a conversation of its own; extra
columns are ignored; an empty table gives no rows; a part of unknown type or without a reference is kept as a document.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labeldiff.llm.common import stored

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
PLACES = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
#: The template's own control strings, and those of other common templates.
CONTROL = (TURN, SAYS, END, *PLACES.values(), "<s>", "</s>", "<unk>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>")
_control = re.compile(f"(?={'|'.join(map(re.escape, CONTROL))})(.)", re.S)
_escaped = re.compile(r"\\(.)", re.S)
_mark = re.compile("|".join(map(re.escape, (TURN, SAYS, END, *PLACES.values()))))
#: Characters in a segment, roughly; pixels of an image patch's side; frames of a second of audio; tokens of a page.
SEGMENT, PATCH, FRAMES, PAGE = 16_384, 14, 50, 256


def escape(text: str) -> str:
    return _control.sub(r"\1\\", text.replace("\\", "\\\\")) if "\\" in text or "<" in text or "[" in text else text


def unescape(text: str) -> str:
    return _escaped.sub(r"\1", text) if "\\" in text else text


class Flatten:
    """Visitor of content parts: the flat text, the attachments met, and the tokens that placeholders expand to."""

    def __init__(self) -> None:
        self.out: list[str] = []
        self.size = 0
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part.get('type') or 'text'}", self.visit_document)(part)

    def write(self, text: str) -> None:
        self.out.append(text)
        self.size += len(text)

    def visit_text(self, part: dict) -> None:
        self.write(escape(part.get("text") or ""))

    def attach(self, kind: str, part: dict, tokens: int) -> None:
        self.attachments.append({"kind": kind, "ref": part.get("ref") or "", "at": self.size, "tokens": max(1, tokens)})
        self.write(PLACES[kind])

    def visit_image(self, part: dict) -> None:
        self.attach("image", part, math.ceil((part.get("width") or 1) / PATCH) * math.ceil((part.get("height") or 1) / PATCH))

    def visit_audio(self, part: dict) -> None:
        self.attach("audio", part, math.ceil((part.get("seconds") or 0) * FRAMES))

    def visit_document(self, part: dict) -> None:
        self.attach("document", part, (part.get("pages") or 1) * PAGE)


def format_turn(role: str, parts: list[dict]) -> tuple[str, int, int, list[dict]]:
    """The formatted turn, where its content starts and ends, and its attachments (at: in the content)."""
    flat = Flatten()
    for p in parts:
        flat.visit(p)
    head, body = f"{TURN}{escape(role)}{SAYS}", "".join(flat.out)
    return f"{head}{body}{END}", len(head), len(head) + len(body), flat.attachments


def parse(text: str):
    """Turns of formatted text as (role, content start, content end); the inverse of the template."""
    at = 0
    while at < len(text):
        if not text.startswith(TURN, at):
            raise ValueError(f"no turn at {at}")
        says = text.index(SAYS, at)
        end = text.index(END, says)
        yield unescape(text[at + len(TURN) : says]), says + len(SAYS), end
        at = end + len(END)


SEGMENTS = "conv_id long, part int, seq int, n_turns long, text string, mask array<array<int>>, attachments array<struct<turn:long,kind:string,ref:string,at:long,tokens:long>>, n_expanded long"
_schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int32()), ("n_turns", pa.int64()), ("text", pa.string()), ("mask", pa.list_(pa.list_(pa.int32()))), ("attachments", pa.list_(pa.struct([("turn", pa.int64()), ("kind", pa.string()), ("ref", pa.string()), ("at", pa.int64()), ("tokens", pa.int64())]))), ("n_expanded", pa.int64())])


def write_segments(batches):
    """For mapInArrow over sorted turns."""
    from pyspark import TaskContext

    part, seq, segment, size = TaskContext.get().partitionId(), 0, None, 0

    def row():
        return pa.RecordBatch.from_pylist([segment | {"text": "".join(segment["text"])}], schema=_schema)

    for batch in batches:
        for r in (r for k in range(0, batch.num_rows, 256) for r in batch.slice(k, 256).to_pylist()):
            if segment is not None and (segment["conv_id"] != r["conv_id"] or size >= SEGMENT):
                yield row()
                segment, seq = None, seq + 1
            if segment is None:
                segment, size = {"conv_id": r["conv_id"], "part": part, "seq": seq, "n_turns": 0, "text": [], "mask": [], "attachments": [], "n_expanded": 0}, 0
            role = r["role"]
            parts = r.get("parts") if r.get("parts") is not None else [{"type": "text", "text": r["text"]}]
            text, start, end, attachments = format_turn(role, parts)
            if role == "assistant":
                segment["mask"].append([size + start, size + end])
            segment["attachments"] += [a | {"turn": r["turn"], "at": size + start + a["at"]} for a in attachments]
            segment["n_expanded"] += sum(a["tokens"] for a in attachments)
            segment["text"].append(text)
            segment["n_turns"] += 1
            size += len(text)
    if segment is not None:
        yield row()


def format_conversations(turns: DataFrame, parts_col: str | None = None) -> DataFrame:
    """Segments of formatted conversations as written and read back: conv_id, part and seq (their order), text, loss mask, attachments."""
    parts = F.col(f"`{parts_col}`") if parts_col else None
    text = F.coalesce(F.col("text"), F.lit(""))
    tie = F.md5(text.cast("binary")) if parts is None else F.md5(F.concat(text, F.lit("\0"), F.coalesce(F.to_json(parts), F.lit(""))).cast("binary"))
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("unknown")).alias("role"), text.alias("text"), *([parts.alias("parts")] if parts is not None else []), tie.alias("tie"))
    order = ["conv_id", "turn", "role", "tie"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    return stored(dealt.mapInArrow(write_segments, SEGMENTS), "chat")


_report = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_attachments", pa.int64()), ("n_expanded", pa.int64()), ("attachments_sha256", pa.string())])
REPORT = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_attachments long, n_expanded long, attachments_sha256 string"


def read_back(batches):
    """For mapInArrow over segments in order: digests of every conversation, from the formatted text alone, its mask and its
    attachments (a line of turn, kind, reference, place in the formatted conversation and tokens for each)."""
    now = None

    def row():
        return pa.RecordBatch.from_pylist([now | {"turns_sha256": turns.hexdigest(), "loss_sha256": loss.hexdigest(), "attachments_sha256": seen.hexdigest()}], schema=_report)

    for batch in batches:
        for k in range(batch.num_rows):
            r = batch.slice(k, 1).to_pylist()[0]
            if now is None or now["conv_id"] != r["conv_id"]:
                if now is not None:
                    yield row()
                now = {"conv_id": r["conv_id"], "n_turns": 0, "loss_chars": 0, "formatted_chars": 0, "n_attachments": 0, "n_expanded": 0}
                turns, loss, seen = hashlib.sha256(), hashlib.sha256(), hashlib.sha256()
            text = r["text"]
            for role, start, end in parse(text):
                turns.update(f"{role}\n{unescape(text[start:end])}\n".encode())
                now["n_turns"] += 1
            for start, end in r["mask"]:
                said = unescape(text[start:end])
                loss.update(said.encode())
                now["loss_chars"] += len(said)
            for x in r["attachments"]:
                if not text.startswith(PLACES[x["kind"]], x["at"]):
                    raise ValueError(f"no placeholder at {x['at']}")
                seen.update(f"{x['turn']}\t{x['kind']}\t{x['ref']}\t{now['formatted_chars'] + x['at']}\t{x['tokens']}\n".encode())
            now["n_attachments"] += len(r["attachments"])
            now["n_expanded"] += r["n_expanded"]
            now["formatted_chars"] += len(text)
    if now is not None:
        yield row()


def report(segments: DataFrame) -> DataFrame:
    """One row per conversation. A digest of a whole conversation is sequential by definition: its segments are streamed through one task, in constant memory."""
    rows = segments.select("conv_id", "part", "seq", "text", "mask", "attachments", "n_expanded").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return rows.mapInArrow(read_back, REPORT)
