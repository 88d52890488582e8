"""Chat formatting with typed content parts.

A message's content is a list of typed parts: text, image, audio, document. A
visitor flattens them in order into one segment between turn marks. A part
that is no text becomes a numbered placeholder; its attachment reference and
the number of tokens it expands to are recorded beside the segment.

Escaping is reversible: in texts, ``<`` + n backslashes + ``|`` gets one
backslash more, so a control string (n = 0) never stands in an escaped text.
In roles, backslashes and line ends are escaped as well.

A conversation's training string is the concatenation of its segments in the
order (turn, role, segment), nulls first. One row per message is written and
never a whole conversation, so a conversation of any length needs no more
memory than its longest message.

Null text is empty; a null role is an empty one; a null conversation id is an
id of its own; rows that repeat or tie are all kept. Unknown part types raise.
Other columns of the input are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import map_rows

START, END = "<|im_start|>", "<|im_end|>"
PART_TYPE = "array<struct<type:string,text:string,ref:string,width:long,height:long,seconds:double,pages:long>>"
SEGMENT_SCHEMA = (
    "conv_id long, turn long, role string, segment string, loss_spans array<struct<begin:long,end:long>>, "
    "attachments array<struct<number:long,kind:string,ref:string,position:long,tokens:long>>, expanded_tokens long"
)
# Documented sizes behind the expanded token counts.
IMAGE_PATCH, AUDIO_TOKENS_A_SECOND, DOCUMENT_TOKENS_A_PAGE = 28, 25, 512

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_PLACE = re.compile(r"<\|(image|audio|document)_(\d+)\|>")
_SEGMENT = re.compile(rf"{re.escape(START)}([^\n]*)\n(.*){re.escape(END)}\n", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class PartVisitor:
    """Flattens the parts of one message; ``visit_<type>`` handles each type."""

    def __init__(self, role: str, trained: bool):
        self.pieces = [START, escape_role(role), "\n"]
        self.at = sum(map(len, self.pieces))
        self.trained, self.loss, self.attachments = trained, [], []

    def put(self, text: str) -> None:
        self.pieces.append(text)
        self.at += len(text)

    def visit(self, part: dict) -> None:
        method = getattr(self, f"visit_{part['type']}", None)
        if method is None:
            raise ValueError(f"unknown part type {part['type']!r}")
        method(part)

    def visit_text(self, part: dict) -> None:
        begin = self.at
        self.put(escape(part["text"] or ""))
        if self.trained and self.at > begin:
            self.loss.append({"begin": begin, "end": self.at})

    def attach(self, kind: str, part: dict, tokens: int) -> None:
        number = len(self.attachments) + 1
        self.attachments.append({"number": number, "kind": kind, "ref": part["ref"], "position": self.at, "tokens": tokens})
        self.put(f"<|{kind}_{number}|>")

    def visit_image(self, part: dict) -> None:
        across, down = (-(-(part[k] or 0) // IMAGE_PATCH) for k in ("width", "height"))
        self.attach("image", part, max(1, across * down))

    def visit_audio(self, part: dict) -> None:
        self.attach("audio", part, max(1, round((part["seconds"] or 0) * AUDIO_TOKENS_A_SECOND)))

    def visit_document(self, part: dict) -> None:
        self.attach("document", part, max(1, (part["pages"] or 0) * DOCUMENT_TOKENS_A_PAGE))

    def segment(self) -> str:
        return "".join([*self.pieces, END, "\n"])


def text_parts(text) -> F.Column:
    """Plain text as a list of one text part."""
    null = {"ref": "string", "width": "long", "height": "long", "seconds": "double", "pages": "long"}
    part = F.struct(
        F.lit("text").alias("type"),
        F.coalesce(text.cast("string"), F.lit("")).alias("text"),
        *(F.lit(None).cast(t).alias(k) for k, t in null.items()),
    )
    return F.array(part).cast(PART_TYPE)


def format_chat(messages: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """A formatted segment per message ``(conv_id, turn, role, parts)``; text of ``trained_role`` is under the loss mask."""

    def run(batches):
        for b in batches:
            done = []
            for role, parts in zip(b["role"], b["parts"], strict=True):
                v = PartVisitor(role, role == trained_role)
                for part in parts or ():
                    v.visit(part)
                done.append(v)
            yield {
                "conv_id": b["conv_id"],
                "turn": b["turn"],
                "role": b["role"],
                "segment": [v.segment() for v in done],
                "loss_spans": [v.loss for v in done],
                "attachments": [v.attachments for v in done],
                "expanded_tokens": [sum(a["tokens"] for a in v.attachments) for v in done],
            }

    rows = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.col("parts").cast(PART_TYPE).alias("parts"),
    )
    return map_rows(rows, run, SEGMENT_SCHEMA)


def parse_segment(segment: str) -> tuple[str, str]:
    """Role and text of a segment, placeholders left in place."""
    found = _SEGMENT.fullmatch(segment)
    if found is None:
        raise ValueError("not a formatted segment")
    return unescape_role(found[1]), unescape(found[2])


def conversation_digests(segments: DataFrame) -> DataFrame:
    """Per conversation, read back from its segments: turns, digests of turns and of the text under the loss mask, lengths.

    Rows are dealt by conversation and sorted, then hashed as they stream by; nothing of a conversation is collected.
    """

    def run(batches):
        state = None

        def result(s):
            return {
                "conv_id": [s["conv_id"]],
                "n_turns": [s["n"]],
                "turns_sha256": [s["turns"].hexdigest()],
                "loss_chars": [s["loss_chars"]],
                "loss_sha256": [s["loss"].hexdigest()],
                "formatted_chars": [s["chars"]],
            }

        for b in batches:
            for conv, segment, spans in zip(b["conv_id"], b["segment"], b["loss_spans"], strict=True):
                if state is None or state["conv_id"] != conv:
                    if state is not None:
                        yield result(state)
                    state = {"conv_id": conv, "n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0}
                role, text = parse_segment(segment)
                state["turns"].update(f"{role}\n{text}\n".encode())
                for s in spans:
                    shown = unescape(segment[s["begin"] : s["end"]])
                    state["loss"].update(shown.encode())
                    state["loss_chars"] += len(shown)
                state["n"] += 1
                state["chars"] += len(segment)
        if state is not None:
            yield result(state)

    rows = segments.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "segment")
    return map_rows(
        rows.select("conv_id", "segment", "loss_spans"),
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
