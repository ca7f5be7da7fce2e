r"""Chat formatting with typed content parts.

A turn's content is a list of parts: text, image, audio or document. A visitor flattens them: texts
are escaped and kept in place, attachments become ordered placeholders, and each attachment's
reference and the number of tokens it will expand to are recorded. A formatted turn is

    ### role:
    text with <|image:0|> placeholders</turn>

and the loss mask lists the spans of an assistant's text. In texts, a backslash, `###`, `</turn>`
and `<|` get a backslash in front, which is taken off when the turn is read back.

A formatted conversation is the sequence of its formatted turns, one row each, so a conversation
of any length never sits in one row. Readers take the turns of a conversation in order and keep
running digests only.

Defined results: null texts and null roles count as empty, null parts and null part lists as none;
a part of unknown type is an attachment of one token; a null conversation id is a conversation of
its own; turns go by number (null first), repeated numbers by their formatted text; repeated rows
are repeated turns; an empty table gives no rows. Only the named columns are read."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ATTACHMENT = "struct<ordinal:int,kind:string,ref:string,n_tokens:long>"
TURN = f"formatted string, loss array<struct<start:int,length:int>>, attachments array<{ATTACHMENT}>"
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"

_CONTROL = re.compile(r"\\|###|</turn>|<\|")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|<\|)")
_HEADER = re.compile(r"### ((?:[^\\:]|\\.)*):\n", re.DOTALL)
_BODY = re.compile(r"\\(?:\\|###|</turn>|<\|)|(?P<end></turn>\n)|(?P<slot><\|[^|]*:\d+\|>)")


@dataclass(frozen=True)
class Expansion:
    """How attachments expand: image patches, audio frames per second, tokens per page."""

    patch: int = 14
    frames_per_second: float = 25.0
    tokens_per_page: int = 1024
    unknown_size: int = 1


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _escape_role(role: str) -> str:
    return re.sub(r"[\\:]", lambda m: "\\" + m.group(), role)


@dataclass
class PartVisitor:
    """Flattens the parts of one turn."""

    expansion: Expansion
    with_loss: bool
    head: str
    out: list[str] = field(default_factory=list)
    size: int = 0
    pending: list[str] = field(default_factory=list)
    loss: list[dict] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def __post_init__(self) -> None:
        self._put(self.head)

    def _put(self, text: str) -> None:
        self.out.append(text)
        self.size += len(text)

    def visit(self, part: dict | None) -> None:
        if part is not None:
            kind = part.get("type") or "text"
            getattr(self, f"visit_{kind}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        # Neighbouring texts are escaped as one, or a control string could arise between them.
        self.pending.append(part.get("text") or "")

    def visit_image(self, part: dict) -> None:
        w, h, patch = part.get("width"), part.get("height"), self.expansion.patch
        self._attach(part, math.ceil(w / patch) * math.ceil(h / patch) if w and h else None)

    def visit_audio(self, part: dict) -> None:
        s = part.get("seconds")
        self._attach(part, math.ceil(s * self.expansion.frames_per_second) if s else None)

    def visit_document(self, part: dict) -> None:
        pages = part.get("pages")
        self._attach(part, pages * self.expansion.tokens_per_page if pages else None)

    def visit_other(self, part: dict) -> None:
        self._attach(part, None)

    def _attach(self, part: dict, n_tokens: int | None) -> None:
        self._flush()
        ordinal, kind = len(self.attachments), re.sub(r"\W", "", part["type"])
        size = self.expansion.unknown_size if n_tokens is None else n_tokens
        self.attachments.append(
            {"ordinal": ordinal, "kind": kind, "ref": part.get("ref"), "n_tokens": size}
        )
        self._put(f"<|{kind}:{ordinal}|>")

    def _flush(self) -> None:
        text = escape("".join(self.pending))
        self.pending = []
        if text:
            if self.with_loss:
                self.loss.append({"start": self.size, "length": len(text)})
            self._put(text)

    def finish(self) -> dict:
        self._flush()
        self._put("</turn>\n")
        return {"formatted": "".join(self.out), "loss": self.loss, "attachments": self.attachments}


def format_turn(role: str | None, parts: list[dict] | None, expansion: Expansion = Expansion()) -> dict:
    visitor = PartVisitor(expansion, role == "assistant", f"### {_escape_role(role or '')}:\n")
    for part in parts or []:
        visitor.visit(part)
    return visitor.finish()


def read_turn(formatted: str) -> tuple[str, str, list[str]]:
    """Role, text (without placeholders) and placeholders of a formatted turn."""
    head = _HEADER.match(formatted)
    if head is None:
        raise ValueError("not a formatted turn")
    role = re.sub(r"\\(.)", r"\1", head.group(1), flags=re.DOTALL)
    texts, slots, at = [], [], head.end()
    for m in _BODY.finditer(formatted, at):
        if m.lastgroup is None:
            continue
        texts.append(unescape(formatted[at : m.start()]))
        at = m.end()
        if m.lastgroup == "end":
            if at != len(formatted):
                break
            return role, "".join(texts), slots
        slots.append(m.group())
    raise ValueError("a formatted turn has one end, at its end")


def text_part(text: Column) -> Column:
    """A content list of one text part."""
    nulls = [F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), *nulls))


def format_turns(
    turns: DataFrame,
    expansion: Expansion = Expansion(),
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    content: str = "content",
) -> DataFrame:
    """conv_id, turn, formatted, loss, attachments: one row per turn, without any shuffle."""
    slim = turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        F.col(role).alias("role"), F.col(content).alias("content"),
    )
    out_types = pa.schema(
        [
            ("formatted", pa.string()),
            ("loss", pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))),
            ("attachments", pa.list_(pa.struct([("ordinal", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("n_tokens", pa.int64())]))),
        ]
    )

    def flatten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("role").to_pylist(), batch.column("content").to_pylist())
            made = [format_turn(r, parts, expansion) for r, parts in rows]
            columns = [pa.array([m[f.name] for m in made], f.type) for f in out_types]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), *columns],
                names=["conv_id", "turn", *out_types.names],
            )

    ids = ", ".join(f"{c} {slim.schema[c].dataType.simpleString()}" for c in ("conv_id", "turn"))
    return slim.mapInArrow(flatten, f"{ids}, {TURN}")


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_attachments, from
    formatted turns. Turns of a conversation are sorted (Spark spills) and streamed; the digests
    are sequential by nature, so a conversation is read by one task, in constant memory."""
    ordered = (
        formatted.select("conv_id", "turn", "formatted", "loss", F.size("attachments").alias("n"))
        .repartition(F.col("conv_id"))
        .sortWithinPartitions("conv_id", "turn", "formatted")
    )
    kind = formatted.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_attachments"]
    types = ["long", "string", "long", "string", "long", "long"]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, schema = None, None, None

        def closed() -> list:
            n, turns, loss_chars, loss, chars, slots = state
            return [current, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, slots]

        def as_batch(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), schema)], names=names
            )

        for batch in batches:
            schema = [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            rows = []
            for conv, text, loss, n in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss", "n"))):
                if state is None or conv != current:
                    if state is not None:
                        rows.append(closed())
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                role, said, _ = read_turn(text)
                state[0] += 1
                state[1].update(f"{role}\n{said}\n".encode())
                for span in loss:
                    under = unescape(text[span["start"] : span["start"] + span["length"]])
                    state[2] += len(under)
                    state[3].update(under.encode())
                state[4] += len(text)
                state[5] += n
            if rows:
                yield as_batch(rows)
        if state is not None:
            yield as_batch([closed()])

    fields = ", ".join(f"{n} {t}" for n, t in zip(names[1:], types))
    return ordered.mapInArrow(fold, f"conv_id {kind}, {fields}")
