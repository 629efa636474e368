"""Chat formatting: typed content parts flattened into one marked-up text."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
#: Tokens that one unit of an attachment stands for: image tiles, audio seconds, pages.
UNIT_TOKENS = {"image": 256, "audio": 25, "document": 1024}
PARTS = "array<struct<kind:string,text:string,ref:string,units:bigint>>"
_FORMATTED = (
    "formatted string, loss_start bigint, loss_end bigint, "
    "attachments array<struct<kind:string,ref:string,tokens:bigint>>, tokens bigint"
)
_CONTROL = re.compile(r"<\|(image|audio|document) (\d+)\|>")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """No marker of the template can occur in the result, nor where two results meet;
    ``unescape`` gives ``text`` back."""
    safe = text.replace("\\", "\\\\").replace("<|", "<\\|")
    return "\\" + safe if safe.startswith("|") else safe


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class Flatten:
    """Visits the parts of one turn in order and gathers text and attachments."""

    def __init__(self) -> None:
        self.out: list[str] = []
        self.attachments: list[dict] = []

    def visit(self, part) -> None:
        kind = part["kind"] or "text"
        visitor = getattr(self, f"visit_{kind}", None)
        if visitor is None:
            raise ValueError(f"unknown part: {kind}")
        visitor(part)

    def visit_text(self, part) -> None:
        self.out.append(escape(part["text"] or ""))

    def _attach(self, part) -> None:
        units = part["units"]
        tokens = UNIT_TOKENS[part["kind"]] * int(1 if units is None or units != units else units)
        self.out.append(f"<|{part['kind']} {len(self.attachments)}|>")
        self.attachments.append({"kind": part["kind"], "ref": part["ref"], "tokens": tokens})

    visit_image = visit_audio = visit_document = _attach


def text_parts(text: Column) -> Column:
    """One text part; null counts as empty."""
    return F.array(F.struct(
        F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"), F.lit(None).cast("bigint").alias("units"),
    )).cast(PARTS)


def format_turns(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts",
    loss_role: str = "assistant",
) -> DataFrame:
    """One formatted piece per turn; a conversation is its pieces in order of turn.

    Columns: conversation, turn, formatted, loss_start and loss_end (code points in the
    piece that the loss covers: the body of a ``loss_role`` turn, else empty),
    attachments, tokens (what all attachments expand to). A null role or part list counts
    as empty. Turns are formatted one by one, without a shuffle.
    """
    @F.pandas_udf(_FORMATTED)
    def of(roles: pd.Series, parts: pd.Series) -> pd.DataFrame:
        out = []
        for role, own in zip(roles, parts):
            flat = Flatten()
            for part in own if own is not None else []:
                flat.visit(part)
            body, head = "".join(flat.out), f"{TURN}{escape(role or '')}{BODY}"
            end = len(head) + (len(body) if role == loss_role else 0)
            out.append((head + body + END, len(head), end, flat.attachments, sum(a["tokens"] for a in flat.attachments)))
        return pd.DataFrame(out, columns=["formatted", "loss_start", "loss_end", "attachments", "tokens"])

    return rows.select(F.col(conv_col), F.col(turn_col), of(F.col(role_col), F.col(parts_col)).alias("f")).select(conv_col, turn_col, "f.*")


def parse_turn(piece: str) -> tuple[str, list[tuple[str, str]]]:
    """(role, [(kind, text or number of the attachment)]) of one formatted turn."""
    if not (piece.startswith(TURN) and piece.endswith(END)):
        raise ValueError("not a formatted turn")
    role, body = piece[len(TURN) : -len(END)].split(BODY, 1)
    parts, at = [], 0
    for m in _CONTROL.finditer(body):
        if m.start() > at:
            parts.append(("text", unescape(body[at : m.start()])))
        parts.append((m[1], m[2]))
        at = m.end()
    if at < len(body) or not parts:
        parts.append(("text", unescape(body[at:])))
    return unescape(role), parts


def _digests(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """One row per run of equal conversation ids; what is held does not grow with a run."""
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    conv, n, out = None, 0, []
    turns = loss = None
    loss_chars = chars = 0

    def close() -> None:
        if n:
            out.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))

    for batch in batches:
        for own, piece, start, end in zip(*(c.to_pylist() for c in batch.columns)):
            if not n or own != conv:
                close()
                conv, n, loss_chars, chars, turns, loss = own, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
            role, parts = parse_turn(piece)
            text = "".join(v for k, v in parts if k == "text")
            turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            under = unescape(piece[start:end])
            loss.update(under.encode("utf-8", "surrogatepass"))
            n, loss_chars, chars = n + 1, loss_chars + len(under), chars + len(piece)
        if len(out) >= 1000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
            out.clear()
    close()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def read_back(formatted: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Digests per conversation of what the formatted pieces say.

    Turns are read in order (equal turn numbers by piece, null first) as a stream sorted
    on disk, so a conversation of any length needs the memory of one turn; its digest is
    sequential by nature. Rows without a conversation id are one conversation.
    """
    kind = formatted.schema[conv_col].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = to_arrow_type(kind)
    ordered = formatted.repartition(conv_col).sortWithinPartitions(conv_col, turn_col, "formatted")
    schema = f"conv {kind.simpleString()}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return ordered.select(conv_col, "formatted", "loss_start", "loss_end").mapInArrow(
        lambda batches: _digests(batches, arrow), schema
    ).withColumnRenamed("conv", conv_col)
