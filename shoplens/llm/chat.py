"""Chat formatting with typed content parts.

A turn holds a role and parts: text, image, audio or document.  A visitor flattens the parts in order: text is
escaped, every other part becomes a numbered placeholder, its reference is recorded as an attachment, and the token
count it expands to is added up.  A turn is written as

    <|turn|>role<|body|>content<|end|>

and only the text inside an assistant's content is under the loss mask.  Control strings inside roles and texts are
broken by a backslash after their first character, one more if some are there already, so what is read back is what
was written and no control string of a text ever stands in the output.

A turn's format depends on the turn alone, so formatting needs no grouping, whatever the length of a conversation.
Digests over a conversation are taken by streaming its sorted turns: memory holds one batch, not a conversation.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import ship_code

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
# Control strings of public chat templates that a text must not smuggle in, besides our own.
_TAILS = r"\|turn\|>|\|body\|>|\|end\|>|\|(?:image|audio|document):\d+\|>|s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|\|im_start\|>|\|im_end\|>|\|endoftext\|>"
_BREAK = re.compile(rf"([<\[])(\\*)(?=(?:{_TAILS}))")
_JOIN = re.compile(rf"([<\[])\\(\\*)(?=(?:{_TAILS}))")
_TURNS = re.compile(r"<\|turn\|>(.*?)<\|body\|>(.*?)<\|end\|>", re.S)
_HOLDER = re.compile(r"<\|(?:image|audio|document):\d+\|>")

SCHEMA = ("conv_id long, turn long, role string, formatted string, loss_spans array<struct<start:int,length:int>>, "
          "attachments array<struct<place:int,kind:string,ref:string,tokens:long>>, media_tokens long")


def escape(text: str) -> str:
    return _BREAK.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _JOIN.sub(r"\1\2", text)


_SURROGATE = re.compile("[\ud800-\udfff]")
LARGEST = 10**8  # a size beyond is no size


def _text(value) -> str:
    """A text of a part: null is empty, other values are their JSON; halves of a character become U+FFFD."""
    if value is None:
        return ""
    return _SURROGATE.sub("\ufffd", value if isinstance(value, str) else json.dumps(value, ensure_ascii=False))


def _size(value) -> float:
    """A size of a part; 1 for what is no number (or the text of one) over 0 and up to ``LARGEST``."""
    try:
        size = 1.0 if isinstance(value, bool) else float(value)
    except (TypeError, ValueError, OverflowError):
        return 1.0
    return size if 0 < size <= LARGEST else 1.0


class PartVisitor:
    """Flattens the parts of one turn.

    Expanded token counts: an image takes 85 tokens and 170 for each tile of 512 x 512 begun, audio 25 a second begun,
    a document 1,500 a page begun; sizes that are missing or no sizes count as one tile, second or page.  A part of
    another type is its text; has it a ``ref``, this is attached under the part's own type, in a document's place and
    with no tokens.
    """

    def __init__(self):
        self.pieces: list[str] = []
        self.texts: list[tuple[int, int]] = []
        self.attachments: list[tuple[int, str, str | None, int]] = []
        self.at = 0

    def visit(self, part: dict) -> None:
        kind = part.get("type") or "text"
        known = {"text": self.visit_text, "image": self.visit_image, "audio": self.visit_audio, "document": self.visit_document}
        (known.get(kind, self.visit_other) if isinstance(kind, str) else self.visit_other)(part)

    def _put(self, piece: str) -> None:
        self.pieces.append(piece)
        self.at += len(piece)

    def _attach(self, kind: str, part: dict, tokens: int, place: str | None = None) -> None:
        ref = part.get("ref")
        self.attachments.append((len(self.attachments), kind, None if ref is None else _text(ref), tokens))
        self._put(f"<|{place or kind}:{len(self.attachments) - 1}|>")

    def visit_text(self, part: dict) -> None:
        text = escape(_text(part.get("text")))
        if text:
            self.texts.append((self.at, len(text)))
            self._put(text)

    def visit_other(self, part: dict) -> None:
        self.visit_text(part)
        if part.get("ref") is not None:
            self._attach(_text(part["type"]), part, 0, "document")

    def visit_image(self, part: dict) -> None:
        across, down = (math.ceil(_size(part.get(side)) / 512) for side in ("width", "height"))
        self._attach("image", part, 85 + 170 * across * down)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, 25 * math.ceil(_size(part.get("seconds"))))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, 1500 * math.ceil(_size(part.get("pages"))))


def format_turn(role: str, parts: list[dict]) -> tuple[str, list, list, int]:
    """Formatted turn, loss spans (start and length in code points), attachments, media tokens."""
    visitor = PartVisitor()
    for part in parts:
        visitor.visit(part)
    head = f"{TURN}{escape(role)}{BODY}"
    spans = [(len(head) + a, n) for a, n in visitor.texts] if role == "assistant" else []
    return f"{head}{''.join(visitor.pieces)}{END}", spans, visitor.attachments, sum(x[3] for x in visitor.attachments)


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each formatted turn, placeholders left out."""
    for role, body in _TURNS.findall(formatted):
        yield unescape(role), "".join(unescape(x) for x in _HOLDER.split(body))


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per row of ``turns`` (conv_id, turn, role, and ``text``, or ``parts`` as a JSON list of objects with
    ``type``, and ``text`` or ``ref`` and its size): formatted, loss_spans, attachments, media_tokens.

    Null text or parts count as empty, a null role as the empty role; parts that are no JSON list of objects, or nested
    too deep to be read, are taken as one text; for odd values in a part see :class:`PartVisitor`, ``_text`` and ``_size``.
    A text of any length is one row's work.  Rows are formatted one by one, so repeated rows, null ids
    and extra columns (ignored) need no care.  An empty table gives no rows.
    """
    content = F.col("parts") if "parts" in turns.columns else F.lit(None).cast("string")
    text = F.col("text") if "text" in turns.columns else F.lit(None).cast("string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [_formatted(role or "", text, parts) for role, text, parts in zip(batch.role, batch.text, batch.parts)]
            out = batch[["conv_id", "turn", "role"]].copy()
            out["formatted"] = [x[0] for x in done]
            out["loss_spans"] = [[{"start": a, "length": n} for a, n in x[1]] for x in done]
            out["attachments"] = [[dict(zip(("place", "kind", "ref", "tokens"), a)) for a in x[2]] for x in done]
            out["media_tokens"] = [x[3] for x in done]
            yield out

    ship_code(turns.sparkSession)
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", text.alias("text"), content.alias("parts"))
    return rows.mapInPandas(_nullable(run), SCHEMA)


def _nullable(run):
    """Integer columns with nulls arrive as floats; keep them whole."""

    def wrapped(batches):
        def whole():
            for batch in batches:
                for c in ("conv_id", "turn"):
                    batch[c] = batch[c].astype("Int64")
                yield batch.astype({"role": object}).where(batch.notna(), None)

        yield from run(whole())

    return wrapped


def _formatted(role: str, text: str | None, parts: str | None) -> tuple[str, list, list, int]:
    try:
        return format_turn(role, _parts(parts, text))
    except RecursionError:
        return format_turn(role, [{"type": "text", "text": parts}])


def _parts(parts: str | None, text: str | None) -> list[dict]:
    if parts is None:
        return [{"type": "text", "text": text}]
    try:
        found = json.loads(parts)
    except ValueError:
        found = None
    if isinstance(found, list) and all(isinstance(x, dict) for x in found):
        return found
    return [{"type": "text", "text": parts}]


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from its formatted turns: n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars.  Turns are taken by turn, then by formatted text; rows of a null conv_id form one conversation.

    The digest of a conversation is sequential, so its sorted turns pass through one task, as a stream.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None
        for batch in batches:
            done = []
            for conv, formatted, spans in zip(batch.conv_key, batch.formatted, batch.loss_spans):
                if state is None or conv != now:
                    if state is not None:
                        done.append(_closed(now, state))
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_turns(formatted):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                for span in spans:
                    text = unescape(formatted[span["start"]:span["start"] + span["length"]])
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(formatted)
            if done:
                yield pd.DataFrame(done, columns=_FIELDS).astype({"conv_id": "Int64"})
        if state is not None:
            yield pd.DataFrame([_closed(now, state)], columns=_FIELDS).astype({"conv_id": "Int64"})

    keyed = formatted.select(F.col("conv_id").cast("string").alias("conv_key"), "turn", "formatted", "loss_spans").withColumn("conv_key", F.coalesce("conv_key", F.lit("")))
    return keyed.repartition("conv_key").sortWithinPartitions("conv_key", "turn", "formatted").drop("turn").mapInPandas(run, DIGESTS)


_FIELDS = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def _closed(key: str, state: list) -> tuple:
    return int(key) if key else None, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]
