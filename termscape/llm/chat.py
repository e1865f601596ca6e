"""Chat formatting: typed content parts flattened into marked turns, with a loss mask.

A conversation is a set of turns, a turn a list of typed parts (text, image, audio, document). A
visitor renders each part: text is escaped, an attachment becomes a placeholder ``<image 0>`` whose
number is its place in the turn, and its reference and expanded token count are recorded. A turn is
rendered as ``<turn ROLE>BODY</turn>\\n``.

Escaping is reversible and leaves no control character in a text: ``\\`` becomes ``\\b``, ``<``
becomes ``\\l``, ``>`` becomes ``\\g``. So every ``<`` of the output is the template's.

Formatting needs no shuffle: a turn's segment depends on the turn alone, and the formatted
conversation is the concatenation of its segments by (turn, role, segment). Segments stay one row per
turn, so a conversation of any length is never held whole.

Defined cases: null text or null part is empty text; a null role is an empty role; null ``conv_id`` is
a conversation of its own; a null turn comes first; equal turns are ordered by role, then by text;
repeated rows are separate turns; unknown part kinds become placeholders of zero tokens; texts of any length are
formatted whole; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termscape.llm.common import bounded_batches

PART_TYPE = "struct<kind:string,text:string,ref:string,width:bigint,height:bigint,seconds:double,pages:bigint>"
TRAINED_ROLE = "assistant"
END_OF_TURN = "</turn>\n"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\b"))
    text = F.replace(text, F.lit("<"), F.lit("\\l"))
    return F.replace(text, F.lit(">"), F.lit("\\g"))


def unescape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\l"), F.lit("<"))
    text = F.replace(text, F.lit("\\g"), F.lit(">"))
    return F.replace(text, F.lit("\\b"), F.lit("\\"))


class PartVisitor:
    """Column expressions for one part; subclass to add kinds or change token counts."""

    def __init__(self, patch: int = 28, audio_tokens_per_second: float = 25.0, tokens_per_page: int = 600):
        self.patch = patch
        self.audio_tokens_per_second = audio_tokens_per_second
        self.tokens_per_page = tokens_per_page

    def is_text(self, part: Column) -> Column:
        return F.coalesce(part["kind"], F.lit("text")) == "text"

    def visit_image(self, part: Column) -> Column:
        across = F.ceil(F.coalesce(part["width"], F.lit(0)) / self.patch)
        down = F.ceil(F.coalesce(part["height"], F.lit(0)) / self.patch)
        return (across * down).cast("long")

    def visit_audio(self, part: Column) -> Column:
        return F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * self.audio_tokens_per_second).cast("long")

    def visit_document(self, part: Column) -> Column:
        return (F.coalesce(part["pages"], F.lit(0)) * self.tokens_per_page).cast("long")

    def tokens(self, part: Column) -> Column:
        kinds = {"image": self.visit_image, "audio": self.visit_audio, "document": self.visit_document}
        found = F.lit(0).cast("long")
        for kind, visit in kinds.items():
            found = F.when(part["kind"] == kind, visit(part)).otherwise(found)
        return found

    def render(self, part: Column, place: Column) -> Column:
        marker = F.concat(F.lit("<"), escape(part["kind"]), F.lit(" "), place.cast("string"), F.lit(">"))
        return F.when(self.is_text(part), escape(F.coalesce(part["text"], F.lit("")))).otherwise(marker)

    def attachment(self, part: Column, place: Column) -> Column:
        return F.struct(
            place.cast("int").alias("place"),
            part["kind"].alias("kind"),
            part["ref"].alias("ref"),
            self.tokens(part).alias("tokens"),
        )


def text_part(text: Column) -> Column:
    """A turn that holds nothing but one text."""
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "bigint"), ("height", "bigint"), ("seconds", "double"), ("pages", "bigint"))]
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), *nothing))


def format_turns(turns: DataFrame, visitor: PartVisitor | None = None, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """``(conv_id, turn, role, parts)`` to one rendered segment per turn.

    Returns conv_id, turn, segment, loss_start and loss_chars (code points of the segment that are
    trained on), attachments (place, kind, ref, tokens) and expanded_tokens.
    """
    visitor = visitor or PartVisitor()
    parts = F.coalesce(F.col("parts"), F.array().cast(f"array<{PART_TYPE}>"))
    parts = F.filter(parts, lambda part: part.isNotNull())
    role = F.coalesce(F.col("role"), F.lit(""))
    rendered = turns.select(
        "conv_id",
        "turn",
        (role == trained_role).alias("_trained"),
        F.concat(F.lit("<turn "), escape(role), F.lit(">")).alias("_open"),
        F.array_join(F.transform(parts, visitor.render), "").alias("_body"),
        F.filter(F.transform(parts, visitor.attachment), lambda a: F.coalesce(a["kind"], F.lit("text")) != "text").alias("attachments"),
    )
    return rendered.select(
        "conv_id",
        "turn",
        F.concat("_open", "_body", F.lit(END_OF_TURN)).alias("segment"),
        F.length("_open").alias("loss_start"),
        F.when(F.col("_trained"), F.length("_body")).otherwise(0).alias("loss_chars"),
        "attachments",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda total, a: total + a["tokens"]).alias("expanded_tokens"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse segments: conv_id, turn, role, text, trained (the text under the mask), segment_chars.

    Placeholders are kept as they stand; texts come back unescaped.
    """
    segment = F.col("segment")
    open_end = F.instr(segment, ">")
    body_chars = F.length(segment) - open_end - len(END_OF_TURN)
    body = F.substring(segment, open_end + 1, body_chars)
    return formatted.select(
        "conv_id",
        "turn",
        unescape(F.substring(segment, F.lit(len("<turn ") + 1), open_end - 1 - len("<turn "))).alias("role"),
        unescape(body).alias("text"),
        unescape(F.substring(segment, F.col("loss_start") + 1, F.col("loss_chars"))).alias("trained"),
        F.length(segment).cast("long").alias("segment_chars"),
    )


DIGEST_SCHEMA = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def _digest_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash rows sorted by conversation as they pass; holds one batch, whatever a conversation's length."""
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    done: list[tuple] = []
    current: list = []

    def finish() -> None:
        if current:
            conv, count, turns, chars, loss, total = current
            done.append((conv, count, turns.hexdigest(), chars, loss.hexdigest(), total))

    def flush() -> pa.RecordBatch:
        values = [list(c) for c in zip(*done, strict=True)] if done else [[] for _ in columns]
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names=columns)

    for batch in batches:
        rows = zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True)
        for conv, role, text, trained, chars in rows:
            if not current or current[0] != conv:
                finish()
                current[:] = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            current[1] += 1
            current[2].update(f"{role}\n{text}\n".encode())
            current[3] += len(trained)
            current[4].update(trained.encode())
            current[5] += chars
        if done:
            yield flush()
    finish()
    yield flush()


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation with digests of what ``read_back`` finds.

    Turns meet by conversation and are sorted there, a sort that can spill; a digest is a sequential
    function of its conversation, so one task streams over it, in constant memory.
    """
    bounded_batches(formatted.sparkSession)
    turns = read_back(formatted)
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text", "trained", "segment_chars").mapInArrow(_digest_stream, DIGEST_SCHEMA)
