r"""Chat formatting: a finite-state machine over roles and a declarative template with loss flags.

Each turn becomes three segments (opener, body, closer), one row each, so a
conversation of any length streams through a task; only a segment's ``loss``
flag says whether it is learned. Control strings of the template inside a
body are escaped: the backslashes before one are doubled and one more is put,
so an odd run marks an ordinary string and reading back restores the text.

Defined results: null text is empty, null role is the empty role, a role that
the template does not name gets the general marker with its (escaped) name.
Turns are ordered by turn, then role, then text (nulls first); repeated rows
are repeated turns; rows of a null conv_id form one conversation. The machine
never drops a turn: a turn that breaks the order makes ``valid`` false.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm.common import shuffle_parts, ship, table

ship(__name__)


@dataclass(frozen=True)
class Turn:
    opener: str
    closer: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Markers by role, the machine's transitions, the states a conversation may end in, and the control strings."""

    roles: dict[str, Turn]
    other: Turn
    other_name: tuple[str, str]
    moves: dict[str, tuple[str, ...]]
    final: tuple[str, ...]
    controls: tuple[str, ...] = field(default=())

    def __post_init__(self) -> None:
        for turn in (*self.roles.values(), self.other):
            if not (turn.opener[-1:].isspace() and turn.closer[:1].isspace()):
                raise ValueError("an opener must end, and a closer begin, with white space")

    def pattern(self) -> re.Pattern:
        return re.compile(r"(\\*)(" + "|".join(map(re.escape, sorted(self.controls, key=len, reverse=True))) + ")")


TEMPLATE = Template(
    roles={"system": Turn("<s><<SYS>> ", " <</SYS>></s>"), "user": Turn("<s>[INST] ", " [/INST]"),
           "assistant": Turn("[ANS] ", " [/ANS]</s>", loss=True)},
    other=Turn(" ", " [/TURN]</s>"), other_name=("<s>[TURN] ", " [/ROLE]"),
    moves={"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    final=("assistant",),
    controls=("<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "[ANS]", "[/ANS]", "[TURN]", "[/ROLE]", "[/TURN]"))

SEGMENTS = "conv_id long, segment long, text string, loss boolean, turn_end boolean, valid boolean, conv_end boolean"


def escape(text: str, controls: re.Pattern) -> str:
    return controls.sub(lambda m: m[1] * 2 + "\\" + m[2], text)


def unescape(text: str, controls: re.Pattern) -> str:
    return controls.sub(lambda m: m[1][:len(m[1]) // 2] + m[2], text)


def turn_segments(template: Template, controls: re.Pattern, role: str, text: str) -> list[tuple[str, bool]]:
    turn = template.roles.get(role)
    if turn is not None:
        return [(turn.opener, False), (escape(text, controls), turn.loss), (turn.closer, False)]
    before, after = template.other_name
    opener = before + escape(role, controls) + after + template.other.opener
    return [(opener, False), (escape(text, controls), template.other.loss), (template.other.closer, False)]


def format_conversations(conversations: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Segments of every conversation in order; each partition holds whole conversations, sorted."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    rows = rows.repartition(shuffle_parts(conversations.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        controls = template.pattern()
        state, valid, number, open_conv, waiting = "", True, 0, None, []
        out: list[tuple] = []

        def close() -> None:
            """The held last segment of a conversation, now known to be its last."""
            conv, seg, text, loss, turn_end, _, _ = waiting.pop()
            out.append((conv, seg, text, loss, turn_end, valid and state in template.final, True))

        for batch in batches:
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                role, text = role or "", text or ""
                if waiting and open_conv != conv:
                    close()
                if waiting:
                    out.append(waiting.pop())
                elif open_conv != conv or number == 0 or not waiting:
                    state, valid, number, open_conv = "", True, 0, conv
                valid = valid and role in template.moves.get(state, ())
                state = role
                parts = turn_segments(template, controls, role, text)
                for i, (piece, loss) in enumerate(parts):
                    row = (conv, number, piece, loss, i == len(parts) - 1, valid, False)
                    number += 1
                    (waiting if i == len(parts) - 1 else out).append(row)
            yield from rows_batch(out)
            out.clear()
        if waiting:
            close()
        yield from rows_batch(out)

    return rows.mapInArrow(segments, SEGMENTS)


def rows_batch(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    types = (pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_(), pa.bool_(), pa.bool_())
    names = [c.split()[0] for c in SEGMENTS.split(", ")]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def read_turn(template: Template, controls: re.Pattern, raw: str) -> tuple[str, int, int]:
    """Role, and where the body begins and ends, of the turn at the start of formatted text."""
    def real(at: int) -> re.Match:
        while (m := controls.search(raw, at)) is not None:
            if len(m[1]) % 2 == 0:
                return m
            at = m.end()
        raise ValueError("formatted text ends inside a turn")

    before, after = template.other_name
    for role, turn in template.roles.items():
        if raw.startswith(turn.opener):
            begin, closer = len(turn.opener), turn.closer
            break
    else:
        if not raw.startswith(before):
            raise ValueError("formatted text does not begin with a turn")
        mark = real(len(before)).start() - (len(after) - len(after.lstrip()))
        role = unescape(raw[len(before):mark], controls)
        begin, closer = mark + len(after) + len(template.other.opener), template.other.closer
    end = real(begin).start() - (len(closer) - len(closer.lstrip()))
    if not raw.startswith(closer, end):
        raise ValueError("a turn is closed by another role's marker")
    return role, begin, end


def read_back(segments: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """One row per conversation, from the formatted text and its loss flags alone."""
    schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long, valid boolean")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        controls = template.pattern()
        fresh = lambda: {"n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0}
        at, raw, learned = fresh(), [], []
        for batch in batches:
            out: list[tuple] = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "text", "loss", "turn_end", "valid", "conv_end"))
            for conv, text, loss, turn_end, valid, conv_end in zip(*columns, strict=True):
                raw.append(text)
                at["chars"] += len(text)
                if loss:
                    learned.append(unescape(text, controls))
                if turn_end:
                    whole = "".join(raw)
                    role, begin, end = read_turn(template, controls, whole)
                    body = unescape(whole[begin:end], controls)
                    at["turns"].update(f"{role}\n{body}\n".encode())
                    at["n"] += 1
                    for piece in learned:
                        at["loss"].update(piece.encode())
                        at["loss_chars"] += len(piece)
                    raw.clear()
                    learned.clear()
                if conv_end:
                    out.append((conv, at["n"], at["turns"].hexdigest(), at["loss_chars"], at["loss"].hexdigest(), at["chars"], valid))
                    at = fresh()
            if out:
                types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                                                 names=[c.split()[0] for c in schema.split(", ")])

    return segments.mapInArrow(read, schema)


#: The registered query formats this conversation too.
EXTRA = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(EXTRA, "conv_id long, turn long, role string, text string")
    return read_back(format_conversations(given.unionByName(extra)))
