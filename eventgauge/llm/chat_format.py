"""Chat formatting: a finite-state machine over roles, segments with loss flags, a template.

The template is data: for every role its opening and closing strings and whether its text
counts for the loss, the states a role may follow, and the control strings that texts must not
contain.  Formatting is done row by row (the state of a turn is the role before it, found by a
window); a conversation is never gathered.  Reading back streams the segments of a
conversation in order through one state machine with a few fields of state, because a digest
over a conversation has to be taken in order; memory does not grow with its length.

Escaping: the escape character is doubled and every control string inside a text has the
escape character put after its first character, so no control string survives in a text and
the change can be undone.

Defined results: a null text or role is the empty string; a role without its own entry in the
template uses the template's default entry; turns are ordered by (turn, role, text), null turns
first, so equal rows are kept as turns of their own; a conversation of wrong turn order is
formatted all the same and marked invalid; a null conv_id is a conversation of its own; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventgauge.llm.shared import stored


@dataclass(frozen=True)
class Part:
    """How the turns of a role are written."""

    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    parts: dict[str, Part]
    default: Part
    #: Which roles may follow a role; "" is the state before the first turn.
    follows: dict[str, tuple[str, ...]]
    #: Roles a conversation may end with.
    last: tuple[str, ...]
    escape: str = "\\"
    control: tuple[str, ...] = field(default=())

    def guarded(self) -> tuple[str, ...]:
        """All strings a text must not hold, the longest first."""
        parts = [*self.parts.values(), self.default]
        marks = {m.strip() for p in parts for m in (p.before, p.after)} | set(self.control)
        return tuple(sorted((m for m in marks if m), key=lambda m: (-len(m), m)))


#: The role stands in the opening mark, so what is written can be read back.
INSTRUCT = Template(
    parts={
        "system": Part("<<SYS>> ", " <</SYS>>"),
        "user": Part("[INST] ", " [/INST]"),
        "assistant": Part("<s> ", " </s>", loss=True),
        "tool": Part("[TOOL] ", " [/TOOL]"),
    },
    default=Part("[ROLE] ", " [/ROLE]"),
    follows={
        "": ("system", "user"),
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user", "tool"),
        "tool": ("assistant", "tool"),
    },
    last=("user", "assistant"),
)
#: Ends the role name inside a turn of the default part.
NAME_END = "\n"


class Writer:
    """Escapes texts and undoes it."""

    def __init__(self, template: Template):
        self.template = template
        e = re.escape(template.escape)
        # A mark is spoiled by the escape character after its first character.
        self.find = re.compile("|".join([e, *map(re.escape, template.guarded())]))
        self.undo = re.compile(f"{e}{e}|{e}")

    def escape(self, text: str) -> str:
        e = self.template.escape
        return self._repeated(text) if e in text or self.find.search(text) else text

    def _repeated(self, text: str) -> str:
        e = self.template.escape
        text = text.replace(e, e + e)
        marks = re.compile("|".join(map(re.escape, self.template.guarded())))
        while (m := marks.search(text)) is not None:
            # Marks may overlap; every pass spoils at least one and makes none.
            text = marks.sub(lambda m: m[0][0] + e + m[0][1:], text)
        return text

    def unescape(self, text: str) -> str:
        e = self.template.escape
        return self.undo.sub(lambda m: e if len(m[0]) == 2 * len(e) else "", text) if e in text else text


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text as they are used."""
    empty = F.lit("")
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), empty).alias("role"),
        F.coalesce(F.col("text").cast("string"), empty).alias("text"),
    )


def segments(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """conv_id, turn, role, part (0 opening, 1 text, 2 closing), segment, loss.

    The segments of a conversation, joined in order, are its formatted text.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = Writer(template)
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                piece = batch.slice(start, 2000)
                rows = []
                columns = (piece.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text"))
                for conv, turn, role, text in zip(*columns, strict=True):
                    part = template.parts.get(role)
                    opening = part.before if part else template.default.before + writer.escape(role) + NAME_END
                    part = part or template.default
                    whole = writer.escape(text)
                    for k, (segment, loss) in enumerate(
                        ((opening, False), (whole, part.loss), (part.after, False))
                    ):
                        rows.append((conv, turn, role, text, k, segment, loss))
                made = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(made, kinds, strict=True)],
                    ["conv_id", "turn", "role", "sort_text", "part", "segment", "loss"],
                )

    schema = "conv_id long, turn long, role string, sort_text string, part int, segment string, loss boolean"
    return turns(conversations).mapInArrow(work, schema)


def turn_order(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """conv_id, valid: whether the machine accepts the roles in their order.

    The machine's state after a turn is the turn's role, so each step needs one row before it.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = turns(conversations)
    steps = rows.select(
        "conv_id",
        "role",
        F.coalesce(F.lag("role").over(order), F.lit("")).alias("state"),
        F.lead("role").over(order).alias("next"),
    )
    allowed = F.lit(False)
    for state, roles in template.follows.items():
        allowed = allowed | ((F.col("state") == state) & F.col("role").isin(*roles))
    ends = F.col("next").isNotNull() | F.col("role").isin(*template.last)
    return steps.groupBy("conv_id").agg(F.every(allowed & ends).alias("valid"))


class Reader:
    """Reads one conversation back from its formatted text, given piece by piece.

    The state is the text that is not yet a whole turn, two digests and four counts.
    """

    def __init__(self, template: Template, writer: Writer):
        self.template, self.writer = template, writer
        self.pending = ""
        self.turn_digest, self.loss_digest = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0
        self.before = sorted(
            [(p.before, name, p) for name, p in template.parts.items()] + [(template.default.before, None, template.default)],
            key=lambda x: -len(x[0]),
        )

    def feed(self, piece: str) -> None:
        self.formatted_chars += len(piece)
        self.pending += piece

    def take(self) -> None:
        """Read the whole turns at the start of what is pending."""
        while self.pending:
            found = next((x for x in self.before if self.pending.startswith(x[0])), None)
            if found is None:
                raise ValueError(f"no opening mark at {self.pending[:40]!r}")
            opening, role, part = found
            # The marks themselves cannot stand in an escaped text, the blanks around them can.
            stop = self.pending.find(part.after.strip(), len(opening))
            if stop < 0:
                return
            stop -= len(part.after) - len(part.after.lstrip())
            body = self.pending[len(opening) : stop]
            if role is None:
                role, _, body = body.partition(NAME_END)
                role = self.writer.unescape(role)
            text = self.writer.unescape(body)
            self.turn_digest.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
            if part.loss:
                self.loss_digest.update(text.encode())
                self.loss_chars += len(text)
            self.pending = self.pending[stop + len(part.after) :]

    def row(self) -> tuple:
        if self.pending:
            raise ValueError(f"an unfinished turn: {self.pending[:40]!r}")
        return (
            self.n_turns, self.turn_digest.hexdigest(), self.loss_chars,
            self.loss_digest.hexdigest(), self.formatted_chars,
        )


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def read_back(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """What the formatted text of each conversation says, read segment by segment."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = Writer(template)
        reader, current, done = None, None, []

        def made() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = [x.split()[0] for x in DIGESTS.split(", ")]
            columns = list(zip(*done, strict=True)) or [()] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                piece = batch.slice(start, 2000)
                columns = (piece.column(c).to_pylist() for c in ("conv_id", "part", "segment"))
                for conv, part, segment in zip(*columns, strict=True):
                    if reader is None or conv != current:
                        if reader is not None:
                            done.append((current, *reader.row()))
                        reader, current = Reader(template, writer), conv
                    reader.feed(segment)
                    if part == 2:
                        reader.take()
                if len(done) > 2000:
                    yield made()
                    done.clear()
        if reader is not None:
            done.append((current, *reader.row()))
        yield made()

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "sort_text", "copy", "part")
    return ordered.select("conv_id", "part", "segment").mapInArrow(work, DIGESTS)


def formatted(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """The segments, with equal rows told apart by `copy`."""
    # Equal rows give equal segments; counting them keeps the three segments of each together.
    rows = segments(conversations, template)
    keys = ["conv_id", "turn", "role", "sort_text", "part", "segment", "loss"]
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).drop("n")


def format_conversations(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per conversation, read back from the stored output, with `valid`."""
    output = stored(formatted(conversations, template), "chat")
    read = read_back(output, template)
    order = turn_order(conversations, template).withColumnRenamed("conv_id", "_conv")
    joined = read.join(order, F.col("conv_id").eqNullSafe(F.col("_conv")))
    return joined.drop("_conv")
