r"""Chat formatting by a grammar round trip.

The grammar of a rendered conversation is

    conversation = { turn }
    turn         = "<|turn|>" role "<|says|>" text "<|over|>" newline

where neither role nor text may hold a control string. A turn is rendered as it
is, parsed again by the deterministic parser and compared to its source; where
the two differ (the text holds a control string, or something that reads as an
escape), its content is escaped one level further until they are identical.
Escaping puts one backslash into every ``<`` ``\``... ``|`` (``<|`` becomes ``<\|``,
``<\|`` becomes ``<\\|``); reading takes one out. It is a bijection, so one level
always suffices, and nothing is lost for any text.

A conversation may be longer than a worker's memory: it is stored as numbered
parts of bounded size, cut anywhere, and the parser reads parts as a stream.

Rows: a null text counts as empty and a null role as the empty role; rows are
ordered by turn, then role, then text (nulls first), and repeated rows stay;
rows of a null conv_id form one conversation; extra columns are ignored; an empty
table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_arrow

TURN, SAYS, OVER = "<|turn|>", "<|says|>", "<|over|>\n"
#: Roles whose text is learned.
LEARNED = ("assistant",)
#: Code points of one stored part of a conversation.
PART_CHARS = 1 << 20

_RAW, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_CONTROL = re.compile(r"<\|turn\|>|<\|says\|>|<\|over\|>\n")


def escape(text: str) -> str:
    return _RAW.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


class Parser:
    """Reads a conversation piece by piece; ``feed`` yields its completed turns.

    Only the turn being read is held. Anything outside the grammar raises.
    """

    def __init__(self):
        self.held: list[str] = []
        self.tail = ""              # the end of what came, where a control string may have begun
        self.state = 0              # 0: before a turn, 1: in a role, 2: in a text
        self.role = ""

    def feed(self, piece: str) -> Iterator[tuple[str, str]]:
        data, at = self.tail + piece, 0
        for m in _CONTROL.finditer(data):
            part, at = data[at:m.start()], m.end()
            want = (TURN, SAYS, OVER)[self.state]
            if m[0] != want or (self.state == 0 and (part or self.held)):
                raise ValueError(f"expected {want!r}")
            body = "".join(self.held) + part
            self.held = []
            if self.state == 1:
                self.role = unescape(body)
            elif self.state == 2:
                yield self.role, unescape(body)
            self.state = (self.state + 1) % 3
        rest = data[at:]
        cut = rest.rfind("<", max(0, len(rest) - len(OVER) + 1))
        cut = len(rest) if cut < 0 else cut
        if cut:
            self.held.append(rest[:cut])
        self.tail = rest[cut:]

    def close(self) -> None:
        if self.state or self.tail or self.held:
            raise ValueError("the conversation ends inside a turn")


def parse(text: str) -> list[tuple[str, str]]:
    """All turns of a whole rendered conversation."""
    parser = Parser()
    turns = list(parser.feed(text))
    parser.close()
    return turns


def render(role: str, text: str) -> str:
    """One turn, escaped as far as its round trip needs."""
    said = (role, text)
    for _ in range(2):
        out = f"{TURN}{said[0]}{SAYS}{said[1]}{OVER}"
        try:
            if parse(out) == [(role, text)]:
                return out
        except ValueError:
            pass
        said = (escape(said[0]), escape(said[1]))
    raise AssertionError("escaping is a bijection; this can't be reached")


def rendered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and the rendered turn, row by row, without a shuffle."""
    bound_arrow(conversations.sparkSession)
    rows = conversations.select("conv_id", "turn", "role", "text")
    schema = rows.withColumn("rendered", F.lit("")).schema

    def run(batches):
        for b in batches:
            out = [render(r or "", t or "") for r, t in zip(b.column("role").to_pylist(), b.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], names=[*b.schema.names, "rendered"])

    return rows.mapInArrow(run, schema)


def format_conversations(conversations: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """(conv_id, part, formatted): each conversation's text, in parts of at most ``part_chars`` code points.

    Turns are rendered where they lie; the shuffle brings a conversation's
    turns together in order, and they stream through the task, so that a very long
    conversation needs no more memory than one part and one turn.
    """
    turns = (rendered_turns(conversations).repartition("conv_id")
             .sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "rendered"))
    schema = turns.select("conv_id", F.lit(0).cast("long").alias("part"), F.lit("").alias("formatted")).schema
    kind = conversations.schema["conv_id"].dataType

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        def rows(out):
            return pa.table({"conv_id": pa.array([x[0] for x in out], to_arrow_type(kind)),
                             "part": pa.array([x[1] for x in out], pa.int64()),
                             "formatted": pa.array([x[2] for x in out], pa.string())}).to_batches()

        conv, part, held, size, out, ready, begun = None, 0, [], 0, [], 0, False
        for b in batches:
            for c, text in zip(b.column("conv_id").to_pylist(), b.column("rendered").to_pylist()):
                if begun and c != conv:
                    out.append((conv, part, "".join(held)))
                    part, held, size = 0, [], 0
                conv, begun = c, True
                held.append(text)
                size += len(text)
                ready += len(text)
                while size > part_chars:
                    whole = "".join(held)
                    out.append((conv, part, whole[:part_chars]))
                    part, held, size = part + 1, [whole[part_chars:]], size - part_chars
                if ready > 4 * part_chars:
                    yield from rows(out)
                    out, ready = [], 0
        if begun:
            out.append((conv, part, "".join(held)))
        yield from rows(out)

    return turns.mapInArrow(run, schema)


def read_back(formatted: DataFrame, learned: tuple[str, ...] = LEARNED) -> DataFrame:
    """Parse stored conversations and return what was recovered, as counts and digests, one row a conversation.

    conv_id, n_turns, turns_sha256 (role, newline, text, newline a turn),
    loss_chars and loss_sha256 (text under the loss mask: of the ``learned``
    roles), formatted_chars. A stream over sorted parts, so that the digest of a
    conversation of any length needs one turn at a time.
    """
    parts = formatted.select("conv_id", "part", "formatted")
    schema = parts.select("conv_id", F.lit(0).cast("long").alias("n_turns"), F.lit("").alias("turns_sha256"),
                          F.lit(0).cast("long").alias("loss_chars"), F.lit("").alias("loss_sha256"),
                          F.lit(0).cast("long").alias("formatted_chars")).schema
    kind = formatted.schema["conv_id"].dataType

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        class Read:
            def __init__(self, conv):
                self.conv, self.parser, self.turns, self.loss = conv, Parser(), hashlib.sha256(), hashlib.sha256()
                self.n = self.loss_chars = self.chars = 0

            def feed(self, piece):
                self.chars += len(piece)
                for role, text in self.parser.feed(piece):
                    self.n += 1
                    self.turns.update(f"{role}\n{text}\n".encode())
                    if role in learned:
                        self.loss_chars += len(text)
                        self.loss.update(text.encode())

            def row(self):
                self.parser.close()
                return self.conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars

        def rows(out):
            cols = list(zip(*out)) or [[]] * 6
            kinds = [to_arrow_type(kind), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.table({n: pa.array(list(c), k) for n, c, k in zip(schema.names, cols, kinds)}).to_batches()

        now, out = None, []
        for b in batches:
            for c, part, piece in zip(*[b.column(i).to_pylist() for i in range(3)]):
                if now is None or c != now.conv or part == 0:
                    if now is not None:
                        out.append(now.row())
                    now = Read(c)
                now.feed(piece)
                if len(out) >= 5000:
                    yield from rows(out)
                    out = []
        if now is not None:
            out.append(now.row())
        yield from rows(out)

    return parts.mapInArrow(run, schema)


def read_back_stored(formatted: DataFrame, learned: tuple[str, ...] = LEARNED) -> DataFrame:
    """``read_back`` of a table read from storage: brings the parts of a conversation together first."""
    return read_back(formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part"), learned)
