r"""Chat formatting that proves itself by parsing its own output.

Grammar of a rendered turn: ``### Role: text</turn>`` and a newline. A control
string (``### `` or ``</turn>``) in a text is data if an odd number of
backslashes stands before it; the parser takes one off and halves the rest. A
turn is first rendered as it is and parsed again. If the parser does not get
back exactly that turn, the control strings in it, and backslashes at its end,
are escaped, and the round trip is made once more. Texts without conflicts are
thus left byte by byte as they are.

Roles are capitalised if they are one of the usual ones; any other is percent
encoded after ``=``, so that it holds no control string.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, COLON = "### ", "</turn>", ": "
USUAL = ("system", "user", "assistant", "tool")
CONTROL = re.compile(r"(\\*)(### |</turn>)")
TRAILING = re.compile(r"\\+\Z")
RENDERED = "conv_id bigint, position bigint, turn bigint, rendered string, loss_from bigint, loss_to bigint, escaped boolean"
BATCH_CHARS = 1 << 20


class GrammarError(ValueError):
    pass


def role_tag(role: str) -> str:
    return role.capitalize() if role in USUAL else "=" + quote(role, safe="", errors="surrogatepass")


def role_of(tag: str) -> str:
    if tag.startswith("="):
        return unquote(tag[1:], errors="surrogatepass")
    role = tag.lower()
    if role not in USUAL or role.capitalize() != tag:
        raise GrammarError(f"no such role: {tag}")
    return role


def escape(text: str) -> str:
    text = CONTROL.sub(lambda m: m[1] * 2 + "\\" + m[2], text)
    return TRAILING.sub(lambda m: m[0] * 2, text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The rendered turn, and where its text begins and ends in it."""
    head = OPEN + role_tag(role) + COLON
    return f"{head}{text}{CLOSE}\n", len(head), len(head) + len(text)


def parse(rendered: str) -> list[tuple[str, str, int, int]]:
    """(role, text, from, to) of the turns of a rendered text; from and to without escapes taken off."""
    turns, at = [], 0
    while at < len(rendered):
        if not rendered.startswith(OPEN, at):
            raise GrammarError(f"a turn must begin at {at}")
        begin = rendered.find(COLON, at)
        if begin < 0:
            raise GrammarError("a role without end")
        role = role_of(rendered[at + len(OPEN) : begin])
        begin += len(COLON)
        parts, plain = [], begin
        for m in CONTROL.finditer(rendered, begin):
            slashes = len(m[1])
            parts.append(rendered[plain : m.start()])
            parts.append("\\" * (slashes // 2))
            plain = m.end()
            if slashes % 2:
                parts.append(m[2])
            elif m[2] == CLOSE:
                break
            else:
                raise GrammarError(f"a turn begins inside another at {m.start()}")
        else:
            raise GrammarError("a turn without end")
        if not rendered.startswith("\n", plain):
            raise GrammarError(f"no newline after a turn at {plain}")
        turns.append((role, "".join(parts), begin, plain - len(CLOSE)))
        at = plain + 1
    return turns


def _returns(rendered: str, role: str, text: str) -> bool:
    try:
        turns = parse(rendered)
    except GrammarError:
        return False
    return len(turns) == 1 and turns[0][:2] == (role, text)


def format_turn(role: str, text: str) -> tuple[str, int, int, bool]:
    """render(), escaped if the plain form does not come back, and whether it was."""
    plain = render(role, text)
    if _returns(plain[0], role, text):
        return *plain, False
    safe = render(role, escape(text))
    if not _returns(safe[0], role, text):
        raise GrammarError(f"a turn of role {role!r} does not come back")
    return *safe, True


def _batches(rows: Iterator[tuple], schema: pa.Schema, text_at: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[text_at] or "") + 64
        if size >= BATCH_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


_RENDERED = pa.schema(
    [("conv_id", pa.int64()), ("position", pa.int64()), ("turn", pa.int64()), ("rendered", pa.string()), ("loss_from", pa.int64()), ("loss_to", pa.int64()), ("escaped", pa.bool_())]
)


def _formatter(learned: frozenset[str]):
    def format_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            conversation, position = object(), 0
            for batch in batches:
                for conv, turn, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                    position = position + 1 if conv == conversation else 0
                    conversation = conv
                    rendered, begin, end, escaped = format_turn(role, text)
                    loss = (begin, end) if role in learned else (None, None)
                    yield conv, position, turn, rendered, *loss, escaped

        yield from _batches(rows(), _RENDERED, 3)

    return format_


def formatted(
    turns: DataFrame, learned: tuple[str, ...] = ("assistant",), conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """A row per turn, in order within its conversation: conv_id, position, turn,
    rendered, loss_from, loss_to, escaped.

    A conversation's training text is its rendered turns joined in order. loss_from
    and loss_to are the characters of ``rendered`` that a model learns, null for
    roles that are not learned. Turns are ordered by turn, then role and text;
    null turns come first, repeated rows stay. A null text or role is empty. Rows
    whose conversation is null form one conversation. A conversation is streamed
    through its task in batches, so it may be longer than memory; a single turn is
    held whole. An empty table gives no rows; other columns are not read.
    """
    rows = turns.select(
        F.col(conv).cast("bigint").alias("conv_id"),
        F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(_formatter(frozenset(learned)), RENDERED)


DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, escaped_turns bigint"
)
_DIGESTS = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("escaped_turns", pa.int64())]
)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        conversation, state = None, None
        for batch in batches:
            columns = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "rendered", "loss_from", "loss_to", "escaped"))
            for conv, rendered, begin, end, escaped in zip(*columns):
                if state is None or conv != conversation:
                    if state is not None:
                        yield conversation, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), *state[4:]
                    conversation, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, text, first, last in parse(rendered):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                    if begin is not None and (first, last) == (begin, end):
                        state[2] += len(text)
                        state[3].update(text.encode("utf-8", "surrogatepass"))
                state[4] += len(rendered)
                state[5] += escaped
        if state is not None:
            yield conversation, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), *state[4:]

    yield from _batches(rows(), _DIGESTS, 2)


def read_back(rendered: DataFrame) -> DataFrame:
    """Per conversation, what parsing its rendered turns gives.

    rendered: as ``formatted`` returns it, in its partitions and order, where a
    conversation lies together. n_turns and turns_sha256 are of the recovered
    turns, loss_chars and loss_sha256 of the recovered text under the loss mask.
    """
    return rendered.mapInArrow(_digest, DIGESTS)
