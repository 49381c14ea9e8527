"""Chat formatting with a grammar round trip: what is written is parsed again until it gives the source back.

Grammar of a formatted conversation::

    conversation := turn*
    turn         := "[SYS] " text " [/SYS]"          role system
                  | "[INST] " text " [/INST]"        role user
                  | "[OUT] " text "</s>"             role assistant
                  | "[ROLE " name "] " text " [/ROLE]"   any other role; name is percent-encoded

No control string stands unescaped inside a text. Escaping puts a backslash behind the first character of a
control string (before any backslashes already there); unescaping takes one away.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKS = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("[OUT] ", "</s>")}
CONTROL = re.compile(r"\[/?(?:SYS|INST|OUT|ROLE)|</s>")
_ESCAPABLE = re.compile(r"([\[<])(\\*/?(?:SYS|INST|OUT|ROLE)|\\*/s>)")
_ESCAPED = re.compile(r"([\[<])\\(\\*/?(?:SYS|INST|OUT|ROLE)|\\*/s>)")
_OPEN = re.compile(r"\[(SYS|INST|OUT|ROLE)(?: ([^\] ]*))?\] ")
_ROLES = {"SYS": "system", "INST": "user", "OUT": "assistant"}


def escape(text: str) -> str:
    return _ESCAPABLE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


class GrammarError(ValueError):
    pass


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """Turns of a formatted conversation: role, text, and the span of its (escaped) text. One way to read, no backtracking."""
    turns, at = [], 0
    while at < len(formatted):
        opened = _OPEN.match(formatted, at)
        if not opened or (opened[1] == "ROLE") != (opened[2] is not None):
            raise GrammarError(f"no turn begins at {at}")
        role = _ROLES.get(opened[1])
        close = MARKS[role][1] if role else " [/ROLE]"
        role = unquote(opened[2]) if role is None else role
        start = opened.end()
        control = CONTROL.search(formatted, start)
        stop = control.start() - (len(close) - len(close.lstrip())) if control else -1
        if stop < start or not formatted.startswith(close, stop):
            raise GrammarError(f"the turn that begins at {at} is not closed by its own mark")
        turns.append((role, unescape(formatted[start:stop]), start, stop))
        at = stop + len(close)
    return turns


def render(role: str, text: str) -> tuple[str, int, int]:
    """One turn and the span of its text in it. Plain first; escaped if parsing does not give the turn back."""
    opening, close = MARKS.get(role) or (f"[ROLE {quote(role, safe='')}] ", " [/ROLE]")
    for body in (text, escape(text)):
        formatted, span = opening + body + close, (len(opening), len(opening) + len(body))
        try:
            if parse(formatted) == [(role, text, *span)]:
                return formatted, *span
        except GrammarError:
            pass
    raise GrammarError("the turn cannot be written")


def format_conversations(turns: DataFrame, path: str, part_chars: int = 1 << 20, conversation: str = "conv_id") -> DataFrame:
    """Write formatted conversations as Parquet to ``path`` and return that table.

    ``turns`` has a conversation key, turn, role and text. A conversation becomes one or more parts, cut between
    turns once ``part_chars`` are reached; its rows stream through one task in order, so memory stays bounded
    however long it is. Columns: the key, part, n_turns, formatted, loss_starts and loss_ends (spans of the
    assistant's texts in ``formatted``: the loss mask).

    Null texts and roles count as empty; rows without key form one conversation of their own. Equal turn numbers
    are ordered by role and text, null turns come first, repeated rows stay. Other columns are ignored.
    """
    kind = turns.schema[conversation].dataType.simpleString()
    schema = f"`{conversation}` {kind}, part bigint, n_turns bigint, formatted string, loss_starts array<bigint>, loss_ends array<bigint>"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_type = None
        key, part, n, chunk, size, starts, ends, done = None, 0, 0, [], 0, [], [], []

        def cut():
            nonlocal part, n, chunk, size, starts, ends
            if n:
                done.append((key, part, n, "".join(chunk), starts, ends))
            part, n, chunk, size, starts, ends = part + 1, 0, [], 0, [], []

        def out():
            kinds = [key_type, pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            columns = [pa.array(c, t) for c, t in zip(zip(*done), kinds)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, [conversation, "part", "n_turns", "formatted", "loss_starts", "loss_ends"])

        for batch in batches:
            key_type = batch.schema.types[0]
            for name, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if name != key:
                    cut()
                    key, part = name, 0
                formatted, start, stop = render(role, text)
                if role == "assistant":
                    starts.append(size + start)
                    ends.append(size + stop)
                chunk.append(formatted)
                size, n = size + len(formatted), n + 1
                if size >= part_chars:
                    cut()
            if len(done) >= 1000:
                yield out()
        cut()
        if done:
            yield out()

    text_of = lambda name: F.coalesce(F.col(name), F.lit("")).alias(name)
    rows = turns.select(conversation, "turn", text_of("role"), text_of("text"))
    rows.repartition(conversation).sortWithinPartitions(conversation, "turn", "role", "text").mapInArrow(write, schema).write.parquet(path)
    return turns.sparkSession.read.schema(schema).parquet(path)


def read_conversations(formatted: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """Parse formatted conversations; per conversation the counts and digests of its turns and of its loss text.

    turns_sha256 covers role, newline, text, newline of every turn; loss_sha256 the unescaped texts under the loss
    mask in order. Parts of a conversation stream through one task in order.
    """
    kind = formatted.schema[conversation].dataType.simpleString()
    schema = f"`{conversation}` {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, begun, done, key_type = None, False, [], None
        n = loss_chars = chars = 0
        turns_hash = loss_hash = None

        def cut():
            if begun:
                done.append((key, n, turns_hash.hexdigest(), loss_chars, loss_hash.hexdigest(), chars))

        def out():
            kinds = [key_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*done), kinds)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, [conversation, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            key_type = batch.schema.types[0]
            for name, part, text, starts, ends in zip(*(column.to_pylist() for column in batch.columns)):
                if not begun or part == 0:
                    cut()
                    key, begun, n, loss_chars, chars = name, True, 0, 0, 0
                    turns_hash, loss_hash = hashlib.sha256(), hashlib.sha256()
                for role, content, _, _ in parse(text):
                    turns_hash.update(f"{role}\n{content}\n".encode())
                    n += 1
                for start, stop in zip(starts, ends):
                    content = unescape(text[start:stop])
                    loss_hash.update(content.encode())
                    loss_chars += len(content)
                chars += len(text)
            if len(done) >= 1000:
                yield out()
        cut()
        if done:
            yield out()

    rows = formatted.select(conversation, "part", "formatted", "loss_starts", "loss_ends")
    return rows.repartition(conversation).sortWithinPartitions(conversation, "part").mapInArrow(read, schema)
