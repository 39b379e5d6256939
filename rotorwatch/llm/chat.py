"""Chat formatting by compiled templates (operator 1)."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rotorwatch.llm.common import tidy
from rotorwatch.llm.templates import CLOSE, OPEN, compile_template

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
TEMPLATE = (
    "{% for message in messages %}<s>[INST]{{ message.role | escape }}[/INST]"
    "{% if message.role == 'assistant' %}{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}</s>\n{% endfor %}"
)
PIECE_CHARS = 1 << 18  # a long conversation comes in pieces of about this size
_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>\n", re.S)


def escaper(controls: tuple[str, ...] = CONTROLS) -> tuple[Callable[[str], str], Callable[[str], str]]:
    """(escape, unescape): a control string, with any number of backslashes after its first character, gets one more, and loses
    it again.  Escaped text holds no control string.  First characters must not occur again in control strings."""
    firsts = {c[0] for c in controls}
    if any(len(c) < 2 or firsts & set(c[1:]) or "\\" in c for c in controls):
        raise ValueError(f"unsuitable control strings {controls}")
    any_of = "|".join(f"(?<={re.escape(c[0])})(\\\\*)(?={re.escape(c[1:])})" for c in controls)
    put = re.compile(any_of)
    drop = re.compile(any_of.replace("(\\\\*)", "\\\\(\\\\*)"))
    kept = lambda m: next(g for g in m.groups() if g is not None)
    return lambda t: put.sub(lambda m: "\\" + kept(m), t), lambda t: drop.sub(kept, t)


def _by_key(batches: Iterator[pa.RecordBatch], n_keys: int = 1) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows of consecutive equal first columns, streamed; what a consumer leaves is skipped."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    row = next(rows, None)
    while row is not None:
        key = row[:n_keys]

        def group() -> Iterator[tuple]:
            nonlocal row
            while row is not None and row[:n_keys] == key:
                now, row = row, next(rows, None)
                yield now

        own = group()
        yield key, own
        for _ in own:
            pass


def format_chats(turns: DataFrame, template: str = TEMPLATE, controls: tuple[str, ...] = CONTROLS, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, piece, begin, text, loss): formatted conversations; ``loss`` holds the spans of generations.

    ``turns`` has a row per turn; they are ordered by turn, nulls first, then role and text, so ties and repeated rows have a fixed place and all stay.  Null
    roles and texts are empty; null conversation ids are one conversation; an empty table gives no rows; other columns of ``turns`` are not read.  A piece is as much as
    :data:`PIECE_CHARS` characters or one more turn; ``begin`` and the spans count code points of the whole conversation.
    Conversations are partitioned by id and streamed through a template in order, so a task holds a piece at a time
    however long a conversation is.
    """
    compile_template(template, {"escape": str})  # a bad template fails here

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        escape, _ = escaper(controls)
        render = compile_template(template, {"escape": lambda v: escape(v or "")})
        out: list[tuple] = []
        held = 0
        for (key,), rows in _by_key(batches):
            messages = ({"role": r[1] or "", "text": r[2] or ""} for r in rows)
            piece, begin, at, parts, spans, opened = 0, 0, 0, [], [], None
            for event in render({"messages": messages}):
                if event is OPEN:
                    opened = at
                elif event is CLOSE:
                    spans.append({"begin": opened, "end": at})
                    opened = None
                else:
                    parts.append(event)
                    at += len(event)
                if at - begin >= PIECE_CHARS and opened is None:
                    out.append((key, piece, begin, "".join(parts), spans))
                    held += at - begin
                    piece, begin, parts, spans = piece + 1, at, [], []
                    if held >= PIECE_CHARS:
                        yield batch(out)
                        out, held = [], 0
            if parts or spans or not piece:
                out.append((key, piece, begin, "".join(parts), spans))
                held += at - begin
            if held >= PIECE_CHARS or len(out) >= 1000:
                yield batch(out)
                out, held = [], 0
        if out:
            yield batch(out)

    kind = turns.schema[conv_id].dataType
    span = T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([T.StructField(conv_id, kind), T.StructField("piece", T.IntegerType()), T.StructField("begin", T.LongType()), T.StructField("text", T.StringType()), T.StructField("loss", T.ArrayType(span))])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)
    rows = turns.select(F.col(conv_id).alias("_conv"), F.col(turn).alias("_turn"), F.col(role).alias("_role"), F.col(text).alias("_text"))
    rows = rows.repartition("_conv").sortWithinPartitions("_conv", "_turn", "_role", "_text")
    return rows.select("_conv", "_role", "_text").mapInArrow(tidy(work), schema)


def read_chats(formatted: DataFrame, controls: tuple[str, ...] = CONTROLS, conv_id: str = "conv_id") -> DataFrame:
    """Digests read back from what :func:`format_chats` wrote with :data:`TEMPLATE`, in its order: turns are found by their marks,
    texts are unescaped, and the loss text is what lies under the spans."""
    kind = formatted.schema[conv_id].dataType

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, unescape = escaper(controls)
        out = []
        for (key,), rows in _by_key(batches):
            turns, loss, n, chars, loss_chars, rest = hashlib.sha256(), hashlib.sha256(), 0, 0, 0, ""
            for _, begin, text, spans in rows:
                for s in spans:
                    under = unescape(text[s["begin"] - begin: s["end"] - begin])
                    loss.update(under.encode())
                    loss_chars += len(under)
                chars += len(text)
                rest, done = rest + text, 0
                for m in _TURN.finditer(rest):
                    if m.start() != done:
                        raise ValueError(f"conversation {key}: no turn at {done}")
                    done = m.end()
                    turns.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
                    n += 1
                rest = rest[done:]
            if rest:
                raise ValueError(f"conversation {key}: an unfinished turn")
            out.append((key, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) if k else pa.array(c, arrow_kind) for k, c in enumerate(zip(*out, strict=True))], names=schema.names)

    schema = T.StructType([T.StructField(conv_id, kind), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])
    from pyspark.sql.pandas.types import to_arrow_type

    arrow_kind = to_arrow_type(kind)
    return formatted.select(conv_id, "begin", "text", "loss").mapInArrow(tidy(work), schema)
