r"""Chat formatting with a grammar round trip.

    conversation  =  turn*
    turn          =  "<|im_start|>" role "\n" text "<|im_end|>" "\n"

A turn ends at the first ``<|im_end|>`` after its role, and a role at its first line break, so
the grammar has one reading and the rendering of a conversation is that of its turns in a row.
Control strings inside a text carry backslashes after the ``<``: the reader takes one off each
``<\...\|im_start|>`` or ``<\...\|im_end|>`` that has any.

Every turn is rendered as it stands, read back by the grammar and compared with its source;
where they differ its conflicting strings are escaped and it is read again, until they are
identical.  This is done turn by turn where the rows lie.  Only then do rendered turns move to
their conversation, in order.  A task streams through them and never holds a conversation, so
one with very many turns needs no more memory than its longest turn.

Rows.  Turns are ordered by number, nulls first, then by role and text (ties and repeated rows
are all kept).  A null text or role counts as empty.  Rows with a null conversation id form one
conversation.  An empty table gives an empty result.  Only the four columns named are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import ship

START, END = "<|im_start|>", "<|im_end|>"
_CONTROL = re.compile(r"<(\\*)\|(im_start|im_end)\|>")
_ESCAPED = re.compile(r"<\\(\\*)\|(im_start|im_end)\|>")

SEGMENT = "segment string, text_at int, text_end int"


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\1\\|\2|>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|\2|>", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """Role, text and the place of the (escaped) text of every turn; raises on what is no conversation."""
    turns, at = [], 0
    while at < len(formatted):
        line, end = formatted.find("\n", at), formatted.find(END, at)
        if not formatted.startswith(START, at) or not -1 < line < end or formatted[end + len(END) : end + len(END) + 1] != "\n":
            raise ValueError(f"no turn at character {at}")
        role, text = formatted[at + len(START) : line], formatted[line + 1 : end]
        if START in role or START in text:
            raise ValueError(f"a turn within the turn at character {at}")
        turns.append((unescape_role(role), unescape(text), line + 1, end))
        at = end + len(END) + 1
    return turns


def _reads(segment: str, role: str, text: str) -> tuple[str, str, int, int] | None:
    try:
        turns = parse(segment)
    except ValueError:
        return None
    return turns[0] if len(turns) == 1 and turns[0][:2] == (role, text) else None


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """The rendered turn and the place of its text in it; reading it back gives the source."""
    for as_role, as_text in ((role, text), (role, escape(text)), (escape_role(role), escape(text))):
        segment = f"{START}{as_role}\n{as_text}{END}\n"
        if (read := _reads(segment, role, text)) is not None:
            return segment, read[2], read[3]
    raise ValueError(f"no rendering reads back: {role!r}")


def format_turns(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Every turn as its segment of the formatted conversation, with the place of its text in the segment."""

    ship(rows.sparkSession)

    def render(role: pd.Series, text: pd.Series) -> pd.DataFrame:
        done = [render_turn(r, t) for r, t in zip(role, text, strict=True)]
        return pd.DataFrame(done, columns=["segment", "text_at", "text_end"])

    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    udf = F.pandas_udf(render, SEGMENT).asNondeterministic()  # evaluated once
    plain = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), udf(role, text).alias("done"))
    return plain.select("conv_id", "turn", "role", "done.*")


def in_order(segments: DataFrame) -> DataFrame:
    """Conversations side by side, the turns of each in order."""
    return segments.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "segment")


DIGEST = "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(segments: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """What the formatted conversations say, read from their text alone: one row per conversation.

    The loss mask covers the text of the turns whose role is one of ``trained``.
    """
    names = [part.split()[0] for part in DIGEST.split(", ")]

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = (), None  # () is no conversation; None is one
        out: list[tuple] = []

        def close() -> None:
            if state is not None:
                out.append((now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        for batch in batches:
            for conv, segment in zip(batch["conv_id"], batch["segment"], strict=True):
                if conv != now:
                    close()
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text, _, _ in parse(segment):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    if role in trained:
                        state[2] += len(text)
                        state[3].update(text.encode())
                state[4] += len(segment)
            yield pd.DataFrame(out, columns=names)
            out.clear()
        close()
        yield pd.DataFrame(out, columns=names)

    kind = segments.schema["conv_id"].dataType
    # As text: pandas has no null among integers.
    rows = in_order(segments).select(F.col("conv_id").cast("string").alias("conv_id"), "segment")
    return rows.mapInPandas(digest, DIGEST).withColumn("conv_id", F.col("conv_id").cast(kind))


def format_conversations(segments: DataFrame) -> DataFrame:
    """``conv_id`` and ``formatted``: each conversation as one text, for conversations that fit a row."""
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "segment")))
    return segments.groupBy("conv_id").agg(F.array_join(F.transform(ordered, lambda t: t.segment), "").alias("formatted"))
