"""Conversations as training windows of a token budget, and the way back.

A turn is written as `<turn>role`, a line break, the text and `</turn>`. Inside role
and text a backslash is doubled and a marker gets a backslash before it (in a role a
line break becomes a backslash and n), so control strings in a text stay text and
every window can be read back.

Prefix sums of turn tokens cut a conversation into spans of whole turns. A window
holds the conversation's system turn, a limited history of turns that earlier
windows had already, and its own span. Only assistant texts of the span are under
the loss mask: the system turn and the history are repeated without loss, so every
target counts once.

A long conversation is cut into segments of a fixed number of turns, each of which
starts a new span with the last turns before it as history. Segments are dealt to
tasks on their own, so one conversation may hold most rows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.llm import bpe
from brightloom.llm.shared import partitions, stored
from brightloom.operators.ordering import composite_row_numbers

BUDGET = 1024
HISTORY_TOKENS = 256
HISTORY_TURNS = 4
SEGMENT_TURNS = 4096
OPEN, CLOSE = "<turn>", "</turn>"
SYSTEM, TARGET = "system", "assistant"

_TURN = re.compile(r"<turn>((?:[^\\<]++|\\.|<(?!/?turn>))*+)</turn>\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)
WINDOW_SCHEMA = (
    "conv_id {kind}, window long, repeated int, turns int, tokens long, text string, loss array<struct<start:int,stop:int>>"
)


def escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace(OPEN, "\\" + OPEN).replace(CLOSE, "\\" + CLOSE)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text) if "\\" in text else text


def head_of(role: str) -> str:
    one_line = escaped(role).replace("\n", "\\n")
    return f"{OPEN}{one_line}\n"


def format_turn(role: str, text: str) -> str:
    return f"{head_of(role)}{escaped(text)}{CLOSE}\n"


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted window."""
    found = []
    for turn in _TURN.findall(formatted):
        role, text = turn.split("\n", 1)
        found.append((_ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], role), unescaped(text)))
    return found


class _Segment:
    """Windows of one segment of a conversation, turn by turn."""

    def __init__(self, budget: int, history_tokens: int, history_turns: int):
        self.budget, self.history_tokens, self.history_turns = budget, history_tokens, history_turns
        self.system: tuple | None = None
        self.held: list[tuple] = []  # history, then the open span
        self.sums = [0]  # prefix sums of their tokens
        self.start = 0  # where the span starts
        self.first = 0  # where the window's history starts
        self.system_is_new = False

    def _base(self) -> int:
        return self.system[1] if self.system else 0

    def add_system(self, turn: tuple, new: bool) -> None:
        self.system, self.system_is_new = turn, new

    def add_history(self, turn: tuple) -> None:
        self.held.append(turn)
        self.sums.append(self.sums[-1] + turn[1])
        self.start = self.first = len(self.held)

    def add(self, turn: tuple) -> list | None:
        """Take the next turn of the span; gives the window before it where the budget is full."""
        done = None
        opened = len(self.held) > self.start
        if opened and self._base() + self.sums[-1] - self.sums[self.first] + turn[1] > self.budget:
            done, opened = self.close(), False
        if not opened:
            self._open(turn[1])
        self.held.append(turn)
        self.sums.append(self.sums[-1] + turn[1])
        return done

    def _open(self, tokens: int) -> None:
        """The earliest history turn with which history and new turn still fit, by the prefix sums."""
        room = min(self.history_tokens, self.budget - self._base() - tokens)
        least = max(0, len(self.held) - self.history_turns)
        self.first = max(least, bisect_left(self.sums, self.sums[-1] - room)) if room > 0 else len(self.held)
        self.start = len(self.held)

    def close(self) -> list | None:
        """The window of the open span: (turns, how many are repeated)."""
        span = self.held[self.start :]
        if not span and not self.system_is_new:
            return None
        front = [self.system] if self.system else []
        repeated = self.start - self.first + (0 if self.system_is_new else len(front))
        window = [[*front, *self.held[self.first :]], repeated]
        self.system_is_new = False
        kept = self.held[-self.history_turns :] if self.history_turns else []
        self.held, self.sums = kept, [0]
        for turn in kept:
            self.sums.append(self.sums[-1] + turn[1])
        self.start = self.first = len(kept)
        return window


def windows(
    turns: DataFrame, ranks_path: str, pattern: str, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", budget: int = BUDGET, history_tokens: int = HISTORY_TOKENS, history_turns: int = HISTORY_TURNS,
    segment_turns: int = SEGMENT_TURNS, remembered: int = 100_000,
) -> DataFrame:
    """(conv_id, window, repeated, turns, tokens, text, loss): the training windows, a written table.

    `repeated` turns at the front are repeats; `loss` has code point spans of the
    formatted text. Tokens are those of the byte BPE in `ranks_path` over the
    formatted turn. A window stays within `budget` tokens unless the system turn
    and one turn alone are longer: texts are never cut. Turns go by `turn` (null
    first); ties by role, then by a hash of the text, and repeated rows stay turns
    of their own. Null texts and roles are empty; rows without a conv_id are one
    conversation. Only a first turn of role `system` is retained. An empty table
    gives no windows; other columns are not read.
    """
    kind = turns.schema[conv_id].dataType.simpleString()

    def format_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.text_encoder(ranks_path, pattern, remembered)
        for batch in batches:
            roles = batch.column("role").to_pylist()
            pieces = list(map(format_turn, roles, batch.column("text").to_pylist()))
            leads = [len(head_of(who)) for who in roles]
            tokens = list(map(len, encoder.encode_many(pieces)))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("row", "conv_id", "turn", "role", "hash")],
                 pa.array(pieces, pa.string()), pa.array(leads, pa.int32()), pa.array(tokens, pa.int64())],
                names=["row", "conv_id", "turn", "role", "hash", "piece", "lead", "tokens"],
            )

    said = F.coalesce(F.col(text), F.lit(""))
    rows = turns.select(
        F.monotonically_increasing_id().alias("row"), F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.xxhash64(said).alias("hash"), said.alias("text"),
    )
    order_kind = turns.schema[turn].dataType.simpleString()
    formatted = stored(
        rows.mapInArrow(
            format_rows,
            f"row long, conv_id {kind}, turn {order_kind}, role string, hash long, piece string, lead int, tokens long",
        ),
        "turns",
    )
    numbered = composite_row_numbers(
        formatted.select("conv_id", "turn", "role", "hash", "row"),
        [F.asc_nulls_first("turn"), "role", "hash", "row"], ["conv_id"], "n", total="total",
    )
    place = F.col("n") - 1
    segment = F.floor(place / segment_turns).cast("long")
    last = F.floor((F.col("total") - 1) / segment_turns).cast("long")
    leads_on = (place % segment_turns >= segment_turns - history_turns) & (segment < last)
    # The system turn goes to every segment, the last turns of a segment also to the next one.
    is_system = (place == 0) & (F.col("role") == SYSTEM)
    copied = numbered.select(
        "row", place.alias("place"), is_system.alias("system"), segment.alias("home"),
        F.explode(
            F.when(is_system, F.sequence(F.lit(0).cast("long"), last))
            .when(leads_on, F.array(segment, segment + 1))
            .otherwise(F.array(segment))
        ).alias("segment"),
    )
    n = partitions(turns.sparkSession)
    dealt = (
        copied.join(formatted.select("row", "conv_id", "role", "piece", "lead", "tokens"), "row")
        .select(
            "conv_id", "segment", "place", "system", (F.col("home") == F.col("segment")).alias("own"), "piece", "lead",
            "tokens", (F.col("role") == TARGET).alias("target"),
        )
        .repartition(n, "conv_id", "segment").sortWithinPartitions("conv_id", "segment", "place")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, count, out = None, None, 0, []

        def emit(window: list | None) -> None:
            nonlocal count
            if window is None:
                return
            members, repeated = window
            loss, at = [], 0
            for i, (piece, _, lead, target) in enumerate(members):
                if target and i >= repeated:
                    loss.append({"start": at + lead, "stop": at + len(piece) - len(CLOSE) - 1})
                at += len(piece)
            out.append((key[0], (key[1] << 32) + count, repeated, len(members), sum(m[1] for m in members),
                        "".join(m[0] for m in members), loss))
            count += 1

        def drained() -> pa.RecordBatch:
            loss = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
            types = [id_type, pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string(), loss]
            columns = list(zip(*out)) or [()] * len(types)
            names = ["conv_id", "window", "repeated", "turns", "tokens", "text", "loss"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        id_type = None
        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for conv, segment, place, system, own, piece, lead, tokens, target in zip(*columns):
                if key != (conv, segment) or held is None:
                    if held is not None:
                        emit(held.close())
                    key, held, count = (conv, segment), _Segment(budget, history_tokens, history_turns), 0
                member = (piece, tokens, lead, target)
                if system:
                    held.add_system(member, own)
                elif own:
                    emit(held.add(member))
                else:
                    held.add_history(member)
            if out:
                yield drained()
                out.clear()
        if held is not None:
            emit(held.close())
            if out:
                yield drained()

    return stored(dealt.mapInArrow(cut, WINDOW_SCHEMA.format(kind=kind)), "windows")


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation what its windows hold: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_windows.

    Windows are parsed where they are read. A digest of a whole conversation needs
    its bytes one after the other, so these, and nothing else, stream through one
    task per conversation in the order of the windows; nothing is gathered.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, said, lost, sizes = [], [], [], []
            for text, repeated, loss in zip(*[batch.column(c).to_pylist() for c in ("text", "repeated", "loss")]):
                own = read_turns(text)[repeated:]
                counts.append(len(own))
                said.append("".join(f"{role}\n{words}\n" for role, words in own))
                lost.append("".join(unescaped(text[s["start"] : s["stop"]]) for s in loss))
                sizes.append(len(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("window"), pa.array(counts, pa.int64()), pa.array(said, pa.string()),
                 pa.array(lost, pa.string()), pa.array(sizes, pa.int64())],
                names=["conv_id", "window", "n", "said", "lost", "size"],
            )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"]
        key, state, out, id_type = None, None, [], None

        def finish() -> None:
            if state is not None:
                out.append((key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5]))

        def drained() -> pa.RecordBatch:
            types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for conv, _, n, said, lost, size in zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns)]):
                if state is None or conv != key:
                    finish()
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                state[0] += n
                state[1].update(said.encode())
                state[2] += len(lost)
                state[3].update(lost.encode())
                state[4] += size
                state[5] += 1
            if out:
                yield drained()
                out.clear()
        finish()
        if out:
            yield drained()

    parsed = formatted.select("conv_id", "window", "repeated", "text", "loss").mapInArrow(
        parse, f"conv_id {kind}, window long, n long, said string, lost string, size long"
    )
    n = partitions(formatted.sparkSession)
    return parsed.repartition(n, "conv_id").sortWithinPartitions("conv_id", "window").mapInArrow(
        digest,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long",
    )
