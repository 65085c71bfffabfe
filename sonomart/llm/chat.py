"""Chat formatting by event-sourced reconstruction.

A conversation is a log of events ordered by sequence number. Folding the log gives its final messages:

* ``open``: a turn begins, with its role and the first piece of its text;
* ``delta``: more text for a turn, as it is streamed;
* ``edit``: the text of a turn is replaced; later deltas continue the new text;
* ``regenerate``: a turn is written anew and all turns after it are dropped.

Logs are partitioned by conversation and sorted by sequence in the shuffle, so a task reads each
conversation as a stream. Only the turns that a later event may still change are held: the log says by
``sealed`` that no later event touches an earlier turn, and sealed turns leave at once. Rendered text leaves
in parts of bounded size, so a conversation of any length passes through constant memory. Its digests are
defined over its whole text in order, hence one task per conversation is inherent; tasks read, they hold nothing.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``. A backslash, and the bar of every ``<|``, get a backslash
before them (a line feed in a role becomes ``\\n`` spelled out), so no text can forge a mark and unescaping restores it.
Loss counts on the text of assistant turns, given as spans of each part.

Defined results
---------------
* Null text and null role are empty. A null conversation id is a conversation of its own. Null sequence
  numbers come first. Equal sequence numbers are ordered by event kind, role and text.
* Events without a turn number belong to one turn that stands before all others.
* Events for turns that were never opened open them. An empty log gives an empty result; repeated events are
  applied again.
* Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"
DELTA_CHARS = 1024
PART_CHARS = 1 << 20
# Stands for a null turn, before all others.
FIRST_TURN = -(1 << 63)

PARTS = "conv_id string, part long, text string, loss array<struct<start:int,end:int>>"
DIGESTS = ("conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + r"\n", re.S)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m.group(1) == "n" else m.group(1), text) if "\\" in text else text


def render(role: str, text: str) -> tuple[str, int, int]:
    """The marked turn and the span of its escaped text."""
    head = START + escape(role).replace("\n", "\\n") + "\n"
    body = escape(text)
    return head + body + END + "\n", len(head), len(head) + len(body)


class Conversation:
    """Folds events of one conversation; yields turns that can no longer change."""

    def __init__(self):
        self.turns: dict[int, tuple[str, list[str]]] = {}
        self.last = None

    def apply(self, kind: str, turn: int, role: str, text: str) -> None:
        if kind == "regenerate":
            for later in [t for t in self.turns if t > turn]:
                del self.turns[later]
        if kind == "delta" and turn in self.turns:
            self.turns[turn][1].append(text)
        elif kind in ("edit", "regenerate") and turn in self.turns:
            self.turns[turn] = (role or self.turns[turn][0], [text])
        else:
            self.turns[turn] = (role, [text])

    def release(self, before: int | None) -> Iterator[tuple[str, str]]:
        """Final turns below ``before`` (all if None), in order."""
        for t in sorted(self.turns):
            if before is None or t < before:
                role, pieces = self.turns.pop(t)
                yield role, "".join(pieces)


def _key(x):
    """Ids travel as strings: pandas would turn nullable longs into doubles."""
    return x if isinstance(x, str) else None


def _typed(df: DataFrame) -> DataFrame:
    return df.withColumn("conv_id", F.col("conv_id").cast("long"))


def _named(df: DataFrame) -> DataFrame:
    return df.withColumn("conv_id", F.col("conv_id").cast("string"))


class _Parts:
    """Rendered turns of one conversation as parts of about ``size`` characters."""

    def __init__(self, conv, size):
        self.conv, self.size = conv, size
        self.number, self.pieces, self.loss, self.length = 0, [], [], 0

    def add(self, role: str, text: str):
        piece, start, end = render(role, text)
        if role == TRAINED_ROLE:
            self.loss.append({"start": self.length + start, "end": self.length + end})
        self.pieces.append(piece)
        self.length += len(piece)
        if self.length >= self.size:
            yield self.flush()

    def flush(self):
        row = (self.conv, self.number, "".join(self.pieces), self.loss)
        self.number, self.pieces, self.loss, self.length = self.number + 1, [], [], 0
        return row


def _fold(part_chars: int):
    def frame(rows):
        return pd.DataFrame(rows, columns=["conv_id", "part", "text", "loss"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, log, parts, ready, held = object(), None, None, [], 0

        def close():
            for role, text in log.release(None):
                ready.extend(parts.add(role, text))
            if parts.pieces or not parts.number:
                ready.append(parts.flush())

        for batch in batches:
            for conv, kind, turn, role, text, sealed in zip(
                    *(batch[c].tolist() for c in ("conv_id", "kind", "turn", "role", "text", "sealed"))):
                conv = _key(conv)
                if conv != key:
                    if log is not None:
                        close()
                    key, log, parts = conv, Conversation(), _Parts(conv, part_chars)
                log.apply(kind, int(turn), role, text)
                if sealed:
                    for done in log.release(int(turn)):
                        ready.extend(parts.add(*done))
                if ready and sum(len(r[2]) for r in ready) >= part_chars:
                    yield frame(ready)
                    ready = []
        if log is not None:
            close()
        if ready:
            yield frame(ready)
    return run


def events_of_messages(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                       text_col: str = "text", delta_chars: int = DELTA_CHARS) -> DataFrame:
    """The log of finished messages: each opens a turn and streams its text in pieces.

    Columns conv_id, seq (an ordered struct), kind, role, text, new_turn.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = messages.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                           F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.col(text_col).alias("text"))
    rows = rows.withColumn("text", text)
    starts = F.sequence(F.lit(0), F.floor((F.greatest(F.length("text"), F.lit(1)) - 1) / delta_chars).cast("int"))
    # Repeated messages are told apart by a hash of the whole text, then by a number of their own.
    message = F.struct("turn", "role", F.sha2("text", 256).alias("digest"), F.monotonically_increasing_id().alias("copy"))
    return rows.select("conv_id", message.alias("message"), "role", "text", F.posexplode(starts).alias("i", "at")).select(
        "conv_id", F.struct("message", "i").alias("seq"), F.when(F.col("i") == 0, "open").otherwise("delta").alias("kind"),
        "role", F.substring(F.col("text"), F.col("at") * delta_chars + 1, F.lit(delta_chars)).alias("text"),
        (F.col("i") == 0).alias("new_turn"))


def format_messages(messages: DataFrame, part_chars: int = PART_CHARS, **columns) -> DataFrame:
    """Parts of the formatted conversations of a table of finished messages, sorted within their task."""
    events = events_of_messages(messages, **columns)
    ordered = events.repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    ordered = _named(ordered.select("conv_id", "kind", "role", "text", "new_turn"))
    return _typed(ordered.mapInPandas(_fold_messages(part_chars), PARTS))


def _fold_messages(part_chars: int):
    fold = _fold(part_chars)

    def number(batches):
        key, turn = object(), 0
        for batch in batches:
            turns = []
            for conv, new in zip(batch["conv_id"].tolist(), batch["new_turn"].tolist()):
                conv = _key(conv)
                if conv != key:
                    key, turn = conv, -1
                turn += bool(new)
                turns.append(turn)
            yield batch.assign(turn=turns, sealed=batch["new_turn"])

    return lambda batches: fold(number(batches))


def format_log(events: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """Parts of the formatted conversations of a log (conv_id, seq, kind, turn, role, text, sealed)."""
    turn = F.coalesce(F.col("turn").cast("long"), F.lit(FIRST_TURN))
    rows = events.select(F.col("conv_id").cast("long").alias("conv_id"), "seq", "kind", turn.alias("turn"),
                         F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
                         F.coalesce("sealed", F.lit(False)).alias("sealed"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "seq", "kind", "turn", "role", "text")
    return _typed(_named(rows.drop("seq")).mapInPandas(_fold(part_chars), PARTS))


def _read_back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    key, state = object(), None

    def row():
        conv, n, turns, loss_chars, loss, chars = state
        return conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

    for batch in batches:
        done = []
        for conv, text, spans in zip(batch["conv_id"].tolist(), batch["text"].tolist(), batch["loss"].tolist()):
            conv = _key(conv)
            if conv != key:
                if state is not None:
                    done.append(row())
                key, state = conv, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for m in _TURN.finditer(text):
                state[1] += 1
                state[2].update(f"{unescape(m.group(1))}\n{unescape(m.group(2))}\n".encode("utf-8", "surrogatepass"))
            for span in spans:
                trained = unescape(text[span["start"]:span["end"]])
                state[3] += len(trained)
                state[4].update(trained.encode("utf-8", "surrogatepass"))
            state[5] += len(text)
        if done:
            yield _digest_frame(done)
    if state is not None:
        yield _digest_frame([row()])


def _digest_frame(rows) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in DIGESTS.split(", ")])


def digests(parts: DataFrame, sort: bool = False) -> DataFrame:
    """Per conversation, what its formatted parts say when parsed again.

    ``sort``: set it for parts that were stored; parts fresh from the formatter are in order already.
    """
    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part") if sort else parts
    return _typed(_named(ordered).mapInPandas(_read_back, DIGESTS))
