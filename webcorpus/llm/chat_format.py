"""Conversations as training text with a loss mask, assembled column by column.

Rows arrive sorted by conversation and turn. For an Arrow batch of rows, the three segments of
each turn (header, escaped text, trailer) get their lengths, running offsets and scatter indices in
numpy; headers and texts are then copied into one preallocated buffer that becomes the Arrow
column. A conversation is one or more parts: a part ends with its conversation or with the batch,
so memory is bounded by a batch, whatever a conversation holds.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The template. Every control string begins with "<" or "[", and none holds a backslash.
CONTROLS = ("<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "[ANS]", "[ROLE]", "[/ROLE]", "[TEXT]")
MARKS = {"user": ("<s>[INST]", "[/INST]"), "assistant": ("[ANS]", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
OTHER = ("[ROLE]", "[TEXT]", "[/ROLE]")  # around the name and the text of any other role

PART = "conv_id bigint, part bigint, text string, loss array<struct<start:bigint,length:bigint>>, n_turns bigint"


def escape(texts: pa.Array) -> pa.Array:
    """Doubles backslashes and puts one behind the first character of each control string."""
    texts = pc.replace_substring(texts, "\\", "\\\\")
    for control in CONTROLS:
        texts = pc.replace_substring(texts, control, f"{control[0]}\\{control[1:]}")
    return texts


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def _bytes_and_offsets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)), offsets


def _scatter(out: np.ndarray, to: np.ndarray, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> None:
    """Copies slices of data to their places, all at once."""
    if not length.sum():
        return
    ends = np.cumsum(length)
    within = np.arange(ends[-1]) - np.repeat(ends - length, length)
    out[np.repeat(to, length) + within] = data[np.repeat(start, length) + within]


def assemble(roles: list[str | None], texts: pa.Array, group: np.ndarray) -> tuple[pa.Array, list[list[dict]]]:
    """The formatted text and loss spans of each group of rows; group counts up from 0."""
    heads, tails = [], []
    for role in roles:
        if role in MARKS:
            head, tail = MARKS[role]
        else:
            name = escape(pa.array([role or ""]))[0].as_py()
            head, tail = f"{OTHER[0]}{name}{OTHER[1]}", OTHER[2]
        heads.append(head)
        tails.append(tail)
    escaped = escape(pc.fill_null(texts, ""))
    columns = [pa.array(heads), escaped, pa.array(tails)]
    parts = [_bytes_and_offsets(c) for c in columns]
    lengths = np.stack([np.diff(offsets) for _, offsets in parts], axis=1)
    ends = np.cumsum(lengths.reshape(-1)).reshape(lengths.shape)
    out = np.empty(int(ends[-1, -1]) if len(ends) else 0, np.uint8)
    for j, (data, offsets) in enumerate(parts):
        _scatter(out, ends[:, j] - lengths[:, j], data, offsets[:-1], lengths[:, j])
    last = np.flatnonzero(np.append(group[1:] != group[:-1], True))
    bounds = np.concatenate(([0], ends[last, 2])).astype(np.int64)
    joined = pa.Array.from_buffers(
        pa.large_string(), len(last), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(out)]
    ).cast(pa.string())

    # The mask counts code points.
    chars = np.stack([pc.utf8_length(c).to_numpy().astype(np.int64) for c in columns], axis=1)
    upto = np.cumsum(chars.reshape(-1)).reshape(chars.shape)
    before = np.concatenate(([0], upto[last[:-1], 2]))
    starts = upto[:, 0] - before[group - group[0]]
    loss: list[list[dict]] = [[] for _ in last]
    for i in np.flatnonzero(np.array([r == "assistant" for r in roles])):
        loss[group[i] - group[0]].append({"start": int(starts[i]), "length": int(chars[i, 1])})
    return joined, loss


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    previous, part = object(), 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("conv_id").to_pylist()
        new = np.array([True] + [a != b for a, b in zip(ids[1:], ids)])
        group = np.cumsum(new) - 1
        texts, loss = assemble(batch.column("role").to_pylist(), batch.column("text"), group)
        firsts = np.flatnonzero(new)
        names = [ids[i] for i in firsts]
        numbers = [0] * len(names)
        if names[0] == previous:
            numbers[0] = part + 1
        previous, part = names[-1], numbers[-1]
        turns = np.diff(np.append(firsts, len(ids)))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.int64()), pa.array(numbers, pa.int64()), texts,
                pa.array(loss, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                pa.array(turns, pa.int64()),
            ],
            ["conv_id", "part", "text", "loss", "n_turns"],
        )


def format_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, text, loss, n_turns): the formatted parts of each conversation, in order.

    conversations has conv_id, turn, role and text; rows are taken by turn, rows that tie by role
    and text, repeated rows each count. The parts of a conversation joined by part are its text;
    most have one. loss are the spans of the assistant's texts, in code points of the part, start
    from 0, escaped as they stand there. Control strings inside texts and roles are escaped and
    come back with parse(). A NULL text is an empty one, a NULL role the empty role, NULL conv_id
    is one conversation of its own, NULL turns come first. Other columns are not read.
    """
    rows = conversations.select(F.col("conv_id").cast("bigint"), "turn", F.col("role").cast("string"), F.col("text").cast("string"))
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(_format, PART)


_TURN = re.compile(
    r"<s>\[INST\](?P<user>.*?)\[/INST\]|<<SYS>>(?P<system>.*?)<</SYS>>"
    r"|\[ROLE\](?P<name>.*?)\[TEXT\](?P<other>.*?)\[/ROLE\]|\[ANS\](?P<assistant>.*?)</s>",
    re.DOTALL,
)


def parse(text: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a formatted part."""
    turns, at = [], 0
    while at < len(text):
        found = _TURN.match(text, at)
        if found is None:
            raise ValueError(f"no turn at {at}")
        at = found.end()
        kind = found.lastgroup if found.lastgroup != "other" else "name"
        role = unescape(found["name"]) if kind == "name" else kind
        turns.append((role, unescape(found[kind if kind != "name" else "other"])))
    return turns


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ])
    state: list | None = None
    close = lambda s: (s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5])
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            if state is not None and (row["part"] == 0 or row["conv_id"] != state[0]):
                rows.append(close(state))
                state = None
            if state is None:
                state = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in parse(row["text"]):
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
            for span in row["loss"]:
                text = unescape(row["text"][span["start"] : span["start"] + span["length"]])
                state[3] += len(text)
                state[4].update(text.encode())
            state[5] += len(row["text"])
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)
    if state is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, close(state)))], schema=schema)


def read_back(parts: DataFrame) -> DataFrame:
    """Digests per conversation, from the formatted parts alone, which come in order per task."""
    return parts.mapInArrow(
        _digests,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )
