"""Chat formatting by columnar byte assembly, and reading the result back.

Turns are dealt by range of (conversation, turn), so a conversation of any length is
spread over tasks. A block of turns becomes bytes without a loop over turns: the lengths
of the five segments of each turn give cumulative offsets, and the offsets give the
positions to which headers, roles and texts are scattered in one preallocated Arrow
buffer. A piece is the part of a conversation in one block. The loss mask is a list of
byte spans in the piece, one for each assistant text.

Inside roles and texts, a ``<`` that any number of backslashes and a ``|`` follow gets
one backslash more, so that no control string can occur there, and loses it on the way
back; in roles, backslashes are doubled and line ends written ``\\n``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = b"<|im_start|>", b"<|im_end|>\n"
ASSISTANT = "assistant"
#: Bytes of roles and texts assembled at a time; one longer text is a block of its own.
BLOCK_BYTES = 1 << 21
#: Segments above this are copied as slices, as positions take eight bytes for each.
SLICE_BYTES = 1 << 16

_PIECES = (
    "conv_id bigint, part int, seq bigint, turns bigint, formatted string, "
    "loss array<struct<start:bigint,length:bigint>>"
)
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))


def escaped(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, r"<(\\*)\|", r"<\1\\|")


def unescaped(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, r"<(\\*)\\\|", r"<\1|")


def _escaped_roles(roles: pa.Array) -> pa.Array:
    doubled = pc.replace_substring(roles, "\\", "\\\\")
    return escaped(pc.replace_substring(doubled, "\n", "\\n"))


def _unescaped_roles(roles: pa.Array) -> pa.Array:
    # A null byte can't stand for a doubled backslash in general, so pairs go first.
    plain = unescaped(roles)
    out = []
    for role in plain.to_pylist():
        parts = role.split("\\\\")
        out.append("\\".join(p.replace("\\n", "\n") for p in parts))
    return pa.array(out, pa.string())


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The data of a string array and the length of each string."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, np.diff(offsets)


def _scatter(out: np.ndarray, to: np.ndarray, data: np.ndarray, sizes: np.ndarray) -> None:
    """Copies the i-th string of ``data`` to ``out[to[i]:]``."""
    starts = np.cumsum(sizes) - sizes
    short = sizes <= SLICE_BYTES
    n = sizes[short]
    ramp = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    out[np.repeat(to[short], n) + ramp] = data[np.repeat(starts[short], n) + ramp]
    for i in np.flatnonzero(~short):
        out[to[i] : to[i] + sizes[i]] = data[starts[i] : starts[i] + sizes[i]]


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The formatted bytes of all turns, where each turn starts and ends, and where its
    text starts and how long it is there."""
    role_data, role_sizes = _bytes_of(_escaped_roles(roles))
    text_data, text_sizes = _bytes_of(escaped(texts))
    n = len(role_sizes)
    sizes = np.column_stack(
        [np.full(n, len(START)), role_sizes, np.full(n, 1), text_sizes, np.full(n, len(END))]
    )
    ends = np.cumsum(sizes.ravel()).reshape(n, 5)
    starts = ends - sizes
    out = np.empty(int(ends[-1, -1]) if n else 0, np.uint8)
    for column, header in ((0, START), (2, b"\n"), (4, END)):
        out[starts[:, column, None] + np.arange(len(header))] = np.frombuffer(header, np.uint8)
    _scatter(out, starts[:, 1], role_data, role_sizes)
    _scatter(out, starts[:, 3], text_data, text_sizes)
    return out, np.concatenate(([0], ends[:, -1])), starts[:, 3], text_sizes


def _piece_rows(conv: pa.Array, roles: pa.Array, texts: pa.Array, part: int, seq: int) -> pa.RecordBatch:
    """One row for each run of turns of one conversation."""
    out, turn_ends, text_starts, text_sizes = assemble(roles, texts)
    ids, missing = conv.fill_null(0).to_numpy(), conv.is_null().to_numpy(zero_copy_only=False)
    new = np.ones(len(conv), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (missing[1:] != missing[:-1])
    first = np.flatnonzero(new)
    bounds = turn_ends[np.append(first, len(conv))]
    formatted = pa.LargeStringArray.from_buffers(
        len(first), pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(out)
    )
    loss = np.array(pc.equal(roles, ASSISTANT).to_pylist(), bool)
    run = np.cumsum(new) - 1
    spans = pa.StructArray.from_arrays(
        [
            pa.array((text_starts - bounds[run])[loss], pa.int64()),
            pa.array(text_sizes[loss], pa.int64()),
        ],
        fields=list(_SPANS.value_type),
    )
    losses = np.concatenate(([0], np.cumsum(np.bincount(run[loss], minlength=len(first)))))
    return pa.record_batch(
        [
            conv.take(pa.array(first)),
            pa.array(np.full(len(first), part), pa.int32()),
            pa.array(seq + np.arange(len(first)), pa.int64()),
            pa.array(np.diff(np.append(first, len(conv))), pa.int64()),
            formatted.cast(pa.string()),
            pa.ListArray.from_arrays(pa.array(losses, pa.int32()), spans),
        ],
        ["conv_id", "part", "seq", "turns", "formatted", "loss"],
    )


def format_turns(turns: DataFrame) -> DataFrame:
    """``(conv_id, part, seq, turns, formatted, loss)``: pieces of conversations.

    Ordered by (part, seq), the pieces of a conversation are its text. Turns of equal
    number are ordered by role, then text. A null text or role counts as an empty one,
    a null turn comes first, and rows without conv_id are one conversation of their
    own. Repeated rows are turns of their own. Other columns are not read; an empty
    table gives an empty table.
    """
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    keys = ["conv_id", "turn", "role", "text"]
    dealt = rows.repartitionByRange("conv_id", "turn", "role").sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = pc.binary_length(batch.column(3)).to_numpy(zero_copy_only=False)
            cuts = (np.cumsum(sizes) // BLOCK_BYTES).astype(np.int64)
            edges = [0, *(np.flatnonzero(np.diff(cuts)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                if b > a:
                    block = batch.slice(a, b - a)
                    piece = _piece_rows(block.column(0), block.column(2), block.column(3), part, seq)
                    seq += piece.num_rows
                    yield piece

    return dealt.mapInArrow(run, _PIECES)


def turns_of(formatted: str) -> tuple[list[str], list[str]]:
    """Roles and texts of a piece."""
    start, end = START.decode(), END.decode()
    turns = formatted.split(start)[1:]
    pairs = [t[: -len(end)].split("\n", 1) for t in turns]
    roles = _unescaped_roles(pa.array([p[0] for p in pairs], pa.string()))
    texts = unescaped(pa.array([p[1] for p in pairs], pa.string()))
    return roles.to_pylist(), texts.to_pylist()


def read_back(pieces: DataFrame) -> DataFrame:
    """Figures and digests of each conversation, from its pieces alone.

    The digests run over a whole conversation in order, so its pieces pass through one
    task as a sorted stream; only one piece is held at a time.
    """
    dealt = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    schema = (
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []

        def rows() -> pa.RecordBatch:
            columns = [[d[i] for d in done] for i in range(6)]
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, types)],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

        def close() -> None:
            if now:
                done.append((now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5]))

        for batch in batches:
            names = batch.schema.names
            ids, formatted, loss = (batch.column(names.index(n)) for n in ("conv_id", "formatted", "loss"))
            for conv, text, spans in zip(ids.to_pylist(), formatted, loss):
                if now is None or now[0] != conv:
                    close()
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                text = text.as_py()
                roles, texts = turns_of(text)
                now[1] += len(roles)
                now[2].update("".join(f"{r}\n{t}\n" for r, t in zip(roles, texts)).encode())
                data = text.encode()
                masked = [
                    data[s["start"] : s["start"] + s["length"]].decode() for s in spans.as_py()
                ]
                under = "".join(unescaped(pa.array(masked, pa.string())).to_pylist())
                now[3] += len(under)
                now[4].update(under.encode())
                now[5] += len(text)
            if len(done) > 1000:
                yield rows()
                done = []
        close()
        if done:
            yield rows()

    return dealt.mapInArrow(run, schema)
