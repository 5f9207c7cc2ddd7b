"""Vectorised text plumbing shared by the operators: Arrow string columns as numpy
code-point arrays and back, without a Python string per row."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def code_points(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all rows one after another, offsets of the n + 1 row bounds). Nulls count as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string())
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint32), np.zeros(1, np.int64)
    if col.null_count:
        col = col.fill_null("")
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + n + 1]
    raw = col.buffers()[2]
    raw = np.frombuffer(raw, np.uint8)[offs[0] : offs[-1]] if raw is not None else np.zeros(0, np.uint8)
    cps = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    starts = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)]) if len(raw) else np.zeros(1, np.int64)
    return cps, starts[offs - offs[0]].astype(np.int64)


def strings(cps: np.ndarray, offs: np.ndarray) -> pa.Array:
    """The inverse of code_points."""
    raw = cps.astype("<u4").tobytes().decode("utf-32-le").encode("utf-8")
    data = np.frombuffer(raw, np.uint8)
    at = np.concatenate([np.flatnonzero((data & 0xC0) != 0x80), [len(data)]]) if len(data) else np.zeros(1, np.int64)
    return pa.LargeStringArray.from_buffers(len(offs) - 1, pa.py_buffer(at[offs].astype(np.int64).tobytes()), pa.py_buffer(raw))


def batches(frame, columns, size: int):
    """Split Arrow batches so that a slice holds at most about `size` bytes of text (one row at least)."""
    for batch in frame:
        n = batch.num_rows
        if n == 0:
            continue
        total = sum(batch.column(batch.schema.get_field_index(c)).nbytes for c in columns)
        step = max(1, int(n * size / max(total, 1)))
        for i in range(0, n, step):
            yield batch.slice(i, min(step, n - i))
