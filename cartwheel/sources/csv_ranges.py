"""Records of the byte ranges of CSV files, for ``mapInArrow``. Pickled by value, so executors need not have the package."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

QUOTE = '"'
RECORDS = "file int, block long, head int, n long, record string, begins boolean, ends boolean"


class Range(NamedTuple):
    file: int       # number of the file, in the order of names
    block: int      # where the range starts
    head: int       # number of the file's header among all different ones
    inside: bool    # whether it starts inside a quoted value


def cut_records(batches: Iterator[pa.RecordBatch], ranges: dict[int, tuple]) -> Iterator[pa.RecordBatch]:
    """(key of the range, line with its line feed) of whole ranges, line by line, as records: where quotes are closed, a record
    ends. ``n`` numbers the records of a range. A part of a record that another range begins or ends is marked. Blank lines between records are none."""
    key, own, n = None, None, 0
    begins, opened, held = True, False, b""

    def emit(records: pa.Array, first_begins: bool, ends: bool) -> pa.RecordBatch:
        nonlocal n
        begun = np.ones(len(records), bool)
        begun[0] = first_begins
        if ends:
            some = pc.not_equal(pc.utf8_trim_whitespace(records), "").to_numpy(zero_copy_only=False) | ~begun
            records, begun = records.filter(pa.array(some)), begun[some]
        k = len(records)
        out = pa.RecordBatch.from_arrays(
            [pa.array(np.full(k, own.file, np.int32)), pa.array(np.full(k, own.block, np.int64)), pa.array(np.full(k, own.head, np.int32)),
             pa.array(np.arange(n, n + k)), records, pa.array(begun), pa.array(np.full(k, ends))], names=["file", "block", "head", "n", "record", "begins", "ends"])
        n += k
        return out

    for batch in batches:
        if not batch.num_rows:
            continue
        keys, lines = batch.column("key").to_numpy(), batch.column("line").cast(pa.large_string())
        offsets = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset:lines.offset + len(lines) + 1]
        data = lines.buffers()[2]
        odd = pc.count_substring(lines, QUOTE).to_numpy(zero_copy_only=False) & 1
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])).tolist()
        for s, e in zip(starts, [*starts[1:], len(keys)]):
            if keys[s] != key:
                if held:
                    yield emit(pa.array([held.decode()]), begins, False)
                key, n, held = keys[s], 0, b""
                own = Range(*ranges[int(key)])
                begins, opened = not own.inside, own.inside
            after = (np.cumsum(odd[s:e]) + opened) & 1
            closing = np.flatnonzero(after == 0)
            opened = bool(after[-1])
            if not len(closing):
                held += data[int(offsets[s]):int(offsets[e])].to_pybytes()
                continue
            bounds = np.concatenate([offsets[s:s + 1], offsets[s + closing + 1]])
            if held:
                yield emit(pa.array([(held + data[int(bounds[0]):int(bounds[1])].to_pybytes()).decode()]), begins, True)
                begins, bounds = True, bounds[1:]
            if len(bounds) > 1:
                records = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(np.ascontiguousarray(bounds)), data)
                yield emit(records.cast(pa.string()), begins, True)
                begins = True
            held = data[int(bounds[-1]):int(offsets[e])].to_pybytes()
    if held:
        yield emit(pa.array([held.decode()]), begins, False)
