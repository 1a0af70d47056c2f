"""Sorted lists of whole numbers as bytes, so that a shuffle moves about two bytes for a key; the functions are for ``mapInArrow``.

A list is its keys in ascending order, each as the difference from the one before, seven bits to a byte, the last byte of a key below 128.
A null key is a null list of its own.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Functions go to the executors by value, so that these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Pairs that a task orders by their second key at a time. More of them cost memory, and first keys that no longer fit the dictionary of a file.
HELD = 2_000_000


def _firsts(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Whether a row's value differs from that of the row before; a null equals a null."""
    values, null = np.asarray(column.fill_null(0)), np.asarray(column.is_null())
    return np.concatenate([[True], (values[1:] != values[:-1]) | (null[1:] != null[:-1])])[: len(values)]


def encode(keys: np.ndarray, first: np.ndarray) -> pa.Array:
    """Lists of ascending keys; ``first`` marks where one begins."""
    keys, starts = keys.view(np.uint64), np.flatnonzero(first)
    gaps = np.where(first, keys, keys - np.roll(keys, 1))
    size = np.ones(len(gaps), np.int64)
    for k in range(1, 10):
        size += gaps >= np.uint64(1 << 7 * k)
    ends = np.cumsum(size)
    data = np.empty(ends[-1] if len(ends) else 0, np.uint8)
    for k in range(size.max(initial=0)):
        there = size > k
        part = (gaps[there] >> np.uint64(7 * k)) & np.uint64(127)
        data[(ends - size)[there] + k] = part + np.where(size[there] > k + 1, 128, 0).astype(np.uint64)
    offsets = np.append((ends - size)[starts], len(data)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def decode(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All keys of the lists, and how many each list has (a null list: none)."""
    offsets = np.frombuffer(lists.buffers()[1], np.int32)[lists.offset : lists.offset + len(lists) + 1].astype(np.int64)
    data = np.frombuffer(lists.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    ends = np.flatnonzero(data < 128) + 1
    upto = np.searchsorted(ends, offsets - offsets[0], "right")
    if not len(ends):
        return np.empty(0, np.int64), np.diff(upto)
    starts = np.append(0, ends[:-1])
    size = ends - starts
    gaps = np.zeros(len(ends), np.uint64)
    for k in range(size.max()):
        there = slice(None) if k == 0 else size > k
        gaps[there] |= (data[starts[there] + k] & 127).astype(np.uint64) << np.uint64(7 * k)
    sums, count = np.cumsum(gaps), np.diff(upto)
    before = np.append(np.uint64(0), sums)[upto[:-1]]
    return (sums - np.repeat(before, count)).view(np.int64), count


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of an item and a key, in ascending order, as rows of an item and a list; an item of several batches has several lists."""
    for batch in batches:
        item, key = batch.columns
        new = _firsts(item)
        null = np.asarray(key.is_null())
        if null.any():
            of = item.filter(pa.array(null & (new | ~np.append(False, null[:-1]))))
            yield pa.RecordBatch.from_arrays([of, pa.nulls(len(of), pa.binary())], ["_item", "_list"])
        batch = batch.filter(pa.array(~null))
        item, key = batch.columns
        batch = batch.filter(pa.array(_firsts(item) | _firsts(key)))
        item, key = batch.columns
        first = _firsts(item)
        yield pa.RecordBatch.from_arrays([item.filter(pa.array(first)), encode(np.asarray(key), first)], ["_item", "_list"])


def _pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Each key of the first column with every key of its lists once, ordered by the latter."""
    key, first = table.column(0), _firsts(table.column(0))
    starts, run = np.flatnonzero(first), np.cumsum(first) - 1
    lists = pa.concat_arrays(table.column(1).chunks)
    values, count = decode(lists)
    run_of = np.repeat(run, count)
    least, bits = values.min(initial=0), int(run[-1]).bit_length()
    if int(values.max(initial=0)) - int(least) < 1 << 63 - bits:
        both = np.sort((values - least) << bits | run_of)
        both = both[np.append(True, both[1:] != both[:-1])[: len(both)]]
        values, run_of = (both >> bits) + least, both & (1 << bits) - 1
    else:
        by = np.lexsort((run_of, values))
        values, run_of = values[by], run_of[by]
        new = np.append(True, (values[1:] != values[:-1]) | (run_of[1:] != run_of[:-1]))
        values, run_of = values[new], run_of[new]
    none = np.unique(run[np.asarray(lists.is_null())])
    for runs, other in ((run_of, pa.array(values)), (none, pa.nulls(len(none), pa.int64()))):
        yield from pa.table({"_a": key.take(pa.array(starts[runs])), "_b": other}).to_batches(max_chunksize=100_000)


def _united(table: pa.Table) -> list[pa.RecordBatch]:
    """One key's lists as one."""
    key, lists = table.column(0).slice(0, 1).to_pylist(), pa.concat_arrays(table.column(1).chunks)
    values = np.sort(decode(lists)[0])
    values = values[np.append(True, values[1:] != values[:-1])[: len(values)]]
    one = [encode(values, np.arange(len(values)) == 0), pa.nulls(min(1, lists.null_count), pa.binary())]
    return [pa.RecordBatch.from_arrays([pa.array(key * len(x), pa.int64()), x], ["_a", "_list"]) for x in one]


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``HELD`` keys, since long lists make a batch large."""
    nth = np.cumsum(np.asarray(pc.binary_length(batch.column(1)).fill_null(0)), dtype=np.int64) // (2 * HELD)
    cuts = [0, *(np.flatnonzero(np.diff(nth)) + 1).tolist(), batch.num_rows]
    return (batch.slice(i, j - i) for i, j in zip(cuts, cuts[1:]))


def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a key and a list, those of a key in succession, as distinct pairs. A key's lists are worked on together; many are united first."""
    held, most = [], HELD
    for batch in (part for whole in batches for part in _parts(whole)):
        held.append(batch)
        if sum(b.column(1).nbytes for b in held) < 2 * most:
            continue
        table = pa.Table.from_batches(held)
        if cut := int(np.flatnonzero(_firsts(table.column(0)))[-1]):
            yield from _pairs(table.slice(0, cut))
            held, most = table.slice(cut).to_batches(), HELD
        else:
            held = _united(table)
            most = max(HELD, held[0].column(1).nbytes)
    if sum(b.num_rows for b in held):
        yield from _pairs(pa.Table.from_batches(held))
