"""Small groups inside a sorted partition, as Arrow tables, and spanning stars of a closeness matrix."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str], least: int = 1) -> Iterator[pa.Table]:
    """The groups of at least ``least`` rows of a partition sorted by ``keys``; holds one batch and one open group."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        here = pa.Table.from_batches([batch])
        rest = here if rest is None else pa.concat_tables([rest, here]).combine_chunks()
        change = np.zeros(rest.num_rows, dtype=bool)
        for k in keys:
            values = rest.column(k).to_numpy()
            change[1:] |= values[1:] != values[:-1]
        edges = np.concatenate([[0], np.flatnonzero(change)])
        for at in np.flatnonzero(np.diff(edges) >= least):
            yield rest.slice(edges[at], edges[at + 1] - edges[at])
        rest = rest.slice(edges[-1])
    if rest is not None and rest.num_rows >= least:
        yield rest


def stars(member: np.ndarray, close: np.ndarray) -> pa.RecordBatch:
    """Edges (a, b) from every member to the least member it can reach by ``close`` (a symmetric matrix with its diagonal)."""
    n = len(member)
    label = np.arange(n)
    while True:
        low = np.where(close, label[None, :], n).min(axis=1)
        low = np.minimum(low, label)[low] if n else low
        low = np.minimum(low, label)
        if (low == label).all():
            break
        label = low
    moved = np.flatnonzero(label != np.arange(n))
    return pa.RecordBatch.from_arrays([pa.array(member[label[moved]]), pa.array(member[moved])], names=["a", "b"])
