"""Runs of equal keys in sorted Arrow batches, one run held at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa


def runs(batches: Iterator[pa.RecordBatch], by: Sequence[str], work: Callable) -> Iterator[pa.RecordBatch]:
    """``work`` on each run of rows with equal keys, which follow each other."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        change = np.zeros(len(batch), bool)
        for c in by:
            x = batch.column(c).to_numpy()
            change[1:] |= x[1:] != x[:-1]
            change[0] |= bool(held) and held[-1].column(c)[-1].as_py() != x[0]
        starts = np.flatnonzero(change).tolist()
        if not starts:
            held.append(batch)
            continue
        first = batch.slice(0, starts[0])
        if len(first):
            held.append(first)
        if held:
            yield from work(pa.concat_batches(held))
        for a, b in zip(starts, starts[1:], strict=False):
            yield from work(batch.slice(a, b - a))
        held = [batch.slice(starts[-1])]
    if held:
        yield from work(pa.concat_batches(held))
