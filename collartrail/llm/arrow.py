"""Arrow batches of texts for Python tasks."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

BATCH_BYTES = 4_000_000


def by_bytes(
    batches: Iterable[pa.RecordBatch], most: int = BATCH_BYTES, column: str = "text"
) -> Iterator[pa.RecordBatch]:
    """Batches cut again so that each has at most ``most`` bytes of text, or one text."""
    for batch in batches:
        start = size = 0
        for i, n in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
            n = n or 0
            if i > start and size + n > most:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` with the worker's unused memory given back when it ends: workers outlive their tasks."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return wrapped


def per_worker(key: tuple, make: Callable[[], object]):
    """What ``make`` returns, made once in a Python worker and shared by all tasks it runs.

    Task functions travel by value, so their own modules start anew in each task; this does not.
    """
    store = sys.modules.setdefault("collartrail_worker", types.ModuleType("collartrail_worker")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


cloudpickle.register_pickle_by_value(sys.modules[__name__])
