"""Memory of Python workers: given back when a task's rows are done.

Workers are reused for later tasks, and allocators keep what a task has freed. On small
executors that idle memory would stand beside the next stage's."""

from __future__ import annotations

import ctypes
import functools
import gc

import pyarrow as pa


def release() -> None:
    """Return freed memory of Arrow's pool and of the C library to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # other C libraries have no such call
        return


def lean(run):
    """A generator of Arrow batches that gives memory back at its end."""

    @functools.wraps(run)
    def wrapped(batches, *args, **kwargs):
        try:
            yield from run(batches, *args, **kwargs)
        finally:
            release()

    return wrapped


def small(batches, rows: int):
    """The same rows in batches of at most ``rows``."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)
