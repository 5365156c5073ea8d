"""What a Python worker keeps between tasks.

Spark uses a worker for tasks of any operator, one after the other.  So a worker
keeps only what the operator of its present task uses, and after a task it
gives the memory it has freed back to the system; an idle worker is then no
larger than what it keeps.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache, wraps

import pyarrow as pa

#: Caches of this process that last longer than a task.
_kept: list = []


def kept_between_tasks(build: Callable) -> Callable:
    """``build`` with its last two results kept, until a task runs that has no use for them."""
    cached = lru_cache(maxsize=2)(build)
    _kept.append(cached)
    return cached


def give_back() -> None:
    """Return freed memory to the system; the C library and Arrow would hold much of it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:  # glibc's
        trim(0)


def keep_only(uses: Sequence[Callable]) -> None:
    for cached in _kept:
        if cached not in uses and cached.cache_info().currsize:
            cached.cache_clear()
            give_back()


def lean(run: Callable, *uses: Callable) -> Callable:
    """``run``, a function for mapInArrow; other operators' caches than ``uses`` go before it, memory it has freed after it."""

    @wraps(run)
    def task(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only(uses)
        try:
            yield from run(rows)
        finally:
            give_back()

    return task
