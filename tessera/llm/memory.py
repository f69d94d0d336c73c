"""Giving memory back: workers live on between tasks and operators, and their allocators keep what they once held."""

from __future__ import annotations

import ctypes
import functools
import inspect
import time

import pyarrow as pa

_last = 0.0


def trim(every: float = 0.0) -> None:
    """Returns free memory to the system, at most once in ``every`` seconds."""
    global _last
    if time.monotonic() - _last < every:
        return
    _last = time.monotonic()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidied(f):
    """A kernel that trims after it has run: batch iterators at their end, group functions now and then."""
    if inspect.isgeneratorfunction(f):

        @functools.wraps(f)
        def batches(it):
            yield from f(it)
            trim()

        return batches

    @functools.wraps(f)
    def group(*args):
        out = f(*args)
        trim(every=1.0)
        return out

    # Spark tells by the number of parameters whether a function wants the key
    group.__signature__ = inspect.signature(f)
    return group
