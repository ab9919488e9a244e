"""Objects that a Python worker keeps between tasks: one at a time, and none while other operators run in it."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa

from . import kernel

_objects: dict = {}


def hold(key, make):
    """The object of a key, made where the worker does not hold it; all others go."""
    if key not in _objects:
        _objects.clear()
        kernel.release()
        _give_back()
        _objects[key] = make()
    return _objects[key]


def drop() -> None:
    """No object stays, and what was freed since the last task goes back."""
    if _objects:
        _objects.clear()
        gc.collect()
    trim()


def _give_back() -> None:
    gc.collect()
    trim()


def trim() -> None:
    """What this worker has freed goes back to the machine: Arrow's pool and the C library keep it otherwise."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library than glibc
        return
