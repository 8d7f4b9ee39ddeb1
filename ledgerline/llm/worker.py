"""What a Python worker keeps from task to task: the tables of one operator.

Spark gives a worker tasks of all stages, one after the other. An operator's tables stay for its own next task and go with
the first task of another one; memory that a task no longer uses goes back to the system, as idle workers stay alive.
"""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa

_kept: dict[str, dict] = {}


def kept(operator: str) -> dict:
    """The operator's tables in this worker, under its own keys; those of all others go."""
    others = [name for name in _kept if name != operator]
    for name in others:
        del _kept[name]
    if others:
        gc.collect()
        give_back()
    return _kept.setdefault(operator, {})


def give_back() -> None:
    """Free memory that Arrow's and the C library's allocators hold goes back to the system."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError, TypeError):  # not every C library has it
    _trim = None
