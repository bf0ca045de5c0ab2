"""What a Python worker keeps from task to task.

Workers are reused by all operators of an application.  A worker keeps the prepared
objects (vocabularies, memos, indexes) of one operator at a time, and gives freed
memory back to the system when it turns to another.
"""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable
from typing import Any


def release() -> None:
    """Hand freed memory back to the system."""
    import pyarrow

    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def one_thread() -> None:
    """Matrix products of this process in one thread: tasks are the parallelism, and a local
    session sets no limit of its own."""
    if sys.__dict__.setdefault("_voxloom_threads", False):
        return
    sys._voxloom_threads = True
    try:
        with open("/proc/self/maps") as f:
            found = {line.split()[-1] for line in f if "openblas" in line}
    except OSError:  # another system
        return
    for path in found:
        library = ctypes.CDLL(path)
        for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)
                break


def keep(operator: str, key: str, build: Callable[[], Any], most: int = 1) -> Any:
    """The object under ``key``, built at need; those of other operators go, and of this one
    the ``most`` last stay."""
    slot = sys.__dict__.setdefault("_voxloom_slot", {"operator": "", "kept": {}})
    if slot["operator"] != operator:
        slot["operator"] = operator
        slot["kept"] = {}
        release()
    kept = slot["kept"]
    if key not in kept:
        while len(kept) >= most:
            kept.pop(next(iter(kept)))
        kept[key] = build()
    return kept[key]
