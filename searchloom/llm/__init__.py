"""Operators for preparing language-model training data, and their queries."""

from __future__ import annotations

import ctypes

import pyarrow as pa

M_TRIM_THRESHOLD, M_MMAP_THRESHOLD = -1, -3  # of glibc's malloc.h
RETURNED = 1 << 18


def _give_back_memory() -> None:
    """Blocks of ``RETURNED`` bytes or more go back to the system when they are freed.

    Spark keeps a Python worker for each task and Python step that ever ran side by side. Else glibc raises this limit to
    32 MB by itself and Arrow's own pool caches what was freed, so that idle workers hold the batches of past stages.
    """
    pa.set_memory_pool(pa.system_memory_pool())
    try:
        c = ctypes.CDLL(None)
        c.mallopt(M_MMAP_THRESHOLD, RETURNED)
        c.mallopt(M_TRIM_THRESHOLD, RETURNED)
    except (OSError, AttributeError):  # another C library
        pass


_give_back_memory()
