"""Memory of Python workers, which Spark keeps and gives to the next tasks.

A step may keep large tables in a worker for its own next tasks; a step that
doesn't use them drops them, so that a worker holds one step's tables at a time.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

_drops: list[Callable[[], None]] = []
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # None: not glibc


def droppable(drop: Callable[[], None]) -> None:
    """``drop`` empties what a module keeps; it must be able to make it again."""
    _drops.append(drop)


def drop_kept() -> None:
    """Drop what earlier steps kept in this process."""
    for drop in _drops:
        drop()
    gc.collect()
    trim()


def trim() -> None:
    """Give freed memory back, which the allocator would hold."""
    if _trim:
        _trim(0)
