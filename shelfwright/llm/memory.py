"""Bounded memory of what a Python worker has already encoded."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable

import pyarrow as pa


class Memory:
    """Two generations of at most about ``limit`` entries: what is asked for moves to the new one, the old one goes when that is full."""

    def __init__(self, limit: int):
        self.limit, self.new, self.old = limit, {}, {}

    def recall(self, keys: Iterable[str]) -> list[str]:
        """Make the known ones of different ``keys`` ready in ``new``; returns the others."""
        new, old = self.new, self.old
        absent = [k for k in keys if k not in new]
        known = [k for k in absent if k in old] if old else []
        if known:
            new.update({k: old[k] for k in known})
            absent = [k for k in absent if k not in new]
        return absent

    def turn(self) -> None:
        """Between batches: start a new generation if this one is full."""
        if len(self.new) >= self.limit:
            self.old, self.new = self.new, {}

    def rest(self) -> None:
        """At the end of a task: the worker's next task may be another job's."""
        self.new, self.old = {}, {}

    def fill(self, keys: list[str], make: Callable[[list[str]], dict[str, bytes]]) -> None:
        """Add what ``make`` gives for the keys that are not known."""
        absent = self.recall(keys)
        if absent:
            self.new.update(make(absent))


def release() -> None:
    """Give what a task has freed back to the system: workers live on between tasks, beside the executor's own memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library; others need none
    if trim:
        trim(0)
