"""What a Python worker remembers from task to task: one object, so that memory does not add up over operators."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

T = TypeVar("T")
_held: list[tuple[object, object]] = []


def remembered(key: object, build: Callable[[], T]) -> T:
    """The worker's object for ``key``, built when another was held; a worker outlives its tasks."""
    if not _held or _held[0][0] != key:
        _held.clear()
        _held.append((key, build()))
    return _held[0][1]
