"""What a Python worker keeps from one task to the next: one thing at a time."""

from __future__ import annotations

import gc
from collections.abc import Callable, Hashable
from typing import TypeVar

Kept = TypeVar("Kept")
_kept: dict[Hashable, object] = {}


def kept(key: Hashable, make: Callable[[], Kept]) -> Kept:
    """What ``make`` gave for this key in this process; another key lets go of it.

    Workers serve one operator after another, and their caches would add up.
    """
    if key not in _kept:
        _kept.clear()
        gc.collect()
        _kept[key] = make()
    return _kept[key]
