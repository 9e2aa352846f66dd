"""Objects kept by a Python worker between its tasks.

The cache lives in this module, which workers import by name; inside a pickled function it
would travel with every task and start empty.
"""

from __future__ import annotations

from collections.abc import Callable

_KEPT: dict[str, object] = {}


def worker_cache(key: str, make: Callable[[], object]):
    """What ``make`` returned when this worker first asked for ``key``."""
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]
