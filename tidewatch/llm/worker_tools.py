"""What a Python worker keeps from task to task: tokenizers with the words and states that they have learned.

Spark reuses its Python workers for one stage after another, and what was learned for a stage may be a few hundred MB.
So it goes when the worker begins with a stage that has no use for it.
"""

from __future__ import annotations

import gc
import sys
from collections.abc import Callable, Hashable


def _kept() -> dict:
    # A module of its own: functions that are sent to a worker bring globals of their own.
    return sys.modules.setdefault("_tidewatch_worker_tools", type(sys)("_tidewatch_worker_tools")).__dict__.setdefault(
        "tools", {}
    )


def keep[T](key: Hashable, make: Callable[[], T]) -> T:
    """The tool of that key in this worker, made when it is first asked for."""
    kept = _kept()
    if key not in kept:
        kept[key] = make()
    return kept[key]


def release() -> None:
    """Drop all tools of this worker; for tasks of stages that use none."""
    if kept := _kept():
        kept.clear()
        gc.collect()
