"""What a Python worker keeps from task to task."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from typing import Any

MOST_KEPT = 4


def kept(key: str, make: Callable[[], Any]) -> Any:
    """`make()`, made once by a worker process for all its tasks of one key. Of several keys the last few are kept.

    Functions travel with their code, so a module's own variables are new in every task; these are held beside them."""
    module = sys.modules.setdefault("_earshot_kept", types.ModuleType("_earshot_kept"))
    held: dict[str, Any] = module.__dict__.setdefault("held", {})
    if key not in held:
        while len(held) >= MOST_KEPT:
            held.pop(next(iter(held)))
        held[key] = make()
    return held[key]
