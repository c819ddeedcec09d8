"""Small helpers that run inside Python workers."""

from __future__ import annotations

import sys
import types


def stash(name: str) -> dict:
    """A dict that lives as long as the Python worker, across its tasks.

    Functions travel by value, so their own globals last one task only."""
    module = sys.modules.setdefault("larkspan_worker_stash", types.ModuleType("larkspan_worker_stash"))
    return module.__dict__.setdefault(name, {})


def pieces_of(batch, max_bytes: int = 1 << 23):
    """Cut an Arrow batch into slices of about `max_bytes`, never below one row,
    so that what is held as Python objects has a bound besides the longest text."""
    n = batch.num_rows
    step = max(1, min(n, int(n * max_bytes / max(batch.nbytes, 1))))
    for at in range(0, n, step):
        yield batch.slice(at, step)
