"""What a Python worker keeps between tasks."""

from __future__ import annotations

import sys
import types


def kept_in_worker(name: str) -> dict:
    """A dictionary that lives as long as the worker. Functions travel by value, so a module global would start empty in every task."""
    module = sys.modules.setdefault("_harbormill_kept", types.ModuleType("_harbormill_kept"))
    return module.__dict__.setdefault(name, {})
