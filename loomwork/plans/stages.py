"""Stages in a fixed order, timed; the first failure stops the run."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass


@dataclass(frozen=True)
class Stage:
    name: str
    work: Callable[[], object]
    online: bool = False


def run(stages: Sequence[Stage], offline: bool = False, dry: bool = False) -> list[tuple[str, str, float]]:
    """(name, done, skipped or planned, seconds) of each stage; errors pass through."""
    report = []
    for s in stages:
        began = time.monotonic()
        status = "skipped" if offline and s.online else "planned" if dry else "done"
        if status == "done":
            s.work()
        report.append((s.name, status, time.monotonic() - began))
    return report
