"""Logging of stages and progress."""

from __future__ import annotations

import logging
import time


def logger(name: str, file: str | None = None, level: int = logging.INFO) -> logging.Logger:
    """Console and, if asked for, file logging; handlers are added once."""
    out = logging.getLogger(name)
    out.setLevel(level)
    if not out.handlers:
        for h in [logging.StreamHandler(), *([logging.FileHandler(file, encoding="utf-8")] if file else [])]:
            h.setFormatter(logging.Formatter("%(asctime)s | %(levelname)s | %(name)s | %(message)s"))
            out.addHandler(h)
    return out


def percent(current: int, total: int) -> float:
    return 100.0 * current / total if total else 0.0


class Stage:
    """Times a stage; failures are logged and raised."""

    def __init__(self, name: str, log: logging.Logger | None = None) -> None:
        self.name, self.log, self.seconds = name, log or logger("foliant"), 0.0

    def __enter__(self) -> Stage:
        self.began = time.monotonic()
        self.log.info("%s started", self.name)
        return self

    def __exit__(self, kind, error, trace) -> bool:
        self.seconds = time.monotonic() - self.began
        if kind:
            self.log.error("%s failed after %.1f s: %s", self.name, self.seconds, error)
        else:
            self.log.info("%s ended after %.1f s", self.name, self.seconds)
        return False

    def progress(self, current: int, total: int, message: str = "") -> None:
        self.log.info("%s: %d/%d (%.1f%%) %s", self.name, current, total, percent(current, total), message)
