"""Driver-side logging: plain, coloured or JSON lines, set by arguments or environment."""

from __future__ import annotations

import json
import logging
import os
import sys

COLOURS = {"DEBUG": 36, "INFO": 32, "WARNING": 33, "ERROR": 31, "CRITICAL": 35}


class JsonLines(logging.Formatter):
    """One JSON object a record, with its context."""

    def format(self, record: logging.LogRecord) -> str:
        entry = {"time": self.formatTime(record), "level": record.levelname, "logger": record.name, "message": record.getMessage()}
        entry |= getattr(record, "context", {})
        if record.exc_info:
            entry["exception"] = self.formatException(record.exc_info)
        return json.dumps(entry, ensure_ascii=False, default=str)


class Plain(logging.Formatter):
    """Readable lines, coloured on a terminal."""

    def __init__(self, colour: bool = False):
        super().__init__("%(asctime)s %(levelname)s %(name)s: %(message)s")
        self.colour = colour

    def format(self, record: logging.LogRecord) -> str:
        line = super().format(record)
        context = getattr(record, "context", {})
        if context:
            line += " [" + ", ".join(f"{k}={v}" for k, v in context.items()) + "]"
        return f"\033[{COLOURS.get(record.levelname, 0)}m{line}\033[0m" if self.colour else line


class ContextLogger(logging.LoggerAdapter):
    """``log.info("message", lines=3)``: keywords become the record's context."""

    def process(self, msg, kwargs):
        known = {k: kwargs.pop(k) for k in ("exc_info", "stack_info", "stacklevel", "extra") if k in kwargs}
        context = {**(self.extra or {}), **kwargs}
        return msg, {**known, "extra": {"context": context}}


def configure(level: str | None = None, style: str | None = None, stream=None) -> None:
    """Set up the engine's logger; FOLIOWORKS_LOG_LEVEL and FOLIOWORKS_LOG_FORMAT give the defaults."""
    level = (level or os.environ.get("FOLIOWORKS_LOG_LEVEL", "INFO")).upper()
    style = (style or os.environ.get("FOLIOWORKS_LOG_FORMAT", "text")).lower()
    stream = stream or sys.stderr
    handler = logging.StreamHandler(stream)
    handler.setFormatter(JsonLines() if style == "json" else Plain(style == "colour" or style == "text" and stream.isatty()))
    root = logging.getLogger("folioworks")
    root.handlers[:] = [handler]
    root.setLevel(level)


def get_logger(name: str, **context) -> ContextLogger:
    return ContextLogger(logging.getLogger(f"folioworks.{name}"), context)
