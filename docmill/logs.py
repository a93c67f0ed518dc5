"""Log records of the driver as one JSON object a line, like the event logs that the engine reads."""

from __future__ import annotations

import json
import logging
import sys
from datetime import datetime, timezone

_PLAIN = frozenset(vars(logging.makeLogRecord({}))) | {"message", "taskName"}


class JsonLines(logging.Formatter):
    """ts, level, logger, msg, what was passed as ``extra``, and exc; values of any type, letters of any script."""

    def format(self, record: logging.LogRecord) -> str:
        when = datetime.fromtimestamp(record.created, timezone.utc).isoformat(timespec="milliseconds")
        line = {"ts": when, "level": record.levelname, "logger": record.name, "msg": record.getMessage()}
        line |= {k: v for k, v in vars(record).items() if k not in _PLAIN and not k.startswith("_")}
        if record.exc_info:
            line["exc"] = self.formatException(record.exc_info)
        return json.dumps(line, default=str, ensure_ascii=False)


def log_as_json(level: str = "INFO", stream=None) -> logging.Logger:
    """Make the root logger write JSON lines; again and again is the same as once."""
    root = logging.getLogger()
    if not any(isinstance(h.formatter, JsonLines) for h in root.handlers):
        handler = logging.StreamHandler(stream or sys.stdout)
        handler.setFormatter(JsonLines())
        root.handlers[:] = [handler]
    number = logging.getLevelNamesMapping().get(level.upper(), logging.INFO)
    root.setLevel(number)
    return root
