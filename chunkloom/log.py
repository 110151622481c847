"""The engine's log: driver-side messages on standard error."""

from __future__ import annotations

import logging
import sys

logger = logging.getLogger("chunkloom")


def to_stderr(level: int = logging.INFO) -> logging.Logger:
    """Write messages of ``level`` and above to standard error, once however often it is called."""
    if not logger.handlers:
        handler = logging.StreamHandler(sys.stderr)
        handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
        logger.addHandler(handler)
    logger.setLevel(level)
    return logger
