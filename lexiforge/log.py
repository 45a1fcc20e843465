"""A logger to the console and, in full, to a file."""

from __future__ import annotations

import logging


def logger(name: str, path: str | None = None) -> logging.Logger:
    """Messages from INFO on go to the console, all of them to ``path``; calling again adds nothing."""
    log = logging.getLogger(name)
    if not log.handlers:
        log.setLevel(logging.DEBUG)
        form = logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s")
        for handler, level in ((logging.StreamHandler(), logging.INFO), *(((logging.FileHandler(path, encoding="utf-8"), logging.DEBUG),) if path else ())):
            handler.setLevel(level)
            handler.setFormatter(form)
            log.addHandler(handler)
        log.propagate = False
    return log
