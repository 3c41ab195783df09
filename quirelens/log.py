"""One logger for runs on the driver: console, and a file with the time in its name.

What happens to single rows is data (the columns success and errors, and counters of `counted`), not log lines of executors."""

from __future__ import annotations

import logging
import os
import sys
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

NAME = "quirelens"


def get_logger(level: int = logging.INFO, log_dir: str | None = None) -> logging.Logger:
    """The logger; its handlers are made by the first call that asks for them."""
    logger = logging.getLogger(NAME)
    form = logging.Formatter("[%(asctime)s] [%(levelname)s] %(message)s", "%H:%M:%S")
    if not any(type(h) is logging.StreamHandler for h in logger.handlers):
        logger.addHandler(logging.StreamHandler(sys.stdout))
    if log_dir and not log_path():
        os.makedirs(log_dir, exist_ok=True)
        logger.addHandler(logging.FileHandler(f"{log_dir}/annotation_{datetime.now():%Y%m%d_%H%M%S}.log", encoding="utf-8"))
    for h in logger.handlers:
        h.setFormatter(form)
    logger.propagate = False
    set_log_level(level)
    return logger


def set_log_level(level: int) -> None:
    logger = logging.getLogger(NAME)
    for x in (logger, *logger.handlers):
        x.setLevel(level)


def log_path() -> str | None:
    return next((h.baseFilename for h in logging.getLogger(NAME).handlers if isinstance(h, logging.FileHandler)), None)


def close_logger() -> None:
    logger = logging.getLogger(NAME)
    for h in list(logger.handlers):
        h.close()
        logger.removeHandler(h)


def counted(results: DataFrame) -> tuple[DataFrame, Observation]:
    """results with counters (total, success, failed) that are filled by whatever action runs on them."""
    seen = Observation("results")
    good = F.coalesce("success", F.lit(False))
    return results.observe(seen, F.count(F.lit(1)).alias("total"), F.count_if(good).alias("success"), F.count_if(~good).alias("failed")), seen
