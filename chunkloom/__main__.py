"""``spark-submit chunkloom/__main__.py`` or ``python -m chunkloom``: a run from environment variables, with an exit code."""

from __future__ import annotations

import os
import sys
from collections.abc import Mapping

from pyspark.sql import SparkSession

from chunkloom.config import Config
from chunkloom.log import to_stderr
from chunkloom.streaming.stream import run_from


def main(env: Mapping[str, str] = os.environ, **how) -> int:
    """0 after a run that wrote every page that it could read; 1 for wrong settings, a run that broke off, or pages that were not written."""
    log = to_stderr()
    try:
        config = Config.from_env(env).validate()
    except ValueError as wrong:
        log.error("settings: %s", wrong)
        return 1
    for option, value in config.display().items():
        log.info("%s = %s", option, value)
    spark = SparkSession.builder.appName("chunkloom").getOrCreate()
    try:
        stats = run_from(spark, config, **how).first()["stats"].asDict()
    except Exception as problem:
        log.error("the run broke off: %r", problem)
        return 1
    for name, n in stats.items():
        log.info("%s: %d", name, n)
    if stats["pages_write_failed"]:
        log.error("%d pages were not written; they are set aside in %s", stats["pages_write_failed"], f"{config.output_dir}/{config.output_prefix}_dead_letters_*")
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
