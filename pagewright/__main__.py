"""``python -m pagewright``: one run, with everything from environment variables.

PAGEWRIGHT_PROVIDERS names the image providers as module:attribute. The attribute
is an operators.imaging.Providers, or makes one from the settings.
"""

from __future__ import annotations

import importlib
import logging
import os
import sys
from collections.abc import Mapping

from pyspark.sql import SparkSession

from pagewright.operators.imaging import Providers
from pagewright.plans.runs import run
from pagewright.settings import Settings, read_settings


def providers_of(env: Mapping[str, str], settings: Settings) -> Providers:
    module, _, name = env.get("PAGEWRIGHT_PROVIDERS", "").partition(":")
    if not module or not name:
        raise ValueError("PAGEWRIGHT_PROVIDERS must be module:attribute")
    found = getattr(importlib.import_module(module), name)
    return found if isinstance(found, Providers) else found(settings)


def main(env: Mapping[str, str] | None = None) -> int:
    """0 after a run, 1 where the settings are bad or a storage cannot be reached."""
    env = os.environ if env is None else env
    logging.basicConfig(level=logging.INFO)
    log = logging.getLogger("pagewright")
    try:
        settings = read_settings(env)
        providers = providers_of(env, settings)
    except (ValueError, ImportError, AttributeError) as problem:
        log.error("%s", problem)
        return 1
    try:
        counts = run(SparkSession.builder.getOrCreate(), settings, providers)
    except OSError as problem:
        log.error("a storage cannot be reached: %s", problem)
        return 1
    log.info("%s", counts)
    return 0


if __name__ == "__main__":
    sys.exit(main())
