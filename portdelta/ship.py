"""Python functions for executors that do not have this package installed."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def by_value(module: str) -> None:
    """Send the functions of ``module`` with their code, so a job runs without ``--py-files``."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
