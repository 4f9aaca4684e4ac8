"""Values observed by a write."""

from __future__ import annotations

import logging

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation

log = logging.getLogger(__name__)


def collected(obs: Observation, df: DataFrame, metrics: dict[str, Column]) -> dict:
    """Values of an observation; computed with one aggregate over ``df`` if missing.

    Adaptive execution can drop observed metrics when it replaces an
    all-empty plan; the fallback keeps the values exact.
    """
    try:
        values = dict(obs.get)
    except (PySparkException, Py4JError):
        values = {}
    if set(values) == set(metrics):
        return values
    log.warning("No metrics observed for this plan; one aggregate computes them.")
    return df.agg(*[e.alias(k) for k, e in metrics.items()]).first().asDict()
