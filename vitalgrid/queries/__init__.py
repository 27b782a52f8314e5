"""Registered queries: every operator on the test tables, with an SQL twin where SQL can say it."""

from vitalgrid.queries import (  # noqa: F401
    anomalies,
    clusters,
    collections,
    cleaning,
    description,
    features,
    files,
    forecasts,
    names,
    nans,
    profiling,
    stages,
    times,
)
from vitalgrid.queries.registry import ORACLES, QUERIES  # noqa: F401
