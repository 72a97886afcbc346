"""Registered queries over the driver's tables, each next to the SQL it must agree with."""

from catalog import clean, contract, decisions, diagnosis, drift, features, jobs, metrics, models, monitor, registry, routing, sinks, splits  # noqa: F401
from catalog.base import QUERIES, SQL  # noqa: F401
