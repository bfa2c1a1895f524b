"""Every operator as a runnable query over the given tables, with an independent SQL statement to check it."""

from . import aggregates, balance, monitoring, pipeline, quality, scoring, series, streams, tables  # noqa: F401
from .base import ORACLES, QUERIES  # noqa: F401
