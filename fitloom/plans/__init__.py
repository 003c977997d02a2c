"""Queries over the given tables, grouped by theme; importing registers them."""

from fitloom.plans import evaluation, exchange, fitting, partitions, pictures, profiles, projections, texts, vectors  # noqa: F401
from fitloom.plans.registry import ORACLES, QUERIES  # noqa: F401
