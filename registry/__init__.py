"""Registered queries: every operator over the given tables, with its SQL where SQL can say it."""

from registry import cleaning, describing, modelling, pipelines, quality, sources, testing  # noqa: F401
from registry.common import ORACLES, QUERIES  # noqa: F401
