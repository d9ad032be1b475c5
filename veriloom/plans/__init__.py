"""Registered queries, and commands that run the pipeline over a store."""

from . import catalog, more  # noqa: F401  (each registers its queries)
from .catalog import ORACLES, QUERIES  # noqa: F401
