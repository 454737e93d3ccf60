"""All registered queries of the library, except those of training-data pipelines."""

from . import families, functions, relational, tasks, windows  # noqa: F401  they register themselves
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
