"""A thin handle on a session: statements, bound parameters, results, bulk appends, table changes."""

from .appender import Appender, ConstraintError, Constraints
from .engine import Column, column_index, columns, Engine, identifier, kind, literal, MoreThanOneRow, NoRows, NotOneChange, ParameterError, Pool, Row, split_statements

__all__ = [
    "Appender", "Column", "column_index", "columns", "ConstraintError", "Constraints", "Engine", "identifier", "kind", "literal", "MoreThanOneRow", "NoRows", "NotOneChange",
    "ParameterError", "Pool", "Row", "split_statements",
]
