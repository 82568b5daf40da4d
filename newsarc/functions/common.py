"""Small helpers shared by the column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, fn) -> Column:
    """Evaluate ``value`` once and hand it to ``fn`` as a lambda variable.

    A Column used twice in an expression tree is computed twice; binding it
    through a one-element ``transform`` computes it once.
    """
    return F.try_element_at(F.transform(F.array(value), fn), F.lit(1))
