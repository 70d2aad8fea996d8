"""Binding a value once within an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once a row however often body uses it.

    The optimizer may inline a projected column into every use; a lambda variable it does not.
    """
    return F.transform(F.array(value), body)[0]
