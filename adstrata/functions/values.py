"""Values in general."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(expression: Column) -> Column:
    """An expression computed once per row, as a generated column.

    A filter on an ordinary column is pushed below its projection with the expression copied into it, as
    many times as the filter mentions it. For a regular expression over a page that is costly.
    """
    return F.explode(F.array(expression))
