"""Column objects by exact name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.scalars import name


def quoted(column: str) -> Column:
    """Column by exact name, whatever characters the name holds."""
    return F.col(name(column))
