"""Vector expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def l2_norm(vector: Column) -> Column:
    """Euclidean length of an array."""
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def l2_normalise(vector: Column) -> Column:
    """Row scaled to unit length; a zero vector stays zero.

    The norm sits in the accumulator's final step, so it is computed once per row.
    """
    return F.aggregate(
        vector,
        F.lit(0.0),
        lambda acc, x: acc + x.cast("double") * x.cast("double"),
        lambda squares: F.transform(
            vector, lambda x: F.when(squares > 0, x.cast("double") / F.sqrt(squares)).otherwise(x.cast("double"))
        ),
    )
