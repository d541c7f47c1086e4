"""Which rows of an embedding table hold a usable vector."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def usable(vector: Column, dimension: int) -> Column:
    """Not null, of the given length, every component a finite number, not all of them zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce((F.size(vector) == dimension) & ~odd & some, F.lit(False))


def dimension_of(rows: DataFrame) -> int:
    """The commonest length of the vectors, the smaller one on a tie; 0 without any."""
    sizes = rows.filter("embedding is not null").groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n"))
    first = sizes.filter("d > 0").orderBy(F.desc("n"), "d").first()
    return first.d if first else 0


def number_type(rows: DataFrame) -> str:
    """The narrowest numpy type that holds the components exactly."""
    return "<f4" if isinstance(rows.schema["embedding"].dataType.elementType, T.FloatType) else "<f8"
