"""Vector expressions over array columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def l2_norm(v: Column) -> Column:
    return F.sqrt(_total(F.transform(v, lambda x: x.cast("double") * x.cast("double"))))


def cosine(a: Column, b: Column, norm_a: Column | None = None, norm_b: Column | None = None) -> Column:
    """Cosine similarity; 0 when either vector is all zeros."""
    size = (l2_norm(a) if norm_a is None else norm_a) * (l2_norm(b) if norm_b is None else norm_b)
    return F.when(size == 0, F.lit(0.0)).otherwise(dot(a, b) / size)


def vector_to_text(v: Column) -> Column:
    """The text form vectors take in a CSV file, with a wrapped last line."""
    return F.concat(F.lit("[array(["), F.array_join(v.cast("array<string>"), ", "), F.lit("],\n      dtype=float32)]"))


def text_to_vector(c: Column) -> Column:
    """Inverse of :func:`vector_to_text`; a value that is no number becomes NULL."""
    bare = F.regexp_replace(F.replace(c, F.lit(" dtype=float32"), F.lit("")), r"[\s\x0B]", "")
    inside = F.regexp_extract(bare, r"^\[array\(\[(.*)\],?\)\]$", 1)
    return F.transform(F.split(inside, ","), lambda x: x.try_cast("float"))


def all_finite(v: Column) -> Column:
    """Whether an array holds neither NULL nor NaN nor an infinite value; NULL for no array."""
    return ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def is_vector(v: Column, dim: int) -> Column:
    """Whether ``v`` has ``dim`` finite values; false for NULL."""
    return F.coalesce((F.size(v) == dim) & all_finite(v), F.lit(False))
