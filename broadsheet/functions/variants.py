"""Type-strict access to free-form JSON held as VARIANT."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip


def kind(v: Column) -> Column:
    """Schema text of a variant, null for a missing value."""
    return F.schema_of_variant(v)


def is_object(v: Column) -> Column:
    return F.coalesce(F.startswith(kind(v), F.lit("OBJECT")), F.lit(False))


def field(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "variant")


def fields(v: Column, names: Sequence[str]) -> Column:
    """Named fields of an object as one struct of variants, read in a single pass.

    Null for anything that is not an object.
    """
    return F.try_variant_get(v, "$", "struct<" + ", ".join(f"{n}: variant" for n in names) + ">")


def text(v: Column) -> Column:
    """A JSON string, stripped. Any other JSON type reads as empty, it is not cast."""
    value = F.when(kind(v) == "STRING", F.try_variant_get(v, "$", "string"))
    return F.coalesce(strip(value), F.lit(""))


def elements(v: Column, name: str) -> Column:
    """Elements of an array field as ``array<variant>``; null when it is not an array."""
    return F.try_variant_get(v, f"$.{name}", "array<variant>")
