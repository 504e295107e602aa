"""Arrays, maps, JSON text and variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unwrap_jsonp(c: Column, callback: str) -> Column:
    """Strip ``callback( ... )`` from a landed response."""
    return F.regexp_replace(F.regexp_replace(c, rf"^{callback}\(", ""), r"\)$", "")


def first_map_value(m: Column) -> Column:
    return F.get(F.map_values(m), F.lit(0))


def pluck(array: Column, field: str) -> Column:
    """One field of every struct of an array."""
    return F.transform(array, lambda item: item[field])


def variant_field(json_text: Column, path: str, dtype: str) -> Column:
    """Typed access by path; null when the path is absent or does not fit the type."""
    return F.try_variant_get(F.try_parse_json(json_text), path, dtype)


def unnest_structs(df: DataFrame, array: str) -> DataFrame:
    """One row per struct of ``array``, its fields as columns beside the others."""
    others = [c for c in df.columns if c != array]
    return df.select(*others, F.inline(array))


def unnest_map(df: DataFrame, column: str, key: str, value: str) -> DataFrame:
    """One row per entry of a map whose keys are not known in advance."""
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.explode(column).alias(key, value))
