"""Declared models held against the rows of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harbormill.models.registry import Model


def measured_fields(df: DataFrame, model: Model) -> DataFrame:
    """One row per declared field: its type and role, whether the table has it, rows, nulls and values that do not fit its type.

    The table may be typed or landed as text. Names match in any case; a missing field counts as null in every row, and an empty
    table gives zeros. All fields are counted in one pass.
    """
    found = {c.lower(): c for c in df.columns}
    counts = [F.count(F.lit(1)).alias("total")]
    for n, f in enumerate(model.schema.fields):
        have = found.get(f.name.lower())
        if have is not None:
            value = F.col(f"`{have}`")
            counts.append(F.count(value).alias(f"filled_{n}"))
            if df.schema[have].dataType != f.dataType:
                counts.append(F.count(value.try_cast(f.dataType)).alias(f"fit_{n}"))
    measured = df.agg(*counts)
    reports = []
    for n, (f, declared) in enumerate(zip(model.schema.fields, model.fields, strict=True)):
        filled = F.col(f"filled_{n}") if f"filled_{n}" in measured.columns else F.lit(0)
        fit = F.col(f"fit_{n}") if f"fit_{n}" in measured.columns else filled
        reports.append(
            F.struct(
                F.lit(f.name).alias("field"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.lit(declared.role.kind if declared.role else "base").alias("role"),
                F.lit(f.name.lower() in found).alias("present"),
                F.col("total"),
                (F.col("total") - filled).cast("bigint").alias("nulls"),
                (filled - fit).cast("bigint").alias("unfit"),
            )
        )
    return measured.select(F.inline(F.array(*reports)))
