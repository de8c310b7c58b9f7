"""Declared layout against actual data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def schema_conformance(df: DataFrame, declared: T.StructType) -> DataFrame:
    """One row per declared column: both types, whether they agree, and how many values the declared type cannot hold.

    All columns are counted in a single aggregate; a declared column that is absent has no actual type.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    lost = [
        F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name)
        for f in declared.fields
        if f.name in actual
    ]
    rows = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("expected"),
            F.lit(actual[f.name].simpleString() if f.name in actual else None).cast("string").alias("actual"),
            F.lit(actual.get(f.name) == f.dataType).alias("ok"),
            (F.col(f.name) if f.name in actual else F.lit(None).cast("bigint")).alias("unfit_values"),
        )
        for f in declared.fields
    ]
    return df.agg(*lost).select(F.inline(F.array(*rows)))
