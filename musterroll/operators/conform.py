"""Fitting rows to a declared table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OVERFLOW_COLUMN = "overflow_columns"


def _too_long(field: T.StructField) -> Column | None:
    """Longer than declared; trailing blanks do not count."""
    if not isinstance(field.dataType, T.VarcharType):
        return None
    return F.length(F.rtrim(F.col(field.name).cast("string"))) > field.dataType.length


def _shaped(df: DataFrame, field: T.StructField) -> Column:
    if field.name not in df.columns:
        value = F.lit(None)
    else:
        value = F.col(field.name)
    if isinstance(field.dataType, T.VarcharType):
        text = value.cast("string")
        return F.substring(text, 1, field.dataType.length)
    return value.cast(field.dataType)


def conform(df: DataFrame, schema: T.StructType, on_overflow: str = "raise") -> DataFrame:
    """Select the declared columns with their types; missing ones become NULL.

    Oversize text fails the job (``raise``) or is named per row in an extra array
    column and left whole (``quarantine``), for ``split_overflow`` to route. The
    error names the column and its limit, never the value.
    """
    present = [f for f in schema if f.name in df.columns]
    checks = {f.name: test for f in present if (test := _too_long(f)) is not None}
    if on_overflow == "raise":
        columns = []
        for field in schema:
            shaped = _shaped(df, field)
            if field.name in checks:
                problem = f"{field.name} is longer than {field.dataType.length} characters"
                shaped = F.when(checks[field.name], F.raise_error(F.lit(problem))).otherwise(shaped)
            columns.append(shaped.alias(field.name))
        return df.select(*columns)
    if on_overflow != "quarantine":
        raise ValueError("on_overflow must be 'raise' or 'quarantine'")
    found = F.filter(
        F.array(*[F.when(test, F.lit(name)) for name, test in checks.items()])
        if checks
        else F.array().cast("array<string>"),
        lambda item: item.isNotNull(),
    )
    columns = []
    for field in schema:
        shaped = _shaped(df, field)
        if field.name in checks:
            shaped = F.when(checks[field.name], F.col(field.name).cast("string")).otherwise(shaped)
        columns.append(shaped.alias(field.name))
    return df.select(*columns, found.alias(OVERFLOW_COLUMN))


def split_overflow(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that fit (without the extra column) and rows that do not."""
    fits = F.size(OVERFLOW_COLUMN) == 0
    return df.where(fits).drop(OVERFLOW_COLUMN), df.where(~fits)
