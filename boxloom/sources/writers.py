"""Sinks: CSV tables with fixed fields, label text tables, one-row JSON summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_csv_fields(rows: DataFrame, fields: list[str]) -> DataFrame:
    """The fields in order as text: TRUE and FALSE, and empty for null, NaN and infinities. Missing fields are empty."""
    kinds = {f.name: f.dataType for f in rows.schema}

    def text(name):
        if name not in kinds:
            return F.lit("").alias(name)
        c = F.col(f"`{name}`")
        if isinstance(kinds[name], T.BooleanType):
            value = F.when(c, "TRUE").when(~c, "FALSE")
        elif isinstance(kinds[name], (T.DoubleType, T.FloatType)):
            value = F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c.cast("string"))
        else:
            value = c.cast("string")
        return F.coalesce(value, F.lit("")).alias(name)

    return rows.select(*map(text, fields))


def write_table_csv(rows: DataFrame, path: str, fields: list[str]) -> None:
    as_csv_fields(rows, fields).write.mode("errorifexists").csv(path, header=True, emptyValue="")


def write_summary_json(rows: DataFrame, path: str) -> None:
    """Each row as one JSON object."""
    rows.select(F.to_json(F.struct("*")).alias("value")).write.mode("errorifexists").text(path)
